"""Connected components of a table of links, by contraction to smallest neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantloom.llm.common import Stored

FEW_LINKS = 100_000  # of 16 bytes each


def components(links: DataFrame) -> DataFrame:
    """(v, c) for every end of a link (u, v): the smallest vertex reachable from it.

    In each round every vertex takes the name of its smallest neighbour, if that is
    smaller, and links are rewritten between the new names.  The smallest vertex of a
    component keeps its name, so it is what remains.  With names in no order along the
    links, as hashes are, a round leaves about a third of the vertices.  All steps are
    partial aggregates and joins over stored tables: nothing is gathered, whatever the
    number of links of a vertex.  Once at most ``FEW_LINKS`` are left, far less than one
    task's share of a large table, a round is one partition that needs no shuffle.
    """
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    edges = Stored(both.filter("u <> v").distinct())
    labels = Stored(both.select("v", F.col("v").alias("c")).distinct())
    while left := edges.frame.count():
        few = left <= FEW_LINKS
        links = edges.frame.coalesce(1) if few else edges.frame
        lower = links.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("to"))
        of = lambda name, to: lower.select(F.col("v").alias(name), F.col("to").alias(to))
        moved = links.join(of("u", "x"), "u").join(of("v", "y"), "v").filter("x <> y")
        names = F.broadcast(of("c", "to")) if few else of("c", "to")
        renamed = Stored(labels.frame.join(names, "c", "left").select("v", F.coalesce("to", "c").alias("c")))
        contracted = Stored(moved.select(F.col("x").alias("u"), F.col("y").alias("v")).distinct())
        for old in (labels, edges):
            old.drop()
        labels, edges = renamed, contracted
    edges.drop()
    return labels.frame
