"""Prefix trie of conversations by van Emde Boas recursion.

A conversation is a sequence of turns, a turn being (role, text).  Every different
sequence of first d turns is a node of depth d; the textless root has depth 0.

*Cut.*  A trie of height 2h is cut at depth h.  What a sequence has above the cut goes
into the upper trie, what it has below into the lower forest that hangs from its cut
prefix.  The prefix is named by a digest of the name of the forest it starts in and the
turns up to the cut, so the same prefix has the same name in every task and naming
needs no shuffle.  Upper tries and lower forests have the same height and are rows of
one table, so each level of the recursion is one projection over all of them; after
log2(height) levels every row is one turn with the name of its node.

*Graft.*  The recursion leaves with every turn two short lists, one entry a level at the
most: the cuts above it (the forests that hold it) and the cuts at or below it (the lower
forests that hang from its upper trie).  Any two nodes on one path are parted by exactly
one cut.  So the total of each lower forest is one aggregate over the nodes under its
cut, and the total of a subtree is the node's own value plus the totals of the forests
whose cuts lie at or below it: n log(height) rows in all, where adding every node to all
its ancestors would take n times the height.

Equal conversations are one sequence with a weight before the recursion starts, and all
steps are partial aggregates and equi joins, so a hot conversation or a hot first turn
costs one row a task.  Texts are never shuffled, only digests of 32 characters.  The
digests of one conversation are held in one row; its texts are not.  The ids that end
at a node are hashed in ascending order over sorted batches, so that no list of them is
ever held; pieces of the list are joined in parallel first and only they meet in the
task that hashes a node's list.

Defined cases: null role and null text are empty; turns are ordered by turn, nulls
first, and equal turns by the digest of role and text; repeated rows are turns of their
own; rows without a conversation id belong to no conversation and are left out; a
conversation without turns is a member of the root; a very long text is one digest; an
empty table has no nodes; other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby, islice
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.llm.common import Stored

ROOT = ""
PIECE_IDS = 20_000  # ids in one piece of a node's list


def turn_digest(role: Column, text: Column) -> Column:
    """128-bit identity of a turn; the length keeps role and text apart."""
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))


def sequences(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turns): the ordered turns (item, bytes) of every conversation."""
    clean = turns.filter(turns[conv_id].isNotNull()).select(
        turns[conv_id].alias("conv"), turns[turn].alias("at"), F.coalesce(turns[role], F.lit("")).alias("r"), F.coalesce(turns[text], F.lit("")).alias("t")
    )
    told = clean.select("conv", F.struct("at", turn_digest(F.col("r"), F.col("t")).alias("item"), F.octet_length("t").cast("long").alias("bytes")).alias("x"))
    ordered = told.groupBy("conv").agg(F.sort_array(F.collect_list("x")).alias("x"))
    return ordered.select("conv", F.transform("x", lambda x: F.struct(x["item"].alias("item"), x["bytes"].alias("bytes"))).alias("turns"))


def _cut(segments: DataFrame, h: int) -> DataFrame:
    """Every segment of up to 2h turns as its part above the cut and its part below."""
    items = lambda turns: F.array_join(F.transform(turns, lambda t: t["item"]), "")
    head = F.slice("turns", 1, h)
    size = F.size("turns")
    named = segments.withColumn("cut", F.when(size >= h, F.md5(F.concat(F.element_at("forests", -1), items(head)))))
    # The segment ends at its cut: then the cut is its last node, and nothing hangs from it here.
    whole = F.struct("start", F.col("turns").alias("turns"), "forests", "grafts", F.coalesce("last", "cut").alias("last"), "ends")
    upper = F.struct("start", head.alias("turns"), "forests", F.concat("grafts", F.array("cut")).alias("grafts"), F.col("cut").alias("last"), F.lit(False).alias("ends"))
    lower = F.struct(
        (F.col("start") + h).alias("start"), F.slice("turns", F.lit(h + 1), F.greatest(size - h, F.lit(0))).alias("turns"),
        F.concat("forests", F.array("cut")).alias("forests"), "grafts", "last", "ends",
    )
    return named.select("first", "weight", F.inline(F.when(size > h, F.array(upper, lower)).otherwise(F.array(whole))))


def recurse(classes: DataFrame, height: int) -> DataFrame:
    """One row for each turn of each sequence of ``classes`` (first, weight, turns), named and tied to its cuts.

    (first, weight, depth, bytes, name, forests, grafts, ends): ``forests`` are the cuts
    above, from the root to the parent, ``grafts`` those at or below; ``ends`` marks the
    last turn of a sequence.
    """
    none = F.array().cast("array<string>")
    segments = classes.filter(F.size("turns") > 0).select(
        "first", "weight", F.lit(0).alias("start"), "turns", F.array(F.lit(ROOT)).alias("forests"), none.alias("grafts"),
        F.lit(None).cast("string").alias("last"), F.lit(True).alias("ends"),
    )
    h = 1
    while 2 * h <= height:
        h *= 2
    while h:  # 2h is above the height at first, so that every node becomes the cut of some level
        segments, h = _cut(segments, h), h // 2
    turn = F.element_at("turns", 1)
    return segments.select("first", "weight", (F.col("start") + 1).alias("depth"), turn["bytes"].alias("bytes"), F.col("last").alias("name"), "forests", "grafts", "ends")


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of sorted (name, conv) as joined lists of bounded size."""
    for batch in batches:
        rows = []
        for name, run in groupby(zip(batch["name"], batch["conv"]), itemgetter(0)):
            while ids := [conv for _, conv in islice(run, PIECE_IDS)]:
                rows.append((name, ids[0], ",".join(map(str, ids))))
        yield pd.DataFrame(rows, columns=["name", "low", "ids"])


def _hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 over the pieces of every name, which come in order."""
    name, state = None, None
    for batch in batches:
        done = []
        for at, ids in zip(batch["name"], batch["ids"]):
            if at != name:
                if state is not None:
                    done.append((name, state.hexdigest()))
                name, state = at, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pd.DataFrame(done, columns=["name", "ends_sha256"])
    if state is not None:
        yield pd.DataFrame([(name, state.hexdigest())], columns=["name", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(name, ends_sha256) from (name, conv): digest of each name's ids, ascending and joined by commas."""
    spread = ends.repartitionByRange("name", "conv").sortWithinPartitions("name", "conv")
    kind = ends.schema["conv"].dataType.simpleString()
    pieces = spread.mapInPandas(_pieces, f"name string, low {kind}, ids string")
    return pieces.repartition("name").sortWithinPartitions("name", "low").mapInPandas(_hashes, "name string, ends_sha256 string")


def prefix_trie(seqs: DataFrame) -> DataFrame:
    """Every node of the trie of ``seqs`` (conv, turns), with its members and the totals of its subtree.

    (conv, depth, parent, n_convs, n_children, n_leaves, saved, ends_sha256): ``conv`` is
    the smallest member and names the node together with the depth.
    """
    kept = Stored(seqs.select("conv", "turns", F.md5(F.array_join(F.transform("turns", lambda t: t["item"]), "")).alias("whole"))).frame
    classes = Stored(kept.groupBy("whole", "turns").agg(F.min("conv").alias("first"), F.count(F.lit(1)).alias("weight"))).frame
    height = classes.agg(F.max(F.size("turns"))).first()[0] or 0
    turns = recurse(classes, height)

    nodes = turns.groupBy("name", "forests", "depth", "bytes").agg(
        F.min("first").alias("conv"), F.sum("weight").alias("n_convs"), F.min("ends").alias("leaf")
    )
    root = classes.agg(F.min("first").alias("conv"), F.sum("weight").alias("n_convs")).filter("n_convs > 0")
    own = (F.col("n_convs") - 1) * F.col("bytes")
    nodes = Stored(nodes.select("name", "forests", "depth", "conv", "n_convs", "leaf", own.alias("saved"))).frame

    # The lower forest of every cut: what lies under it, and how many of its nodes are children of the cut.
    under = nodes.select("saved", "leaf", F.posexplode("forests").alias("k", "cut"), F.size("forests").alias("n"))
    forests = under.groupBy("cut").agg(
        F.sum("saved").alias("saved"), F.sum(F.col("leaf").cast("long")).alias("leaves"), F.sum((F.col("k") == F.col("n") - 1).cast("long")).alias("children")
    )
    forests = Stored(forests).frame
    grafts = turns.select("name", F.explode("grafts").alias("cut")).distinct().join(forests, "cut")
    gained = grafts.groupBy("name").agg(
        F.sum("saved").alias("more_saved"), F.sum("leaves").alias("more_leaves"), F.max(F.when(F.col("cut") == F.col("name"), F.col("children"))).alias("children")
    )
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    inner = nodes.join(gained, "name", "left").select(
        "name", F.element_at("forests", -1).alias("above"), "depth", "conv", "n_convs", zero(F.col("children")).alias("n_children"),
        (F.col("leaf").cast("long") + zero(F.col("more_leaves"))).alias("n_leaves"), (F.col("saved") + zero(F.col("more_saved"))).alias("saved"),
    )
    # One row of the root's members and one of what hangs from it.
    ends = root.select(F.lit(ROOT).alias("name"), "conv", "n_convs").unionByName(
        forests.filter(F.col("cut") == ROOT).withColumnRenamed("cut", "name"), allowMissingColumns=True
    )
    top = ends.groupBy("name").agg(
        F.lit(None).cast("string").alias("above"), F.lit(0).alias("depth"), F.max("conv").alias("conv"), F.max("n_convs").alias("n_convs"),
        zero(F.max("children")).alias("n_children"), F.coalesce(F.max("leaves"), F.lit(1).cast("long")).alias("n_leaves"), zero(F.max("saved")).alias("saved"),
    )
    trie = Stored(inner.unionByName(top)).frame

    last = turns.filter("ends").select("first", "name")
    of_class = classes.filter(F.size("turns") == 0).select("first", F.lit(ROOT).alias("name")).unionByName(last)
    members = kept.join(classes.select("whole", "turns", "first"), ["whole", "turns"]).select("conv", "first").join(of_class, "first")
    digests = end_digests(members.select("name", "conv"))
    above = trie.select(F.col("name").alias("above"), F.col("conv").alias("parent"))
    return trie.join(above, "above", "left").join(digests, "name", "left").select(
        "conv", F.col("depth").cast("long").alias("depth"), "parent", "n_convs", "n_children", "n_leaves", "saved",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv, turns): every conversation c with its first h turns taken from conversation c - c % 5, h = crc32(c) % 9."""
    own = Stored(sequences(turns)).frame
    base = own.filter(F.col("conv") % 5 == 0).select(F.col("conv").alias("base"), F.slice("turns", 1, 8).alias("lent"))
    h = (F.crc32(F.col("conv").cast("string")) % 9).cast("int")
    told = own.withColumn("base", F.col("conv") - F.col("conv") % 5).withColumn("h", h).join(base, "base", "left")
    start = F.when(F.col("lent").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("lent", F.lit(1), F.col("h")))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return told.select("conv", F.concat(start, rest).alias("turns"))
