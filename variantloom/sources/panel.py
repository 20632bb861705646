"""Panel variants as a table partitioned by population and chromosome."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantloom.sinks.export import write_clustered

INDEX = "POPULATION string, CHR string, POS bigint, ID string, REF string, ALT string"
BIN_BP = 1_000_000
BROADCAST_LOCI = 200_000  # rows of some fifty bytes; beyond that loci are shuffled like any table


def write_panel(index: DataFrame, path: str) -> str:
    """Store panel variants; within a partition files are ranges of positions."""
    return write_clustered(index.select(*[c.split()[0] for c in INDEX.split(", ")]), path, ["POPULATION", "CHR", "POS"], partition_by=("POPULATION", "CHR"))


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(path)


def region_variants(panel: DataFrame, loci: DataFrame) -> DataFrame:
    """Panel variants inside each locus (LOCUS_ID, POPULATION, CHR, START, END), ends included.

    A locus asks for the bins it touches, so this is an equi join on population,
    chromosome and bin.  Loci are counted; few enough are broadcast, and Spark then reads
    only the partitions of their populations and chromosomes.
    """
    spans = loci.filter(F.col("END") >= F.col("START")).select(
        "LOCUS_ID", "POPULATION", "CHR", "START", "END", F.explode(F.sequence(F.expr(f"START div {BIN_BP}"), F.expr(f"END div {BIN_BP}"))).alias("_BIN")
    )
    side = F.broadcast(spans) if loci.count() <= BROADCAST_LOCI else spans
    met = panel.withColumn("_BIN", F.expr(f"POS div {BIN_BP}")).join(side, ["POPULATION", "CHR", "_BIN"])
    return met.filter(F.col("POS").between(F.col("START"), F.col("END"))).select("LOCUS_ID", *panel.columns)
