"""Shared-variant screen of fine-mapping against QTL probabilities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantloom.functions.statistics import any_of, screen_class

PAIR_KEYS = ("LOCUS_ID", "POPULATION", "GENE", "TISSUE", "QTL_TYPE")


def variant_screen(finemapped: DataFrame, qtl: DataFrame, cross_ancestry: DataFrame | None = None) -> DataFrame:
    """Exact-allele overlap with vCLPP = GWAS PIP x QTL PIP and its class."""
    left = finemapped.select("VARIANT_ID", "LOCUS_ID", "POPULATION", F.col("PIP").alias("GWAS_PIP"))
    if cross_ancestry is not None:
        one = cross_ancestry.groupBy("VARIANT_ID").agg(F.max("CROSS_ANCESTRY_PIP").alias("CROSS_ANCESTRY_PIP"))
        left = left.join(one, "VARIANT_ID", "left")
    overlap = left.join(qtl, "VARIANT_ID").withColumn("vCLPP", F.col("GWAS_PIP") * F.col("QTL_PIP"))
    return overlap.withColumn("SCREEN_CLASS", screen_class("vCLPP"))


def pair_screen(overlap: DataFrame) -> DataFrame:
    """LCLPP per locus, population, gene, tissue and QTL type; rows without a QTL PIP are counted apart."""
    return overlap.groupBy(*PAIR_KEYS).agg(
        any_of(F.col("vCLPP")).alias("LCLPP"),
        F.max("vCLPP").alias("MAX_vCLPP"),
        F.count("*").alias("N_MATCHING_VARIANTS"),
        F.sum(F.col("vCLPP").isNull().cast("bigint")).alias("N_NULL_PIP"),
        F.min_by("VARIANT_ID", F.struct((-F.coalesce("vCLPP", F.lit(-1.0))).alias("S"), F.col("VARIANT_ID"))).alias("TOP_VARIANT"),
    )


def gene_summary(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("GENE").agg(F.max("LCLPP").alias("LCLPP"), F.count("*").alias("N_PAIRS"))


def locus_summary(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("LOCUS_ID").agg(F.max("LCLPP").alias("LCLPP"), F.count("*").alias("N_PAIRS"))


def top_candidates(pairs: DataFrame, n: int = 100) -> DataFrame:
    """The n best pairs: a distributed top-k, not a sort."""
    return pairs.orderBy(F.col("LCLPP").desc(), *[F.col(k).asc_nulls_last() for k in PAIR_KEYS]).limit(n)
