"""Splice predictions: sub-field parsing, summaries, integration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.functions.variants import number


def parse_spliceai(vcf: DataFrame) -> DataFrame:
    """(VARIANT_ID, INFO) rows to one row per predicted allele and gene.

    The first ``SpliceAI=`` entry of INFO holds comma-separated records of at
    least ten pipe-separated fields.
    """
    entry = F.regexp_extract(F.col("INFO"), r"(?:^|;)SpliceAI=([^;]*)", 1)
    records = vcf.select("VARIANT_ID", F.explode(F.split(entry, ",")).alias("_ITEM")).select(
        "VARIANT_ID", F.split("_ITEM", r"\|").alias("_F")
    ).filter(F.size("_F") >= 10)
    names = ["DS_AG", "DS_AL", "DS_DG", "DS_DL"]
    field = lambda i: F.get("_F", F.lit(i))
    scores = {name: F.when(~field(i).isin("", "."), number(field(i))) for i, name in enumerate(names, start=2)}
    distances = {name.replace("DS", "DP"): field(i) for i, name in enumerate(names, start=6)}
    return records.select(
        "VARIANT_ID", field(0).alias("ALLELE"), field(1).alias("GENE"),
        *[expr.alias(name) for name, expr in {**scores, **distances}.items()], "_F",
    ).drop("_F").withColumn("SPLICEAI_MAX", F.greatest(*names))


def parse_pangolin(rows: DataFrame) -> DataFrame:
    """(VARIANT_ID, PREDICTIONS) rows to gain, loss and the larger absolute score."""
    items = rows.select("VARIANT_ID", F.explode(F.split("PREDICTIONS", ",")).alias("_ITEM")).select(
        "VARIANT_ID", F.split("_ITEM", r"\|").alias("_F")
    ).filter(F.size("_F") >= 3)

    def score(i: int) -> Column:
        return number(F.substring_index(F.get("_F", F.lit(i)), ":", -1))

    return items.select(
        "VARIANT_ID", F.get("_F", F.lit(0)).alias("GENE"), score(1).alias("PANGOLIN_GAIN"), score(2).alias("PANGOLIN_LOSS")
    ).withColumn("PANGOLIN_SCORE", F.greatest(F.abs("PANGOLIN_GAIN"), F.abs("PANGOLIN_LOSS")))


def summarise(predictions: DataFrame, score: str, genes: str = "SPLICE_GENES") -> DataFrame:
    """Largest score per variant and its sorted distinct genes.

    The gene list has its own name: it is an array and must not become a join
    key against a single gene.
    """
    return predictions.groupBy("VARIANT_ID").agg(
        F.max(score).alias(score), F.array_sort(F.collect_set("GENE")).alias(genes)
    )


def integrate_splicing(spliceai: DataFrame, pangolin: DataFrame) -> DataFrame:
    """Full outer join of the two predictors on the variant."""
    clash = (set(spliceai.columns) & set(pangolin.columns)) - {"VARIANT_ID"}
    return spliceai.join(pangolin.withColumnsRenamed({c: f"{c}_right" for c in clash}), "VARIANT_ID", "full_outer")


def unscored(variants: DataFrame, summary: DataFrame) -> DataFrame:
    return variants.join(summary.select("VARIANT_ID"), "VARIANT_ID", "left_anti")
