"""Report tables: small queries over the finished stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def top_evidence(evidence: DataFrame, n: int = 50) -> DataFrame:
    """The n best rows by priority: a distributed top-k."""
    ties = [c for c in ("VARIANT_ID", "POPULATION", "LOCUS_ID", "GENE", "TISSUE", "QTL_TYPE") if c in evidence.columns]
    return evidence.orderBy(F.col("PRIORITY_SCORE").desc(), *[F.col(c).asc_nulls_last() for c in ties]).limit(n)


def report_summary(evidence: DataFrame, qtl: DataFrame, failures: DataFrame, phenotype: str, run_id: str) -> DataFrame:
    """One row: evidence rows, tissues represented, failed loci."""
    rows = evidence.agg(F.count("*").alias("evidence_rows"))
    tissues = qtl.agg(F.count_distinct("TISSUE").alias("qtl_tissues"))
    failed = failures.agg(F.count("*").alias("failed_loci"))
    return (
        rows.withColumn("_K", F.lit(1)).join(tissues.withColumn("_K", F.lit(1)), "_K").join(failed.withColumn("_K", F.lit(1)), "_K")
        .select(F.lit(phenotype).alias("phenotype"), F.lit(run_id).alias("run_id"), "evidence_rows", "qtl_tissues", "failed_loci")
    )


def report_tables(
    selection: DataFrame, comparison: DataFrame, evidence: DataFrame, qtl: DataFrame, failures: DataFrame,
    phenotype: str, run_id: str = "run", top_n: int = 50,
) -> dict[str, DataFrame]:
    """The tables of a report, whole; only the evidence list is a top-n, by its score."""
    return {
        "selection": selection,
        "comparison": comparison,
        "top_evidence": top_evidence(evidence, top_n),
        "qtl": qtl,
        "failures": failures,
        "summary": report_summary(evidence, qtl, failures, phenotype, run_id),
    }
