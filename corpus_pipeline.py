"""Corpus pipeline: quality rules, line dedup, near duplicates, decontamination, encoding.

Every stage takes the documents that the one before kept and is written as Parquet in
the shared folder before the next reads it.  All but the last give the columns of
documents.  A document whose every line an earlier document has leaves with the line
stage, since nothing of it is left to train on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantloom.llm import decontaminate, line_dedup, ngram_jaccard, piece_sampling, quality_rules
from variantloom.llm.common import Stored, free_name, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    verdict = free_name(docs, "quality")
    return quality_rules.judge(docs, "text", column=verdict).filter(F.col(verdict).getField("kept")).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand earlier; ``n_chars`` follows the new text."""
    done = line_dedup.dedup_lines(docs, "doc_id", "text")
    lines, removed = done.columns[-2:]
    left = done.filter((F.col(lines) == 0) | (F.col(lines) > F.col(removed)))
    return left.select(*(F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of similar ones."""
    return ngram_jaccard.keep_one(docs, "doc_id", "text", width=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), "doc_id", "text", "item_id", "text")


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with sampled pieces, which decode to the text."""
    return piece_sampling.encode_column(docs, "doc_id", "text", "piece_ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("sentencepiece", encoding_stage),
]

# Sampled segmentation has no SQL form; tests hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each over the stored result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = Stored(stage(spark, docs, sf_dir)).frame
    return docs
