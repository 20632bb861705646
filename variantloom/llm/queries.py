"""Registered queries of the numbered operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantloom.llm import chat_format, collocations, decontaminate, language_id, license_scan, line_dedup, minhash, ngram_jaccard, piece_sampling, pii, prefix_trie, quality_rules, toxicity
from variantloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(docs["doc_id"].cast("string")) % 4
    network = language_id.train(docs, fold != 2)
    named = language_id.identify(docs.select("doc_id", "text"), network)
    return named.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the quality rules for every document."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), "text").select("doc_id", "quality.*")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_upper", "base_failed", "kept",
        F.concat_ws(",", "failed").alias("failed_rules"),
    )


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recognised licence sentences and the licences they make up, for every document."""
    found = license_scan.scan(table(spark, sf_dir, "documents"), "text").select("doc_id", "license.*")
    listed = [F.concat_ws(",", c).alias(c) for c in ("sentences", "licenses", "unresolved")]
    return found.select("doc_id", F.size("sentences").cast("long").alias("n_sentences"), *listed)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans and all spans of personal data of every document."""
    spans = pii.span_texts(pii.detect(table(spark, sf_dir, "documents")))
    return spans.select(F.col("id").alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier line repeats within one word edit."""
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), "doc_id", "text")
    return done.select("doc_id", "n_lines", "n_removed", "text")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled pieces of every document, and whether they decode to its text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = piece_sampling.decode_column(piece_sampling.encode_column(docs, "doc_id", "text"))
    return pieces.select("doc_id", "piece_ids", F.size("piece_ids").cast("long").alias("n_pieces"), F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that overlap, with the best window and the number of places."""
    found = decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "best_words", "n_places")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt from the labelled rows that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = lambda df: F.crc32(df["doc_id"].cast("string")) % 5
    model = toxicity.train(docs, labels, fold(labels) != 0)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(fold(docs) == 0, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under 85 per cent similarity of its four-word shingles."""
    found = ngram_jaccard.join_similar(table(spark, sf_dir, "documents"), "doc_id", "text", width=4, percent=85)
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation and one made of control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], rows.schema)
    return chat_format.digests(chat_format.format_pieces(rows.unionByName(probe)))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all rebuilt conversations, with its members and the totals of its subtree."""
    trie = prefix_trie.prefix_trie(prefix_trie.rebuilt(table(spark, sf_dir, "conversations")))
    return trie.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), "ends_sha256",
    )


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, how alike they are, and the class of near duplicates."""
    docs = table(spark, sf_dir, "documents")
    prints = minhash.near_classes(minhash.fingerprints(docs), docs)
    return prints.select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", F.lower(F.hex("mark")).alias("fingerprint"),
        F.lower(F.hex("edited_mark")).alias("edited_fingerprint"), "near_edited", "near_next", F.col("class").alias("class_id"),
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 2,000 phrases of two and three words of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_license_scan": op1_license_scan,
    "op2_pii": op2_pii,
    "op3_line_dedup": op3_line_dedup,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_decontamination": op5_decontamination,
    "op6_toxicity": op6_toxicity,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_chat_format": op8_chat_format,
    "op9_quality_rules": op9_quality_rules,
    "op10_language_id": op10_language_id,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_minhash": op12_minhash,
    "op13_collocations": op13_collocations,
}
