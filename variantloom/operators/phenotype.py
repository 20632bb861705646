"""Phenotype resolution and study-trait matching."""

from __future__ import annotations

import difflib
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from variantloom.functions.text import (
    canonical_term_id,
    normalize_reported,
    normalize_text,
    slugify,
)
from variantloom.session import checkpointed, stored, stored_path

# Match kinds, best first, with their scores.
MATCH_SCORES = {
    "exact_mapped_trait": 1.0,
    "exact_reported_trait": 0.95,
    "synonym_mapped_trait": 0.9,
    "synonym_reported_trait": 0.85,
    "descendant_term": 0.7,
    "fuzzy_reported_trait": 0.5,
    "none": 0.0,
}
FUZZY_MIN_RATIO = 0.92
LISTED = 10_000  # values that a resolution holds as lists
REJECTED = "neither label nor synonym of the phenotype; name its id to accept it"


@dataclass
class Resolution:
    """One phenotype's accepted terms: those that bear its name, are named by id, or lie below them."""

    phenotype_input: str
    phenotype_canonical: str
    phenotype_slug: str
    term_ids: list[str]
    synonyms: list[str]
    descendant_ids: list[str] = field(default_factory=list)
    resolution_type: str = "free_text"

    def tables(self, spark: SparkSession) -> ResolvedTables:
        """The same resolution as small tables."""
        one = lambda values, columns: spark.createDataFrame(values, columns)
        me = self.phenotype_input
        chief = one([(me, self.phenotype_canonical)], "PHENOTYPE string, NAME string").select("PHENOTYPE", normalize_text("NAME").alias("NAME"), F.lit(True).alias("IS_CANONICAL"))
        others = one([(me, s, False) for s in self.synonyms], "PHENOTYPE string, NAME string, IS_CANONICAL boolean")
        return ResolvedTables(
            one([(me, t, t, self.resolution_type) for t in self.term_ids], "PHENOTYPE string, term_id string, label string, resolution_type string"),
            others.unionByName(chief).groupBy("PHENOTYPE", "NAME").agg(F.max("IS_CANONICAL").alias("IS_CANONICAL")),
            one([(me, t) for t in self.descendant_ids], "PHENOTYPE string, term_id string"),
            one([(me, self.phenotype_canonical, self.phenotype_slug, self.resolution_type)], "PHENOTYPE string, phenotype_canonical string, phenotype_slug string, resolution_type string"),
        )


def dedupe_terms(terms: DataFrame) -> DataFrame:
    """One row per term id, one with synonyms preferred."""
    has = F.size(F.coalesce("synonyms", F.array().cast("array<string>"))) > 0
    order = [has.desc()] + ([F.col("ORD").asc()] if "ORD" in terms.columns else []) + [F.col("label").asc_nulls_last()]
    ranked = terms.withColumn("_R", F.row_number().over(Window.partitionBy("term_id").orderBy(*order)))
    return ranked.filter(F.col("_R") == 1).drop("_R")


def sequence_ratio(query: str):
    """Arrow UDF: similarity of a text to one query (matching-block ratio)."""

    @F.pandas_udf("double")
    def ratio(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: difflib.SequenceMatcher(None, query, t or "").ratio())

    return ratio


def length_allows(text: Column, queries: Sequence[str], min_ratio: float) -> Column:
    """Exact necessary condition: 2 min(a, b) / (a + b) bounds the ratio from above."""
    allowed = F.lit(False)
    n = F.length(text)
    for size in sorted({len(q) for q in queries}):
        allowed = allowed | (2.0 * F.least(n, F.lit(size)) >= min_ratio * (n + size))
    return allowed


def fuzzy_candidates(terms: DataFrame, phenotype_normal: str, min_ratio: float = FUZZY_MIN_RATIO) -> DataFrame:
    """Best ratio per term over its label and synonyms, for the terms that reach the minimum."""
    texts = terms.select(
        "term_id", "label",
        F.explode(F.concat(F.array("label"), F.coalesce("synonyms", F.array().cast("array<string>")))).alias("_TEXT"),
    ).withColumn("_TEXT", normalize_text("_TEXT"))
    near = texts.filter(length_allows(F.col("_TEXT"), [phenotype_normal], min_ratio))
    return (
        near.withColumn("RATIO", sequence_ratio(phenotype_normal)(F.col("_TEXT")))
        .groupBy("term_id", "label").agg(F.max("RATIO").alias("RATIO")).filter(F.col("RATIO") >= min_ratio)
    )


# ------------------------------------------------- resolution and matching as tables


@dataclass
class ResolvedTables:
    """Resolution of any number of phenotypes, kept as tables.

    ``accepted`` (PHENOTYPE, term_id, label, resolution_type), ``names`` (PHENOTYPE, NAME,
    IS_CANONICAL: the normalised names under which studies may be found), ``below``
    (PHENOTYPE, term_id: terms under the accepted ones), ``summary`` (PHENOTYPE,
    phenotype_canonical, phenotype_slug, resolution_type).
    """

    accepted: DataFrame
    names: DataFrame
    below: DataFrame
    summary: DataFrame


def by_shuffle(side: DataFrame) -> DataFrame:
    """The side of a join that grows with the phenotypes or the ontology: never a broadcast, whatever size is estimated for its Parquet."""
    return side.hint("merge")


def descendants(starts: DataFrame, parents: DataFrame) -> DataFrame:
    """(PHENOTYPE, term_id) of all terms below ``starts`` (PHENOTYPE, term_id), these left out.

    ``parents`` is (term_id, parent_id).  Each round goes one step down from the terms
    that the round before found, so a cycle ends where it meets what is known.  There are
    as many rounds as the ontology has levels; every round is an equi join and an anti
    join, and its result is stored.
    """
    edges = stored(parents.select(F.col("parent_id").alias("_P"), F.col("term_id").alias("_C")).filter("_P is not null and _C is not null").distinct())
    spark, base = starts.sparkSession, stored_path(starts.sparkSession)

    def kept(rows: DataFrame, n: int) -> DataFrame:
        rows.write.parquet(f"{base}/round={n}")
        return spark.read.schema(rows.schema).parquet(f"{base}/round={n}")

    rounds, edge = 0, kept(starts.select("PHENOTYPE", "term_id").distinct(), 0)
    while True:
        # All rounds so far are one scan, so its tasks grow with its size, not with the rounds.
        known = spark.read.schema(edge.schema).parquet(*[f"{base}/round={n}" for n in range(rounds + 1)])
        found = edge.join(by_shuffle(edges), edge["term_id"] == edges["_P"]).select("PHENOTYPE", F.col("_C").alias("term_id")).distinct()
        rounds += 1
        edge = kept(found.join(by_shuffle(known), ["PHENOTYPE", "term_id"], "left_anti"), rounds)
        if edge.isEmpty():
            # What a round found was not known before, so the starts are only in round 0.
            later = [f"{base}/round={n}" for n in range(1, rounds + 1)]
            return spark.read.schema(edge.schema).parquet(*later)


def resolve_terms(
    terms: DataFrame,
    phenotypes: DataFrame,
    pins: DataFrame | None = None,
    user_synonyms: DataFrame | None = None,
    parents: DataFrame | None = None,
) -> ResolvedTables:
    """Resolve every row of ``phenotypes`` (PHENOTYPE) against an ontology, by joins alone.

    Named ids (``pins``: PHENOTYPE, term_id) win, then terms whose label is the phenotype,
    then terms with such a synonym; a phenotype without any is free text.  ``user_synonyms``
    is (PHENOTYPE, synonym); ``parents`` (term_id, parent_id) adds the terms below.
    """
    no_strings = F.array().cast("array<string>")
    asked = phenotypes.select("PHENOTYPE").filter("PHENOTYPE is not null").distinct().withColumn("NAME", normalize_text("PHENOTYPE"))
    unique = dedupe_terms(terms)
    order = F.col("ORD") if "ORD" in terms.columns else F.lit(0)
    described = unique.select(
        "term_id", "label", order.alias("_ORD"), normalize_text("label").alias("_LABEL"), F.transform(F.coalesce("synonyms", no_strings), normalize_text).alias("_SYN")
    )
    entry = lambda tier, name: F.struct(F.lit(tier).alias("TIER"), name.alias("NAME"))
    spelled = described.select(
        "term_id", "label", "_ORD", F.explode(F.concat(F.array(entry(1, F.col("_LABEL"))), F.transform("_SYN", lambda s: entry(2, s)))).alias("_N")
    ).select("term_id", "label", "_ORD", "_N.TIER", "_N.NAME").filter("NAME <> ''")
    by_name = asked.join(by_shuffle(spelled), "NAME").select("PHENOTYPE", "term_id", "label", "_ORD", "TIER")
    if pins is not None:
        named = pins.select("PHENOTYPE", canonical_term_id("term_id").alias("term_id")).distinct().join(by_shuffle(asked.select("PHENOTYPE")), "PHENOTYPE", "left_semi")
        told = named.join(by_shuffle(described.select("term_id", "label")), "term_id", "left").select(
            "PHENOTYPE", "term_id", F.coalesce("label", "term_id").alias("label"), F.lit(0).alias("_ORD"), F.lit(0).alias("TIER")
        )
        by_name = by_name.unionByName(told)
    best = by_name.groupBy("PHENOTYPE").agg(F.min("TIER").alias("TIER"))
    kind = F.when(F.col("TIER") == 0, "user_pinned").when(F.col("TIER") == 1, "exact_label").otherwise("exact_synonym")
    accepted = stored(
        by_name.join(by_shuffle(best), ["PHENOTYPE", "TIER"]).groupBy("PHENOTYPE", "term_id").agg(
            F.min("label").alias("label"), F.min("_ORD").alias("_ORD"), F.first(kind).alias("resolution_type")
        )
    )
    head = accepted.groupBy("PHENOTYPE").agg(F.min(F.struct("_ORD", "term_id", "label", "resolution_type")).alias("_H"))
    summary = asked.join(by_shuffle(head), "PHENOTYPE", "left").select(
        "PHENOTYPE", F.coalesce("_H.label", F.trim("PHENOTYPE")).alias("phenotype_canonical"), slugify("PHENOTYPE").alias("phenotype_slug"),
        F.coalesce("_H.resolution_type", F.lit("free_text")).alias("resolution_type"),
    )
    own = accepted.join(by_shuffle(described), "term_id").select("PHENOTYPE", F.explode(F.concat(F.array("_LABEL"), "_SYN")).alias("NAME"), F.lit(False).alias("IS_CANONICAL"))
    chief = summary.select("PHENOTYPE", normalize_text("phenotype_canonical").alias("NAME"), F.lit(True).alias("IS_CANONICAL"))
    names = own.unionByName(chief).unionByName(asked.select("PHENOTYPE", "NAME", F.lit(False).alias("IS_CANONICAL")))
    if user_synonyms is not None:
        more = user_synonyms.join(asked.select("PHENOTYPE"), "PHENOTYPE", "left_semi")
        names = names.unionByName(more.select("PHENOTYPE", normalize_text("synonym").alias("NAME"), F.lit(False).alias("IS_CANONICAL")))
    names = names.filter("NAME <> ''").groupBy("PHENOTYPE", "NAME").agg(F.max("IS_CANONICAL").alias("IS_CANONICAL"))
    if parents is None:
        below = accepted.select("PHENOTYPE", "term_id").limit(0)
    else:
        below = descendants(accepted, parents)
    return ResolvedTables(accepted.select("PHENOTYPE", "term_id", "label", "resolution_type"), names, below, summary)


def match_resolved(studies: DataFrame, resolved: ResolvedTables, key: str = "study_accession") -> DataFrame:
    """(PHENOTYPE, key, match_type, match_score, match_reason) of every study that an exact rule gives to a phenotype.

    Ids, labels and reported traits of the studies are joined to the resolution's tables;
    of several rules the best counts, and its reason names the first term or name.
    """
    no_strings = F.array().cast("array<string>")
    ids = studies.select(key, F.explode(F.coalesce("mapped_trait_ids", no_strings)).alias("term_id"))
    labels = studies.select(key, F.posexplode(F.coalesce("mapped_trait_labels", no_strings)).alias("_AT", "_SPELLED")).withColumn("NAME", normalize_text("_SPELLED"))
    reported = studies.select(key, F.col("reported_trait").alias("_SPELLED"), normalize_reported("reported_trait").alias("NAME")).filter("NAME <> ''")
    asked = resolved.summary.select("PHENOTYPE", normalize_text("PHENOTYPE").alias("_INPUT"))
    names = resolved.names.join(asked, "PHENOTYPE").withColumn("_CHIEF", F.col("IS_CANONICAL") | (F.col("NAME") == F.col("_INPUT")))
    quoted = lambda before, value, after: F.concat(F.lit(before), value, F.lit(after))

    def ruled(rows: DataFrame, rank: Column, first: Column, last: Column, why: Column) -> DataFrame:
        """Joined rows with the rule that each meets, and what puts reasons in order."""
        return rows.select("PHENOTYPE", key, F.struct(rank.alias("rank"), first.alias("first"), (-last).alias("last"), why.alias("why")).alias("_R"))

    zero, none, spelled, term = F.lit(0), F.lit(""), F.col("_SPELLED"), F.col("term_id")
    listed = resolved.accepted.select("PHENOTYPE", "term_id", F.lit(True).alias("_IN")).unionByName(resolved.below.select("PHENOTYPE", "term_id", F.lit(False).alias("_IN")))
    chief = F.col("IS_CANONICAL")
    found = [
        ruled(
            ids.join(listed, "term_id"), F.when(F.col("_IN"), 1).otherwise(6), term, zero,
            F.when(F.col("_IN"), quoted("mapped to accepted term ", term, "")).otherwise(quoted("mapped term ", term, " lies below an accepted term")),
        ),
        ruled(
            labels.join(names, "NAME"), F.when(chief, 2).otherwise(4), F.when(chief, none).otherwise(F.col("NAME")), F.col("_AT"),
            F.when(chief, quoted("mapped trait '", spelled, "' is the phenotype's label")).otherwise(quoted("mapped trait '", spelled, "' is among the synonyms")),
        ),
        ruled(
            reported.join(names, "NAME"), F.when(F.col("_CHIEF"), 3).otherwise(5), none, zero,
            F.when(F.col("_CHIEF"), quoted("reported trait '", spelled, "' is the phenotype")).otherwise(quoted("reported trait '", spelled, "' is among the synonyms")),
        ),
    ]
    best = reduce(DataFrame.unionByName, found).groupBy("PHENOTYPE", key).agg(F.min("_R").alias("_R"))
    kinds = F.array(*[F.lit(k) for k in (
        "exact_mapped_trait", "exact_mapped_trait", "exact_reported_trait", "synonym_mapped_trait", "synonym_reported_trait", "descendant_term"
    )])
    kind = F.element_at(kinds, F.col("_R.rank"))
    scores = F.create_map(*[part for k, v in MATCH_SCORES.items() for part in (F.lit(k), F.lit(v))])
    return best.select("PHENOTYPE", key, kind.alias("match_type"), F.element_at(scores, kind).alias("match_score"), F.col("_R.why").alias("match_reason"))


def fuzzy_pairs(reported: DataFrame, names: DataFrame, key: str, min_ratio: float = FUZZY_MIN_RATIO) -> DataFrame:
    """(PHENOTYPE, key, _RATIO): best similarity of a normalised text (key, NAME) to a phenotype's names, where it reaches the minimum.

    Only texts of fitting lengths meet: twice the shorter over both lengths bounds the
    ratio from above, so a name asks for a range of lengths, an equi join.
    """
    n = F.length("NAME")
    low, high = F.ceil(n * (min_ratio / (2.0 - min_ratio)) - 1e-9), F.floor(n * ((2.0 - min_ratio) / min_ratio) + 1e-9)
    asking = names.filter("NAME <> ''").select("PHENOTYPE", F.col("NAME").alias("_WANTED"), F.explode(F.sequence(low, high)).alias("_LEN"))
    texts = reported.select(key, "NAME", F.length("NAME").cast("bigint").alias("_LEN"))

    @F.pandas_udf("double")
    def ratio(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([difflib.SequenceMatcher(None, a, b).ratio() for a, b in zip(left, right)], dtype="float64")

    met = texts.join(asking, "_LEN").withColumn("_RATIO", ratio("NAME", "_WANTED"))
    return met.groupBy("PHENOTYPE", key).agg(F.max("_RATIO").alias("_RATIO")).filter(F.col("_RATIO") >= min_ratio)


def match_studies(studies: DataFrame, resolution: Resolution | ResolvedTables, fuzzy_min_ratio: float = FUZZY_MIN_RATIO) -> DataFrame:
    """``studies`` with match_type, match_score and match_reason for one phenotype, best kind first.

    ``studies`` has study_accession, reported_trait, mapped_trait_ids[] and
    mapped_trait_labels[].  Similarity is asked only for studies no exact rule decided.
    """
    key = "study_accession"
    resolved = resolution.tables(studies.sparkSession) if isinstance(resolution, Resolution) else resolution
    exact = checkpointed(match_resolved(studies, resolved, key).drop("PHENOTYPE"))
    left = studies.join(exact.select(key), key, "left_anti").select(key, normalize_reported("reported_trait").alias("NAME")).filter("NAME <> ''")
    alike = fuzzy_pairs(left, resolved.names, key, fuzzy_min_ratio).select(
        key, F.lit("fuzzy_reported_trait").alias("match_type"), F.lit(MATCH_SCORES["fuzzy_reported_trait"]).alias("match_score"),
        F.format_string("reported trait is %.2f alike", F.col("_RATIO")).alias("match_reason"),
    )
    return studies.join(exact.unionByName(alike), key, "left").select(
        *studies.columns, F.coalesce("match_type", F.lit("none")).alias("match_type"), F.coalesce("match_score", F.lit(MATCH_SCORES["none"])).alias("match_score"),
        F.coalesce("match_reason", F.lit("no rule agrees")).alias("match_reason"),
    )


def _few(df: DataFrame) -> list[str]:
    """A column as a sorted list; more than LISTED values belong in a table."""
    rows = df.distinct().limit(LISTED + 1).collect()
    if len(rows) > LISTED:
        raise ValueError(f"more than {LISTED} values; use the tables of resolve_terms")
    return sorted(row[0] for row in rows)


def resolve_phenotype(
    terms: DataFrame,
    phenotype: str,
    pinned_ids: Sequence[str] = (),
    user_synonyms: Sequence[str] = (),
    fuzzy: bool = False,
    fuzzy_min_ratio: float = FUZZY_MIN_RATIO,
    parents: DataFrame | None = None,
) -> tuple[Resolution, DataFrame]:
    """(resolution, rejected terms) of one phenotype as short lists, for a look at it.

    The work is that of :func:`resolve_terms`; with ``fuzzy``, a phenotype that no term
    bears takes the most similar one that reaches the minimum.
    """
    spark = terms.sparkSession
    asked = spark.createDataFrame([(phenotype,)], "PHENOTYPE string")
    pins = spark.createDataFrame([(phenotype, i) for i in pinned_ids], "PHENOTYPE string, term_id string") if pinned_ids else None
    more = spark.createDataFrame([(phenotype, s) for s in user_synonyms], "PHENOTYPE string, synonym string")
    resolved = resolve_terms(terms, asked, pins, more, parents)
    told = resolved.summary.first()
    kind = told["resolution_type"]
    if kind == "free_text" and fuzzy:
        query = asked.select(normalize_text("PHENOTYPE")).first()[0]
        best = fuzzy_candidates(dedupe_terms(terms), query, fuzzy_min_ratio).orderBy(F.desc("RATIO"), "term_id").first()
        if best is not None:
            kind = "fuzzy"
            resolved = resolve_terms(terms, asked, spark.createDataFrame([(phenotype, best["term_id"])], "PHENOTYPE string, term_id string"), more, parents)
            told = resolved.summary.first()
    rejected = dedupe_terms(terms).join(resolved.accepted, "term_id", "left_anti").select("term_id", "label", F.lit(REJECTED).alias("reason"))
    return (
        Resolution(
            phenotype, told["phenotype_canonical"], told["phenotype_slug"], _few(resolved.accepted.select("term_id")), _few(resolved.names.select("NAME")),
            _few(resolved.below.select("term_id")), kind,
        ),
        rejected,
    )
