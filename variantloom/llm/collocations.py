"""Collocations of words by SETM, mining by sorted relations.

Texts are cut at punctuation and line breaks into pieces, pieces into words.  A phrase
is a run of words of one piece; everything is counted for each language.

*Occurrence relation.*  R1 is persisted once: a row for each piece, with its words in
order.  It is the relation (piece, position, word), sorted and nested by piece.  Joining
occurrences of k - 1 words with words on equal piece and adjacent position is then a
merge within the row, position by position; the planner has nothing to shuffle or sort,
and no row is copied for it, as positions are generated and words are looked up in place.

*Rounds.*  Round k counts the phrases of k words and keeps those that reach the least
count.  Before it counts, it semi-joins every occurrence with the frequent phrases of
k - 1 words, for its first and for its last k - 1 words.  The frequent phrases come as
a bitmap of hashed phrases of fixed size (``common.bitmap``), so what is
broadcast has the same size whatever the corpus.  A bit may stand for several phrases:
the semi-join lets a few more occurrences through, which the count then drops, so the
result is exact at any fill of the bitmap.  Counting combines on the map side, so a
phrase that makes up a third of a corpus arrives as one row from each task.

*Score.*  Cutting a phrase in two gives l and r, the counts of its parts, and
floor(1000000 * a * a / (l * r)) with a its own count; the lowest cut counts, the
shortest first part among equals.  Products are decimals of 38 digits: exact while
a < 10 ** 16.  A phrase that lies in a longer candidate at least half as frequent is
left out.  The best of a language are ranked in two steps, first within hashed parts of
a language, so that no language has to be sorted in one task.

Defined cases: a null text is empty and has no phrases; a null language is ``und``; a
piece shorter than a phrase has none; a very long text is as many rows as it has
pieces, and a piece is one row; repeated rows count again; ties are broken by count and
then by the phrase in byte order; an empty table gives no rows; columns of other names
are not read, whatever they are called.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from variantloom.llm.common import Stored, bitmap, lower_ascii, may_hold

PIECE_ENDS = "[.,;:!?\\x0A-\\x0D]"
BLANKS = "[\\x20\\x09]+"
RANK_PARTS = 64  # of one language, ranked in parallel


@dataclass(frozen=True)
class Limits:
    """What counts as a collocation."""

    most_words: int = 3
    least_count: int = 10
    top: int = 2000
    inside_percent: int = 50


def occurrences(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """R1: (lang, words), a row for each piece that has a word, its words in order."""
    body = lower_ascii(F.coalesce(docs[text], F.lit("")))
    pieces = docs.select(F.coalesce(docs[lang], F.lit("und")).alias("lang"), F.explode(F.split(body, PIECE_ENDS)).alias("piece"))
    told = pieces.select("lang", F.array_remove(F.split("piece", BLANKS), "").alias("words"))
    return told.filter(F.size("words") > 0)


def _hashed(phrase: str) -> Column:
    return F.xxhash64("lang", phrase)


def _run(start: Column, k: int) -> Column:
    """The k words from a position on, joined by blanks."""
    return F.concat_ws(" ", *(F.get("words", start + j) for j in range(k)))


def count_phrases(relation: DataFrame, k: int, bits: DataFrame | None, least: int) -> DataFrame:
    """(lang, phrase, f): phrases of k words, both of whose k - 1 word ends pass the bitmap, found ``least`` times."""
    at = relation.filter(F.size("words") >= k).select("lang", "words", F.explode(F.sequence(F.lit(0), F.size("words") - k)).alias("i"))
    rows = at.select("lang", _run(F.col("i"), k).alias("phrase"))
    if bits is not None:
        ends = at.select("lang", _run(F.col("i"), k).alias("phrase"), _run(F.col("i"), k - 1).alias("front"), _run(F.col("i") + 1, k - 1).alias("back"))
        rows = may_hold(may_hold(ends, _hashed("front"), bits), _hashed("back"), bits).select("lang", "phrase")
    return rows.groupBy("lang", "phrase").agg(F.count(F.lit(1)).alias("f")).filter(F.col("f") >= least)


def frequent_phrases(relation: DataFrame, limits: Limits) -> list[DataFrame]:
    """Frequent phrases (lang, phrase, f) of 1, 2 .. words, each stored."""
    levels = [Stored(count_phrases(relation, 1, None, limits.least_count)).frame]
    for k in range(2, limits.most_words + 1):
        levels.append(Stored(count_phrases(relation, k, bitmap(levels[-1].select(_hashed("phrase"))), limits.least_count)).frame)
    return levels


def _parts(phrase: Column, first: int, count: Column | int) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, count), " ")


def scored(levels: list[DataFrame]) -> DataFrame:
    """(lang, phrase, a, l, r, score) of every frequent phrase of two words or more."""
    counts = reduce(DataFrame.unionByName, levels)
    cuts = []
    for k, level in enumerate(levels[1:], 2):
        named = level.withColumnRenamed("f", "a")
        cuts += [named.select("lang", "phrase", "a", F.lit(c).alias("cut"), _parts(F.col("phrase"), 1, c).alias("left"), _parts(F.col("phrase"), c + 1, k - c).alias("right")) for c in range(1, k)]
    of = lambda name, f: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    told = reduce(DataFrame.unionByName, cuts).join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"])
    wide = told.withColumns({"wa": F.col("a").cast("decimal(16,0)"), "wl": F.col("l").cast("decimal(19,0)"), "wr": F.col("r").cast("decimal(19,0)")})
    score = F.expr("(wa * wa * cast(1000000 as decimal(7,0))) div (wl * wr)").cast("long")
    lowest = wide.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("m"))
    return lowest.select("lang", "phrase", "a", "m.l", "m.r", "m.score")


def covered(levels: list[DataFrame]) -> DataFrame:
    """(lang, phrase, most): the largest count of a longer frequent phrase that holds the phrase."""
    inner = []
    for k, level in enumerate(levels[2:], 3):
        runs = [_parts(F.col("phrase"), s + 1, size) for size in range(2, k) for s in range(k - size + 1)]
        inner.append(level.select("lang", F.explode(F.array(*runs)).alias("phrase"), "f"))
    return reduce(DataFrame.unionByName, inner).groupBy("lang", "phrase").agg(F.max("f").alias("most"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", limits: Limits = Limits()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of every language."""
    relation = Stored(occurrences(docs, text, lang)).frame
    sizes = relation.groupBy("lang").agg(F.sum(F.size("words")).alias("n"))
    levels = frequent_phrases(relation, limits)
    found = scored(levels)
    if limits.most_words > 2:
        found = found.join(covered(levels), ["lang", "phrase"], "left").filter(
            F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * limits.inside_percent)
        )
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    ahead = found.withColumn("part", part).withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*best)))
    ranked = ahead.filter(F.col("rank") <= limits.top).withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*best)))
    told = ranked.filter(F.col("rank") <= limits.top).join(sizes, "lang")
    return told.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
