"""Quality rules: a table of thresholds compiled into one projection, without user functions.

Every measure is a built-in expression over the whole text, so a document is
judged where it lies: no shuffle, no Python.  A null text has no words; an empty
text fails the length rules; repeated rows are judged alike.  The verdict is one
struct column, so only its name must be free (``free_name`` finds one).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.llm.common import LOWER, indexes, let, words

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in is that for it with as was on be by this are from or "
    "de la que el en y los se las un por con para una su no es "
    "le les et des est une du dans qui pour pas sur avec ce il au "
    "der die und das den von zu mit sich auf ist im dem nicht ein eine als für"
).split()
SYMBOLS = "#*$%&|<>"


class Rule(NamedTuple):
    """``numerator`` must lie within [low, high] times ``per``; a bound may be absent."""

    name: str
    numerator: str
    per: str
    low: float | None
    high: float | None


BASE_RULES = (
    Rule("too_short", "n_words", "1", 50, None),
    Rule("repeated_windows", "n_repeat_words", "n_words", None, 0.5),
)
RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 20.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.15),
    Rule("few_stop_words", "n_stop_words", "n_words", 0.02, None),
    Rule("upper_case", "n_upper", "word_chars", None, 0.4),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 0.5),
)


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def repeated_window_words(tokens: Column, width: int = 3) -> Column:
    """Number of words inside ``width``-word windows that occur twice or more.

    Windows are sorted by hash with their places; equal neighbours are repeats,
    and the places of the repeats, in order, say how many words they cover.
    """

    def covered(places: Column) -> Column:
        spans = F.transform(places, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(places, k + 1) - x, F.lit(width))))
        return F.aggregate(spans, F.lit(0).cast("long"), lambda total, x: total + x)

    def repeats(pairs: Column) -> Column:
        same = lambda k, h: F.coalesce(F.get(pairs, k).getField("h") == h, F.lit(False))
        found = F.filter(pairs, lambda p, k: same(k - 1, p.getField("h")) | same(k + 1, p.getField("h")))
        return let(F.sort_array(F.transform(found, lambda p: p.getField("i"))), covered)

    def windows(hashes: Column) -> Column:
        at = lambda i: F.struct(F.xxhash64(*(F.get(hashes, i + j) for j in range(width))).alias("h"), i.alias("i"))
        return let(F.sort_array(F.transform(indexes(F.size(hashes) - (width - 1)), at)), repeats)

    return let(F.transform(tokens, lambda w: F.xxhash64(w)), windows)


def measures(text: Column) -> Column:
    """One struct of counts over the whole text."""
    text = F.coalesce(text, F.lit(""))

    def of_words(w: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            _without(text, " \t\n\x0b\f\r").cast("long").alias("word_chars"),
            (F.length(text) - _without(text, SYMBOLS)).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("lines"),
            repeated_window_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
            (F.length(text) - _without(text, LOWER.upper())).cast("long").alias("n_upper"),
        )

    return let(words(text), of_words)


def compile_rules(rules: tuple[Rule, ...], value: dict[str, Column]) -> Column:
    """Names of the rules that fail, in the order of the table."""
    checks = []
    for rule in rules:
        number, per = value[rule.numerator], value[rule.per] if rule.per in value else F.lit(int(rule.per))
        fails = F.lit(False)
        if rule.low is not None:
            fails = fails | (number < F.lit(rule.low) * per)
        if rule.high is not None:
            fails = fails | (number > F.lit(rule.high) * per)
        checks.append(F.when(fails, F.lit(rule.name)))
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, column: str = "quality") -> DataFrame:
    """``docs`` with one struct column: the counts, failed rules, base_failed and kept."""
    names = ("n_words", "word_chars", "n_symbols", "n_repeat_words", "n_stop_words", "n_upper")

    def verdict(m: Column) -> Column:
        value = {n: m.getField(n) for n in names} | {n: m.getField("lines").getField(n) for n in ("n_lines", "n_dup_lines")}
        base, own = compile_rules(BASE_RULES, value), compile_rules(rules, value)
        fields = [c.alias(n) for n, c in value.items()]
        fields += [F.concat(base, own).alias("failed"), (F.size(base) > 0).alias("base_failed"), ((F.size(base) == 0) & (F.size(own) == 0)).alias("kept")]
        return F.struct(*fields)

    # Bound, so that a filter on the verdict does not measure the text once for each rule.
    return docs.withColumn(column, let(measures(docs[text]), verdict))
