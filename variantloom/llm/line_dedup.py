"""Line dedup: a deletion-neighbourhood join over word edits, keeping the earliest line.

A line is the sequence of its words.  It goes when an earlier line, by (id, text
hash, line number), is the same sequence or, where both have ``min_words`` words
or more, lies within one word edit (one word put in, left out or exchanged);
whether that earlier line itself stays does not matter, so the result does not
depend on the order of the work.  Lines without a word always stay.

1. Equal lines meet in one partial aggregate, which yields the earliest of each.
2. Two different lines within one edit share the first or the last half of their
   words, for a half that follows from the longer length.  Lines none of whose
   halves occurs in another line have no partner; the others are *active*.  The
   same is asked of three quarters, once the words of the active lines are at hand.
3. Active lines emit themselves and every variant with one word left out, as
   128-bit hashed keys; keys that occur once go before anything is shuffled by them.
4. Equal keys are joined by aggregates that carry only the earliest member:
   equal variants at one position are exchanges, a variant equal to a whole line
   is an insertion.  No pairs are made within a group.
5. Each candidate is verified against its earliest partner by edit distance, and
   the texts are rebuilt from the surviving line numbers.

Defined cases: a null text stays null; an empty text stays empty; rows that share
an id and a text keep the same lines, ids may be null; other columns of the input
stay as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.llm.common import Stored, free_name, indexes, let, words


BROADCAST_PLACES = 500_000  # of 24 bytes each; beyond that the documents are shuffled


def _hash2(*parts: Column) -> tuple[Column, Column]:
    return F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)


def has_word(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\n\x0b\f\r")) != ""


def occurrences(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, th, i, line): every line that has a word."""
    base = docs.select(docs[doc_id].alias("id"), F.xxhash64(docs[text]).alias("th"), F.posexplode(F.split(docs[text], "\n")).alias("i", "line"))
    return base.filter(has_word(F.col("line")))


def line_words(line: Column) -> Column:
    """:func:`words` of a line that is not null; without tabs and rare breaks it is cut at single blanks, which needs no pattern."""
    rare = reduce(Column.__or__, [F.contains(line, F.lit(c)) for c in "\t\n\x0b\f\r"])
    return F.when(rare, words(line)).otherwise(F.array_remove(F.split(line, " "), ""))


def half_keys(w: Column) -> Column:
    """Keys of the first and last half, for a partner as long as, or longer by one than, the line."""
    n = F.size(w)

    def key(h: Column, side: int) -> Column:
        part = F.slice(w, F.lit(1), h) if side == 0 else F.slice(w, n - h + 1, h)
        return F.xxhash64(F.lit(side), h, part)

    long = F.floor(n / 2).cast("int")
    both = lambda h: (key(h, 0), key(h, 1))
    return F.when(n % 2 == 1, F.array(*both(long))).otherwise(F.array(*both(long - 1), *both(long)))  # (n - 1) // 2 and n // 2


def distinct_lines(lines: DataFrame, min_words: int) -> DataFrame:
    """(k1, k2, first, n, halves): each different line once, at its earliest place."""
    k1, k2 = _hash2(F.col("w"))
    n = F.size("w")
    keyed = lines.select("id", "th", "i", line_words(F.col("line")).alias("w")).select(
        k1.alias("k1"), k2.alias("k2"), F.struct("id", "th", "i").alias("place"), n.alias("n"),
        F.when(n >= min_words, half_keys(F.col("w"))).alias("halves"),
    )
    return keyed.groupBy("k1", "k2").agg(F.min("place").alias("first"), F.first("n").alias("n"), F.first("halves").alias("halves"))


def active_lines(distinct: DataFrame) -> DataFrame:
    """Places of the lines that share a half with another line."""
    halves = distinct.select("first", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("half")
    return halves.join(shared, "half").select("first.*").distinct()


def quarter_keys(w: Column) -> Column:
    """Keys of all but the quarter that holds the edit, for a partner as long as, or longer by one than, the line."""

    def keys(longer: Column) -> list[Column]:
        cut = [F.floor((longer - 1) * k / 4).cast("int") for k in (1, 2, 3)]
        first = lambda n: F.slice(w, F.lit(1), n)
        last = lambda n: F.slice(w, F.size(w) - n + 1, n)
        parts = [
            (first(cut[2]), F.lit(None)), (first(cut[1]), last(longer - cut[2])),
            (first(cut[0]), last(longer - cut[1])), (F.lit(None), last(longer - cut[0])),
        ]
        return [F.xxhash64(F.lit(side), longer, *(p for p in pair)) for side, pair in enumerate(parts)]

    return F.array(*keys(F.size(w)), *keys(F.size(w) + 1))


def close_lines(active: DataFrame) -> DataFrame:
    """The active lines that share three quarters with another one, which a partner within one edit does."""
    keyed = active.select(F.struct("id", "th", "i").alias("place"), F.explode(quarter_keys(F.col("w"))).alias("key"))
    shared = keyed.groupBy("key").agg(F.min("place").alias("low"), F.max("place").alias("high")).filter("low <> high").select("key")
    return keyed.join(shared, "key").select("place.*").distinct()


def prefix_xor(values: Column) -> Column:
    """For every place the exclusive or of what stands before it.

    Runs of about the square root of the length are summed first, so that a place
    costs one run and not all that stands before it.
    """
    zero = F.lit(0).cast("long")
    of = lambda part: F.aggregate(part, zero, lambda total, x: total.bitwiseXOR(x))
    n, run = F.size(values), F.greatest(F.ceil(F.sqrt(F.size(values))).cast("int"), F.lit(1))

    def with_run(c: Column) -> Column:
        runs = F.transform(indexes(F.ceil(n / c).cast("int")), lambda k: of(F.slice(values, k * c + 1, c)))
        before = lambda sums: F.transform(sums, lambda _, k: of(F.slice(sums, F.lit(1), k)))
        at = lambda i: F.floor(i / c).cast("int")
        return let(let(runs, before), lambda upto: F.transform(values, lambda _, i: F.get(upto, at(i)).bitwiseXOR(of(F.slice(values, at(i) * c + 1, i % c)))))

    return let(run, with_run)


def deletion_hashes(w: Column, *seed: Column) -> Column:
    """Hashes of all one-word deletions, then that of the whole line.

    A hash is the exclusive or of (word, place) hashes.  Without word i it is that of the
    words before i at their places and of the words behind it one place further left.
    """
    own = F.transform(w, lambda x, i: F.xxhash64(*seed, x, i))
    left = F.transform(w, lambda x, i: F.xxhash64(*seed, x, i - 1))
    total = lambda v: F.aggregate(v, F.lit(0).cast("long"), lambda t, x: t.bitwiseXOR(x))

    def cut(o: Column, m: Column) -> Column:
        change = F.zip_with(o, m, lambda x, y: x.bitwiseXOR(y))
        without = let(total(m), lambda t: F.zip_with(let(change, prefix_xor), m, lambda before, x: before.bitwiseXOR(t).bitwiseXOR(x)))
        return F.concat(without, F.array(total(o)))

    return let(own, lambda o: let(left, lambda m: cut(o, m)))


def variant_hashes(w: Column) -> Column:
    """(len, v1, v2, at) of the line itself (at = -1) and of all its one-word deletions."""
    n = F.size(w)
    named = lambda v1: F.transform(v1, lambda x, i: F.struct(F.when(i < n, n - 1).otherwise(n).alias("len"), x.alias("v1"), F.when(i < n, i).otherwise(-1).alias("at")))
    return F.zip_with(let(deletion_hashes(w), named), deletion_hashes(w, F.lit(1)), lambda s, v2: F.struct(s["len"].alias("len"), s["v1"].alias("v1"), v2.alias("v2"), s["at"].alias("at")))


def variants(active: DataFrame) -> DataFrame:
    """(len, v1, v2, at, ord): the variants of the active lines that occur more than once.

    What occurs once, nearly everything, is told by counts of single hashes, so that
    only those and not the variants with their lines are shuffled.
    """
    single = F.explode(deletion_hashes(F.col("w"))).alias("v1")
    again = Stored(active.select(single).groupBy("v1").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("v1")).frame
    each = active.select(F.struct("id", "th", "i").alias("ord"), F.explode(variant_hashes(F.col("w"))).alias("v")).select("v.*", "ord")
    return each.join(F.broadcast(again) if again.count() <= BROADCAST_PLACES else again, "v1")


def earliest_partners(keyed: DataFrame) -> DataFrame:
    """(ord, partner): the earliest line that shares a key with a later one."""
    key = ["len", "v1", "v2"]
    cut, full = keyed.filter("at >= 0"), keyed.filter("at < 0")
    exchanged = cut.groupBy(*key, "at").agg(F.min("ord").alias("partner"), F.count(F.lit(1)).alias("m")).filter("m > 1").drop("m")
    longer = cut.groupBy(*key).agg(F.min("ord").alias("partner"))
    shorter = full.groupBy(*key).agg(F.min("ord").alias("partner"))
    found = cut.join(exchanged, [*key, "at"]).select("ord", "partner")
    found = found.unionByName(full.join(longer, key).select("ord", "partner"))
    found = found.unionByName(cut.join(shorter, key).select("ord", "partner"))
    return found.filter(F.col("partner") < F.col("ord")).groupBy("ord").agg(F.min("partner").alias("partner"))


def within_one_edit(a: Column, b: Column) -> Column:
    """Edit distance of at most one: common prefix and suffix leave at most one word."""
    longer = F.greatest(F.size(a), F.size(b))

    def common(x: Column, y: Column) -> Column:
        same = F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False)))
        return let(F.array_position(same, F.lit(False)), lambda p: F.when(p == 0, longer.cast("long")).otherwise(p - 1))

    return (F.abs(F.size(a) - F.size(b)) <= 1) & (common(a, b) + common(F.reverse(a), F.reverse(b)) >= longer - 1)


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 8) -> DataFrame:
    """``docs`` with ``text`` rebuilt from its surviving lines, and ``n_lines`` and ``n_removed`` beside it."""
    if min_words < 5:
        raise ValueError("lines of fewer than five words have no quarters to compare")
    lines = occurrences(docs, doc_id, text)
    distinct = Stored(distinct_lines(lines, min_words)).frame
    places = Stored(active_lines(distinct.filter(F.col("halves").isNotNull()))).frame
    at = lambda a, b: (a["id"].eqNullSafe(b["id"])) & (a["th"] == b["th"]) & (a["i"] == b["i"])
    if places.count() <= BROADCAST_PLACES:
        fetched = lines.join(F.broadcast(places), at(lines, places), "left_semi")
    else:  # only the documents that hold such a line are cut again
        holding = docs.join(places, docs[doc_id].eqNullSafe(places["id"]) & (F.xxhash64(docs[text]) == places["th"]), "left_semi")
        again = occurrences(holding, doc_id, text)
        fetched = again.join(places, at(again, places), "left_semi")
    active = Stored(fetched.dropDuplicates(["id", "th", "i"]).select("id", "th", "i", line_words(F.col("line")).alias("w"))).frame
    close = close_lines(active)
    active = Stored(active.join(close, at(active, close), "left_semi")).frame
    pairs = earliest_partners(Stored(variants(active)).frame)
    later, earlier = active.select(F.struct("id", "th", "i").alias("ord"), F.col("w").alias("a")), active.select(F.struct("id", "th", "i").alias("partner"), F.col("w").alias("b"))
    near = pairs.join(later, "ord").join(earlier, "partner").filter(within_one_edit(F.col("a"), F.col("b"))).select("ord.*")
    kept = distinct.select("first.*")
    kept = kept.join(near, at(kept, near), "left_anti").groupBy("id", "th").agg(F.collect_list("i").alias("kept"))
    return _rebuild(docs, kept, doc_id, text)


def _rebuild(docs: DataFrame, kept: DataFrame, doc_id: str, text: str) -> DataFrame:
    held, n, removed = (free_name(docs, x) for x in ("kept_lines", "n_lines", "n_removed"))
    kept = kept.withColumnRenamed("kept", held).withColumnRenamed("id", "_dedup_id").withColumnRenamed("th", "_dedup_th")
    joined = docs.join(kept, docs[doc_id].eqNullSafe(kept["_dedup_id"]) & (F.xxhash64(docs[text]) == kept["_dedup_th"]), "left")
    numbers = F.coalesce(F.col(held), F.array().cast("array<int>"))

    def rebuilt(lines: Column) -> Column:
        """Blank lines and surviving lines in their order, and the number of lines with a word."""
        blanks = F.array_compact(F.transform(lines, lambda x, i: F.when(~has_word(x), i)))
        return let(
            blanks,
            lambda b: F.struct(
                let(F.sort_array(F.concat(numbers, b)), lambda order: F.array_join(F.transform(order, lambda i: F.get(lines, i)), "\n")).alias("text"),
                (F.size(lines) - F.size(b)).cast("long").alias("n"),
            ),
        )

    out = free_name(docs, "dedup_result")
    joined = joined.withColumn(out, F.when(docs[text].isNotNull(), let(F.split(docs[text], "\n"), rebuilt)))
    with_word = F.coalesce(F.col(out).getField("n"), F.lit(0))
    columns = [F.col(out).getField("text").alias(c) if c == text else docs[c] for c in docs.columns]
    return joined.select(*columns, with_word.alias(n), (with_word - F.size(numbers)).alias(removed))
