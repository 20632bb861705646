"""Benchmark decontamination by spaced-seed hashing.

A document overlaps a benchmark item where ``WINDOW`` words of the item stand, at
equal distances, in the document with at most ``TOLERANCE`` of them exchanged.
Fixed masks select some positions of a span and ignore the rest; the words they
select are hashed at every place of the items and of the documents, equal hashes
are joined, and every hit is verified word by word in the windows around it.
The two masks together hit every window with up to two exchanges, whichever they
are (a test goes through all of them), so the search loses nothing.

An item shorter than ``WINDOW`` words must occur whole and unchanged; one shorter
than ``MIN_ITEM`` words is no evidence and is not searched.  Words are compared in
ASCII lower case without punctuation.  Null and empty texts overlap nothing;
rows that share an id and a text share the result; ids may be null.

Only the benchmark's seeds are broadcast, and only when they have been counted and
are at most ``BROADCAST_SEEDS`` (each carries less than 300 bytes); beyond that
both sides are shuffled on the hash.  Document words never leave their task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.llm.common import LOWER, Stored, indexes, let, words

WINDOW, TOLERANCE, MIN_ITEM = 13, 2, 5
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
BROADCAST_SEEDS = 100_000
PUNCTUATION = ",.;:!?\"'()[]{}"


def word_hashes(text: Column) -> Column:
    plain = F.translate(text, LOWER.upper() + PUNCTUATION, LOWER)
    return F.transform(words(plain), lambda w: F.xxhash64(w))


def masks_for(short_lengths: list[int]) -> list[tuple[int, ...]]:
    """The fixed masks, and one that selects everything for each length of a short item."""
    return [*MASKS, *(tuple(range(n)) for n in short_lengths)]


def _seed(hashes: Column, at: Column, number: int, mask: tuple[int, ...]) -> Column:
    """Hash of the selected words; null when the mask reaches over the end."""
    key = F.xxhash64(F.lit(number), *(F.get(hashes, at + m) for m in mask))
    return F.when(F.size(hashes) > at + mask[-1], key)


def benchmark_seeds(items: DataFrame, item_id: str, text: str) -> tuple[DataFrame, list[tuple[int, ...]]]:
    """(key, item, window, need, before, context): every masked place with the words around it."""
    held = Stored(items.select(items[item_id].alias("item"), word_hashes(items[text]).alias("h")).filter(F.size("h") >= MIN_ITEM)).frame
    # At most WINDOW - MIN_ITEM different lengths reach the driver.
    short = sorted(r[0] for r in held.filter(F.size("h") < WINDOW).select(F.size("h")).distinct().collect())
    masks = masks_for(short)
    seeds = []
    for number, mask in enumerate(masks):
        own = held.filter(F.size("h") >= WINDOW) if number < len(MASKS) else held.filter(F.size("h") == len(mask))
        window, need = (WINDOW, WINDOW - TOLERANCE) if number < len(MASKS) else (len(mask), len(mask))
        at = own.select("item", "h", F.explode(indexes(F.size("h"))).alias("p"))
        before = F.least(F.col("p"), F.lit(window - 1 - mask[-1]))
        seeds.append(
            at.select(
                _seed(F.col("h"), F.col("p"), number, mask).alias("key"), "item", "p", F.lit(window).alias("window"), F.lit(need).alias("need"),
                before.alias("before"), F.slice("h", F.col("p") - before + 1, before + window).alias("context"),
            )
        )
    found = seeds[0]
    for more in seeds[1:]:
        found = found.unionByName(more)
    return found.filter(F.col("key").isNotNull()), masks


def _best(around: Column, skipped: Column, context: Column, window: Column) -> Column:
    """Most equal words in a window of the context; ``around`` starts ``skipped`` words into it."""
    same = F.transform(context, lambda x, j: F.coalesce(F.get(around, j - skipped) == x, F.lit(False)))
    count = lambda flags, s: F.size(F.filter(F.slice(flags, s + 1, window), lambda x: x))
    return let(same, lambda flags: F.array_max(F.transform(indexes(F.size(flags) - window + 1), lambda s: count(flags, s))))


def overlaps(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, th, item, best_words, n_places): each document and item that overlap."""
    seeds, masks = benchmark_seeds(items, item_id, item_text)
    seeds = Stored(seeds).frame
    if seeds.count() <= BROADCAST_SEEDS:
        seeds = F.broadcast(seeds)
    hashed = docs.select(docs[doc_id].alias("id"), F.xxhash64(docs[text]).alias("th"), word_hashes(docs[text]).alias("h"))
    placed = hashed.select("id", "th", "h", F.explode(indexes(F.size("h"))).alias("at"))
    keys = F.array(*(_seed(F.col("h"), F.col("at"), number, mask) for number, mask in enumerate(masks)))
    keyed = placed.select("id", "th", "h", "at", F.explode(keys).alias("key")).filter(F.col("key").isNotNull())
    # Up to here nothing but generated code, which neither copies nor keeps the words of a document
    # for its places; a hit takes along only the words around it.
    begin = F.col("at") - F.col("before")
    skipped = F.greatest(-begin, F.lit(0))
    hits = keyed.join(seeds, "key").select(
        "id", "th", "item", (F.col("at") - F.col("p")).alias("shift"), "need", "window", "context", skipped.alias("skipped"),
        F.slice("h", F.greatest(begin, F.lit(0)) + 1, F.size("context") - skipped).alias("around"),
    )
    judged = hits.repartition("id", "th").select("id", "th", "item", "shift", "need", _best(F.col("around"), F.col("skipped"), F.col("context"), F.col("window")).alias("best"))
    # The bound comes after the aggregate: as a condition of the join it would be tried inside it, word by word.
    places = judged.groupBy("id", "th", "item", "shift", "need").agg(F.max("best").alias("best")).filter("best >= need")
    return places.groupBy("id", "th", "item").agg(F.max("best").cast("long").alias("best_words"), F.count(F.lit(1)).alias("n_places"))


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without those that overlap an item."""
    leaked = Stored(overlaps(docs, items, doc_id, text, item_id, item_text).select("id", "th").distinct()).frame
    return docs.join(leaked, docs[doc_id].eqNullSafe(leaked["id"]) & (F.xxhash64(docs[text]) == leaked["th"]), "left_anti")
