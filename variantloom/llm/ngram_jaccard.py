"""N-gram Jaccard join by T-occurrence search (DivideSkip).

Documents link when the Jaccard similarity of their sets of word n-grams reaches a
bound; the result is the component of every document.  Equal sets are one set from
the start, so copies cost one row each.

*Which lists can matter.*  Sets are ordered by hash.  Two linked sets share many
n-grams among the first quarter of each (the bottom), whatever the hash; how many
follows from the sizes.  List lengths are counted over all bottoms.  A set may lay
aside as many of its longest bottom lists as it must share at the least, less one,
and still meets every partner in one of the others: its short lists.  What many
documents have in common is so laid aside, and n-grams of one set have no list.

*Search.*  Sets that meet in short lists are searched by :func:`divide_skip`, a
T-occurrence search over inverted lists of whole sets: it heap-merges the short lists
of a query, probes the long ones by binary search and keeps the sets that reach the
required overlap.  First one leader of each list is the query and the other members,
in chunks of bounded size, are the index.  Links become components; a list within one
component is done, so a large group of near copies costs one probe for each member and
no pairs.  The lists that are left tie their sets into clusters.  In each cluster all
sets but those of its largest component are queries against all sets of a fitting size,
in blocks of bounded size, which makes the result exact in every case.

Identity of sets is a 64-bit hash (expected number of chance collisions for k
different sets: k**2 / 3.7e19).

Defined cases: null, empty and blank texts have no n-grams, link with nothing and are
their own component; a text with fewer words than n has its whole sequence as one
n-gram; repeated rows and equal ids share a component; null ids are never the name of
a component while it has another.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from variantloom.llm.common import Stored, bitmap, indexes, let, lower_ascii, split_by_bits, words
from variantloom.llm.components import components

MERGE_SHARE = 10  # per cent of a set that two linked sets share among their bottoms
UNIT_TOKENS = 200_000  # of the sets in one task's index
BROADCAST_IDS = 500_000  # of 8 bytes each; beyond that the documents are shuffled


def shingles(text: Column, width: int) -> Column:
    """The sorted hashes of the different ``width``-word windows."""

    def of_words(w: Column) -> Column:
        grams = F.transform(indexes(F.size(w) - (width - 1)), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(width))))
        whole = F.when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(w) >= width, F.sort_array(F.array_distinct(grams))).otherwise(whole)

    return let(words(lower_ascii(text)), of_words)


def least_overlap(n: Column, percent: int) -> Column:
    """What a set of n shares at least with any set it links with."""
    return F.ceil(n * F.lit(percent) / 100).cast("int")


def least_merged(n: Column) -> Column:
    return F.ceil(n * F.lit(MERGE_SHARE) / 100).cast("int")


Cut = Callable[[Column, int], Column]  # of a text and a width, as shingles() has it


def sketches(docs: DataFrame, doc_id: str, text: str, width: int, percent: int, cut: Cut = shingles) -> DataFrame:
    """(id, n, a, bottom): size, identity and bottom of each document's set."""
    base = docs.select(docs[doc_id].alias("id"), cut(docs[text], width).alias("s"))
    n = F.size("s")
    bottom = F.slice("s", F.lit(1), F.least(n, n - least_overlap(n, percent) + least_merged(n)))
    return base.select("id", n.alias("n"), F.xxhash64("s").alias("a"), bottom.alias("bottom"))


def different_sets(wide: DataFrame, sketched: DataFrame) -> DataFrame:
    """(a, n, bottom) once for each identity; bottoms are shuffled only where a set may have copies."""
    copied = sketched.filter("n > 0").groupBy("a").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("a")
    copies, alone = split_by_bits(wide.filter("n > 0"), F.col("a"), bitmap(copied))
    return copies.groupBy("a").agg(F.first("n").alias("n"), F.first("bottom").alias("bottom")).unionByName(alone.select("a", "n", "bottom"))


def short_lists(sets: DataFrame, percent: int, passes: int = 1) -> DataFrame:
    """(h, a, n): the short lists of every set, without those of one set.

    One shuffle by n-gram; a list has one row for each set at most, a task very many lists.
    With several passes each takes a part of the n-grams, so that only the shuffle of
    that part is on disk at a time.
    """
    postings = sets.select("a", "n", F.explode("bottom").alias("h"))
    met = lambda rows: rows.withColumn("m", F.count(F.lit(1)).over(W.partitionBy("h"))).filter("m > 1")
    parts = [met(postings)] if passes == 1 else [Stored(met(postings.filter(F.pmod("h", F.lit(passes)) == k))).frame for k in range(passes)]
    shared = reduce(DataFrame.unionByName, parts)
    longest = F.row_number().over(W.partitionBy("a").orderBy(F.desc("m"), F.desc("h")))
    aside = least_merged(least_overlap(F.col("n"), percent)) - 1
    return shared.withColumn("place", longest).filter(F.col("place") > aside).select("h", "a", "n")


def divide_skip(query: np.ndarray, lists: dict[int, list[int]], least: int, accept: Callable[[int, int], bool]) -> list[int]:
    """Members that share at least ``least`` tokens with the query and that ``accept`` (member, overlap) takes."""
    own = sorted((lists[t] for t in query.tolist() if t in lists), key=len)
    if len(own) < least:
        return []
    # The more and the longer the lists, the more of them are probed instead of merged.
    n_long = min(least - 1, int(least / (0.0085 * np.log2(max(2, len(own[-1]))) + 1)))
    short, long = own[: len(own) - n_long], own[len(own) - n_long :]
    found = []
    for member, run in groupby(heapq.merge(*short)):
        count = sum(1 for _ in run)
        if count < least - n_long:
            continue
        for k, postings in enumerate(reversed(long)):
            if count + len(long) - k < least:
                break
            at = bisect_left(postings, member)
            count += at < len(postings) and postings[at] == member
        if count >= least and accept(member, count):
            found.append(member)
    return found


def search_unit(names: list[int], sets: list[np.ndarray], n_index: int, percent: int) -> list[tuple[int, int]]:
    """Links between queries and the first ``n_index`` sets, the index; only those that join two parts of the unit.

    Lists are made of the tokens that a query holds: no other is looked up.
    """
    if not 0 < n_index < len(sets):
        return []
    lists: dict[int, list[int]] = {}
    asked, tokens = np.unique(np.concatenate(sets[n_index:])), np.concatenate(sets[:n_index])
    at = np.searchsorted(asked, tokens)
    hit = asked[np.minimum(at, len(asked) - 1)] == tokens
    member_of = np.repeat(np.arange(n_index), [len(s) for s in sets[:n_index]])
    for t, member in zip(tokens[hit].tolist(), member_of[hit].tolist()):
        lists.setdefault(t, []).append(member)
    part = {name: name for name in names}

    def top(x: int) -> int:
        while part[x] != x:
            part[x] = part[part[x]]
            x = part[x]
        return x

    links = []
    for q in range(n_index, len(sets)):
        n = len(sets[q])
        least = -(-n * percent // 100)
        for member in divide_skip(sets[q], lists, least, lambda m, o, n=n: 100 * o >= percent * (n + len(sets[m]) - o)):
            x, y = top(names[q]), top(names[member])
            if x != y:
                part[max(x, y)] = min(x, y)
                links.append((names[q], names[member]))
    return links


def search_units(members: DataFrame, tokens: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Links (u, v) found in every unit of ``members`` (keys, a, query)."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, names, sets, n_index, links = None, [], [], 0, []
        for batch in batches:
            *key, query, name, s = batch.columns
            values, ends = s.values.to_numpy(), s.offsets.to_numpy()
            for i, (unit, asks, a) in enumerate(zip(zip(*(k.to_pylist() for k in key)), query.to_pylist(), name.to_pylist())):
                if unit != here:
                    links += search_unit(names, sets, n_index, percent)
                    here, names, sets, n_index = unit, [], [], 0
                names.append(a)
                sets.append(values[ends[i] : ends[i + 1]])
                n_index += not asks
            yield told(links)
            links = []
        yield told(search_unit(names, sets, n_index, percent))

    def told(links: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["u", "v"])

    # Most units are a few sets, so a task reads its units one after the other, in order, as a stream.
    whole = members.join(tokens, "a").select(*keys, "query", "a", "s").repartition(*keys)
    return whole.sortWithinPartitions(*keys, "query", "a").mapInArrow(search, "u bigint, v bigint")


def _size_fits(x: Column, y: Column, percent: int) -> Column:
    return (x * 100 >= y * percent) & (y * 100 >= x * percent)


def leader_links(lists: DataFrame, leaders: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """Each list's leader searched against its other members, in chunks of bounded size."""
    pairs = lists.join(leaders, "h").filter((F.col("a") != F.col("lead")) & _size_fits(F.col("n"), F.col("lead_n"), percent))
    pairs = Stored(pairs.select("lead", "a", "n").distinct()).frame
    chunks = pairs.groupBy("lead").agg(F.ceil(F.sum("n") / UNIT_TOKENS).alias("k"))
    placed = pairs.join(chunks, "lead").select("lead", F.expr("pmod(xxhash64(a), k)").alias("chunk"), "a")
    asking = placed.select("lead", "chunk").distinct().select("lead", "chunk", F.col("lead").alias("a"), F.lit(True).alias("query"))
    return search_units(placed.withColumn("query", F.lit(False)).unionByName(asking), tokens, ["lead", "chunk"], percent)


def cluster_links(members: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """Links within clusters; members: (cluster, a, n, c), c being the component known so far.

    Sizes are laid out in bands as wide as the similarity allows, so a query meets the
    sets of its own and the two neighbouring bands; both sides are cut into blocks.
    """
    sizes = members.groupBy("cluster", "c").agg(F.count(F.lit(1)).alias("m"))
    main = sizes.groupBy("cluster").agg(F.max(F.struct("m", "c")).alias("top")).select("cluster", F.col("top.c").alias("main"))
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(-math.log(percent / 100)))
    held = members.join(main, "cluster").withColumn("band", band)
    asking = held.filter("c <> main").withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    key = ["cluster", "band"]
    blocks = lambda df, name: df.groupBy(*key).agg(F.ceil(F.sum("n") / UNIT_TOKENS).alias(name))
    k = blocks(held, "ki").join(blocks(asking, "kq"), key)
    index = held.join(k, key).select(*key, F.expr("pmod(xxhash64(a), ki)").alias("ib"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("kq") - 1)).alias("qb"), "a", F.lit(False).alias("query"))
    query = asking.join(k, key).select(*key, F.explode(F.sequence(F.lit(0).cast("long"), F.col("ki") - 1)).alias("ib"), F.expr("pmod(xxhash64(1, a), kq)").alias("qb"), "a", F.lit(True).alias("query"))
    return search_units(index.unionByName(query), tokens, [*key, "ib", "qb"], percent)


def whole_sets(docs: DataFrame, doc_id: str, text: str, width: int, holders: DataFrame, cut: Cut = shingles) -> DataFrame:
    """(a, s): the whole sets named by ``holders`` (id, a), cut again from their documents."""
    ids = Stored(holders.select("id").distinct()).frame
    side = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    own = docs.select(docs[doc_id].alias("id"), docs[text].alias("body"))
    held = own.join(side, own["id"].eqNullSafe(side["id"]), "left_semi")
    sets = held.select(cut(F.col("body"), width).alias("s")).select(F.xxhash64("s").alias("a"), "s")
    return sets.join(holders.select("a"), "a", "left_semi").dropDuplicates(["a"])


def known_links(sketched: DataFrame, known: DataFrame) -> DataFrame:
    """Links (u, v) between sets that ``known`` (id, class) already has in one class."""
    told = known.filter("id is not null and class is not null")
    held = Stored(sketched.filter("n > 0").join(told, "id").select("a", "class").distinct()).frame
    first = held.groupBy("class").agg(F.min("a").alias("v"))
    return held.join(first, "class").filter("a <> v").select(F.col("a").alias("u"), "v")


def unsettled(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """The lists whose sets are not all in one component yet."""
    named = lists.join(labels, "a", "left").withColumn("c", F.coalesce("c", "a"))
    open_ = named.groupBy("h").agg(F.min("c").alias("low"), F.max("c").alias("high")).filter("low <> high").select("h")
    return lists.join(open_, "h", "left_semi")


def join_similar(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4, percent: int = 85, known: DataFrame | None = None, cut: Cut = shingles,
    passes: int = 1,
) -> DataFrame:
    """(id, n, component): size of the n-gram set and smallest id of the component of every row.

    ``known`` (id, class) names rows whose links another method has verified: lists
    within one class are not searched, all others are, so the result is as exact.
    ``cut`` makes the sorted 64-bit shingles of a text; more ``passes`` need less disk.
    """
    wide = Stored(sketches(docs, doc_id, text, width, percent, cut))
    sketched = Stored(wide.frame.select("id", "n", "a")).frame
    if passes == 1:
        sets = wide.frame.filter("n > 0").groupBy("a").agg(F.first("n").alias("n"), F.first("bottom").alias("bottom"))
    else:
        sets = different_sets(wide.frame, sketched)
    lists = Stored(short_lists(sets, percent, passes)).frame
    wide.drop()
    before = None
    if known is not None:
        before = Stored(known_links(sketched, known)).frame
        lists = Stored(unsettled(lists, components(before).select(F.col("v").alias("a"), "c"))).frame
    names = Stored(sketched.filter("n > 0").groupBy("a").agg(F.min("id").alias("id"))).frame
    tokens = Stored(whole_sets(docs, doc_id, text, width, names.join(lists.select("a").distinct(), "a", "left_semi"), cut)).frame
    leaders = lists.groupBy("h").agg(F.min(F.struct("a", "n")).alias("l")).select("h", F.col("l.a").alias("lead"), F.col("l.n").alias("lead_n"))
    links = Stored(leader_links(lists, leaders, tokens, percent)).frame
    links = links if before is None else links.unionByName(before)
    labels = components(links).select(F.col("v").alias("a"), "c")
    # A leader has met all members; a list within one component is done.
    rest = lists.join(leaders.select("h", F.col("lead").alias("a")), ["h", "a"], "left_anti")
    rest = Stored(rest.join(labels, "a", "left").withColumn("c", F.coalesce("c", "a"))).frame
    still = rest.groupBy("h").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.min("a").alias("first")).filter("low <> high").select("h", "first")
    rest = Stored(rest.join(still, "h")).frame
    tied = components(rest.filter("a <> first").select(F.col("first").alias("u"), F.col("a").alias("v")).distinct())
    members = rest.select("a", "n", "c").distinct().join(tied.select(F.col("v").alias("a"), F.col("c").alias("cluster")), "a")
    links = links.unionByName(Stored(cluster_links(Stored(members).frame, tokens, percent)).frame)
    labels = components(links).select(F.col("v").alias("a"), "c")
    named = names.join(labels, "a", "left").withColumn("c", F.coalesce("c", "a"))
    smallest = named.groupBy("c").agg(F.min("id").alias("component"))
    by_set = named.join(smallest, "c").select("a", "component")
    done = sketched.select("id", "n", F.when(F.col("n") > 0, F.col("a")).alias("a")).join(by_set, "a", "left")
    return done.select("id", F.col("n").cast("long").alias("n"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4, percent: int = 85) -> DataFrame:
    """``docs`` with one document, that of the smallest id, of each component; rows without an id stay."""
    found = join_similar(docs, doc_id, text, width, percent)
    others = Stored(found.filter(F.col("component") < F.col("id")).select(F.col("id").alias("_later")).distinct()).frame
    return docs.join(others, docs[doc_id] == others["_later"], "left_anti")
