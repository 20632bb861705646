"""Prefix trie, document fingerprints and collocations against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.llm import helpers as H
from variantloom.llm import collocations, common, minhash, prefix_trie

CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"
TRIE = ["conv", "depth", "parent", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256"]


def brute_trie(seqs: dict[int, list[tuple[str, str]]]) -> set[tuple]:
    """Every node by spelling out every prefix of every conversation."""
    members, ends = defaultdict(list), defaultdict(list)
    for conv in sorted(seqs):
        for d in range(len(seqs[conv]) + 1):
            members[tuple(seqs[conv][:d])].append(conv)
        ends[tuple(seqs[conv])].append(conv)
    kids, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for p, convs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(convs) - 1) * len(p[-1][1].encode()) if p else 0
    return {
        (convs[0], len(p), members[p[:-1]][0] if p else None, len(convs), kids[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest())
        for p, convs in members.items()
    }


def ordered(rows) -> dict[int, list[tuple[str, str]]]:
    """Turns by turn, nulls first, equal ones by digest."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            r, t = role or "", text or ""
            by[conv].append((turn is not None, turn or 0, hashlib.md5(f"{len(r)}:{r}{t}".encode()).hexdigest(), (r, t)))
    return {conv: [x[-1] for x in sorted(turns)] for conv, turns in by.items()}


def rebuilt(seqs):
    out = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = seqs.get(base, [])[:h] + own[h:]
    return out


def awkward_conversations():
    rng = random.Random(5)
    rows = []
    for conv in range(-7, 60):
        if conv % 11 == 0:
            continue
        for turn in range(rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 33, 40])):
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "é", "", None])))
    rows += [(100, None, "user", "first"), (100, 3, "user", "x"), (100, 3, "user", "y"), (100, 3, "user", "x"), (100, -1, None, "z" * 200_000)]
    rows += [(101, t, "user", f"t{t}") for t in range(64)] + [(c, t, "user", f"t{t}") for c in (110, 115, 116) for t in range(64)]
    rows += [(None, 0, "user", "lost"), (200, 0, None, None)]
    return rows


def test_trie_of_rebuilt_conversations(spark):
    rows = awkward_conversations()
    rng = random.Random(1)
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, CONVERSATIONS).withColumns({c: F.lit(3) for c in ("name", "depth", "first", "weight", "cut", "turns", "forests", "conv", "x")})
    got = prefix_trie.prefix_trie(prefix_trie.rebuilt(table)).select(*TRIE).collect()
    want = brute_trie(rebuilt(ordered(rows)))
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert any(r.depth == 0 and r.parent is None for r in got)


def test_trie_of_copies_and_single_turns(spark):
    rows = [(c, t, "user", f"t{t}") for c in range(300) for t in range(5)] + [(c, 0, "user", f"alone {c}") for c in range(300, 320)]
    table = spark.createDataFrame(rows, CONVERSATIONS)
    got = prefix_trie.prefix_trie(prefix_trie.sequences(table)).select(*TRIE).collect()
    assert {tuple(r) for r in got} == brute_trie(ordered(rows))


def test_pieces_of_long_lists_are_joined(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 7)
    ends = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), F.col("id") % 50)).alias("name"), F.col("id").alias("conv"))
    want = defaultdict(list)
    for r in ends.collect():
        want[r.name].append(r.conv)
    got = {r.name: r.ends_sha256 for r in prefix_trie.end_digests(ends.repartition(6)).collect()}
    assert got == {n: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest() for n, ids in want.items()}


def test_empty_trie(spark):
    empty = spark.createDataFrame([], CONVERSATIONS)
    assert prefix_trie.prefix_trie(prefix_trie.rebuilt(empty)).count() == 0
    lost = spark.createDataFrame([(None, 0, "user", "x")], CONVERSATIONS)
    assert prefix_trie.prefix_trie(prefix_trie.rebuilt(lost)).count() == 0
    # A conversation whose turns all fall away, as its base is absent, is a member of the root.
    short = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    got = prefix_trie.prefix_trie(prefix_trie.rebuilt(spark.createDataFrame([(short, 0, "user", "x")], CONVERSATIONS))).collect()
    assert [(r.conv, r.depth, r.n_convs, r.n_leaves) for r in got] == [(short, 0, 1, 1)]


def near_documents():
    """Awkward rows, copies and near copies of two bases, and unlike texts."""
    rng = random.Random(9)
    rows = [(0, None), (1, ""), (2, " \n"), (3, "two words"), (4, "Two  Words"), (5, "é" * 9), (6, H.plain(30_000, 5)), (7, "x" * 1_200_000)]
    for k in range(30):
        words = H.plain(120, 11).split(" ")
        for _ in range(k % 3):
            words[rng.randrange(120)] = f"new{k}"
        rows.append((100 + k, " ".join(words)))
    rows += [(200 + k, H.plain(90, 100 + k)) for k in range(20)] + [(300 + k, H.plain(90, 100 + k).upper()) for k in range(5)]
    # Half of each text is common: alike enough to share keys, not to be linked.
    rows += [(400 + k, H.plain(60, 7) + " " + H.plain(60, 500 + k)) for k in range(25)]
    return rows


def test_fingerprints_of_rows_and_edits(spark):
    rows = near_documents()
    got = {r.id: r for r in minhash.fingerprints(H.documents(spark, rows).repartition(5)).collect()}
    assert len(got) == len(rows)
    for (name, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        text, after = text or "", after or ""
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + after[:quarter]
        r = got[name]
        assert (r.n_chars, r.n_words) == (len(text), len(H.words(text)))
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        for value, other in ((r.near_edited, changed), (r.near_next, after)):
            a, b = H.shingle_set(text, 5), H.shingle_set(other, 5)
            assert abs(value - (len(a & b) / len(a | b) if a | b else 1)) < 0.2 and 0 <= value <= 1
        assert (bytes(r.mark) == bytes(got[name + 100].mark)) if 200 <= name < 205 else True
    assert bytes(got[3].mark) == bytes(got[4].mark) and bytes(got[0].mark) == bytes(got[1].mark) == b"\xff" * 128


def test_long_texts_are_read_in_blocks(monkeypatch):
    text = H.plain(700, 3) + "  \n" + "y" * 500 + " end"
    whole = minhash.fingerprint(text)
    for size in (1, 3, 50, 1000):
        monkeypatch.setattr(minhash, "CHUNK", size)
        monkeypatch.setattr(minhash, "BLOCK", size)
        assert minhash.fingerprint(text) == whole


def test_order_of_rows_without_and_with_equal_ids(spark):
    rows = [(None, "no id"), (4, "four a"), (4, "four a"), (9, "nine"), (2, "two")]
    got = minhash.fingerprints(H.documents(spark, rows)).select("id", "n_chars", "near_next").collect()
    assert sorted(r.near_next for r in got if r.id == 4) == [0.0, 1.0] and len(got) == 5
    alone = minhash.fingerprints(H.documents(spark, [(1, "a b c")])).collect()
    assert [r.near_next for r in alone] == [1.0]
    empty = H.documents(spark, [])
    assert minhash.near_classes(minhash.fingerprints(empty), empty).count() == 0


def test_near_classes_are_those_of_all_pairs(spark):
    rows = near_documents()
    docs = H.documents(spark, rows).withColumns({c: F.lit(1) for c in ("a", "key", "lead", "body", "mark", "u", "v", "class")})
    got = {r.id: r["class"] for r in minhash.near_classes(minhash.fingerprints(docs), docs).collect()}
    assert got == H.components(rows, 5, 80)


@pytest.mark.parametrize("keys", ["none", "one"])
def test_links_that_the_bands_leave_out(spark, monkeypatch, keys):
    """Texts that share no key, or one key under an unlike leader, are linked all the same."""
    monkeypatch.setattr(minhash, "band_keys", lambda mark: F.array(F.xxhash64(mark) if keys == "none" else F.lit(7).cast("bigint")))
    rows = near_documents()
    docs = H.documents(spark, rows)
    got = {r.id: r["class"] for r in minhash.near_classes(minhash.fingerprints(docs), docs).collect()}
    assert got == H.components(rows, 5, 80)


def test_recall_of_planted_pairs(spark):
    """Of all links at 0.8 among random edits at least 99 in 100 join their two texts."""
    rng = random.Random(4)
    rows = []
    for k in range(60):
        base = H.plain(150, 40 + k).split(" ")
        for j in range(6):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(150)] = f"e{rng.random()}"
            rows.append((10 * k + j, " ".join(words)))
    docs = H.documents(spark, rows)
    got = {r.id: r["class"] for r in minhash.near_classes(minhash.fingerprints(docs), docs).collect()}
    sets = {i: H.shingle_set(t, 5) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if a // 10 == b // 10 and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert sum(got[a] == got[b] for a, b in links) >= 0.99 * len(links) > 100
    assert all(got[i] // 10 == i // 10 for i in got)


def test_shuffles_of_stored_tables_leave_no_files(spark):
    """Texts are shuffled once, to be sorted by id; what they filled on disk is free when they are stored."""
    folders = [Path(d.getPath()) for d in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()]
    kept = lambda: {f for d in folders for f in d.rglob("shuffle_*.data")}
    before, setting = kept(), spark.conf.get(common.CLEANUP)
    frame = common.Stored(H.documents(spark, near_documents()).repartition(3, "doc_id")).frame
    until = time.monotonic() + 10
    while kept() - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not kept() - before and frame.count() == len(near_documents())
    assert spark.conf.get(common.CLEANUP) == setting


def test_shingle_sets_of_awkward_texts(spark):
    texts = ["", None, " \t\x0b ", "a", "A  b", "a b c d e", "A b\tc\nd e e", "b a c d e", "x " * 40, H.plain(60)]
    docs = H.documents(spark, list(enumerate(texts)))
    got = {r.doc_id: r.s for r in docs.select("doc_id", minhash.shingle_sets(docs["text"], 5).alias("s")).collect()}
    want = [H.shingle_set(t, 5) for t in texts]
    assert all(s == sorted(set(s)) for s in got.values())
    for i, j in itertools.product(range(len(texts)), repeat=2):
        assert len(set(got[i]) & set(got[j])) == len(want[i] & want[j])


def brute_phrases(rows, least=10, top=2000):
    """Every phrase of one to three words counted by hand."""
    counts, sizes = defaultdict(Counter), Counter()
    for text, lang in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = re.findall("[^\x20\x09]+", piece)
            sizes["und" if lang is None else lang] += len(w)
            for k in (1, 2, 3):
                counts["und" if lang is None else lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        told = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and p in [q[i : i + len(p)] for i in range(len(q) - len(p) + 1)] for q, b in found.items()):
                continue
            score, cut = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            told.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        out += [(lang, n, p.decode(), -a, x, y, sizes[lang], -s) for n, (s, a, p, x, y) in enumerate(sorted(told)[:top], 1)]
    return sorted(out)


def phrase_rows():
    rng = random.Random(8)
    vocabulary = ["the", "The", "of", "New", "york", "city", "é", "x\x00", "...", "a-b", "\x0b", "\t", "hall"]
    rows = []
    for n in range(120):
        text = "".join(rng.choice(vocabulary) + rng.choice([" ", "  ", "\t", ", ", "\n", ".", " "]) for _ in range(rng.randint(0, 60)))
        rows.append((text + " new york city " * (n % 3), rng.choice(["en", "de", None, ""])))
    return rows + [(None, "en"), ("", None), ("same same same", "en"), ("same same same", "en"), ("la " * 30_000, "fr")]


def test_collocations_are_those_of_brute_force(spark, monkeypatch):
    rows = phrase_rows()
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], "doc_id bigint, text string, lang string")
    docs = docs.withColumns({c: F.lit(1) for c in ("words", "piece", "phrase", "f", "i", "slot_", "rank")})
    want = brute_phrases(rows)
    assert len({w[0] for w in want}) > 3
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == want
    few = collocations.Limits(least_count=4, top=7)
    assert sorted(map(tuple, collocations.collocations(docs, limits=few).collect())) == brute_phrases(rows, 4, 7)
    # The smallest bitmap is full at once: it lets everything through, and the counts decide.
    monkeypatch.setattr(common, "FILTER_WORDS", 1)
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == want


def test_scores_of_large_counts_are_exact(spark):
    a, left, right = 3_000_000_000_007, 7_000_000_000_001, 5_000_000_000_003
    level = lambda rows: spark.createDataFrame(rows, "lang string, phrase string, f bigint")
    got = collocations.scored([level([("en", "x", left), ("en", "y", right)]), level([("en", "x y", a)])]).collect()
    assert [r.score for r in got] == [1_000_000 * a * a // (left * right)]


def test_no_documents_no_phrases(spark):
    assert collocations.collocations(H.documents(spark, [])).count() == 0
    assert collocations.collocations(H.documents(spark, [(1, None), (2, "one"), (3, ".,;")])).count() == 0


def test_bitmap_keeps_what_it_holds(spark):
    held = spark.range(500).select(F.xxhash64("id").alias("h"))
    near = common.may_hold(spark.range(5000), F.xxhash64("id"), common.bitmap(held))
    ids = {r.id for r in near.collect()}
    assert ids >= set(range(500)) and len(ids) < 520


def test_edited_texts_are_read_on_from_their_beginning():
    """The words of the first three quarters are hashed once for a text and its edited text, with the same fingerprints."""
    texts = ["", "a", "a b", "ab  ", "  ab", "a b c d", "a b c d e", "ÉÉ é ñ X", "\x0bA\x0c b\r\n c", "x" * 50, " " * 7, *(t or "" for _, t in near_documents()[::9])]
    for text, after in itertools.product(texts, texts[::3]):
        begun = minhash.begun(text)
        assert begun[:3] == minhash.fingerprint(text)
        told = minhash._told((1, text, *begun), (2, after, *minhash.fingerprint(after)))
        assert told[5] == minhash.fingerprint(minhash.edited(text, after))[0]
    read = []
    with pytest.MonkeyPatch.context() as patch:
        blocks = minhash.word_blocks
        patch.setattr(minhash, "word_blocks", lambda body: read.append(len(body)) or blocks(body))
        text = "a b c d " * 100
        row = (1, text, *minhash.begun(text))
        minhash._told(row, (2, "e " * 400, *minhash.fingerprint("e")))
    assert sum(read) <= 1.3 * len(text)
