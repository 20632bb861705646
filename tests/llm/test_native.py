"""Quality rules, licence scan, line dedup and decontamination against brute force."""

from __future__ import annotations

import itertools
import random
import textwrap

from pyspark.sql import functions as F

from tests.llm import helpers as H
from variantloom.llm import decontaminate, license_scan, line_dedup, quality_rules
from variantloom.llm.common import free_name


def test_quality_counts_and_verdict(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("a b c the of #x d\n".split(" ")) for _ in range(rng.randint(0, 90)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \t\n"), (103, H.plain(60) + " the of and to"), (103, H.plain(60) + " the of and to"), (None, "x"), (105, "the of " * 30_000)]
    got = quality_rules.judge(H.documents(spark, rows)).select("doc_id", "text", "quality.*").collect()
    assert len(got) == len(rows)
    for r in got:
        w = H.words(r.text)
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        many = {g for g in grams if grams.count(g) > 1} if len(w) < 1000 else set(grams)
        covered = {i + k for i, g in enumerate(grams) if g in many for k in range(3)}
        lines = [x for x in (r.text or "").split("\n") if H.words(x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), len(covered))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in r.text or "") and r.n_dup_lines == len(lines) - len(set(lines))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r.kept and r.base_failed)
    assert [r.kept for r in got if r.doc_id == 103] == [True, True]


def test_quality_thresholds(spark):
    good = H.plain(96) + " the of and to"
    texts = {"symbols": good + " ### $$$ ***" * 3, "upper_case": " ".join(f"ABCDEF{i}" for i in range(90)) + " the of and to", "few_stop_words": H.plain(100), "word_length": "the of " + " ".join(f"{'y' * 40}{i}" for i in range(60))}
    got = {r.doc_id: r.failed for r in quality_rules.judge(H.documents(spark, list(enumerate(texts.values())))).select("doc_id", "quality.failed").collect()}
    for i, name in enumerate(texts):
        assert name in got[i], (name, got[i])


def test_empty_tables_and_clashing_names(spark):
    empty = H.documents(spark, [])
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert quality_rules.judge(empty).count() == license_scan.scan(empty).count() == line_dedup.dedup_lines(empty).count() == 0
    assert decontaminate.overlaps(empty, items).count() == 0
    clash = H.documents(spark, [(1, H.plain(30) + "\n" + H.plain(20, 3)), (2, H.plain(20, 3))]).withColumns({c: F.lit(7) for c in ("n_lines", "kept_lines", "id", "th", "i", "w", "line", "h", "at", "key", "quality", "n_removed", "item", "dedup_result")})
    assert free_name(clash, "quality") == "quality_"
    done = line_dedup.dedup_lines(clash)
    assert done.columns == [*clash.columns, "n_lines_", "n_removed_"] and done.filter("n_removed_ = 1").count() == 1
    assert decontaminate.decontaminate(clash, spark.createDataFrame([(5, H.plain(20, 3))], "item_id bigint, text string")).count() == 0


def test_license_sentences_have_cues():
    for _, sentence in license_scan.SENTENCES:
        assert any(c in sentence.lower() for c in license_scan.CUES), sentence
    names = {name for name, _ in license_scan.SENTENCES}
    assert {x for _, seq in license_scan.RULES for x in seq} <= names


def test_license_sentences_wrapped_at_every_blank(spark):
    assert all(any(c in w for c in license_scan.CUES for w in license_scan.normal_text(s).split(" ")) for _, s in license_scan.SENTENCES)
    cases = [(name, s[:i] + parted + s[i + 1 :] + ".") for name, s in license_scan.SENTENCES for i, c in enumerate(s) if c == " " for parted in ("\n * ", "  ")]
    got = license_scan.scan(H.documents(spark, [(i, text) for i, (_, text) in enumerate(cases)])).select("doc_id", "license.sentences").collect()
    assert len(got) == len(cases)
    for r in got:
        assert r.sentences == [cases[r.doc_id][0]], cases[r.doc_id]


BSD_3 = """Copyright (c) 2020, A. Holder. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED.
"""


def test_license_published_and_narrow_texts(spark):
    commented = "\n".join(f" * {line}" for line in BSD_3.split("\n"))
    forms = [BSD_3, commented] + [text.replace("1. ", a).replace("2. ", b).replace("3. ", c) for text in (BSD_3, commented) for a, b, c in (("1) ", "2) ", "3) "), ("(a) ", "(b) ", "(c) "), ("i. ", "ii. ", "iii. "), ("* ", "* ", "* "))]
    two = [t[: t.index("3. ")] + "THIS SOFTWARE" for t in (BSD_3, commented)]
    rows = list(enumerate(forms + two))
    narrow = {100 + k: (name, "\n".join(f"// {line}" for line in (textwrap.wrap(s, width, break_long_words=False) if width else s.split(" ")))) for k, ((name, s), width) in enumerate(itertools.product(license_scan.SENTENCES, (0, 12, 20, 40, 60)))}
    rows += [(i, text + ".") for i, (_, text) in narrow.items()]
    rows += [(9000, "1. MIT License\n2. Licensed under the GNU General Public License, version\n3.\n4. word"), (9001, "the\n" * 30_000 + "MIT\nLicense\n" + "permission " * 100_000)]
    got = {r.doc_id: r for r in license_scan.scan(H.documents(spark, rows)).select("doc_id", "license.*").collect()}
    for i in range(len(forms)):
        assert got[i].licenses == ["BSD-3-Clause"] and got[i].unresolved == ["AllRights"], rows[i]
    for i in range(len(forms), len(forms + two)):
        assert got[i].licenses == ["BSD-2-Clause"] and got[i].unresolved == ["AllRights"], rows[i]
    for i, (name, text) in narrow.items():
        assert got[i].sentences == [name], text
    assert got[9000].sentences == ["MitTitle", "GplNotice3"] and got[9001].sentences == ["MitTitle"]


def test_license_scan(spark):
    mit = [s for n, s in license_scan.SENTENCES if n in ("MitGrant", "MitKeep", "MitAsIs")]
    wrapped = "\n".join(f"# {line}" for s in mit for line in (s[: s.index(" ", 60)], s[s.index(" ", 60) + 1 :] + "."))
    rows = [
        (1, "Some text.\nLicensed under the Apache License, Version 2.0."),
        (2, wrapped),
        (3, "One thing. released under the mit licence! Another; Licensed under CC BY-NC 4.0"),
        (4, "This is not licensed under the Apache License, Version 2.0 at all."),
        (5, None), (6, ""), (7, "All rights reserved."), (7, "All rights reserved."),
        (8, "word " * 50_000 + ".\nMIT License"),
    ]
    got = [(r.doc_id, r.sentences, r.licenses, r.unresolved) for r in license_scan.scan(H.documents(spark, rows)).select("doc_id", "license.*").orderBy("doc_id").collect()]
    want = [
        (1, ["ApacheNotice"], ["Apache-2.0"], []), (2, ["MitGrant", "MitKeep", "MitAsIs"], ["MIT"], []), (3, ["MitNotice", "CcByNc4"], ["MIT", "CC-BY-NC-4.0"], []),
        (4, [], [], []), (5, [], [], []), (6, [], [], []), (7, ["AllRights"], [], ["AllRights"]), (7, ["AllRights"], [], ["AllRights"]), (8, ["MitTitle"], [], ["MitTitle"]),
    ]
    assert got == want


def test_line_dedup(spark):
    rng = random.Random(4)
    bases = [[f"v{rng.randint(0, 6)}" for _ in range(rng.randint(7, 12))] for _ in range(12)]
    rows: list[tuple[int, str | None]] = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(0, 5)):
            w = list(rng.choice(bases))
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(w))
                w[at : at + rng.randint(0, 1)] = rng.choice(([], ["z"], [w[at]]))
            lines.append(rng.choice(("  ".join(w), " ".join(w) + " ", "", "ab")))
        rows.append((i, "\n".join(lines)))
    rows += [(90, None), (91, ""), (92, "\n\n"), (93, "long " * 20_000), (94, "long " * 19_999), (95, "one  two")]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(H.documents(spark, rows)).collect()}
    assert got == H.deduped(rows)


def test_line_dedup_repeated_rows_and_null_ids(spark):
    line = H.plain(12)
    rows = [(1, line), (1, line), (None, line + "\nx y"), (2, line.replace(" ", "  "))]
    got = sorted((str(r.doc_id), r.text) for r in line_dedup.dedup_lines(H.documents(spark, rows)).collect())
    # A null id comes first, equal rows stay alike.
    assert got == [("1", ""), ("1", ""), ("2", ""), ("None", line + "\nx y")]


def test_masks_hit_every_window():
    window, masks = range(decontaminate.WINDOW), decontaminate.MASKS
    for changed in itertools.combinations(window, decontaminate.TOLERANCE):
        assert any(not {s + m for m in mask} & set(changed) for mask in masks for s in range(decontaminate.WINDOW - mask[-1]))


def test_decontamination(spark):
    rng = random.Random(6)
    items: list[tuple[int, str | None]] = [(k, H.plain(n, 50 + k)) for k, n in enumerate((30, 13, 20, 12, 6, 4, 60))] + [(20, None), (21, "")]
    rows: list[tuple[int | None, str | None]] = [(-1, None), (-2, ""), (-3, H.plain(300, 99))]
    for i in range(80):
        body = H.words(items[rng.randrange(7)][1])
        a = rng.randrange(len(body))
        part = [w.upper() + "," if rng.random() < 0.2 else w for w in body[a : a + rng.randint(5, 25)]]
        for _ in range(rng.randint(0, 4)):
            part[rng.randrange(len(part))] = "other"
        rows.append((i, " ".join([H.plain(rng.randint(0, 4), i + 200), *part, H.plain(rng.randint(0, 4), i + 300)])))
    rows.append((500, H.plain(30_000, 77) + " " + items[0][1]))
    docs, bench = H.documents(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.id, r.item): r.best_words for r in decontaminate.overlaps(docs, bench).collect()}
    want = {(i, k): n for i, t in rows if i != 500 for k, n in H.overlap_items(t, items).items()} | {(500, 0): 13}
    assert got == want and len(want) > 10
    clean = {r.doc_id for r in decontaminate.decontaminate(docs, bench).collect()}
    assert clean == {i for i, _ in rows} - {i for i, _ in want}


def test_variants_are_counted_by_one_hash(spark, monkeypatch):
    """The count of variants hashes every line once, with the first of the two hashes that the variants carry."""
    texts = ["a b c d e f g h", "a  b\tc d e\x0bf g h ", "x " * 9, "é ñ", "one"]
    w = line_dedup.line_words(F.col("text"))
    rows = H.documents(spark, list(enumerate(texts))).select(
        w.alias("w"), line_dedup.deletion_hashes(w).alias("single"), line_dedup.variant_hashes(w).getField("v1").alias("v1"), line_dedup.half_keys(w).alias("halves")
    )
    for text, r in zip(texts, rows.collect()):
        assert r.w == H.words(text) and r.single == r.v1 and len(r.v1) == len(r.w) + 1
        assert len(r.halves) == (2 if len(r.w) % 2 else 4)
    seen = []
    real = line_dedup.Stored
    monkeypatch.setattr(line_dedup, "Stored", lambda df: seen.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df))
    lines = [(1, texts[0]), (2, texts[0] + "x")]
    active = H.documents(spark, lines).select(F.col("doc_id").alias("id"), F.lit(1).alias("th"), F.lit(0).alias("i"), line_dedup.words(F.col("text")).alias("w"))
    found = line_dedup.variants(active).collect()
    assert {r.at for r in found} == {7} and len(found) == 2
    assert seen[0].count("transform(w#") == 2
