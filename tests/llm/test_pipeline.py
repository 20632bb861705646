"""N-gram Jaccard join and the pipeline against brute force."""

from __future__ import annotations

import random

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm import helpers as H
from variantloom.llm import ngram_jaccard, piece_sampling, quality_rules
from variantloom.llm.components import components


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 330)] + [(5, 5)]
    name = {v: v for link in links for v in link}
    for _ in range(400):
        for u, v in links:
            name[u] = name[v] = min(name[u], name[v])
    got = {r.v: r.c for r in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert got == name
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_divide_skip_counts_like_a_scan():
    rng = random.Random(2)
    for _ in range(200):
        sets = [sorted(rng.sample(range(60), rng.randint(1, 40))) for _ in range(30)]
        lists: dict[int, list[int]] = {}
        for k, s in enumerate(sets):
            for t in s:
                lists.setdefault(t, []).append(k)
        import numpy as np

        query, least = sorted(rng.sample(range(60), rng.randint(1, 40))), rng.randint(1, 15)
        want = [k for k, s in enumerate(sets) if len(set(s) & set(query)) >= least]
        seen = {}
        got = ngram_jaccard.divide_skip(np.array(query), lists, least, lambda m, o, seen=seen: seen.setdefault(m, o) is not None)
        assert got == want and all(o == len(set(sets[m]) & set(query)) for m, o in seen.items())


def similar_rows(seed: int) -> list[tuple[int, str | None]]:
    """Chains of edits, shared passages, copies and awkward texts."""
    rng = random.Random(seed)
    common = H.plain(40, 900).split()
    rows: list[tuple[int, str | None]] = []
    for family in range(12):
        w = H.plain(rng.randint(30, 120), family + 1).split() + (common if family % 2 else [])
        for _ in range(rng.randint(1, 12)):
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(w).upper() if rng.random() < 0.2 else "  ".join(w)))
    rows += [(len(rows) + k, rows[3][1]) for k in range(6)]
    return rows + [(500, None), (501, ""), (502, " \n"), (503, "a b"), (504, "A  b"), (505, "a"), (506, "x y " * 20_000), (507, "x y " * 19_000)]


def test_jaccard_join(spark, monkeypatch):
    for seed, unit in ((1, 200_000), (2, 300)):
        monkeypatch.setattr(ngram_jaccard, "UNIT_TOKENS", unit)
        rows = similar_rows(seed)
        got = {r.id: r.component for r in ngram_jaccard.join_similar(H.documents(spark, rows)).collect()}
        assert got == H.components(rows, 4, 85)


def test_jaccard_join_of_nothing_and_null_ids(spark):
    assert ngram_jaccard.join_similar(H.documents(spark, [])).count() == 0
    got = sorted((str(r.id), r.n, r.component) for r in ngram_jaccard.join_similar(H.documents(spark, [(None, "a b c d e"), (7, "a b c d e"), (7, "a b c d e"), (9, None)])).collect())
    assert got == [("7", 2, 7), ("7", 2, 7), ("9", 0, 9), ("None", 2, 7)]


def brute_pipeline(rows, judged, items):
    kept = [(i, t) for i, t in rows if judged[i]]
    lines = H.deduped(kept)
    left = [(i, lines[i]) for i, t in kept if H.words(lines[i]) or not H.words(t)]
    names = H.components(left, 5, 80)
    ones = [(i, t) for i, t in left if names[i] == i]
    return {i: t for i, t in ones if not H.overlap_items(t, items)}


def test_pipeline_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    stop = "the of and to in is".split()
    text = lambda n, seed: " ".join(w + (" " + rng.choice(stop) if k % 5 == 0 else "") for k, w in enumerate(H.plain(n, seed).replace("w", "k").split()))
    items = [(k, H.plain(20, 700 + k)) for k in range(3)]
    rows: list[tuple[int, str | None]] = []
    for i in range(40):
        body = text(70, i)
        if i % 5 == 1:
            w = rows[-1][1].split(" ") if rows else body.split(" ")
            w[rng.randrange(len(w))] = "changed"
            w[rng.randrange(len(w))] = "altered"
            w[rng.randrange(len(w))] = "edited"
            body = " ".join(w)
        if i % 7 == 2:
            body += "\n" + text(60, 400)
        if i % 9 == 3:
            body += " " + items[i % 3][1]
        if i % 11 == 4:
            body = "### " * 80
        rows.append((i, body))
    rows += [(90, None), (91, ""), (92, rows[0][1])]
    docs = H.documents(spark, rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    judged = {r.doc_id: r.kept for r in quality_rules.judge(docs).select("doc_id", "quality.kept").collect()}
    want = brute_pipeline(rows, judged, items)
    out = corpus_pipeline.run(spark, str(tmp_path))
    got = out.collect()
    assert {r.doc_id: r.text for r in got} == want and 5 < len(want) < 35
    assert out.columns == [*docs.columns, "piece_ids"] and all(r.n_chars == len(r.text) for r in got)
    vocabulary = piece_sampling.Vocabulary.load(piece_sampling.model_file())
    assert all(piece_sampling.decode(r.piece_ids, vocabulary) == r.text for r in got)


def test_stages_bear_empty_tables_and_clashing_columns(spark, tmp_path):
    spark.createDataFrame([(1, "a b c d e f g h")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    good = "the of and to in is " + H.plain(80).replace("w", "k")
    for docs in (H.documents(spark, []), H.documents(spark, [(1, good), (2, None)]).withColumns({c: F.lit("q") for c in ("quality", "n_lines", "id", "item", "a", "component")})):
        out = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, out, str(tmp_path))
            assert out.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, out, str(tmp_path)).count() == min(1, docs.count())


def test_few_links_are_contracted_without_shuffles(spark, monkeypatch):
    from variantloom.llm import components as module

    rng = random.Random(8)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    frame = spark.createDataFrame(links, "u bigint, v bigint")
    found, tasks = [], []
    for few in (0, module.FEW_LINKS):
        monkeypatch.setattr(module, "FEW_LINKS", few)
        spark.sparkContext.setJobGroup(f"components-{few}", "test")
        found.append({r.v: r.c for r in components(frame).collect()})
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"components-{few}")
        stages = {s for j in jobs for s in spark.sparkContext.statusTracker().getJobInfo(j).stageIds}
        tasks.append(len(stages))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found[0] == found[1] and tasks[1] < 0.7 * tasks[0]


def test_search_indexes_only_what_queries_hold(monkeypatch):
    import numpy as np

    made = []
    sets = [np.arange(k, k + 50) for k in range(40)] + [np.array([3, 4, 5])]
    real = ngram_jaccard.divide_skip
    monkeypatch.setattr(ngram_jaccard, "divide_skip", lambda query, lists, *rest: made.append(set(lists)) or real(query, lists, *rest))
    ngram_jaccard.search_unit(list(range(41)), sets, 40, 80)
    assert made == [{3, 4, 5}]
    assert ngram_jaccard.search_unit([1, 2], [np.array([1]), np.array([1])], 2, 80) == ngram_jaccard.search_unit([], [], 0, 80) == []
