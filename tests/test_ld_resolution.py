"""LD from blocks of samples, and resolution and matching as joins."""

import itertools
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from variantloom.operators import ld, ld_blocks, ld_spectrum, phenotype

DOSAGES = "POPULATION string, CHR string, POS bigint, VARIANT_ID string, DOSAGE array<double>"


def panel(n_variants=60, n_samples=37, seed=3):
    """Correlated dosages with missing calls; one variant constant, one never called, many at one position."""
    rng = np.random.default_rng(seed)
    rows = []
    for population in ("EUR", "AFR"):
        base = rng.integers(0, 3, (6, n_samples)).astype(float)
        for v in range(n_variants):
            d = np.where(rng.random(n_samples) < 0.8, base[v % 6], rng.integers(0, 3, n_samples)).tolist()
            d = [None if rng.random() < 0.03 else float("nan") if rng.random() < 0.01 else x for x in d]
            if v == 5:
                d = [1.0] * n_samples
            if v == 6:
                d = [None] * n_samples
            rows.append((population, str(1 + v % 2), 1000 if v < 8 else v * 40_000, f"v{v:03d}", d))
    return rows


@pytest.mark.parametrize("size", [1, 5, 36, 37, 100])
def test_pairs_from_blocks_are_those_from_whole_vectors(spark, size, monkeypatch):
    monkeypatch.setattr(ld_blocks, "SUM_WIDTH", 3)  # several rounds of sums
    table = spark.createDataFrame(panel(), DOSAGES)
    want = {(r["POPULATION"], *sorted((r["ID_A"], r["ID_B"]))): r["R"] for r in ld.ld_edges(ld.standardise(table, max_missing=0.2), min_r2=0.2).collect()}
    units = ld_blocks.standardise_blocks(ld_blocks.sample_blocks(table, size), max_missing=0.2).cache()
    assert max(len(r["UNIT"]) for r in units.select("UNIT").collect()) <= size
    got = {(r["POPULATION"], r["ID_A"], r["ID_B"]): r["R"] for r in ld_blocks.ld_edges_blocked(units, min_r2=0.2, tile_bytes=1).collect()}
    assert len(want) > 100 and got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_products_of_a_pair_stay_in_their_task(spark, monkeypatch):
    units = ld_blocks.standardise_blocks(ld_blocks.sample_blocks(spark.createDataFrame(panel(), DOSAGES), 5), max_missing=0.2).cache()
    edges = ld_blocks.ld_edges_blocked(units, min_r2=0.2)
    plan = edges._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "InPandas" not in plan  # nothing but vectors is dealt out
    # What leaves a pair of tiles comes in bounded batches, whatever their size.
    monkeypatch.setattr(ld, "CELLS", 1000)
    rng = np.random.default_rng(2)
    values = rng.normal(size=(300, 4))
    pair = ld_blocks._Pair(("EUR", "1", 0, 0, 0, 0))
    pair.name(0, [f"v{k}" for k in range(300)], list(range(300)))
    for block in (0, 1):
        pair.multiply(0, block, 300, np.arange(300), values[:, 2 * block : 2 * block + 2].ravel())
    out = list(pair.edges(0.0, None))
    assert max(len(b) for b in out) <= 1000 and sum(len(b) for b in out) == 300 * 299 // 2
    got = {(r["ID_A"], r["ID_B"]): r["R"] for b in out for r in b.to_pylist()}
    assert all(a < b and abs(r - values[int(a[1:])] @ values[int(b[1:])]) < 1e-9 for (a, b), r in got.items())


def test_two_tiles_meet_once_in_any_order(spark, monkeypatch):
    monkeypatch.setattr(ld, "CELLS", 64)
    rng = np.random.default_rng(4)
    values = rng.normal(size=(40, 6))

    def side(s, members):
        return {f"IDS_{s}": [f"v{k:02d}" for k in members], f"POSITIONS_{s}": list(members), f"VALUES_{s}": values[members].ravel().tolist()}

    one, two = list(range(0, 40, 2)), list(range(1, 40, 2))
    # A tile that is collected twice may come in two orders.
    rows = [("same", one, one[::-1]), ("same", two[::-1], two), ("apart", one, two)]
    given = pa.RecordBatch.from_pylist([{"POPULATION": "EUR", "KIND": k, **side("A", a), **side("B", b)} for k, a, b in rows])
    out = list(ld._edge_kernel(0.0, None)(iter([given])))
    got = [(r["ID_A"], r["ID_B"]) for b in out for r in b.to_pylist()]
    assert max(len(b) for b in out) <= 64 and all(a < b for a, b in got) and len(got) == len(set(got)) == 40 * 39 // 2
    assert all(abs(r["R"] - values[int(r["ID_A"][1:])] @ values[int(r["ID_B"][1:])]) < 1e-9 for b in out for r in b.to_pylist())
    given = pa.RecordBatch.from_pylist([{"POPULATION": "EUR", "KIND": "index", **side("A", [3]), **side("B", two)}])
    assert sum(len(b) for b in ld._edge_kernel(0.0, None)(iter([given]))) == len(two) - 1
    # Pairs of tiles that Python sees: each once, in the bin and in the next one.
    units = spark.createDataFrame([("EUR", "1", k * 100, f"v{k:02d}", values[k].tolist()) for k in range(40)], "POPULATION string, CHR string, POS bigint, VARIANT_ID string, UNIT array<double>")
    for window in (None, 1000):
        pairs = [(r["ID_A"], r["ID_B"]) for r in ld.ld_edges(units, min_r2=0.0, window_bp=window, tile=3, spread=2).collect()]
        assert len(pairs) == len(set(pairs)) and set(pairs) == {(f"v{a:02d}", f"v{b:02d}") for a in range(40) for b in range(a + 1, 40) if window is None or b - a <= 10}


def test_single_calls_make_the_same_blocks(spark):
    rows = panel(12, 23)
    table = spark.createDataFrame(rows, DOSAGES)
    calls = [(p, c, pos, v, s, x) for p, c, pos, v, d in rows for s, x in enumerate(d) if x is not None]
    single = spark.createDataFrame(calls, "POPULATION string, CHR string, POS bigint, VARIANT_ID string, SAMPLE bigint, DOSAGE double")
    pairs = lambda blocks: sorted((r["POPULATION"], r["ID_A"], r["ID_B"], round(r["R"], 9)) for r in ld_blocks.ld_edges_blocked(ld_blocks.standardise_blocks(blocks, max_missing=0.3)).collect())
    assert pairs(ld_blocks.call_blocks(single, 7)) == pairs(ld_blocks.sample_blocks(table, 7)) != []


def test_tiles_out_of_reach_never_meet(spark):
    rows = [("EUR", "1", p * 10_000, f"v{p}", [float((p * k) % 3) for k in range(1, 9)]) for p in range(400)]
    units = ld_blocks.standardise_blocks(ld_blocks.sample_blocks(spark.createDataFrame(rows, DOSAGES), 4)).cache()
    placed = ld_blocks.position_tiles(units, 1_000_000, 10)
    sizes = [r["count"] for r in placed.groupBy("CHR", "BIN", "TILE").count().collect()]
    assert max(sizes) <= 10
    near = ld_blocks.tile_pairs(placed, 50_000)
    assert near.count() < 3.2 * len(sizes)
    assert ld_blocks.ld_edges_blocked(units.limit(0)).count() == 0


def test_smallest_eigenvalue_is_that_of_the_matrix(spark):
    rng = np.random.default_rng(8)
    n_samples, names = 7, [f"v{i:02d}" for i in range(12)]
    dosages = rng.integers(0, 3, (12, n_samples)).astype(float)
    dosages[3] = dosages[2]  # two equal variants: a singular matrix
    table = spark.createDataFrame([("EUR", "1", 10 * i, n, d.tolist()) for i, (n, d) in enumerate(zip(names, dosages))], DOSAGES)
    units = ld_blocks.standardise_blocks(ld_blocks.sample_blocks(table, 3)).cache()
    sets = {"one": names[:1], "two": names[5:7], "four": names[4:8], "equal": names[1:4], "more than samples": names[3:12]}
    members = spark.createDataFrame([(s, "EUR", v) for s, vs in sets.items() for v in [*vs, vs[0]]], "SET_ID string, POPULATION string, VARIANT_ID string")
    got = {r["SET_ID"]: r for r in ld_spectrum.smallest_eigenvalue(members, units, ridge=0.01).collect()}
    for name, vs in sets.items():
        u = np.array([dosages[names.index(v)] - dosages[names.index(v)].mean() for v in vs])
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        r = 0.99 * u @ u.T + 0.01 * np.eye(len(vs))
        assert abs(got[name]["MIN_EIGENVALUE"] - np.linalg.eigvalsh(r).min()) < 1e-6 and got[name]["RESIDUAL"] < 1e-6, name
    assert got["more than samples"]["STEPS"] <= n_samples and got["two"]["STEPS"] == 2


TERMS = [
    ("EFO_1", "Migraine", ["migraine disorder"]), ("EFO_2", "headache", ["Migraine"]), ("EFO_3", "aura", []), ("EFO_4", "cluster headache", None),
    ("EFO_5", "migraine", []), ("EFO_6", None, None), ("EFO_1", "other label", []),
]
PARENTS = [("EFO_3", "EFO_1"), ("EFO_4", "EFO_2"), ("EFO_7", "EFO_3"), ("EFO_8", "EFO_7"), ("EFO_1", "EFO_8"), ("EFO_9", "EFO_9"), (None, "EFO_1"), ("EFO_7", "EFO_3"), ("EFO_10", None)]


def resolved(spark):
    terms = spark.createDataFrame(TERMS, "term_id string, label string, synonyms array<string>")
    asked = spark.createDataFrame([("MIGRAINE",), ("Cluster_Headache",), ("Migraine disorder",), ("pinned",), ("nothing",), ("",), (None,), ("MIGRAINE",)], "PHENOTYPE string")
    pins = spark.createDataFrame([("pinned", "http://x/EFO:9"), ("pinned", "EFO_99"), ("unasked", "EFO_1")], "PHENOTYPE string, term_id string")
    more = spark.createDataFrame([("nothing", "Some Name!"), ("unasked", "x")], "PHENOTYPE string, synonym string")
    parents = spark.createDataFrame(PARENTS, "term_id string, parent_id string")
    return phenotype.resolve_terms(terms, asked, pins, more, parents)


def test_resolution_of_many_phenotypes(spark):
    found = resolved(spark)
    accepted = {}
    for r in found.accepted.collect():
        accepted.setdefault(r["PHENOTYPE"], set()).add((r["term_id"], r["resolution_type"]))
    assert accepted == {
        "MIGRAINE": {("EFO_1", "exact_label"), ("EFO_5", "exact_label")}, "Cluster_Headache": {("EFO_4", "exact_label")},
        "Migraine disorder": {("EFO_1", "exact_synonym")}, "pinned": {("EFO_9", "user_pinned"), ("EFO_99", "user_pinned")},
    }
    below = {(r["PHENOTYPE"], r["term_id"]) for r in found.below.collect()}
    # The cycle 1 - 3 - 7 - 8 - 1 ends; a term that is accepted is not below itself.
    assert below == {(p, t) for p in ("MIGRAINE", "Migraine disorder") for t in ("EFO_3", "EFO_7", "EFO_8")}
    kinds = {r["PHENOTYPE"]: (r["resolution_type"], r["phenotype_canonical"]) for r in found.summary.collect()}
    assert kinds["nothing"] == ("free_text", "nothing") and kinds["MIGRAINE"] == ("exact_label", "Migraine") and kinds["pinned"][1] == "EFO_9"
    names = {(r["PHENOTYPE"], r["NAME"]) for r in found.names.collect()}
    assert {("nothing", "some name"), ("MIGRAINE", "migraine disorder"), ("pinned", "efo 9")} <= names and not any(p == "unasked" for p, _ in names)


def test_descendants_are_reached_over_any_depth(spark):
    rng = random.Random(6)
    parents = {f"t{k}": f"t{rng.randrange(max(0, k - 3), k)}" for k in range(1, 60)} | {"t0": "t59"}
    table = spark.createDataFrame(list(parents.items()), "term_id string, parent_id string")
    starts = [("a", "t30"), ("b", "t58"), ("c", "t0"), ("d", "absent")]
    got = {(r["PHENOTYPE"], r["term_id"]) for r in phenotype.descendants(spark.createDataFrame(starts, "PHENOTYPE string, term_id string"), table).collect()}
    want = set()
    for name, start in starts:
        seen, edge = {start}, {start}
        while edge:
            edge = {c for c, p in parents.items() if p in edge} - seen
            seen |= edge
        want |= {(name, t) for t in seen - {start}}
    assert got == want and len(want) > 60


def test_matching_several_phenotypes_at_once(spark):
    studies = spark.createDataFrame(
        [("S1", "x", ["EFO_8", "EFO_1"], ["Cluster headache", "y"]), ("S2", "Migraine (women)", None, None), ("S3", "q", [], ["Some name", "SOME NAME"]),
         ("S4", "z", ["EFO_3"], []), ("S5", None, [], [None]), ("S6", "Migraine disorder", [], ["migraine"])],
        "study_accession string, reported_trait string, mapped_trait_ids array<string>, mapped_trait_labels array<string>",
    )
    got = {(r["PHENOTYPE"], r["study_accession"]): (r["match_type"], r["match_reason"]) for r in phenotype.match_resolved(studies, resolved(spark)).collect()}
    assert got == {
        ("MIGRAINE", "S1"): ("exact_mapped_trait", "mapped to accepted term EFO_1"), ("Migraine disorder", "S1"): ("exact_mapped_trait", "mapped to accepted term EFO_1"),
        ("Cluster_Headache", "S1"): ("exact_mapped_trait", "mapped trait 'Cluster headache' is the phenotype's label"),
        ("MIGRAINE", "S2"): ("exact_reported_trait", "reported trait 'Migraine (women)' is the phenotype"),
        ("Migraine disorder", "S2"): ("exact_reported_trait", "reported trait 'Migraine (women)' is the phenotype"),
        ("nothing", "S3"): ("synonym_mapped_trait", "mapped trait 'SOME NAME' is among the synonyms"),
        ("MIGRAINE", "S4"): ("descendant_term", "mapped term EFO_3 lies below an accepted term"), ("Migraine disorder", "S4"): ("descendant_term", "mapped term EFO_3 lies below an accepted term"),
        ("MIGRAINE", "S6"): ("exact_mapped_trait", "mapped trait 'migraine' is the phenotype's label"), ("Migraine disorder", "S6"): ("exact_mapped_trait", "mapped trait 'migraine' is the phenotype's label"),
    }


def test_similar_texts_meet_by_length(spark):
    import difflib

    rng = random.Random(2)
    texts = ["".join(rng.choice("ab ") for _ in range(n)).strip() for n in range(1, 40)] * 2
    reported = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "k string, NAME string")
    names = spark.createDataFrame([("p", t[:-1] + "b") for t in texts[5:30]], "PHENOTYPE string, NAME string")
    want = {}
    for (i, a), b in itertools.product(enumerate(texts), [t[:-1] + "b" for t in texts[5:30]]):
        ratio = difflib.SequenceMatcher(None, a, b).ratio()
        if ratio >= 0.8:
            want[str(i)] = max(want.get(str(i), 0), ratio)
    got = {r["k"]: r["_RATIO"] for r in phenotype.fuzzy_pairs(reported, names, "k", 0.8).collect()}
    assert got == want


def test_long_lists_are_left_as_tables(spark, monkeypatch):
    monkeypatch.setattr(phenotype, "LISTED", 2)
    terms = spark.createDataFrame([(f"T{i}", "same", []) for i in range(3)], "term_id string, label string, synonyms array<string>")
    with pytest.raises(ValueError, match="tables"):
        phenotype.resolve_phenotype(terms, "same")


@pytest.fixture(scope="module")
def long_chromosome(spark, tmp_path_factory):
    """Tables of variants on two chromosomes, up to 3 Mb from each other."""
    path, rng = str(tmp_path_factory.mktemp("tables")), np.random.default_rng(6)
    ids = [22 * 50 * i + c for i in range(13) for c in (0, 1)]
    part = [(i, "n", "b", "PROMO", i % 7, 1.0) for i in ids]
    spark.createDataFrame(part, "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{path}/part.parquet")
    vectors = [(i, [float(x) for x in rng.normal(0, 0.1, 65)]) for i in ids]
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>").write.parquet(f"{path}/embeddings.parquet")
    return path


def agrees_with_sql(spark, path, name):
    """The query's rows are those of its SQL, and some pairs are further apart than the operators' window."""
    db = duckdb.connect()
    for table in ("part", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet/*.parquet'")
    got = entry.queries()[name](spark, path)
    want = db.execute(f'SELECT {", ".join(got.columns)} FROM ({entry.oracle_sql()[name]})').fetchall()
    rounded = lambda rows: sorted(tuple(round(x, 5) if isinstance(x, float) else x for x in row) for row in rows)
    assert rounded(want) == rounded(tuple(r) for r in got.collect())
    place = lambda name: int(name.split(":")[1])
    assert any(abs(place(r["ID_A"]) - place(r["ID_B"])) > 1_000_000 for r in got.collect())


def test_pairs_of_whole_chromosomes(spark, long_chromosome):
    agrees_with_sql(spark, long_chromosome, "ld_pairs")


def test_blocked_pairs_of_whole_chromosomes(spark, long_chromosome):
    agrees_with_sql(spark, long_chromosome, "ld_pairs_blocked")


def test_weaker_pairs_of_whole_chromosomes(spark, long_chromosome):
    agrees_with_sql(spark, long_chromosome, "ld_pairs_default")


def test_stabilised_pairs_of_whole_chromosomes(spark, long_chromosome):
    agrees_with_sql(spark, long_chromosome, "ld_stabilise")


def test_small_sets_take_no_steps(spark, monkeypatch):
    """Two variants are solved in their row; with steps, as large sets are, the value is the same."""
    stored, store = [], ld_spectrum.checkpointed
    monkeypatch.setattr(ld_spectrum, "checkpointed", lambda df: stored.append(df.columns) or store(df))
    table = spark.createDataFrame([("EUR", "1", 10 * i, f"v{i}", [float((i * k * k) % 3) for k in range(1, 8)]) for i in (1, 2)], DOSAGES)
    units = ld_blocks.standardise_blocks(ld_blocks.sample_blocks(table, 3)).cache()
    members = spark.createDataFrame([("s", "EUR", "v1"), ("s", "EUR", "v2")], "SET_ID string, POPULATION string, VARIANT_ID string")
    value = lambda: [r["MIN_EIGENVALUE"] for r in ld_spectrum.smallest_eigenvalue(members, units).collect()]
    direct = value()
    assert len(stored) <= 2
    monkeypatch.setattr(ld_spectrum, "SMALL", 0)
    assert len(direct) == 1 and value() == pytest.approx(direct, abs=1e-9)
