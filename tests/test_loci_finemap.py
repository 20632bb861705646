"""Clumping, loci, LD, fine-mapping against sequential references."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from variantloom.operators import finemap, ld, loci, region

LEADS = "POPULATION string, CHR string, LEAD_POS bigint, LEAD_VARIANT string, LEAD_P double"


def test_clump_and_loci(spark):
    variants = spark.createDataFrame(
        [("EUR", "1", 100, 1e-10, "a"), ("EUR", "1", 150, 1e-9, "b"), ("EUR", "1", 5000, 1e-12, "c")],
        "POPULATION string, CHR string, POS bigint, P double, VARIANT_ID string",
    )
    edges = spark.createDataFrame([("EUR", "a", "b", 0.9), ("EUR", "b", "a", 0.9)], "POPULATION string, ID_A string, ID_B string, R double")
    members = loci.clump_members(variants, edges, kb=1)
    clumps = {r["LEAD_VARIANT"]: r["N_MEMBERS"] for r in loci.clumps(members).collect()}
    assert clumps == {"a": 2, "c": 1}
    leads = loci.clumps(members).select("POPULATION", "CHR", "LEAD_POS", "LEAD_VARIANT", "LEAD_P")
    table = loci.construct_loci(leads, window_bp=100)
    assert {r["LOCUS_ID"] for r in table.collect()} == {"EUR:1:1-200", "EUR:1:4900-5100"}
    lists = loci.with_member_lists(loci.clumps(members), members, ["POPULATION", "LEAD_VARIANT"], "VARIANT_ID", "MEMBERS", ["VARIANT_ID"])
    assert {r["LEAD_VARIANT"]: r["MEMBERS"] for r in lists.collect()} == {"a": ["a", "b"], "c": ["c"]}


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_clump_equals_sequential_greedy(spark, seed):
    rng = np.random.default_rng(seed)
    n = 60
    r = np.triu((rng.random((n, n)) < 0.08) * 0.9, 1)
    r = r + r.T
    p = np.where(rng.random(n) < 0.7, 10.0 ** -rng.integers(8, 30, n), 0.01)
    pos = rng.integers(1, 2_000_000, n)
    chrom = rng.choice(["1", "2"], n)
    ids = [f"v{i:03d}" for i in range(n)]
    expected, free = {}, np.ones(n, bool)
    for i in sorted(range(n), key=lambda i: (p[i], ids[i])):
        if not free[i] or p[i] > 5e-8:
            continue
        near = free & (chrom == chrom[i]) & (np.abs(pos - pos[i]) <= 1_000_000) & (r[i] ** 2 >= 0.1)
        near[i] = True
        expected[ids[i]] = {ids[j] for j in np.flatnonzero(near)}
        free[near] = False
    variants = spark.createDataFrame(pd.DataFrame({"POPULATION": "EUR", "CHR": chrom, "POS": pos, "P": p, "VARIANT_ID": ids}))
    a, b = np.nonzero(r)
    edges = spark.createDataFrame(pd.DataFrame({"POPULATION": "EUR", "ID_A": [ids[i] for i in a], "ID_B": [ids[j] for j in b], "R": r[a, b]}))
    got = loci.clump_members(variants, edges).toPandas().groupby("LEAD_VARIANT").VARIANT_ID.apply(set).to_dict()
    assert got == expected


def test_loci_lists_members_and_union(spark):
    leads = spark.createDataFrame(
        [("EUR", "1", 1000, "b", 1e-9), ("EUR", "1", 500, "a", 1e-8), ("EUR", "1", 9000, "c", 1e-20), ("AFR", "1", 1500, "d", 1e-10)], LEADS
    )
    table = {r["LOCUS_ID"]: r for r in loci.loci_with_lead_lists(leads, window_bp=300).collect()}
    assert table["EUR:1:200-1300"]["LEAD_VARIANTS"] == ["a", "b"] and table["EUR:1:200-1300"]["LEAD_P"] == 1e-9
    own = loci.construct_loci(leads, window_bp=300)
    real = {(r["START"], r["END"]): r["N_LEADS"] for r in loci.union_loci(own).collect()}
    assert real == {(200, 1800): 3, (8700, 9300): 1}
    points = {(r["START"], r["END"]) for r in loci.union_loci(own, mode="midpoint").collect()}
    assert points == {(750, 750), (1500, 1500), (9000, 9000)}
    assert loci.construct_loci(leads.limit(0)).count() == 0
    with pytest.raises(ValueError):
        loci.union_loci(own, mode="other")


def units_of(spark, matrix, ids, population="EUR"):
    rows = [(population, "1", 1000 * i, name, [float(x) for x in row]) for i, (name, row) in enumerate(zip(ids, matrix, strict=True))]
    return spark.createDataFrame(rows, "POPULATION string, CHR string, POS bigint, VARIANT_ID string, DOSAGE array<double>")


def test_ld_equals_corrcoef(spark):
    rng = np.random.default_rng(5)
    g = rng.integers(0, 3, (30, 40)).astype(float)
    g[3, 5] = np.nan
    ids = [f"v{i:02d}" for i in range(30)]
    filled = np.where(np.isnan(g), np.nanmean(g, axis=1, keepdims=True), g)
    want = np.corrcoef(filled)
    units = ld.standardise(units_of(spark, g, ids))
    got = {(r["ID_A"], r["ID_B"]): r["R"] for r in ld.ld_edges(units, min_r2=0.0, tile=7, spread=2).collect()}
    assert len(got) == 30 * 29 // 2
    for (a, b), value in got.items():
        assert value == pytest.approx(want[ids.index(a), ids.index(b)], abs=1e-12)
    narrow = ld.ld_edges(units, min_r2=0.0, window_bp=3000, tile=5).count()
    assert narrow == 29 + 28 + 27
    index = units.filter(F.col("VARIANT_ID").isin("v03", "v10")).select("POPULATION", "VARIANT_ID")
    assert ld.ld_edges(units, index, min_r2=0.0, tile=4, spread=1).count() == 2 * 29
    members = units.select(F.lit("S").alias("SET_ID"), "POPULATION", "VARIANT_ID")
    low = ld.min_abs_r(members, units, tile=5, spread=2).first()["MIN_ABS_R"]
    assert low == pytest.approx(np.abs(want).min(), abs=1e-12)


def test_panel_quality_filter(spark):
    g = np.array([[0.0] * 20, [2.0] * 19 + [1.0], [0.0, 1.0] * 10, [np.nan] * 2 + [0.0, 1.0] * 9])
    kept = ld.standardise(units_of(spark, g, ["mono", "common", "fine", "missing"]), maf=0.01, max_missing=0.05)
    assert {r["VARIANT_ID"] for r in kept.collect()} == {"common", "fine"}


def test_stabilise(spark):
    table = spark.createDataFrame(
        [("EUR", "a", "b", 0.5), ("EUR", "b", "a", 0.7), ("EUR", "a", "a", 0.9)], "POPULATION string, ID_A string, ID_B string, R double"
    )
    rows = {(r["ID_A"], r["ID_B"]): (r["R"], r["SYMMETRY_ERROR"]) for r in ld.stabilise(table, ridge=0.1).collect()}
    assert rows[("a", "b")] == (pytest.approx(0.54), pytest.approx(0.2)) and rows[("a", "a")][0] == 1.0
    with pytest.raises(Exception, match="non-finite"):
        ld.stabilise(table.withColumn("R", F.lit(float("nan")))).collect()


def test_stabilise_of_single_pairs_shuffles_nothing(spark):
    rng = np.random.default_rng(9)
    ids = [f"v{i:02d}" for i in range(25)]
    units = ld.standardise(units_of(spark, rng.integers(0, 3, (25, 12)).astype(float), ids)).cache()
    found = ld.ld_edges(units, min_r2=0.05, tile=4, spread=2)
    edges = spark.createDataFrame(found.collect(), found.schema)
    assert edges.count() == edges.select("ID_A", "ID_B").distinct().count() > 50
    both = {tuple(r) for r in ld.stabilise(ld.both_ways(edges)).collect()}
    once = ld.stabilise(edges, once=True)
    assert both == {tuple(r) for r in once.collect()}
    assert "Aggregate" not in once._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(Exception, match="non-finite"):
        ld.stabilise(edges.withColumn("R", F.lit(float("nan"))), once=True).collect()


def sequential_finemap(z, r, coverage=0.95, effects=10, v=0.2):
    residual, alphas = z.copy(), []
    for _ in range(min(effects, len(z))):
        score = 0.5 * (v / (1 + v) * residual**2 - np.log1p(v))
        alpha = np.exp(score - score.max())
        alpha /= alpha.sum()
        alphas.append(alpha)
        lead = int(np.argmax(alpha))
        if abs(residual[lead]) < 1:
            break
        residual = residual - r[:, lead] * residual[lead]
    sets = []
    for alpha in alphas:
        order = np.argsort(-alpha, kind="stable")
        stop = int(np.searchsorted(np.cumsum(alpha[order]), coverage)) + 1
        sets.append(order[:stop])
    return 1 - np.prod(1 - np.array(alphas), axis=0), alphas, sets


@pytest.mark.parametrize("provider", ["table", "units"])
def test_finemap_equals_sequential(spark, provider):
    rng = np.random.default_rng(11)
    g = rng.normal(size=(25, 60))
    for i in range(1, 25):
        g[i] += 0.8 * g[i - 1]
    g += 1 - g.mean(axis=1, keepdims=True)
    r = np.corrcoef(g)
    ids = [f"v{i:02d}" for i in range(25)]
    zs = {"L1": rng.normal(size=25) * 2 + 4 * r[7], "L2": rng.normal(size=25) * 0.4}
    rows = spark.createDataFrame(
        [(locus, "EUR", ids[i], float(z[i])) for locus, z in zs.items() for i in range(25)], "LOCUS_ID string, POPULATION string, VARIANT_ID string, Z double"
    )
    units = ld.standardise(units_of(spark, g, ids), maf=None)
    if provider == "units":
        out = finemap.finemap_from_units(rows, units, max_effects=4)
    else:
        out = finemap.finemap_from_table(rows, ld.ld_edges(units, min_r2=0.0), max_effects=4)
    pips = {(x["LOCUS_ID"], x["VARIANT_ID"]): x for x in out["variants"].collect()}
    sets = {(x["LOCUS_ID"], x["EFFECT"]): x for x in out["credible_sets"].collect()}
    for locus, z in zs.items():
        pip, alphas, members = sequential_finemap(z, r, effects=4)
        for i, name in enumerate(ids):
            assert pips[(locus, name)]["PIP"] == pytest.approx(pip[i], abs=1e-9)
            assert pips[(locus, name)]["CREDIBLE_SETS"] == [f"{locus}:CS{e + 1}" for e, m in enumerate(members) if i in m]
        assert len([k for k in sets if k[0] == locus]) == len(alphas)
        for e, m in enumerate(members, start=1):
            found = sets[(locus, e)]
            assert found["N_VARIANTS"] == len(m) and found["COVERAGE"] >= 0.95 - 1e-12
            low = np.abs(r[np.ix_(m, m)]).min() if len(m) > 1 else 1.0
            assert found["PURITY_MIN_ABS_COR"] == pytest.approx(low, abs=1e-9)
    assert sets[("L2", 1)]["WEAK"] in (True, False)
    assert {x["STATUS"] for x in out["summary"].collect()} == {"OK"}


def test_single_strong_variant(spark):
    rows = spark.createDataFrame([("L1", "AFR", v, z) for v, z in (("a", 1.0), ("b", 8.0), ("c", 0.5))], "LOCUS_ID string, POPULATION string, VARIANT_ID string, Z double")
    empty = spark.createDataFrame([], "POPULATION string, ID_A string, ID_B string, R double")
    out = finemap.finemap_from_table(rows, empty, max_effects=1)
    assert out["variants"].orderBy(F.desc("PIP")).first()["VARIANT_ID"] == "b"
    problems = finemap.validate_inputs(rows.withColumn("Z", F.when(F.col("VARIANT_ID") != "a", F.col("Z")))).collect()
    assert problems[0]["REASON"] == "fine-mapping inputs must be finite"


def test_multi_population_inputs(spark):
    rows = spark.createDataFrame(
        [("L1", p, f"v{i}", 1.0, 100.0, None) for p in ("EUR", "AFR") for i in range(3 if p == "EUR" else 2)],
        "LOCUS_ID string, POPULATION string, VARIANT_ID string, Z double, N double, N_EFF double",
    )
    aligned, sizes, failures = finemap.multi_population_inputs(rows, ["EUR", "AFR"], min_variants=2)
    assert aligned.count() == 4 and failures.count() == 0
    assert {r["SAMPLE_SIZE"] for r in sizes.collect()} == {100.0}
    assert finemap.multi_population_inputs(rows, ["EUR", "AFR"], 3)[2].first()["REASON"].startswith("only 2 variants")
    with pytest.raises(ValueError):
        finemap.multi_population_inputs(rows, ["EUR"])


def test_orientation_to_panel(spark):
    gwas = spark.createDataFrame(
        [("1", 10, "rs1", "A", "G", 0.2, 0.1, 0.05, 0.3, 1000.0), ("1", 11, "rs2", "A", "C", 0.2, 0.1, 0.05, 0.3, 1000.0)],
        "CHR string, POS bigint, RSID string, EA string, NEA string, BETA double, SE double, P double, EAF double, N double",
    )
    panel = spark.createDataFrame([("1", 10, "1:10:A:G", "A", "G"), ("1", 11, "1:11:T:G", "T", "G")], "CHR string, POS bigint, ID string, REF string, ALT string")
    rows = region.match_to_reference(gwas, panel).collect()
    assert len(rows) == 1
    assert (rows[0]["BETA_ALT"], rows[0]["ORIENTATION"]) == (-0.2, "EA=REF_FLIPPED")
    assert rows[0]["Z_ALT"] == pytest.approx(-2) and rows[0]["EAF_ALT"] == pytest.approx(0.7)


def test_gates_and_range_join(spark):
    rows = spark.createDataFrame([("EUR", "1", p) for p in (5, 10, 999_999, 1_000_000, 2_500_000)], "POPULATION string, CHR string, POS bigint")
    places = spark.createDataFrame([("EUR", "1", "A", 10, 1_000_000), ("EUR", "1", "B", 3_000_000, 4_000_000)], "POPULATION string, CHR string, LOCUS_ID string, START bigint, END bigint")
    inside = region.rows_in_loci(rows, places)
    assert sorted(r["POS"] for r in inside.collect()) == [10, 999_999, 1_000_000]
    gates = region.locus_gates(inside, min_variants=3, loci=places)
    passed, failed = region.split_by_gate(inside, gates)
    assert passed.count() == 3
    assert [r["REASON"] for r in failed.collect()] == ["0 matched variants, fewer than 3"]


def test_variants_without_ld_are_counted_per_locus(spark):
    cell = "LOCUS_ID string, POPULATION string, VARIANT_ID string"
    matched = spark.createDataFrame([("L1", "EUR", f"v{i}") for i in range(5)] + [("L1", "AFR", "v0"), ("L2", "EUR", "v9")], cell)
    units = spark.createDataFrame([("EUR", "v0"), ("EUR", "v0"), ("EUR", "v3"), ("AFR", "v8")], "POPULATION string, VARIANT_ID string")
    got = {(r["LOCUS_ID"], r["POPULATION"]): (r["N_MATCHED"], r["N_WITH_LD"], r["N_LOST"]) for r in finemap.ld_coverage(matched, units).collect()}
    assert got == {("L1", "EUR"): (5, 2, 3), ("L1", "AFR"): (1, 0, 1), ("L2", "EUR"): (1, 0, 1)}


def test_clumping_stores_edges_as_pairs_of_numbers(spark, monkeypatch):
    stored, store = [], loci.checkpointed
    monkeypatch.setattr(loci, "checkpointed", lambda df: stored.append(df.columns) or store(df))
    variants = spark.createDataFrame([("EUR", "1", 100 + i, 1e-10, f"v{i}") for i in range(4)], "POPULATION string, CHR string, POS bigint, P double, VARIANT_ID string")
    edges = spark.createDataFrame([("EUR", f"v{i}", f"v{j}", 0.9) for i, j in ((0, 1), (1, 2), (2, 3))], "POPULATION string, ID_A string, ID_B string, R double")
    got = {(r["LEAD_VARIANT"], r["VARIANT_ID"]) for r in loci.clump_members(variants, edges).collect()}
    assert got == {("v0", "v0"), ("v0", "v1"), ("v2", "v2"), ("v2", "v3")}
    assert stored and not any({"ID_A", "ID_B"} & set(columns) for columns in stored)
