"""Derivation, quality control, meta-analysis."""

import math
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from variantloom.operators import harmonize, meta
from variantloom.plans.ordered import counted_median, exact_median, merge_intervals, prefix_scan

LONG = "VARIANT_ID string, CHR string, POS bigint, EA string, NEA string, BETA double, SE double, EAF double, N double, N_CASES double, N_CONTROLS double, RSID string, POPULATION string"


def assoc(spark, rows):
    return spark.createDataFrame(rows, LONG)


def test_odds_ratio_becomes_log_odds(spark):
    raw = spark.createDataFrame(
        [("1", "2", "A", "G", "2.0", "0.1", None, "100", "300")],
        "CHR string, POS string, EA string, NEA string, OR string, SE string, P string, N_CASES string, N_CONTROLS string",
    )
    row = harmonize.derive_statistics(raw).first()
    assert row["BETA"] == pytest.approx(math.log(2))
    assert row["Z"] == pytest.approx(math.log(2) / 0.1)
    assert row["N_EFF"] == pytest.approx(300)
    assert row["N"] == 400
    assert row["P"] == pytest.approx(math.erfc(math.log(2) / 0.1 / math.sqrt(2)), rel=1e-10)


def test_quantitative_keeps_n_and_invents_nothing(spark):
    raw = spark.createDataFrame(
        [("1", 2, "a", "g", 0.2, 0.1, 1234.0)], "CHR string, POS int, EA string, NEA string, BETA double, SE double, N double"
    )
    row = harmonize.derive_statistics(raw).first()
    assert (row["N"], row["N_EFF"], row["N_CASES"], row["EA"]) == (1234, None, None, "A")
    bare = harmonize.derive_statistics(raw.drop("N")).first()
    assert bare["N"] is None
    assert harmonize.derive_statistics(raw.drop("N"), n_total=50.0).first()["N"] == 50


def test_confidence_interval_and_underflow(spark):
    raw = spark.createDataFrame(
        [("1", "5", "A", "G", None, "2", "1", "4", None, None), ("1", "6", "A", "G", "10", None, "1", "4", "0.1", "0")],
        "CHR string, POS string, EA string, NEA string, BETA string, OR string, OR_L95 string, OR_U95 string, SE string, P string",
    )
    first, second = harmonize.derive_statistics(raw).orderBy("POS").collect()
    assert first["SE"] == pytest.approx(math.log(4) / (2 * 1.959963984540054))
    assert second["P"] == 0 and second["NEG_LOG10_P"] == pytest.approx(2173.57, rel=1e-4)


def test_quality_control(spark):
    good = {"CHR": "1", "POS": "5", "EA": "A", "NEA": "G", "BETA": "0.1", "SE": "0.1", "P": "0.5", "EAF": None}
    bad = [
        {"CHR": "X"}, {"POS": "0"}, {"POS": "x"}, {"EA": "N"}, {"EA": "G"}, {"BETA": "inf"}, {"BETA": "nan"}, {"SE": "0"}, {"SE": None},
        {"P": "1.2"}, {"P": "-1"}, {"EAF": "1.5"}, {"NEA": None},
    ]
    rows = [good] + [{**good, **change} for change in bad]
    raw = spark.createDataFrame(pd.DataFrame(rows), "CHR string, POS string, EA string, NEA string, BETA string, SE string, P string, EAF string")
    derived = harmonize.derive_statistics(raw)
    assert harmonize.apply_qc(derived).count() == 1
    assert derived.filter(harmonize.qc_condition()).count() == 1


def test_finalize_keeps_strongest_and_schema(spark):
    raw = spark.createDataFrame(
        [("1", "5", "A", "G", "0.1", "0.1", "0.5"), ("1", "5", "G", "A", "0.3", "0.1", "0.003"), ("1", "9", "C", "T", "0.1", "0.1", "0.5")],
        "CHR string, POS string, EA string, NEA string, BETA string, SE string, P string",
    )
    final = harmonize.finalize(harmonize.apply_qc(harmonize.derive_statistics(raw)), "S", "t", "EUR", "f")
    from variantloom import schema

    assert schema.validate(final) == []
    rows = {r["VARIANT_ID"]: r for r in final.collect()}
    assert set(rows) == {"1:5:A:G", "1:9:C:T"} and rows["1:5:A:G"]["P"] == 0.003
    assert "WindowGroupLimit" in final._jdf.queryExecution().executedPlan().toString()


def test_guards(spark):
    with pytest.raises(harmonize.AggregatedSplitError):
        harmonize.check_label("MULTI", "EUR")
    assert harmonize.check_label("MULTI", "COMBINED_PUBLISHED") == "COMBINED_PUBLISHED"
    odds = spark.createDataFrame([(0.9,), (1.1,), (1.3,)], "BETA double")
    with pytest.raises(harmonize.OddsRatioAsBetaError):
        harmonize.refuse_odds_ratio_as_beta(odds)
    harmonize.refuse_odds_ratio_as_beta(odds.select((F.col("BETA") - 1).alias("BETA")))
    bases = spark.createDataFrame([("1", 1, "A"), ("1", 2, "C")], "CHR string, POS bigint, BASE string")
    hits = spark.createDataFrame([("1", 1, "G", "A"), ("1", 2, "G", "C")], "CHR string, POS bigint, EA string, NEA string")
    assert harmonize.validate_build(hits, bases)["ref_concordance"] == 1.0
    with pytest.raises(harmonize.BuildMismatchError):
        harmonize.validate_build(hits.withColumn("EA", F.lit("T")).withColumn("NEA", F.lit("T")), bases)


def test_meta_two_populations(spark):
    rows = [
        ("1:1:A:G", "1", 1, "G", "A", 0.1, 0.1, 0.2, 1000.0, None, None, "rs1", "AFR"),
        ("1:1:A:G", "1", 1, "A", "G", -0.2, 0.1, 0.7, 2000.0, None, None, "rs1", "EUR"),
    ]
    row = meta.run_meta(assoc(spark, rows), ["AFR", "EUR"]).first()
    assert row["BETA"] == pytest.approx(0.15) and row["SE"] == pytest.approx(math.sqrt(1 / 200))
    assert row["Q"] == pytest.approx(0.5) and row["I2"] == 0.0 and row["N_POPULATIONS"] == 2
    assert row["Q_P"] == pytest.approx(math.erfc(math.sqrt(0.25)), rel=1e-9)
    assert row["EAF"] == pytest.approx(0.25) and row["N"] == 3000 and row["N_CASES"] is None
    assert row["DIRECTION"] == "++" and row["POPULATIONS"] == "AFR,EUR" and row["BETA_EUR"] == pytest.approx(0.2)


def test_meta_properties(spark):
    rng = np.random.default_rng(3)
    rows = [
        (f"1:{i}:A:G", "1", i, "A", "G", float(rng.normal()), float(rng.uniform(0.05, 0.3)), 0.3, 10.0, None, None, None, p)
        for i in range(40) for p in ("EUR", "EAS", "AFR")
    ]
    table = assoc(spark, rows)
    flipped = table.select(
        *[c for c in table.columns if c not in {"EA", "NEA", "BETA", "EAF"}], F.col("NEA").alias("EA"), F.col("EA").alias("NEA"),
        (-F.col("BETA")).alias("BETA"), (1 - F.col("EAF")).alias("EAF"),
    )
    key = lambda df: {r["VARIANT_ID"]: (round(r["BETA"], 9), round(r["Q"], 9), r["DIRECTION"]) for r in df.collect()}
    populations = ["AFR", "EAS", "EUR"]
    assert key(meta.run_meta(table, populations)) == key(meta.run_meta(flipped, populations))
    single = meta.inverse_variance_meta(meta.align_for_meta(table.filter("POPULATION = 'EUR'")), ["EUR"]).collect()
    own = {r["VARIANT_ID"]: r for r in table.filter("POPULATION = 'EUR'").collect()}
    for row in single:
        assert row["BETA"] == pytest.approx(-own[row["VARIANT_ID"]]["BETA"]) and row["I2"] is None and row["Q_P"] is None


def test_meta_gates_and_palindromes(spark):
    with pytest.raises(ValueError):
        meta.check_meta_inputs({"EUR": None})
    with pytest.raises(meta.IncompatibleScalesError):
        meta.check_meta_inputs({"EUR": "binary", "AFR": "quantitative"})
    rows = [
        (f"1:{i}:A:T", "1", i, "A", "T", 0.1, 0.1, eaf, None, None, None, None, "EUR") for i, eaf in enumerate([0.1, 0.45, None, 0.95])
    ]
    kept = meta.align_for_meta(assoc(spark, rows))
    assert sorted(r["POS"] for r in kept.collect()) == [0, 3]
    assert meta.align_for_meta(assoc(spark, rows), None).count() == 4


def test_exact_median_and_counted_median(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({
        "k": rng.choice(["a", "b", "c"], 3001, p=[0.8, 0.19, 0.01]),
        "v": np.concatenate([rng.normal(size=2000) * 10.0 ** rng.integers(-6, 6, 2000), np.full(1001, 3.5)]),
    })
    want = pdf.groupby("k").v.median().to_dict()
    df = spark.createDataFrame(pdf)
    assert {r["k"]: r["MEDIAN"] for r in exact_median(df, ["k"], "v").collect()} == pytest.approx(want)
    assert {r["k"]: r["MEDIAN"] for r in counted_median(df, ["k"], "v").collect()} == pytest.approx(want)
    assert exact_median(df, [], "v").first()["MEDIAN"] == pytest.approx(statistics.median(pdf.v))


def test_prefix_scan_with_a_hot_key(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"k": rng.choice(["hot", "b"], 2000, p=[0.95, 0.05]), "id": range(2000), "v": rng.integers(0, 50, 2000).astype(float)})
    out = prefix_scan(spark.createDataFrame(pdf), ["k"], [F.col("v").desc(), F.col("id")], {"S": F.col("v")}, "R").toPandas()
    for _, group in out.sort_values(["k", "R"]).groupby("k"):
        assert list(group.R) == list(range(1, len(group) + 1))
        assert np.allclose(group.S, group.v.cumsum() - group.v)
        assert (np.diff(group.v) <= 0).all()


@pytest.mark.parametrize("gap", [0, 500])
def test_merge_intervals_equals_sequential_merge(spark, gap):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"k": rng.choice(["a", "b"], 800), "START": rng.integers(1, 3_000_000, 800)})
    pdf["END"] = pdf.START + rng.integers(0, 6000, 800)
    expected = []
    for k, group in pdf.sort_values(["k", "START"]).groupby("k"):
        current = None
        for start, end in zip(group.START, group.END, strict=True):
            if current is None or start > current[1] + gap:
                if current:
                    expected.append((k, *current))
                current = [start, end]
            else:
                current[1] = max(current[1], end)
        expected.append((k, *current))
    got = merge_intervals(spark.createDataFrame(pdf), ["k"], gap, bin_bp=100_000).groupBy("k", "ISLAND_START").agg(F.max("END"))
    assert sorted(map(tuple, got.collect())) == sorted(expected)
