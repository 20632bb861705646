"""Nothing is cut: report tables, archives, term lists and the odds-ratio guard."""

import zipfile

import pytest
from pyspark.sql import functions as F

from variantloom.operators import harmonize, report
from variantloom.plans.ordered import bind
from variantloom.sources.text import read_lines


def test_report_tables_are_whole(spark):
    failures = spark.range(60).select(F.concat(F.lit("L"), "id").alias("LOCUS_ID"))
    evidence = spark.createDataFrame([(f"v{i}", float(i)) for i in range(80)], "VARIANT_ID string, PRIORITY_SCORE double")
    qtl = spark.createDataFrame([("t",)] * 70, "TISSUE string")
    tables = report.report_tables(failures, failures, evidence, qtl, failures, "trait")
    assert tables["failures"].count() == tables["selection"].count() == tables["comparison"].count() == 60
    assert tables["qtl"].count() == 70 and tables["top_evidence"].count() == 50
    assert tables["summary"].first()["failed_loci"] == 60


def test_odds_ratio_guard_bears_infinite_values(spark):
    odds = spark.createDataFrame([(0.9,), (1.1,), (1.2,), (float("inf"),), (float("nan"),), (None,)], "BETA double")
    with pytest.raises(harmonize.OddsRatioAsBetaError):
        harmonize.refuse_odds_ratio_as_beta(odds)
    harmonize.refuse_odds_ratio_as_beta(odds.withColumn("BETA", F.log("BETA")))
    harmonize.refuse_odds_ratio_as_beta(odds.limit(0))


def test_all_members_of_an_archive_are_read(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("one.tsv", "a\nb\n")
        archive.writestr("two.tsv", "c\n")
    assert sorted(r["value"] for r in read_lines(spark, str(tmp_path / "a.zip")).collect()) == ["a", "b", "c"]


def test_filters_pass_a_bound_projection(spark, tmp_path):
    spark.createDataFrame([("x", "1.5"), ("y", "2")], "k string, t string").write.parquet(str(tmp_path / "p"))
    bound = bind(spark.read.parquet(str(tmp_path / "p")), {"n": F.col("t").try_cast("double")})
    plan = bound.filter("k = 'x' and n > 1")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,x)" in plan and bound.filter("k = 'x' and n > 1").count() == 1
