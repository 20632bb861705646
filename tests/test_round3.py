"""Findings of the third review: how often text is read, what is sorted, what is broadcast."""

import contextlib
import io

from pyspark.sql import functions as F

from variantloom.operators import harmonize, phenotype
from variantloom.plans import harmonise
from variantloom.plans.ordered import exact_median
from variantloom.queries import files, registry, views
from variantloom.sources import text
from variantloom.sources.blocks import write_bgzf

SF = "/root/testdata/sf0.001"


def plan(df):
    with contextlib.redirect_stdout(io.StringIO()) as told:
        df.explain("extended")
    return told.getvalue().split("== Physical Plan ==")[1]


def test_f6_the_strongest_rows_come_from_the_stored_table(spark, monkeypatch):
    seen = {}
    whole = harmonize.finalize
    monkeypatch.setattr(harmonise.harmonize, "finalize", lambda df, *a, **b: seen.setdefault("out", whole(seen.setdefault("rows", df), *a, **b)))
    record = files.qc_record(spark, SF).first()
    assert record["n_input"] == views.table(spark, SF, "lineitem").count() and record["n_removed"] == record["n_input"] - record["n_after_qc"]
    assert "MapInArrow" not in plan(seen["rows"]) and "Generate" not in plan(seen["rows"])  # no text is parsed again


def test_f9_rows_in_are_counted_without_parsing_and_no_data_is_broadcast(spark, monkeypatch):
    seen = {}
    whole = harmonize.qc_summary
    monkeypatch.setattr(harmonize, "qc_summary", lambda derived, final: seen.setdefault("out", whole(seen.setdefault("derived", derived), final)))
    assert sum(r["N_INPUT"] for r in registry.qc_summary(spark, SF).collect()) == views.table(spark, SF, "lineitem").count()
    assert "Generate" not in plan(seen["derived"])


def test_f9_median_broadcasts_the_two_ranks_not_the_rows(spark, tmp_path):
    spark.range(50_000).select((F.col("id") % 3).alias("K"), (F.col("id") * 0.37).alias("V")).write.parquet(str(tmp_path / "v"))
    rows = spark.read.parquet(str(tmp_path / "v"))
    got = exact_median(rows, ["K"], "V")
    assert "BuildLeft" not in plan(got)
    want = {r["K"]: r["M"] for r in rows.groupBy("K").agg(F.percentile("V", F.lit(0.5)).alias("M")).collect()}
    assert {r["K"]: r["MEDIAN"] for r in got.collect()} == want


def test_f12_headers_are_found_without_sorting_lines(spark, tmp_path, monkeypatch):
    seen = {}
    whole = text.association_layouts
    monkeypatch.setattr(text, "association_layouts", lambda *a: seen.setdefault("heads", whole(*a)))
    (tmp_path / "a.tsv").write_text("## c\n\nCHR\tPOS\tEA\tNEA\tP\tBETA\tSE\n1\t5\tA\tC\t0.1\t1\t2\n")
    table, _ = text.read_association_files(spark, str(tmp_path / "a.tsv"))
    assert table.count() == 1 and "SortAggregate" not in plan(seen["heads"])


def test_f12_a_header_behind_the_first_range_is_found(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        lines = [f"## {i} " + "x" * 90 for i in range(3000)] + ["A\tB", *[f"{i}\t{i * i}" for i in range(500)]]
        (tmp_path / "late.tsv").write_text("\n".join(lines) + "\n")
        assert text.header_lines(spark, str(tmp_path / "late.tsv")).first()["HEAD"] == "A\tB"
        assert text.read_delimited(spark, str(tmp_path / "late.tsv")).count() == 500
        write_bgzf(spark.createDataFrame([(f"## {i} " + str(hash((i, "y")))*4,) for i in range(9000)] + [("A\tB",), ("1\t2",)], "value string").coalesce(1), str(tmp_path / "b"))
        assert text.header_lines(spark, str(tmp_path / "b"), "bgzf").first()["HEAD"] == "A\tB"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_f13_qtl_rows_are_made_once_and_meet_by_shuffle(spark, monkeypatch):
    calls = []
    whole = views.qtl
    monkeypatch.setattr(views, "qtl", lambda *a: calls.append(a) or whole(*a))
    assert registry.report_summary(spark, SF).first()["evidence_rows"] > 0 and len(calls) == 1


def test_f7_resolution_broadcasts_nothing_that_grows(spark):
    assert "BroadcastHashJoin" not in plan(registry.phenotype_resolve(spark, SF))
    edges = spark.createDataFrame([("B", "A"), ("C", "B"), ("A", "C")], "term_id string, parent_id string")
    below = phenotype.descendants(spark.createDataFrame([("p", "A")], "PHENOTYPE string, term_id string"), edges)
    assert sorted(r["term_id"] for r in below.collect()) == ["B", "C"]
