"""One study from text to record; the partitioned panel, clustered files, stable line numbers."""

import json
import random

import pytest
from pyspark.sql import functions as F

from variantloom.operators import harmonize
from variantloom.plans.harmonise import RECORD, Analysis, Reference, harmonise_file
from variantloom.sinks import export
from variantloom.sources import catalog, fasta, panel, text
from variantloom.sources.blocks import deflate_block

BASES = "ACGT"


def study(n=400, odds=False):
    """Lines of a study on contig 1; every tenth allele is unreadable, every other row comes twice, with a larger P."""
    rng = random.Random(4)
    sequence = "".join(rng.choice(BASES) for _ in range(1000))
    lines = ["## made for a test", "snp\tchr\tpos\ta1\ta2\t" + ("or\tor_95l\tor_95u" if odds else "beta\tse") + "\tp\tfreq"]
    for i in range(n):
        ref = sequence[2 * i]
        alt = BASES[(BASES.index(ref) + 1 + i % 3) % 4]
        effect = ("1.5", "1.2", "1.9") if odds else (str(rng.uniform(-1, 1)), "0.1")
        for copy in range(1 + i % 2):
            lines.append("\t".join([f"rs{i}", "chr1", str(2 * i + 1), "N" if i % 10 == 0 else alt, ref, *effect, "1e-9" if i % 4 == 0 else str(0.01 + 0.4 * copy), "" if i % 5 else "0.2"]))
    return lines, sequence


def write_fasta(path, sequence):
    path.write_text(">1\n" + "\n".join(sequence[i : i + 50] for i in range(0, len(sequence), 50)) + "\n")


def reference(spark, path):
    lines = fasta.read_fasta(spark, str(path))
    return Reference(lines, fasta.fasta_index(lines))


def test_a_study_becomes_a_table_and_its_record(spark, tmp_path):
    lines, sequence = study()
    body = "\n".join(lines).encode() + b"\n"
    (tmp_path / "s.tsv.bgz").write_bytes(b"".join(deflate_block(body[i : i + 900]) for i in range(0, len(body), 900)))
    write_fasta(tmp_path / "r.fa", sequence)
    analysis = Analysis("S_EUR", "S", "trait", "EUR", "EUR", "GRCh38", n_cases=10.0, n_controls=30.0, n_total=40.0)
    record = harmonise_file(spark, str(tmp_path / "s.tsv.bgz"), str(tmp_path / "out"), analysis, reference=reference(spark, tmp_path / "r.fa"))
    assert record.schema == RECORD and len(RECORD) == 20
    row = record.first()
    assert (row["n_input"], row["n_after_qc"], row["n_removed"]) == (600, 360, 240)
    table = spark.read.parquet(str(tmp_path / "out" / "sumstats"))
    assert table.count() == 360 and table.filter("P > 0.4").count() == 0 and table.filter("N <> 40 or N_EFF <> 30").count() == 0
    assert row["n_significant"] == table.filter("P < 5e-8").count() == spark.read.parquet(str(tmp_path / "out" / "significant")).count() > 0
    assert row["fraction_with_eaf"] == pytest.approx(table.filter("EAF is not null").count() / 360) and row["fraction_with_rsid"] == 1.0
    chi2 = sorted(r["Z"] ** 2 for r in table.select("Z").collect())
    assert row["lambda_gc"] == pytest.approx((chi2[179] + chi2[180]) / 2 / 0.454936423119572)
    assert row["column_mapping"]["POS"] == "pos" and row["derived"] == {"beta_from_or": False, "se_from_ci": False, "n_from_metadata": True}
    assert row["build_validation"] == {"status": "checked", "n_checked": "360", "ref_concordance": "1.0"}
    stored = json.loads(next((tmp_path / "out" / "record").glob("*.json")).read_text())
    assert stored["n_removed"] == 240 and stored["population"] == "EUR"


def test_odds_ratios_and_intervals_are_named_in_the_record(spark, tmp_path):
    lines, _ = study(60, odds=True)
    (tmp_path / "o.tsv").write_text("\n".join(lines))
    row = harmonise_file(spark, str(tmp_path / "o.tsv"), str(tmp_path / "out"), Analysis("A", "S", "t", "EUR", "EUR")).first()
    assert row["derived"] == {"beta_from_or": True, "se_from_ci": True, "n_from_metadata": False} and row["build_validation"]["status"] == "skipped"
    assert row["fraction_with_n"] == 0.0 and row["n_total"] is None


def test_refused_studies_have_no_record(spark, tmp_path):
    lines, sequence = study(60)
    (tmp_path / "s.tsv").write_text("\n".join(lines))
    run = lambda analysis, name="s.tsv", **more: harmonise_file(spark, str(tmp_path / name), str(tmp_path / "out"), analysis, **more)
    with pytest.raises(harmonize.AggregatedSplitError):
        run(Analysis("A", "S", "t", "MULTI", "EUR"))
    with pytest.raises(harmonize.BuildMismatchError, match="GRCh37"):
        run(Analysis("A", "S", "t", "EUR", "EUR", "GRCh37"))
    (tmp_path / "odds.tsv").write_text("chr\tpos\tea\tnea\tbeta\tse\n" + "".join(f"1\t{i + 1}\tA\tC\t{0.8 + i / 100}\t0.1\n" for i in range(40)))
    with pytest.raises(harmonize.OddsRatioAsBetaError):
        run(Analysis("A", "S", "t", "EUR", "EUR"), "odds.tsv")
    write_fasta(tmp_path / "wrong.fa", "".join(BASES[(BASES.index(b) + 2) % 4] for b in sequence))
    with pytest.raises(harmonize.BuildMismatchError):
        run(Analysis("A", "S", "t", "EUR", "EUR"), reference=reference(spark, tmp_path / "wrong.fa"))
    assert not (tmp_path / "out" / "record").exists()


def test_regions_read_only_the_partitions_of_their_loci(spark, tmp_path):
    index = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, "EUR").otherwise("AFR").alias("POPULATION"), (F.col("id") % 6 + 1).cast("string").alias("CHR"), (F.col("id") * 3000).alias("POS"),
        F.concat(F.lit("v"), "id").alias("ID"), F.lit("A").alias("REF"), F.lit("G").alias("ALT"),
    )
    panel.write_panel(index, str(tmp_path / "panel"))
    loci = spark.createDataFrame(
        [("a", "EUR", "1", 0, 4_500_000), ("b", "EUR", "1", 4_400_000, 4_400_001), ("c", "AFR", "2", 6_999_000, 7_020_000), ("none", "EAS", "1", 0, 10**9), ("turned", "EUR", "3", 9, 1)],
        "LOCUS_ID string, POPULATION string, CHR string, START bigint, END bigint",
    )
    stored = panel.read_panel(spark, str(tmp_path / "panel"))
    found = panel.region_variants(stored, loci)
    want = index.join(loci, ["POPULATION", "CHR"]).filter("POS between START and END").select("LOCUS_ID", *stored.columns)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect())) != []
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "PartitionFilters: [" in plan
    for bound in (0, 10):
        panel.BROADCAST_LOCI, before = bound, panel.BROADCAST_LOCI
        try:
            assert panel.region_variants(stored, loci).count() == want.count()
        finally:
            panel.BROADCAST_LOCI = before


def test_a_region_touches_few_clustered_files(spark, tmp_path):
    rows = spark.range(60_000).select((F.col("id") % 3).cast("string").alias("CHR"), (F.hash("id") % 1_000_000 + 1_000_000).cast("bigint").alias("POS"), "id")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        export.write_clustered(rows, str(tmp_path / "clustered"), ["CHR", "POS"])
        export.write_parquet(rows.repartition(4), str(tmp_path / "plain"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    region = "CHR = '1' and POS between 900000 and 950000"

    def read(name):
        """(rows, files whose range holds the region, files)."""
        table = spark.read.parquet(str(tmp_path / name)).withColumn("FILE", F.col("_metadata.file_path"))
        ranges = table.groupBy("FILE").agg(F.min(F.struct("CHR", "POS")).alias("low"), F.max(F.struct("CHR", "POS")).alias("high"))
        near = ranges.filter("low <= struct('1', 950000L) and high >= struct('1', 900000L)").count()
        return table.filter(region).count(), near, ranges.count()

    rows_found, near, files = read("clustered")
    assert (rows_found, 4) == read("plain")[:2] and near <= 2 < files
    inside = spark.read.parquet(str(tmp_path / "clustered")).select("CHR", "POS", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i")).collect()
    by_file = {}
    for r in sorted(inside, key=lambda r: (r["f"], r["i"])):
        by_file.setdefault(r["f"], []).append((r["CHR"], r["POS"]))
    assert all(keys == sorted(keys) for keys in by_file.values())


def test_line_numbers_do_not_depend_on_ranges(spark, tmp_path):
    head = "STUDY ACCESSION\tSTAGE\tNUMBER OF INDIVIDUALS\tBROAD ANCESTRAL CATEGORY\tCOUNTRY OF RECRUITMENT\n"
    for name in ("a.tsv", "b.tsv"):
        (tmp_path / name).write_text(head + "".join(f"G{i % 7}\tInitial \t1,0{i:02d}\tEuropean, ,East Asian\tX\n" for i in range(90)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    seen = []
    try:
        for part in ("500", "3000", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", part)
            raw = catalog.read_ancestries(spark, str(tmp_path))
            records = catalog.ancestry_records(raw, spark.createDataFrame([(f"G{i}",) for i in range(6)], "study_accession string"))
            seen.append(sorted((r["RECORD"], r["study_accession"], r["STAGE"], r["CATEGORY"], r["N"]) for r in records.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert seen[0] == seen[1] == seen[2]
    assert len({r[0] for r in seen[0]}) == len(seen[0]) == 2 * 2 * sum(i % 7 < 6 for i in range(90))
    assert seen[0][0][1:] == ("G0", "initial", "European", 1000) and seen[0][1][3:] == ("East Asian", None)
    assert text.numbered(text.read_lines(spark, str(tmp_path / "a.tsv"))).agg(F.max("LINE")).first()[0] == 90
