"""Readers and writers on small files."""

import gzip
import zipfile

import pytest
from pyspark.sql import functions as F

from variantloom import schema
from variantloom.operators import harmonize, splicing
from variantloom.sinks import export, manifest
from variantloom.sources import catalog, tables, text

RAW = "##comment\nchromosome\tbase_pair_location\teffect_allele\tother_allele\tbeta\tstandard_error\tp_value\nchr1\t10\ta\tg\t0.1\t0.2\t0.5\n2\t20\tC\tT\t0.3\n"


@pytest.mark.parametrize("form", ["plain", "gz", "bgz", "zip", "comma", "blank"])
def test_read_associations(spark, tmp_path, form):
    body, path = RAW, str(tmp_path / "raw.tsv")
    if form == "comma":
        body = RAW.replace("\t", ",")
    if form == "blank":
        body = RAW.replace("\t", " ")
    if form in ("gz", "bgz"):
        path += f".{form}"
        with gzip.open(path, "wt") as handle:
            handle.write(body)
    elif form == "zip":
        path = str(tmp_path / "raw.zip")
        with zipfile.ZipFile(path, "w") as archive:
            archive.writestr("raw.tsv", body)
    else:
        (tmp_path / "raw.tsv").write_text(body)
    raw, mapping = text.read_associations(spark, path)
    assert mapping["BETA"] == "beta" and mapping["CHR"] == "chromosome"
    rows = harmonize.derive_statistics(raw).orderBy("POS").collect()
    assert [(r["CHR"], r["POS"], r["EA"]) for r in rows] == [("1", 10, "A"), ("2", 20, "C")]
    assert rows[1]["SE"] is None and rows[0]["BETA"] == 0.1


def test_reader_errors(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("x\ty\tz\tw\n1\t2\t3\t4\n")
    with pytest.raises(ValueError, match="required columns"):
        text.read_associations(spark, str(tmp_path / "a.tsv"))
    with pytest.raises(ValueError, match="VCF"):
        text.read_associations(spark, "x.vcf.gz")
    (tmp_path / "e.tsv").write_text("## only\n")
    with pytest.raises(ValueError, match="no header"):
        text.read_delimited(spark, str(tmp_path / "e.tsv"))


def test_consequence_clump_and_panel_tables(spark, tmp_path):
    (tmp_path / "vep.tsv").write_text(
        "## note\n#Uploaded_variation\tGene\tConsequence\tSYMBOL\n1:1:A:G\tENSG1\tintron_variant&missense_variant\t-\n1:2:A:G\t-\tNA\tX\n"
    )
    rows = {r["VARIANT_ID"]: r for r in tables.read_consequences(spark, str(tmp_path / "vep.tsv")).collect()}
    assert rows["1:1:A:G"]["FUNCTIONAL_CATEGORY"] == "CODING" and rows["1:1:A:G"]["GENE"] is None
    assert rows["1:2:A:G"]["CONSEQUENCE"] is None and rows["1:2:A:G"]["FUNCTIONAL_CATEGORY"] == "OTHER"
    (tmp_path / "c.clumps").write_text("#CHROM\tPOS\tID\tP\tTOTAL\n1\t5\trs1\t1e-9\t.\n")
    lead = tables.read_clump_table(spark, str(tmp_path / "c.clumps")).first()
    assert (lead["CHR"], lead["LEAD_POS"], lead["LEAD_P"]) == ("1", 5, 1e-9)
    (tmp_path / "bad.clumps").write_text("A\tB\tC\tD\n1\t2\t3\t4\n")
    with pytest.raises(ValueError):
        tables.read_clump_table(spark, str(tmp_path / "bad.clumps"))
    (tmp_path / "p.pvar").write_text("##x\n#CHROM\tPOS\tID\tREF\tALT\nchr1\t7\tv\ta\tg\n")
    row = tables.read_panel_index(spark, str(tmp_path / "p.pvar"), "EUR").first()
    assert (row["CHR"], row["POS"], row["REF"], row["POPULATION"]) == ("1", 7, "A", "EUR")
    with pytest.raises(ValueError, match="pooled"):
        tables.read_panel_index(spark, str(tmp_path / "p.pvar"), "MULTI")
    samples = spark.createDataFrame([("s1", "EUR"), ("s2", "AFR")], "sample string, super_pop string")
    assert tables.panel_samples(samples, ["EUR"]).first()["SAMPLE"] == "s1"
    with pytest.raises(ValueError, match="no samples"):
        tables.panel_samples(samples, ["EAS"])


def test_splice_files(spark, tmp_path):
    (tmp_path / "s.vcf").write_text(
        "##h\n#CHROM\n1\t5\t.\tA\tG\t.\tPASS\tX=1;SpliceAI=G|GENE1|0.1|.|0.9|0.2|1|2|3|4,G|short\n1\t6\tid6\tA\tG\t.\tPASS\tX=1\n"
    )
    rows = splicing.parse_spliceai(tables.read_spliceai_vcf(spark, str(tmp_path / "s.vcf"))).collect()
    assert len(rows) == 1 and rows[0]["VARIANT_ID"] == "1:5:A:G" and rows[0]["SPLICEAI_MAX"] == 0.9 and rows[0]["DS_AL"] is None
    (tmp_path / "p.csv").write_text("CHROM,POS,REF,ALT,REFERENCE_ID,Pangolin\n1,5,A,G,v1,G1|3:0.2|-4:-0.7|w,G2|1:x|2:0.1|\n1,6,A,G,v2\n")
    found = splicing.parse_pangolin(tables.read_pangolin_csv(spark, str(tmp_path / "p.csv"))).orderBy("GENE").collect()
    assert [(r["GENE"], r["PANGOLIN_GAIN"], r["PANGOLIN_LOSS"], r["PANGOLIN_SCORE"]) for r in found] == [("G1", 0.2, -0.7, 0.7), ("G2", None, 0.1, 0.1)]


def test_qtl_archive(spark, tmp_path):
    eqtl = spark.createDataFrame([("chr1_5_A_G_b38", "ENSG1", "S", 0.5)], "variant_id string, gene_id string, gene_name string, pip double")
    sqtl = spark.createDataFrame([("chr1_6_A_G_b38", "clu1", "0.25"), ("broken", "clu2", "x")], "variant string, phenotype_id string, susie_pip string")
    eqtl.toPandas().to_parquet(tmp_path / "Liver.v10.eQTLs.parquet")
    (tmp_path / "sub").mkdir()
    sqtl.toPandas().to_parquet(tmp_path / "sub" / "Brain_Cortex_sQTL.parquet")
    rows = {r["VARIANT_ID"]: r for r in tables.read_qtl_archive(spark, str(tmp_path)).collect()}
    assert set(rows) == {"1:5:A:G", "1:6:A:G"}
    assert (rows["1:5:A:G"]["TISSUE"], rows["1:5:A:G"]["QTL_TYPE"], rows["1:5:A:G"]["QTL_PHENOTYPE"]) == ("Liver.v10", "eQTL", "ENSG1")
    assert (rows["1:6:A:G"]["TISSUE"], rows["1:6:A:G"]["QTL_PIP"]) == ("Brain_Cortex", 0.25)
    assert tables.read_qtl_archive(spark, str(tmp_path), ["Brain_Cortex"]).count() == 1
    with pytest.raises(ValueError, match="Spleen"):
        tables.read_qtl_archive(spark, str(tmp_path), ["Spleen"])


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("1", 5, "1:5:A:G", "A", "G", ["x", "y"], None)], "CHR string, POS bigint, VARIANT_ID string, REF string, ALT string, L array<string>, D double")
    export.write_vcf(df.unionByName(df), str(tmp_path / "v"))
    lines = [r[0] for r in spark.read.text(str(tmp_path / "v")).collect()]
    assert "1\t5\t1:5:A:G\tA\tG\t.\tPASS\t." in lines and lines.count("1\t5\t1:5:A:G\tA\tG\t.\tPASS\t.") == 1 and export.VCF_HEADER[2] in lines
    export.write_tsv(df, str(tmp_path / "t"))
    written = [r[0] for r in spark.read.text(str(tmp_path / "t")).collect()]
    rows = [line for line in written if not line.startswith("CHR\tPOS")]
    assert len(rows) < len(written) and all(line.endswith('["x","y"]\tNA') for line in rows) and rows
    export.write_parquet(df, str(tmp_path / "q"), ("CHR",))
    assert spark.read.parquet(str(tmp_path / "q")).count() == 1
    export.write_table(export.clump_export(df.withColumn("P", F.lit(0.1))), str(tmp_path / "c"), partition_by=("CHR",))
    assert (tmp_path / "c" / "CHR=1").exists()
    assert export.splice_export(df).first()["REFERENCE_ID"] == "1:5:A:G"
    export.write_qc_report(spark.createDataFrame([("EUR", 3)], "POPULATION string, N_INPUT bigint"), str(tmp_path / "qc"))
    assert [r["N_INPUT"] for r in spark.read.json(str(tmp_path / "qc")).collect()] == [3]
    assert tables.read_parquet_or_empty(spark, str(tmp_path / "missing"), schema.SUMSTATS_SCHEMA).count() == 0
    assert tables.union_tables([df.select("CHR"), df.select("POS")]).columns == ["CHR", "POS"]


def test_manifest(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("resource\tsize\tstatus\na\t5\tOK\nb\tNA\tOLD\n")
    current = manifest.read_manifest(spark, str(tmp_path / "m.tsv"))
    assert current.columns == list(manifest.MANIFEST_COLUMNS)
    fresh = spark.createDataFrame([("b", 7, "OK"), ("c", 9, "OK")], "resource string, size bigint, status string")
    rows = manifest.upsert(current, fresh).collect()
    assert [(r["resource"], r["size"], r["actual_size"], r["status"]) for r in rows] == [("a", 5, None, "OK"), ("b", 7, 7, "OK"), ("c", 9, 9, "OK")]
    assert manifest.lookup(current, "a").count() == 1


def test_catalogue_names(spark):
    names = spark.createDataFrame(
        [("GCST1-meta.yaml", False), ("md5sum.txt", False), ("x.h.tsv.gz", False), ("x.tsv", True), ("GCST_buildGRCh37.txt", False), ("x_buildhg38.zip", False), ("readme.pdf", False)],
        "n string, h boolean",
    )
    got = names.select(catalog.file_kind("n", "h").alias("k"), catalog.build_from_name("n").alias("b")).collect()
    assert [r["k"] for r in got] == ["meta_yaml", "md5", "harmonised", "harmonised", "raw", "raw", "other"]
    assert [r["b"] for r in got] == [None, None, None, None, "GRCh37", "GRCh38", None]
    where = spark.range(1).select(catalog.accession_directory("ftp://x/", F.lit("GCST90002001")).alias("d"), catalog.normalise_build(F.lit("hg19")).alias("b")).first()
    assert where["d"] == "ftp://x/GCST90002001-GCST90003000/GCST90002001/" and where["b"] == "GRCh37"
