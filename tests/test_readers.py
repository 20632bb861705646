"""Compressed text in parts, folders of several layouts, sequences by offset arithmetic."""

import gzip
import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from variantloom.queries import files
from variantloom.sources import blocks, fasta, text


def bgzf(data: bytes, size: int) -> bytes:
    """A file of many blocks, as outside programs write it: cut anywhere, an empty block at the end."""
    return b"".join(blocks.deflate_block(data[i : i + size]) for i in range(0, len(data), size)) + blocks.EMPTY_BLOCK


def content(seed: int, lines: int, last: str = "\n") -> list[str]:
    rng = random.Random(seed)
    made = [f"{i} " + "".join(rng.choice("abcé\t ") for _ in range(rng.choice([0, 1, 40, 700]))) for i in range(lines)]
    made[lines // 2] = "long " + "x" * 30_000
    made[lines // 3] = ""
    return made if last else made + ["no break at the end"]


def in_order(lines):
    by_file = {}
    for row in lines.orderBy("FILE", "AT", "ROW").collect():
        by_file.setdefault(row["FILE"].rsplit("/", 1)[-1], []).append(row["value"])
    return by_file


@pytest.mark.parametrize("size", [37, 1000, 65_280])
def test_block_gzip_is_read_by_many_tasks(spark, tmp_path, size):
    want = {}
    for name, last in (("a.bgz", "\n"), ("b.bgz", "")):
        want[name] = content(len(name), 300, last)
        (tmp_path / name).write_bytes(bgzf(("\n".join(want[name]) + last).encode(), size))
    (tmp_path / "empty.bgz").write_bytes(blocks.EMPTY_BLOCK)
    (tmp_path / "crlf.bgz").write_bytes(bgzf(b"one\r\ntwo\r\n\r\nthree", 4))
    (tmp_path / "stream.bgz").write_bytes(gzip.compress(b"plain\nstream\n"))
    want |= {"crlf.bgz": ["one", "two", "", "three"], "stream.bgz": ["plain", "stream"]}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for part in ("6007", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", part)
            lines = text.read_lines(spark, str(tmp_path) + "/*.bgz")
            assert in_order(lines) == want
            numbers = text.numbered(lines).filter(F.col("FILE").endswith("/a.bgz")).select("LINE", "value").collect()
            assert {r["LINE"]: r["value"] for r in numbers} == dict(enumerate(want["a.bgz"]))
            if part == "6007" and size < 65_280:  # large blocks are too few here to make many ranges
                assert lines.rdd.getNumPartitions() > 4
                ranges = lines.filter(F.col("FILE").endswith("/a.bgz")).select("AT").distinct().count()
                assert ranges > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_damaged_blocks_are_refused(spark, tmp_path):
    whole = bytearray(bgzf(b"some text that is long enough\n" * 200, 1000))
    whole[60] ^= 0xFF
    (tmp_path / "bad.bgz").write_bytes(bytes(whole))
    with pytest.raises(Exception, match="damaged|invalid"):
        text.read_lines(spark, str(tmp_path / "bad.bgz")).collect()


def test_written_blocks_are_the_format(spark, tmp_path):
    rows = spark.range(50_000).select(F.concat(F.lit("line "), F.col("id"), F.lit(" é"), F.sha2(F.col("id").cast("string"), 256)).alias("value"))
    blocks.write_bgzf(rows.repartition(3), str(tmp_path / "out"))
    files = sorted((tmp_path / "out").glob("part-*"))
    assert len(files) == 3
    plain = [line for f in files for line in gzip.decompress(f.read_bytes()).decode().splitlines()]
    assert sorted(plain) == sorted(r["value"] for r in rows.collect())
    assert all(f.read_bytes().endswith(blocks.EMPTY_BLOCK) for f in files)
    assert sorted(r["value"] for r in text.read_lines(spark, str(tmp_path / "out"), form="bgzf").collect()) == sorted(plain)


def test_members_of_an_archive_are_files(spark, tmp_path):
    one, two = content(1, 300), content(2, 200, "")
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("dir/one.tsv", "\n".join(one) + "\n", zipfile.ZIP_DEFLATED)
        archive.writestr("two.tsv", "\n".join(two), zipfile.ZIP_STORED)
        archive.writestr("three.tsv", "x\ny\n", zipfile.ZIP_BZIP2)
        archive.writestr("none.tsv", "")
    got = in_order(text.read_lines(spark, str(tmp_path / "a.zip")))
    assert got == {"one.tsv": one, "a.zip!two.tsv": two, "a.zip!three.tsv": ["x", "y"]}


def test_members_with_other_columns_keep_their_fields(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("1.tsv", "chr\tpos\tea\tnea\tbeta\n1\t5\tA\tC\t0.5\n")
        archive.writestr("2.csv", "## note\nOR,A2,A1,BP,CHR\n2.0,T,G,7,2\n1.5,T\n")
    table, heads = text.read_association_files(spark, str(tmp_path / "a.zip"))
    rows = sorted(table.collect(), key=lambda r: r["CHR"] or "")
    assert [(r["CHR"], r["POS"], r["EA"], r["NEA"], r["BETA"], r["OR"]) for r in rows] == [
        (None, None, None, "T", None, "1.5"), ("1", "5", "A", "C", "0.5", None), ("2", "7", "G", "T", None, "2.0"),
    ]
    assert {r["SEP"] for r in heads.collect()} == {"\t", ","}


def test_folder_of_layouts(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("##c\nA\tB\tC\tD\n1\tNA\t3\t4\nA\tB\tC\tD\n5\t6\n")
    (tmp_path / "b.csv").write_text('"D", "A", "E", "B"\n 9 , 8, 7, NA, 5\n')
    (tmp_path / "c.txt").write_text("A  D\n  x   y  z\n")
    got = text.read_delimited(spark, str(tmp_path), null_tokens=("NA",))
    assert got.columns == ["A", "B", "C", "D", "E"]
    assert sorted(map(tuple, got.collect())) == [("1", None, "3", "4", None), ("5", "6", None, None, None), ("8", None, None, "9", "7"), ("x", None, None, "y", None)]
    chosen = text.read_delimited(spark, str(tmp_path), columns={"key": "A", "last": "E"})
    assert chosen.columns == ["key", "last"] and chosen.filter("last = '7'").count() == 1


def test_a_file_without_required_columns_is_named(spark, tmp_path):
    (tmp_path / "good.tsv").write_text("chr\tpos\tea\tnea\n1\t2\tA\tC\n")
    (tmp_path / "short.tsv").write_text("chr\tpos\tea\tx\n1\t2\tA\tC\n")
    with pytest.raises(ValueError, match="NEA.*short.tsv"):
        text.read_associations(spark, str(tmp_path))


@pytest.mark.parametrize("width", [1, 7, 60])
def test_bases_and_spans_of_a_fasta(spark, tmp_path, width):
    rng = random.Random(width)
    contigs = {"chr1": 200, "2": 61, "chr2": 40, "chrM": 5, "tiny": 1}
    bases = {name: "".join(rng.choice("acgtN") for _ in range(n)) for name, n in contigs.items()}
    body = "".join(f">{name} text\n" + "".join(s[i : i + width] + "\n" for i in range(0, len(s), width)) for name, s in bases.items())
    (tmp_path / "r.fa").write_text(body + ">none\n\n")
    (tmp_path / "r.fa.bgz").write_bytes(bgzf(body.encode(), 50))
    positions = [(c, p) for c in ("1", "chr1", "2", "MT", "M", "tiny", "9") for p in (-1, 0, 1, 2, 5, 6, 7, 8, 60, 61, 62, 199, 200, 201)]
    of = {"1": "chr1", "chr1": "chr1", "2": "2", "MT": "chrM", "M": "chrM", "tiny": "tiny"}
    want = {(c, p): bases[of[c]][p - 1].upper() for c, p in positions if c in of and 1 <= p <= contigs[of[c]]}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "90")
        for path in ("r.fa", "r.fa.bgz"):
            lines = fasta.read_fasta(spark, str(tmp_path / path))
            index = fasta.fasta_index(lines)
            assert {r["CONTIG"]: r["LENGTH"] for r in index.collect()} == {k: v for k, v in contigs.items() if k != "chr2"}
            got = fasta.bases(spark.createDataFrame(positions + positions[:3], "CHR string, POS bigint"), lines, index)
            assert {(r["CHR"], r["POS"]): r["BASE"] for r in got.collect()} == want and got.count() == len(want)
            spans = [("1", s, n) for s in (1, 5, 60, 150) for n in (1, 3, 51, 200, 0)] + [("M", 1, 5)]
            told = {(r["CHR"], r["START"], r["SIZE"]): r["BASES"] for r in fasta.sequences(spark.createDataFrame(spans, "CHR string, START bigint, SIZE bigint"), lines, index).collect()}
            assert told == {(c, s, n): bases[of[c]][s - 1 : s - 1 + n].upper() for c, s, n in spans if n and s + n - 1 <= contigs[of[c]]}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_uneven_lines_are_refused(spark, tmp_path):
    (tmp_path / "u.fa").write_text(">1\nACGT\nAC\nACGT\n")
    lines = fasta.read_fasta(spark, str(tmp_path / "u.fa"))
    with pytest.raises(Exception, match="differ in width"):
        fasta.bases(spark.createDataFrame([("1", 5)], "CHR string, POS bigint"), lines, fasta.fasta_index(lines)).collect()


def test_folders_grow_in_files_and_lines_stay_where_they_are(spark, tmp_path, monkeypatch):
    """More rows make more files, each with its header; no shuffle brings the lines of a file together."""
    monkeypatch.setattr(files, "ROWS_PER_FILE", 100)
    rows = spark.range(3000).select(F.concat_ws("\t", F.lit("rs"), F.lit("1"), "id", F.lit("A"), F.lit("C"), F.lit("0.5"), F.lit("0.1")).alias("value"))
    header = "## made here\nrsid\tchromosome\tbase_pair_location\teffect_allele\tother_allele\tbeta\tstandard_error"
    path = str(tmp_path / "many")
    blocks.write_bgzf(files.with_header(rows, header), path)
    assert len([name for name in os.listdir(path) if name.startswith("part-")]) == 30
    table = text.read_associations(spark, path, form="bgzf")[0]
    assert sorted(int(r["POS"]) for r in table.select("POS").collect()) == list(range(3000))
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
