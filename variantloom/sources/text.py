"""Delimited text with ``##`` comment lines, read as strings and split on the JVM.

A folder may hold files of several layouts.  The header of each file is found by an
look into its first byte range, and only where that has none by an aggregate over its
lines, so there is one small row for each file: how it separates fields, and at which place it has each wanted one.  Lines are joined to it on the file
and parsed by their own layout, in one scan of the folder.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from variantloom.schema import COLUMN_ALIASES, REQUIRED_FIELDS
from variantloom.session import checkpointed
from variantloom.sources.blocks import bgzf_openings, read_bgzf, read_zip

BROADCAST_FILES = 20_000  # header rows of about half a kilobyte


def _form(path: str, form: str | None) -> str:
    return form or {"bgz": "bgzf", "zip": "zip"}.get(path.lower().rsplit(".", 1)[-1], "text")


def read_lines(spark: SparkSession, path: str, form: str | None = None) -> DataFrame:
    """Lines as (value, FILE, AT, ROW); AT and ROW put the lines of a file in order.

    ``form`` is ``bgzf``, ``zip`` or ``text`` (plain, or gzip by its suffix); without it
    the suffix of the path decides.
    """
    form = _form(path, form)
    if form == "bgzf":
        return read_bgzf(spark, path)
    if form == "zip":
        return read_zip(spark, path)
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("FILE"), F.col("_metadata.file_block_start").alias("AT"), F.monotonically_increasing_id().alias("ROW")
    )


def numbered(lines: DataFrame, across_files: bool = False) -> DataFrame:
    """Lines with LINE, the number of each from 0 in its file, or over all files in their order.

    The number does not depend on the ranges that the files were read in.

    Lines are counted for each range, a prefix sum over the ranges of a file says where
    each starts, and the rest is arithmetic: no line is sorted or moved.  The lines are
    fixed first, so that both uses see the same ranges.
    """
    fixed = checkpointed(lines)
    ranges = fixed.groupBy("FILE", "AT").agg(F.count("*").alias("_N"), F.min("ROW").alias("_FIRST"))
    order = Window.orderBy("FILE", "AT") if across_files else Window.partitionBy("FILE").orderBy("AT")
    before = order.rowsBetween(Window.unboundedPreceding, -1)  # over ranges, not lines
    starts = ranges.select("FILE", "AT", (F.coalesce(F.sum("_N").over(before), F.lit(0)) - F.col("_FIRST")).alias("_SHIFT"))
    return fixed.join(starts, ["FILE", "AT"]).select(*lines.columns, (F.col("ROW") + F.col("_SHIFT")).alias("LINE"))


def split_by(sep: Column, value: Column | str) -> Column:
    """Fields of a line whose separator is a tab, a comma or (``' '``) any run of blanks."""
    text = F.col(value) if isinstance(value, str) else value
    return F.when(sep == "\t", F.split(text, "\t", -1)).when(sep == ",", F.split(text, ",", -1)).otherwise(F.split(F.trim(text), r"\s+"))


def _openings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(value, FILE), file after file, to (FILE, HEAD): its first line that is neither blank nor ``##``, or null."""
    here, head, rows = None, None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        runs, start = pc.run_end_encode(batch.column(1)), 0
        for file, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
            if file != here:
                if here is not None:
                    rows.append((here, head))
                here, head = file, None
            if head is None:
                head = next((line for line in batch.column(0)[start:end].to_pylist() if line.strip(" ") and not line.startswith("##")), None)
            start = end
    if here is not None:
        rows.append((here, head))
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], ["FILE", "HEAD"])


def _first_lines(lines: DataFrame) -> DataFrame:
    told = lines.filter(~F.col("value").startswith("##") & (F.trim("value") != ""))
    return told.groupBy("FILE").agg(F.min(F.struct("AT", "ROW", "value")).alias("_H")).select("FILE", F.col("_H.value").alias("HEAD"))


def header_lines(spark: SparkSession, path: str, form: str | None = None) -> DataFrame:
    """(FILE, HEAD): the header line of every file that has one, a stored table.

    Each file is looked into at its first byte range and no line is sorted; all lines are
    read only of files whose first range holds nothing but comments, and of zip archives.
    """
    lines, form = read_lines(spark, path, form), _form(path, form)
    if form == "zip":
        return checkpointed(_first_lines(lines))
    opened = lines.filter("AT = 0").select("value", "FILE").mapInArrow(_openings, "FILE string, HEAD string") if form == "text" else bgzf_openings(spark, path)
    heads = checkpointed(opened)
    late = heads.filter("HEAD is null").select("FILE")
    if late.isEmpty():
        return heads
    return checkpointed(heads.filter("HEAD is not null").unionByName(_first_lines(lines.join(late, "FILE", "left_semi"))))


def layouts(lines: DataFrame, heads: DataFrame | None = None) -> DataFrame:
    """(FILE, HEAD, SEP, NAMES): the header of every file, its first line that is neither blank nor ``##``, or as ``heads`` has it."""
    heads = _first_lines(lines) if heads is None else heads
    commas = F.size(F.split("HEAD", ",")) >= 4
    sep = F.when(F.contains("HEAD", F.lit("\t")), "\t").when(commas, ",").otherwise(" ")
    names = F.transform(split_by(F.col("SEP"), "HEAD"), lambda name: F.btrim(F.trim(name), F.lit('"')))
    return heads.withColumn("SEP", sep).withColumn("NAMES", names)


def body_lines(lines: DataFrame, heads: DataFrame) -> DataFrame:
    """The lines of every file that are neither comments, blank nor its header, with HEAD, SEP and PLACES.

    ``heads`` is stored and has a row for each file.  Up to ``BROADCAST_FILES`` of them go
    to the lines; a join by shuffle would bring all lines of one file into one task.
    """
    body = lines.filter(~F.col("value").startswith("##") & (F.col("value") != ""))
    side = heads.select("FILE", "HEAD", "SEP", "PLACES")
    side = F.broadcast(side) if heads.count() <= BROADCAST_FILES else side
    return body.join(side, "FILE").filter(F.col("value") != F.col("HEAD"))


def parse(lines: DataFrame, heads: DataFrame, wanted: Sequence[str], null_tokens: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """The wanted fields of every line, all strings, by the layout of its file, after the columns of ``lines`` to keep.

    ``heads`` is (FILE, HEAD, SEP, PLACES); PLACES has, for each wanted field, its number
    in that file, or null.  Ragged lines give nulls, extra fields are dropped.
    """
    parts = body_lines(lines, heads).select(*keep, "SEP", "PLACES", split_by(F.col("SEP"), "value").alias("_F"))

    def pick(i: int) -> Column:
        value = F.get("_F", F.get("PLACES", F.lit(i)))
        value = F.when(F.col("SEP") == ",", F.trim(value)).otherwise(value)
        return F.when(~value.isin(*null_tokens), value) if null_tokens else value

    return parts.select(*keep, *[pick(i).alias(name) for i, name in enumerate(wanted)])


def _place(names: Column, name: Column | str) -> Column:
    """Number of a field, from 0; null where it is missing."""
    return F.nullif(F.array_position(names, name), F.lit(0)).cast("int") - 1


def read_delimited(
    spark: SparkSession,
    path: str,
    null_tokens: Sequence[str] = (),
    columns: Mapping[str, str] | None = None,
    form: str | None = None,
) -> DataFrame:
    """All-string table of files that may differ in their columns and separators.

    ``columns`` selects and renames (output -> header name); without it the result has
    the columns of all files, in the order of their first appearance.
    """
    return _read(read_lines(spark, path, form), null_tokens, columns, heads=header_lines(spark, path, form))


def read_numbered(spark: SparkSession, path: str, form: str | None = None) -> DataFrame:
    """:func:`read_delimited` with LINE, a number that no two lines of the files share."""
    return _read(numbered(read_lines(spark, path, form), across_files=True), keep=("LINE",), heads=header_lines(spark, path, form))


def _read(lines: DataFrame, null_tokens: Sequence[str] = (), columns: Mapping[str, str] | None = None, keep: Sequence[str] = (), heads: DataFrame | None = None) -> DataFrame:
    heads = checkpointed(layouts(lines, heads))
    if columns is None:
        # One row for each different layout, not for each file.
        kinds = heads.groupBy("NAMES").agg(F.min("FILE").alias("FILE")).orderBy("FILE").collect()
        columns = {name: name for kind in kinds for name in kind["NAMES"]}
        if not kinds:
            raise ValueError("no header line found")
    places = F.array(*[_place(F.col("NAMES"), F.lit(source)) for source in columns.values()])
    return parse(lines, heads.withColumn("PLACES", places), list(columns), null_tokens, keep)


def association_layouts(lines: DataFrame, heads: DataFrame | None = None) -> DataFrame:
    """``layouts`` with MAPPING (canonical field -> header), PLACES and MISSING for association files.

    A field takes the first of its aliases that a header has, whatever its case.
    """
    heads = layouts(lines, heads).withColumn("_LOW", F.transform("NAMES", F.lower))
    found = {field: F.coalesce(*[_place(F.col("_LOW"), F.lit(alias)) for alias in aliases]) for field, aliases in COLUMN_ALIASES.items()}
    placed = heads.withColumn("PLACES", F.array(*found.values()))
    at = {field: F.get("PLACES", F.lit(i)) for i, field in enumerate(COLUMN_ALIASES)}
    entries = F.array(*[F.struct(F.lit(f).alias("key"), F.get("NAMES", at[f]).alias("value")) for f in COLUMN_ALIASES])
    missing = F.filter(F.array(*[F.when(at[f].isNull(), f) for f in REQUIRED_FIELDS]), lambda f: f.isNotNull())
    mapping = F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
    return placed.select("FILE", "HEAD", "SEP", "NAMES", "PLACES", mapping.alias("MAPPING"), missing.alias("MISSING"))


def read_association_files(spark: SparkSession, path: str, form: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(table, layouts): raw association files of any layouts to canonical names, all strings.

    A file whose header lacks a required column is an error that names the file.
    """
    if path.lower().endswith((".vcf", ".vcf.gz")):
        raise ValueError("association VCF input is not supported by this reader")
    lines = read_lines(spark, path, form)
    heads = checkpointed(association_layouts(lines, header_lines(spark, path, form)))
    short = heads.filter(F.size("MISSING") > 0).orderBy("FILE").first()
    if short is not None:
        raise ValueError(f"could not identify required columns {short['MISSING']} in {short['FILE']}; header={short['NAMES'][:30]}")
    present = heads.select(F.explode(F.map_keys("MAPPING")).alias("field")).distinct().collect()  # canonical names
    if not present:
        raise ValueError("no header line found")
    wanted = [f for f in COLUMN_ALIASES if f in {row["field"] for row in present}]
    return parse(lines, heads, list(COLUMN_ALIASES)).select(*[F.col(f"`{f}`") for f in wanted]), heads


def read_associations(spark: SparkSession, path: str, form: str | None = None) -> tuple[DataFrame, dict[str, str]]:
    """Raw associations to canonical names, all strings, and the mapping used (of the first file, where they differ)."""
    table, heads = read_association_files(spark, path, form)
    return table, heads.orderBy("FILE").first()["MAPPING"]
