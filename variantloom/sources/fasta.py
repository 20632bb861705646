"""Reference sequences as numbered lines: bases by offset arithmetic and equi joins.

A FASTA file is lines of equal width under a ``>`` line for each contig.  With the
number of its first line and the width, the line and column of any base are arithmetic,
so looking bases up is one equi join of positions with lines: no line is collected,
and a contig of any length is read by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from variantloom.session import checkpointed
from variantloom.sources.text import numbered, read_lines


def read_fasta(spark: SparkSession, path: str, form: str | None = None) -> DataFrame:
    """(FILE, LINE, value): the numbered lines of FASTA files, plain or compressed."""
    return numbered(read_lines(spark, path, form)).select("FILE", "LINE", F.rtrim("value").alias("value"))


def contig_key(name: Column | str) -> Column:
    """A contig's name without ``chr``; the mitochondrion is MT under any of its names."""
    short = F.regexp_replace(F.col(name) if isinstance(name, str) else name, "(?i)^chr", "")
    return F.when(F.upper(short).isin("M", "MT"), "MT").otherwise(short)


def fasta_index(lines: DataFrame) -> DataFrame:
    """(CONTIG, KEY, FILE, FIRST, LAST, WIDTH, LENGTH) of every contig that has a sequence.

    Headers are few; the next header of the file says where a sequence ends.  Of contigs
    with one key, the name without a prefix counts.
    """
    after = Window.partitionBy("FILE").orderBy("LINE")
    ends = lines.groupBy("FILE").agg(F.max(F.when(F.col("value") != "", F.col("LINE"))).alias("_END"))
    heads = lines.filter(F.col("value").startswith(">")).join(ends, "FILE").select(
        "FILE", F.regexp_extract("value", r"^>\s*(\S*)", 1).alias("CONTIG"), (F.col("LINE") + 1).alias("FIRST"),
        (F.coalesce(F.lead("LINE").over(after), F.col("_END") + 1) - 1).alias("LAST"),
    ).filter("LAST >= FIRST")
    size = lambda end, name: lines.select("FILE", F.col("LINE").alias(end), F.length("value").cast("bigint").alias(name))
    told = heads.join(size("FIRST", "WIDTH"), ["FILE", "FIRST"]).join(size("LAST", "_TAIL"), ["FILE", "LAST"])
    length = (F.col("LAST") - F.col("FIRST")) * F.col("WIDTH") + F.col("_TAIL")
    named = told.select("CONTIG", contig_key("CONTIG").alias("KEY"), "FILE", "FIRST", "LAST", "WIDTH", length.alias("LENGTH"))
    first = Window.partitionBy("KEY").orderBy(F.length("CONTIG"), "CONTIG", "FILE", "FIRST")
    return checkpointed(named.withColumn("_R", F.row_number().over(first)).filter("_R = 1").drop("_R"))


def _checked(index: DataFrame, line: Column) -> Column:
    """The line's text; all lines of a contig but its last must have the width of the first."""
    short = (F.length("value") != F.col("WIDTH")) & (line != F.col("LAST"))
    return F.when(short, F.raise_error(F.concat(F.lit("lines of contig "), F.col("CONTIG"), F.lit(" differ in width")))).otherwise(F.col("value"))


def bases(positions: DataFrame, lines: DataFrame, index: DataFrame) -> DataFrame:
    """(CHR, POS, BASE) of the different positions that a contig covers, upper case."""
    told = positions.select("CHR", "POS").distinct().withColumn("KEY", contig_key("CHR")).join(index, "KEY")
    inside = told.filter((F.col("POS") >= 1) & (F.col("POS") <= F.col("LENGTH")))
    placed = inside.withColumn("LINE", F.col("FIRST") + F.expr("(POS - 1) div WIDTH"))
    column = (F.pmod(F.col("POS") - 1, F.col("WIDTH")) + 1).cast("int")
    found = placed.join(lines, ["FILE", "LINE"])
    return found.select("CHR", "POS", F.upper(F.substring(_checked(index, F.col("LINE")), column, F.lit(1))).alias("BASE"))


def sequences(spans: DataFrame, lines: DataFrame, index: DataFrame) -> DataFrame:
    """(CHR, START, SIZE, BASES) of the different spans that lie within a contig.

    A span becomes one row for each line it touches; the parts are joined in order.
    """
    told = spans.select("CHR", "START", "SIZE").distinct().withColumn("KEY", contig_key("CHR")).join(index, "KEY")
    inside = told.filter((F.col("START") >= 1) & (F.col("SIZE") >= 1) & (F.col("START") + F.col("SIZE") - 1 <= F.col("LENGTH")))
    at = lambda position: F.col("FIRST") + F.expr(f"({position} - 1) div WIDTH")
    touched = inside.withColumn("LINE", F.explode(F.sequence(at("START"), at("START + SIZE - 1"))))
    start = (F.col("LINE") - F.col("FIRST")) * F.col("WIDTH")  # bases before the line
    low = F.greatest(F.col("START") - start, F.lit(1))
    high = F.least(F.col("START") + F.col("SIZE") - 1 - start, F.col("WIDTH"))
    parts = touched.join(lines, ["FILE", "LINE"]).select(
        "CHR", "START", "SIZE", "LINE", F.substring(_checked(index, F.col("LINE")), low.cast("int"), (high - low + 1).cast("int")).alias("PART")
    )
    joined = parts.groupBy("CHR", "START", "SIZE").agg(F.sort_array(F.collect_list(F.struct("LINE", "PART"))).alias("_P"))
    return joined.select("CHR", "START", "SIZE", F.upper(F.array_join(F.transform("_P", lambda p: p["PART"]), "")).alias("BASES"))
