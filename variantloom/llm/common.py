"""Shared pieces of the operators: words, bindings inside expressions, stored tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from variantloom.session import ensure_checkpoint_dir

SPACES = "[\\x20\\x09-\\x0D]+"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in small batches: their arrays are many times the size of the text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def words(text: Column) -> Column:
    """Maximal runs of anything but space, tab and the line breaks; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, LOWER.upper(), LOWER)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row.

    A lambda variable cannot be copied into its uses by the optimizer, which
    would evaluate an array once for each of its elements.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def indexes(count: Column) -> Column:
    """0 .. count - 1; empty when count is not positive."""
    return F.when(count > 0, F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))


FILTER_WORDS = 1 << 20  # 64-bit words of a bitmap: 8 MB of bits, whatever it is made of


def _slot(hashed: Column) -> tuple[Column, Column]:
    """Word and bit of a 64-bit hash."""
    return F.shiftrightunsigned(hashed, 6).bitwiseAND(F.lit(FILTER_WORDS - 1)), hashed.bitwiseAND(F.lit(63)).cast("int")


def bitmap(hashed: DataFrame) -> DataFrame:
    """(slot_, bits_): the bits of a table of one column of 64-bit hashes, FILTER_WORDS rows at the most."""
    slot, bit = _slot(F.col(hashed.columns[0]))
    set_bits = hashed.select(slot.alias("slot_"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("bits_"))
    return set_bits.groupBy("slot_").agg(F.bit_or("bits_").alias("bits_"))


def may_hold(rows: DataFrame, hashed: Column, bits: DataFrame) -> DataFrame:
    """The rows whose hash may be in the bitmap: all that are, and a share of the others that grows with its fill.

    The bitmap has a fixed size, so it is broadcast; an exact step has to follow.
    """
    slot, bit = _slot(hashed)
    return rows.join(F.broadcast(bits), slot == F.col("slot_")).filter(F.getbit("bits_", bit) == 1).select(*rows.columns)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def split_by_bits(rows: DataFrame, hashed: Column, bits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose hash may be in the bitmap, and the others, none of which is."""
    slot, bit = _slot(hashed)
    set_ = F.coalesce(F.getbit("bits_", bit) == 1, F.lit(False))
    told = rows.join(F.broadcast(bits), slot == F.col("slot_"), "left")
    return told.filter(set_).select(*rows.columns), told.filter(~set_).select(*rows.columns)


class Stored:
    """A table written as Parquet into the shared folder, so that it survives lost executors.

    No other plan reads the shuffle files of its write, so they are removed when it ends.
    """

    def __init__(self, df: DataFrame):
        ensure_checkpoint_dir(df.sparkSession)
        self.spark = df.sparkSession
        self.path = f"{self.spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.parquet(self.path)
        finally:
            self.spark.conf.set(CLEANUP, before)
        self.frame = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        """Delete the files; only when no plan reads them any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame) -> DataFrame:
    """The same rows, read back from a table in the shared folder."""
    return Stored(df).frame
