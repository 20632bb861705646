"""Order statistics and prefix aggregates that never put a whole group in one task.

A window over a key sorts every row of that key in one task, and the exact
``percentile`` aggregate keeps every distinct value of a key in one buffer.
Both fail when one key holds a large share of the data, so:

* ``exact_median`` narrows the median down through value-derived buckets, with
  map-side combined counts at each level;
* ``prefix_scan`` range-partitions by (keys, order) so a hot key spans many
  partitions, and combines small per-partition totals with local windows;
* ``merge_intervals`` does gaps-and-islands per coordinate bin.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from variantloom.session import checkpointed

def bind(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add (or replace) columns that later filters and projections read without recomputing.

    The optimizer pushes a filter below a projection by copying the projected
    expressions into the condition, which repeats parsing and casting for every
    mention.  What a generator makes is not copied, while filters on the other
    columns still go through it to the scan.  The expressions stand in a projection
    below it, which is compiled; the generator only passes their values on.
    """
    kept = [F.col(f"`{name}`") for name in df.columns if name not in columns]
    made = df.select(*kept, *[expr.alias(name) for name, expr in columns.items()])
    return made.select(*kept, F.inline(F.array(F.struct(*[F.col(f"`{name}`") for name in columns]))))


BROADCAST_KEYS = 100_000
_FINE = 2048.0
_FINER = 1048576.0


def _coarse_bucket(value: Column) -> tuple[Column, Column]:
    """Two monotone integer refinements of a double: exponent plus 11 bits, then 20 more."""
    size = F.abs(value)
    exponent = F.floor(F.log2(size))
    scaled = (size / F.pow(F.lit(2.0), exponent) - 1.0) * _FINE
    step = F.floor(scaled)
    level1 = (exponent + 1100) * int(_FINE) + step
    level2 = F.floor((scaled - step) * _FINER)
    sign = F.signum(value).cast("bigint")
    return (
        F.when(value == 0, F.lit(0)).otherwise(sign * level1).cast("bigint"),
        F.when(value == 0, F.lit(0)).otherwise(sign * level2).cast("bigint"),
    )


def _narrow(histogram: DataFrame, keys: list[str], bucket: str) -> DataFrame:
    """Bucket that holds the wanted RANK of each key, and the rank inside it."""
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return (
        histogram.withColumn("BEFORE", F.coalesce(F.sum("COUNT").over(before), F.lit(0)))
        .filter((F.col("RANK") > F.col("BEFORE")) & (F.col("RANK") <= F.col("BEFORE") + F.col("COUNT")))
        .select(*keys, bucket, (F.col("RANK") - F.col("BEFORE")).alias("RANK"))
    )


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "MEDIAN") -> DataFrame:
    """Exact median of the non-null, non-NaN values per key.

    Three passes over (keys, value), each a map-side combined count; the first
    two fix their small result, so the data itself is never shuffled.  The
    windows run over histograms whose size is bounded by the bucket grid.  The small
    results, two rows a key, are broadcast up to ``BROADCAST_KEYS`` rows; else the size
    estimates could choose the data for that.  Give it a stored table (or a checkpoint): it is read three times.
    """
    keys = list(keys)
    base = df.select(*keys, F.col(value).cast("double").alias("V")).filter(
        F.col("V").isNotNull() & ~F.isnan("V")
    )
    if not keys:
        return exact_median(base.withColumn("ALL", F.lit(1)), ["ALL"], "V", out).drop("ALL")
    b1, b2 = _coarse_bucket(F.col("V"))
    rows = base.withColumns({"B1": b1, "B2": b2})
    slot_keys = [*keys, "SLOT"]

    counts = rows.groupBy(*keys, "B1").agg(F.count("*").alias("COUNT"))
    total = F.sum("COUNT").over(Window.partitionBy(*keys))
    halves = F.array(
        F.struct(F.lit(0).alias("SLOT"), F.floor((F.col("TOTAL") + 1) / 2).alias("RANK")),
        F.struct(F.lit(1).alias("SLOT"), F.floor((F.col("TOTAL") + 2) / 2).alias("RANK")),
    )
    wanted = counts.withColumn("TOTAL", total).select(*keys, "B1", "COUNT", F.inline(halves))
    level1 = checkpointed(_narrow(wanted, slot_keys, "B1"))
    few = level1.count() <= BROADCAST_KEYS
    counts2 = rows.join(F.broadcast(level1) if few else level1, [*keys, "B1"]).groupBy(*slot_keys, "RANK", "B1", "B2").agg(F.count("*").alias("COUNT"))
    level2 = checkpointed(_narrow(counts2, [*slot_keys, "B1"], "B2"))
    counts3 = rows.join(F.broadcast(level2) if few else level2, [*keys, "B1", "B2"]).groupBy(*slot_keys, "RANK", "V").agg(F.count("*").alias("COUNT"))
    return _narrow(counts3, slot_keys, "V").groupBy(*keys).agg(F.avg("V").alias(out))


def counted_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "MEDIAN") -> DataFrame:
    """Median of a column with few distinct values per key, such as a sample size.

    Equal values are counted before the exact percentile, so its buffer is
    bounded by the distinct values.
    """
    keys = list(keys)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("FREQ"))
    return counts.groupBy(*keys).agg(F.percentile(value, F.lit(0.5), F.col("FREQ")).alias(out))


def prefix_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    sums: Mapping[str, Column] | None = None,
    rank: str | None = None,
) -> DataFrame:
    """Exclusive running sums, and a 1-based rank, within keys in a total order.

    The order must be total so that retries and reads agree.  One range shuffle
    and one checkpoint; a hot key is spread over many range partitions.
    """
    keys, sums = list(keys), dict(sums or {})
    measures = {**{name: expr for name, expr in sums.items()}, **({rank: F.lit(1)} if rank else {})}
    tagged = df.withColumns({f"_V_{name}": expr for name, expr in measures.items()})
    placed = checkpointed(
        tagged.repartitionByRange(*[F.col(k) for k in keys], *order).withColumn("_PART", F.spark_partition_id())
    )
    totals = placed.groupBy(*keys, "_PART").agg(*[F.sum(f"_V_{m}").alias(f"_T_{m}") for m in measures])
    earlier = Window.partitionBy(*keys).orderBy("_PART").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "_PART", *[F.coalesce(F.sum(f"_T_{m}").over(earlier), F.lit(0)).alias(f"_O_{m}") for m in measures]
    )
    local = Window.partitionBy(*keys, "_PART").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = placed.join(offsets, [*keys, "_PART"])
    for name in measures:
        running = F.col(f"_O_{name}") + F.coalesce(F.sum(f"_V_{name}").over(local), F.lit(0))
        out = out.withColumn(name, running + 1 if name == rank else running)
    helpers = ["_PART"] + [f"_{kind}_{m}" for kind in ("V", "O") for m in measures]
    return out.drop(*helpers)


def merge_intervals(
    intervals: DataFrame,
    keys: Sequence[str],
    gap: int = 0,
    bin_bp: int = 1_000_000,
    facts: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Merge overlapping (or nearly touching) START..END intervals within keys.

    Returns one row per distinct (keys, START) with ISLAND_START, the start of
    the merged interval it belongs to, END, its furthest end, and ``facts``,
    further aggregates of the intervals with that start.  Starts are binned by
    coordinate: the windows see at most ``bin_bp`` distinct starts, and the
    carry over bins sees one row per bin.
    """
    keys = list(keys)
    facts = dict(facts or {})
    starts = (
        intervals.groupBy(*keys, "START")
        .agg(F.max("END").alias("END"), *[expr.alias(name) for name, expr in facts.items()])
        .withColumn("_BIN", F.floor(F.col("START") / bin_bp))
    )
    over_bins = Window.partitionBy(*keys).orderBy("_BIN").rowsBetween(Window.unboundedPreceding, -1)
    reach = (
        starts.groupBy(*keys, "_BIN")
        .agg(F.max("END").alias("_BIN_END"))
        .select(*keys, "_BIN", F.max("_BIN_END").over(over_bins).alias("_CARRY_END"))
    )
    in_bin = Window.partitionBy(*keys, "_BIN").orderBy("START")
    flagged = (
        starts.join(reach, [*keys, "_BIN"])
        .withColumn(
            "_REACH",
            F.greatest("_CARRY_END", F.max("END").over(in_bin.rowsBetween(Window.unboundedPreceding, -1))),
        )
        .withColumn(
            "_OPENS",
            F.when(F.col("_REACH").isNull() | (F.col("START") > F.col("_REACH") + gap), F.col("START")),
        )
        .withColumn("_LOCAL", F.max("_OPENS").over(in_bin.rowsBetween(Window.unboundedPreceding, 0)))
    )
    carried = (
        flagged.groupBy(*keys, "_BIN")
        .agg(F.max("_OPENS").alias("_BIN_OPEN"))
        .select(*keys, "_BIN", F.max("_BIN_OPEN").over(over_bins).alias("_CARRY_OPEN"))
    )
    return flagged.join(carried, [*keys, "_BIN"]).select(
        *keys, "START", "END", *facts, F.coalesce("_LOCAL", "_CARRY_OPEN").alias("ISLAND_START")
    )
