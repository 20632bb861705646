"""Linkage disequilibrium for any number of samples: dosages in blocks, Gram products in two dimensions.

A block row is (POPULATION, CHR, POS, VARIANT_ID, BLOCK, DOSAGE): the calls of one run of
samples, so no row holds all samples of a panel.  Frequencies and norms are aggregates
over the blocks of a variant.  Variants are ranked by position and cut into tiles of a
size in bytes; two tiles are multiplied only where they have variants within the window,
which their first and last positions tell before any vector moves.  A pair of tiles is
one matrix product for each block: the blocks of a pair come to one task in order, which
adds their products up as they come, so vectors are shuffled and not products, and a task
holds one pair.  What reaches the floor leaves the sum in batches of bounded size.  Only
where a pair has very many blocks do several tasks add them up, and their sums meet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.operators.ld import edge_batches
from variantloom.plans.ordered import prefix_scan
from variantloom.session import checkpointed, small_batches

VARIANT = ["POPULATION", "CHR", "POS", "VARIANT_ID"]
TILE_BYTES = 4 << 20
TILE_MOST = 2048  # variants of a tile: the products of a pair take 32 MB at the most
SUM_WIDTH = 32  # blocks of one pair that a task adds up, at least


def sample_blocks(dosages: DataFrame, size: int = 4096) -> DataFrame:
    """Blocks of ``size`` samples of rows that hold all of them."""
    n = F.ceil(F.size("DOSAGE") / size).cast("int")
    at = dosages.filter(F.size("DOSAGE") > 0).select(*VARIANT, "DOSAGE", F.explode(F.sequence(F.lit(0), n - 1)).alias("BLOCK"))
    return at.select(*VARIANT, "BLOCK", F.slice("DOSAGE", F.col("BLOCK") * size + 1, F.lit(size)).alias("DOSAGE"))


def call_blocks(calls: DataFrame, size: int = 4096) -> DataFrame:
    """Blocks of single calls (POPULATION, CHR, POS, VARIANT_ID, SAMPLE, DOSAGE), SAMPLE a number from 0.

    A call that is not there is missing; so is the rest of the last block, up to the last
    sample of its population.
    """
    top = calls.groupBy("POPULATION").agg(F.max("SAMPLE").alias("_TOP"))
    placed = calls.withColumn("BLOCK", F.floor(F.col("SAMPLE") / size).cast("int"))
    held = placed.groupBy(*VARIANT, "BLOCK").agg(F.map_from_entries(F.collect_list(F.struct("SAMPLE", "DOSAGE"))).alias("_M")).join(top, "POPULATION")
    last = F.least((F.col("BLOCK") + 1) * F.lit(size) - 1, F.col("_TOP"))
    samples = F.sequence((F.col("BLOCK") * size).cast("bigint"), last.cast("bigint"))
    return held.select(*VARIANT, "BLOCK", F.transform(samples, lambda s: F.element_at("_M", s)).alias("DOSAGE"))


def _called(value: Column) -> Column:
    return F.nanvl(value, F.lit(None))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + F.coalesce(x, F.lit(0.0)))


def standardise_blocks(blocks: DataFrame, maf: float | None = 0.01, max_missing: float | None = 0.05) -> DataFrame:
    """UNIT blocks after the panel's quality filter: mean-imputed, centred and normalised over all blocks.

    A variant whose block is absent has no calls in it.
    """
    calls = F.transform("DOSAGE", _called)
    counted = blocks.select(*VARIANT, "BLOCK", calls.alias("X"))
    size = counted.groupBy("POPULATION", "BLOCK").agg(F.max(F.size("X")).alias("_S")).groupBy("POPULATION").agg(F.sum("_S").alias("_ALL"))
    sums = counted.groupBy(*VARIANT).agg(
        F.sum(F.size(F.filter("X", lambda x: x.isNotNull())).cast("bigint")).alias("_OBS"), F.sum(_sum(F.col("X"))).alias("_SUM")
    )
    means = checkpointed(sums.filter("_OBS > 0").join(size, "POPULATION").withColumn("_MEAN", F.col("_SUM") / F.col("_OBS")))
    keep = F.lit(True)
    if maf is not None:
        keep = keep & (F.least(F.col("_MEAN") / 2.0, 1.0 - F.col("_MEAN") / 2.0) >= maf)
    if max_missing is not None:
        keep = keep & (1.0 - F.col("_OBS") / F.col("_ALL") <= max_missing)
    centred = counted.join(means.filter(keep).select(*VARIANT, "_MEAN"), VARIANT).select(
        *VARIANT, "BLOCK", F.transform("X", lambda x: F.coalesce(x - F.col("_MEAN"), F.lit(0.0))).alias("C")
    )
    norms = centred.groupBy(*VARIANT).agg(F.sqrt(F.sum(F.aggregate("C", F.lit(0.0), lambda s, x: s + x * x))).alias("_NORM")).filter("_NORM > 0")
    return centred.join(norms, VARIANT).select(*VARIANT, "BLOCK", F.transform("C", lambda x: x / F.col("_NORM")).alias("UNIT"))


def position_tiles(units: DataFrame, window_bp: int | None, tile: int) -> DataFrame:
    """(POPULATION, CHR, POS, VARIANT_ID, BIN, TILE, SLOT): at most ``tile`` neighbours to a tile, in bins as wide as the window.

    Without a window a chromosome is one bin.
    """
    bin_ = F.lit(0).cast("bigint") if window_bp is None else F.floor(F.col("POS") / F.lit(window_bp))
    variants = units.select(*VARIANT).distinct().withColumn("BIN", bin_)
    ranked = prefix_scan(variants, ["POPULATION", "CHR", "BIN"], [F.col("POS"), F.col("VARIANT_ID")], rank="_R")
    return checkpointed(ranked.select(*VARIANT, "BIN", F.expr(f"(_R - 1) div {tile}").alias("TILE"), ((F.col("_R") - 1) % tile).cast("int").alias("SLOT")))


def tile_pairs(placed: DataFrame, window_bp: int | None) -> DataFrame:
    """(POPULATION, CHR, BIN_A, TILE_A, BIN_B, TILE_B) of tiles that reach each other, each pair once."""
    tiles = placed.groupBy("POPULATION", "CHR", "BIN", "TILE").agg(F.min("POS").alias("LOW"), F.max("POS").alias("HIGH"))
    a = tiles.select("POPULATION", "CHR", *[F.col(c).alias(f"{c}_A") for c in ("BIN", "TILE", "LOW", "HIGH")])
    b = tiles.select("POPULATION", "CHR", *[F.col(c).alias(f"{c}_B") for c in ("BIN", "TILE", "LOW", "HIGH")])
    near = a.withColumn("BIN_B", F.explode(F.array(F.col("BIN_A"), F.col("BIN_A") + 1))).join(b, ["POPULATION", "CHR", "BIN_B"])
    once = (F.col("BIN_A") < F.col("BIN_B")) | (F.col("TILE_A") <= F.col("TILE_B"))
    reach = F.lit(True) if window_bp is None else F.col("LOW_B") - F.col("HIGH_A") <= window_bp
    return near.filter(once & reach).select("POPULATION", "CHR", "BIN_A", "TILE_A", "BIN_B", "TILE_B")


PAIR = ["POPULATION", "CHR", "BIN_A", "TILE_A", "BIN_B", "TILE_B"]
_PAIR_TYPES = "POPULATION string, CHR string, BIN_A bigint, TILE_A bigint, BIN_B bigint, TILE_B bigint"
_EDGE_TYPES = "POPULATION string, ID_A string, ID_B string, R double"


class _Pair:
    """The names and the summed products of one pair of tiles, whose rows come one after the other."""

    def __init__(self, key: tuple):
        self.key, self.same = key, key[2:4] == key[4:6]
        self.ids, self.positions = [[], []], [[], []]
        self.block, self.left, self.gram = None, None, None

    def name(self, side: int, ids: list, positions: list) -> None:
        self.ids[side], self.positions[side] = ids, positions
        if self.same:
            self.ids[1], self.positions[1] = ids, positions

    def multiply(self, side: int, block: int, n: int, slots: np.ndarray, values: np.ndarray) -> None:
        """The first tile's vectors of a block are held until the second's come."""
        given = n, slots, values.reshape(len(slots), -1)
        if side == 0:
            self.block, self.left = block, given
        if (side == 1 or self.same) and self.left is not None and self.block == block:
            (n_a, slots_a, left), (n_b, slots_b, right) = self.left, given
            if self.gram is None:
                self.gram = np.zeros((n_a, n_b))
            if len(slots_a) == n_a and len(slots_b) == n_b:  # sorted, so each slot is at its place
                self.gram += left @ right.T
            else:
                self.gram[np.ix_(slots_a, slots_b)] += left @ right.T

    def add(self, gram: bytes) -> None:
        part = np.frombuffer(gram)
        if self.gram is None:
            self.gram = np.zeros(part.shape)
        self.gram += part.reshape(self.gram.shape)

    def partial(self) -> Iterator[pa.RecordBatch]:
        if self.gram is not None:
            names = [*PAIR, "GRAM"]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*self.key, self.gram.tobytes())], names)

    def edges(self, min_r2: float, window_bp: int | None) -> Iterator[pa.RecordBatch]:
        """What reaches the floor."""
        shape = len(self.ids[0]), len(self.ids[1])
        if all(shape):
            gram = np.zeros(shape) if self.gram is None else self.gram.reshape(shape)
            yield from edge_batches(self.key[0], self.ids, self.positions, gram, min_r2, window_bp, "same" if self.same else "apart")


def _by_pair(give: Callable[[_Pair], Iterator[pa.RecordBatch]], parts: Sequence[str] = ()):
    """Rows sorted by pair (and part), block and side as a stream: one pair is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pair = None, None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in (*PAIR, *parts)), strict=True))
            blocks, sides, sizes = (batch.column(c).to_pylist() for c in ("BLOCK", "SIDE", "N"))
            for k, key in enumerate(keys):
                if key != at:
                    if pair is not None:
                        yield from give(pair)
                    at, pair = key, _Pair(key[: len(PAIR)])
                if batch.column("GRAM")[k].is_valid:
                    pair.add(batch.column("GRAM")[k].as_buffer())
                elif blocks[k] < 0:
                    pair.name(sides[k], batch.column("IDS")[k].as_py(), batch.column("POSITIONS")[k].as_py())
                else:
                    slots, values = (batch.column(c)[k].values.to_numpy() for c in ("SLOTS", "VALUES"))
                    pair.multiply(sides[k], blocks[k], sizes[k], slots, values)
        if pair is not None:
            yield from give(pair)

    return run


def _pair_rows(units: DataFrame, placed: DataFrame, pairs: DataFrame) -> DataFrame:
    """Everything a pair of tiles needs, as rows of bounded size: SIDE 0 for its first tile and 1 for its second.

    BLOCK -1 has the names of a tile, the others its vectors in a block.  The two tiles of
    a pair may be one, which then comes once.
    """
    key = ["POPULATION", "CHR", "BIN", "TILE"]
    named = placed.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("SLOT", "VARIANT_ID", "POS"))).alias("_V"))
    names = named.select(
        *key, F.lit(-1).alias("BLOCK"), F.size("_V").alias("N"), F.lit(None).cast("array<int>").alias("SLOTS"), F.lit(None).cast("array<double>").alias("VALUES"),
        F.col("_V.VARIANT_ID").alias("IDS"), F.col("_V.POS").alias("POSITIONS"),
    )
    packed = units.join(placed.select("POPULATION", "VARIANT_ID", "BIN", "TILE", "SLOT"), ["POPULATION", "VARIANT_ID"]).groupBy(*key, "BLOCK").agg(
        F.sort_array(F.collect_list(F.struct("SLOT", "UNIT"))).alias("_ROWS")
    )
    sizes = placed.groupBy(*key).agg(F.count("*").cast("int").alias("N"))
    vectors = packed.join(sizes, key).select(
        *key, F.col("BLOCK").cast("int").alias("BLOCK"), "N", F.col("_ROWS.SLOT").alias("SLOTS"), F.flatten("_ROWS.UNIT").alias("VALUES"),
        F.lit(None).cast("array<string>").alias("IDS"), F.lit(None).cast("array<bigint>").alias("POSITIONS"),
    )
    side = lambda s, n: pairs.select("POPULATION", "CHR", F.col(f"BIN_{s}").alias("BIN"), F.col(f"TILE_{s}").alias("TILE"), *PAIR[2:], F.lit(n).alias("SIDE"))
    apart = (F.col("BIN_A") != F.col("BIN_B")) | (F.col("TILE_A") != F.col("TILE_B"))
    roles = side("A", 0).unionByName(side("B", 1).filter(apart))
    return vectors.unionByName(names).join(roles, key).withColumn("GRAM", F.lit(None).cast("binary")).drop("BIN", "TILE")


def _met(rows: DataFrame, parts: Sequence[str] = ()) -> DataFrame:
    return rows.repartition(*PAIR, *parts).sortWithinPartitions(*PAIR, *parts, "BLOCK", "SIDE")


def ld_edges_blocked(units: DataFrame, min_r2: float = 0.1, window_bp: int | None = 1_000_000, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """(POPULATION, ID_A, ID_B, R), ID_A < ID_B: every pair within the window that reaches ``min_r2``; None: within the chromosome.

    ``units`` is the result of :func:`standardise_blocks`, best stored: it is read twice.
    """
    facts = units.agg(F.max(F.size("UNIT")).alias("size"), F.max("BLOCK").alias("top")).first()
    if facts["size"] is None:
        return units.sparkSession.createDataFrame([], _EDGE_TYPES)
    small_batches(units.sparkSession)
    tile = max(16, min(TILE_MOST, tile_bytes // (8 * max(1, facts["size"]))))
    placed = position_tiles(units, window_bp, tile)
    rows = _pair_rows(units, placed, checkpointed(tile_pairs(placed, window_bp)))
    width = max(SUM_WIDTH, tile // max(1, facts["size"]))  # a sum is no larger than the vectors of its blocks
    if facts["top"] + 1 > width:
        named, vectors = rows.filter("BLOCK < 0"), rows.filter("BLOCK >= 0").withColumn("PART", F.expr(f"BLOCK div {width}"))
        sums = _met(vectors, ["PART"]).mapInArrow(_by_pair(_Pair.partial, ["PART"]), f"{_PAIR_TYPES}, GRAM binary")
        rows = named.unionByName(sums.withColumns({"BLOCK": F.lit(0), "SIDE": F.lit(0)}), allowMissingColumns=True)
    return _met(rows).mapInArrow(_by_pair(lambda pair: pair.edges(min_r2, window_bp)), _EDGE_TYPES)
