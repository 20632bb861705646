"""Smallest eigenvalue of LD without the matrix: Lanczos over unit vectors in blocks of samples.

The LD matrix of a set is the product of its unit vectors with themselves.  Multiplying it
by a vector is two aggregates: the unit vectors weighted and summed over the variants,
block by block, and the product of that sum with each of them.  So no pair of variants is
ever formed, a set of any size spans tasks, and a panel of any number of samples stays in
blocks.  All sets take their steps together; each keeps its basis, one number a variant
and step, and is orthogonalised against all of it, twice.  A set whose basis is complete
stops by itself, so up to as many steps as it has variants or samples the value is exact;
for larger ones RESIDUAL bounds how far the value is from an eigenvalue.  Sets with no more
members than steps, and at most ``SMALL`` numbers, take no steps: their matrix is made in
the row that holds the set, after one shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantloom.operators.ld import dot
from variantloom.session import checkpointed

KEY = ["SET_ID", "VARIANT_ID"]
SMALL = 20_000  # numbers in the unit vectors of a set that one row may hold
RESULT = "SET_ID string, MIN_EIGENVALUE double, RESIDUAL double, STEPS int"


def _listed(df: DataFrame, keys: list[str], at: str, value: str, name: str) -> DataFrame:
    """Values of short numbered lists as one array each; a list is as long as a block or a basis."""
    rows = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(at, value))).alias("_L"))
    return rows.select(*keys, F.transform("_L", lambda x: x[value]).alias(name))


def _product(placed: DataFrame, last: DataFrame) -> DataFrame:
    """(SET_ID, VARIANT_ID, _Y): the LD of each set times its last basis vector (SET_ID, VARIANT_ID, _Q)."""
    weighted = placed.join(last, KEY).select("SET_ID", "BLOCK", F.posexplode(F.transform("UNIT", lambda x: x * F.col("_Q"))).alias("_S", "_X"))
    sums = weighted.groupBy("SET_ID", "BLOCK", "_S").agg(F.sum("_X").alias("_X"))
    return placed.join(_listed(sums, ["SET_ID", "BLOCK"], "_S", "_X", "_W"), ["SET_ID", "BLOCK"]).groupBy(*KEY).agg(F.sum(dot("UNIT", "_W")).alias("_Y"))


def _orthogonal(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (SET_ID, VARIANT_ID, _BASIS, _R) without what lies in the basis, and the coefficients taken out."""
    parts = rows.select("SET_ID", "_R", F.posexplode("_BASIS").alias("_J", "_B")).groupBy("SET_ID", "_J").agg(F.sum(F.col("_B") * F.col("_R")).alias("_C"))
    taken = _listed(parts, ["SET_ID"], "_J", "_C", "_CS")
    return rows.join(taken, "SET_ID").select(*KEY, "_BASIS", (F.col("_R") - dot("_BASIS", "_CS")).alias("_R")), taken


def _values(group: pd.DataFrame) -> pd.DataFrame:
    """Smallest eigenvalue of the small tridiagonal matrix of one set."""
    group = group.sort_values("STEP")
    alpha, beta = group["ALPHA"].to_numpy(), group["BETA"].to_numpy()
    values, vectors = np.linalg.eigh(np.diag(alpha) + np.diag(beta[:-1], 1) + np.diag(beta[:-1], -1))
    return pd.DataFrame({"SET_ID": group["SET_ID"].iloc[:1], "MIN_EIGENVALUE": values[0], "RESIDUAL": abs(beta[-1] * vectors[-1, 0]), "STEPS": len(alpha)})


def _small_values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Smallest eigenvalue of each row's set, whose vectors lie in one row as (variant, block) pieces in order, and how many steps it would take at the most."""
    for batch in batches:
        values = []
        for names, blocks, sizes, flat in zip(batch["_NAMES"], batch["_BLOCKS"], batch["_SIZES"], batch["_VALUES"]):
            widths = {}
            for block, size in zip(blocks, sizes):
                widths[block] = max(size, widths.get(block, 0))
            starts = dict(zip(widths, np.cumsum([0, *widths.values()])))
            rows = {name: i for i, name in enumerate(dict.fromkeys(names))}
            matrix, at = np.zeros((len(rows), sum(widths.values()))), 0
            for name, block, size in zip(names, blocks, sizes):
                matrix[rows[name], starts[block] : starts[block] + size] = flat[at : at + size]
                at += size
            values.append((float(np.linalg.eigvalsh(matrix @ matrix.T)[0]), min(matrix.shape)))
        low, n = zip(*values) if values else ((), ())
        yield pd.DataFrame({"SET_ID": batch["SET_ID"], "LOW": np.asarray(low, np.float64), "STEPS": np.asarray(n, np.int32)})


def _solved(placed: DataFrame, ridge: float) -> DataFrame:
    """The result for sets of bounded size, each of which fits a row: one shuffle, whatever the number of sets."""
    rows = placed.groupBy("SET_ID").agg(F.sort_array(F.collect_list(F.struct("VARIANT_ID", "BLOCK", "UNIT"))).alias("_P"))
    flat = rows.select(
        "SET_ID", F.col("_P.VARIANT_ID").alias("_NAMES"), F.col("_P.BLOCK").alias("_BLOCKS"), F.transform("_P", lambda p: F.size(p["UNIT"])).alias("_SIZES"),
        F.flatten("_P.UNIT").alias("_VALUES"),
    )
    low = flat.mapInPandas(_small_values, "SET_ID string, LOW double, STEPS int")
    return low.select("SET_ID", ((1.0 - ridge) * F.col("LOW") + ridge).alias("MIN_EIGENVALUE"), F.lit(0.0).alias("RESIDUAL"), "STEPS")


def smallest_eigenvalue(
    members: DataFrame, units: DataFrame, ridge: float = 1e-4, steps: int = 60, tolerance: float = 1e-9
) -> DataFrame:
    """(SET_ID, MIN_EIGENVALUE, RESIDUAL, STEPS) of the LD of each set, shrunk by ``ridge`` towards the unit matrix.

    ``members`` is (SET_ID, POPULATION, VARIANT_ID), ``units`` the blocks of
    :func:`variantloom.operators.ld_blocks.standardise_blocks`.
    """
    told = members.select("SET_ID", "POPULATION", "VARIANT_ID").distinct()
    placed = checkpointed(told.join(units.select("POPULATION", "VARIANT_ID", "BLOCK", "UNIT"), ["POPULATION", "VARIANT_ID"]).drop("POPULATION"))
    # Steps enough for all members would give the same as the whole matrix of such a set.
    sizes = checkpointed(
        placed.groupBy("SET_ID", "VARIANT_ID").agg(F.sum(F.size("UNIT")).alias("_N")).groupBy("SET_ID")
        .agg(((F.count(F.lit(1)) <= steps) & (F.sum("_N") <= SMALL)).alias("_SMALL"))
    )
    direct = _solved(placed.join(sizes.filter("_SMALL"), "SET_ID", "left_semi"), ridge)
    if sizes.filter("not _SMALL").isEmpty():
        return direct
    placed = checkpointed(placed.join(sizes.filter("not _SMALL"), "SET_ID", "left_semi"))
    start = placed.select(*KEY).distinct().withColumn("_R", F.pmod(F.xxhash64(*KEY), F.lit(1 << 20)) / F.lit(float(1 << 20)) + 0.5)
    norms = start.groupBy("SET_ID").agg(F.sqrt(F.sum(F.col("_R") * F.col("_R"))).alias("_N"))
    basis = checkpointed(start.join(norms, "SET_ID").select(*KEY, F.array(F.col("_R") / F.col("_N")).alias("_BASIS")))
    found: list[DataFrame] = []
    for step in range(1, steps + 1):
        last = basis.select(*KEY, F.element_at("_BASIS", -1).alias("_Q"))
        image = basis.join(_product(placed, last), KEY).select(*KEY, "_BASIS", ((1.0 - ridge) * F.col("_Y") + ridge * F.element_at("_BASIS", -1)).alias("_R"))
        once, first = _orthogonal(checkpointed(image))
        rest, second = _orthogonal(checkpointed(once))
        rest = checkpointed(rest)
        beta = rest.groupBy("SET_ID").agg(F.sqrt(F.sum(F.col("_R") * F.col("_R"))).alias("BETA"))
        alpha = first.join(second.withColumnRenamed("_CS", "_C2"), "SET_ID").select("SET_ID", (F.element_at("_CS", -1) + F.element_at("_C2", -1)).alias("ALPHA"))
        facts = checkpointed(alpha.join(beta, "SET_ID").select("SET_ID", F.lit(step).alias("STEP"), "ALPHA", F.when(F.col("BETA") > tolerance, F.col("BETA")).otherwise(0.0).alias("BETA")))
        found.append(facts)
        going = facts.filter("BETA > 0")
        if step == steps or going.isEmpty():
            break
        basis = checkpointed(rest.join(going, "SET_ID").select(*KEY, F.array_append("_BASIS", F.col("_R") / F.col("BETA")).alias("_BASIS")))
    table = found[0]
    for facts in found[1:]:
        table = table.unionByName(facts)
    return table.groupBy("SET_ID").applyInPandas(_values, RESULT).unionByName(direct)
