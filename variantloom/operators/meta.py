"""Inverse-variance fixed-effect meta-analysis over populations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantloom.functions import statistics as S
from variantloom.functions import tails
from variantloom.functions import variants as V
from variantloom.schema import COMBINED_META, canonical_projection


class IncompatibleScalesError(ValueError):
    """Data sets on different effect scales must not be combined."""


def orient_to_second_allele(assoc: DataFrame) -> DataFrame:
    """Effects re-expressed for A2 of the sorted allele pair; unusable rows dropped."""
    parts = F.split("VARIANT_ID", ":")
    a2 = F.get(parts, F.lit(3))
    flip = F.col("EA") != a2
    return assoc.select(
        "VARIANT_ID",
        "CHR",
        "POS",
        F.get(parts, F.lit(2)).alias("A1"),
        a2.alias("A2"),
        F.when(flip, -F.col("BETA")).otherwise(F.col("BETA")).alias("BETA"),
        "SE",
        F.when(flip, 1.0 - F.col("EAF")).otherwise(F.col("EAF")).alias("EAF"),
        "N",
        "N_CASES",
        "N_CONTROLS",
        "RSID",
        F.col("POPULATION").alias("POP"),
    ).filter(S.is_finite("SE") & (F.col("SE") > 0) & S.is_finite("BETA"))


def drop_ambiguous_palindromes(aligned: DataFrame, maf: float | None = 0.4) -> DataFrame:
    """Drop A/T and C/G pairs without a frequency, or with one too close to a half."""
    if maf is None:
        return aligned
    minor = F.least(F.col("EAF"), 1.0 - F.col("EAF"))
    return aligned.filter(~(V.is_palindromic("A1", "A2") & (F.col("EAF").isNull() | (minor > maf))))


def align_for_meta(assoc: DataFrame, drop_palindromic_maf: float | None = 0.4) -> DataFrame:
    return drop_ambiguous_palindromes(orient_to_second_allele(assoc), drop_palindromic_maf)


def _direction(populations: Sequence[str]) -> Column:
    def sign(name: str) -> Column:
        beta = F.col(f"BETA_{name}")
        return F.when(beta.isNull(), "?").when(beta > 0, "+").when(beta < 0, "-").otherwise("0")

    return F.concat(*[sign(p) for p in populations])


def inverse_variance_meta(aligned: DataFrame, populations: Sequence[str]) -> DataFrame:
    """One shuffle by VARIANT_ID; every statistic is a partial aggregate.

    Sums of only-null sample sizes stay null: sizes are never invented.  Q_P and
    I2 are null with one population.
    """
    populations = sorted(populations)
    w = 1.0 / (F.col("SE") * F.col("SE"))

    def of(population: str, value: str) -> Column:
        return F.max(F.when(F.col("POP") == population, F.col(value)))

    present = [F.when(F.count(F.when(F.col("POP") == p, 1)) > 0, F.lit(p)) for p in populations]
    sums = aligned.groupBy("VARIANT_ID").agg(
        F.min("CHR").alias("CHR"),
        F.min("POS").alias("POS"),
        F.min("A1").alias("A1"),
        F.min("A2").alias("A2"),
        F.min("RSID").alias("RSID"),
        F.count("*").alias("N_POPULATIONS"),
        F.concat_ws(",", *present).alias("POPULATIONS"),
        F.sum(w).alias("_W"),
        F.sum(w * F.col("BETA")).alias("_WB"),
        F.sum(w * F.col("BETA") * F.col("BETA")).alias("_WB2"),
        F.sum(w * F.col("EAF")).alias("_WF"),
        F.sum(F.when(F.col("EAF").isNotNull(), w)).alias("_W_OBS"),
        F.sum("N").alias("N"),
        F.sum("N_CASES").alias("N_CASES"),
        F.sum("N_CONTROLS").alias("N_CONTROLS"),
        *[of(p, "BETA").alias(f"BETA_{p}") for p in populations],
        *[of(p, "SE").alias(f"SE_{p}") for p in populations],
    )
    pooled = sums.withColumns(
        {
            "BETA": F.col("_WB") / F.col("_W"),
            "SE": F.sqrt(1.0 / F.col("_W")),
            "Q": F.greatest(F.lit(0.0), F.col("_WB2") - F.col("_WB") * F.col("_WB") / F.col("_W")),
            "Q_DF": (F.col("N_POPULATIONS") - 1).cast("double"),
            "EAF": F.when(F.col("_W_OBS") > 0, F.col("_WF") / F.col("_W_OBS")),
            "DIRECTION": _direction(populations),
        }
    ).withColumn("Z", F.col("BETA") / F.col("SE"))
    q, k = F.col("Q"), F.col("Q_DF")
    i2 = F.when(q > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (q - k) / q))).otherwise(0.0)
    return tails.with_log_tail(pooled, "Z", "_LOG_P").withColumns(
        {
            "P": F.exp("_LOG_P"),
            "NEG_LOG10_P": F.col("_LOG_P") * (-1.0 / S.LN10),
            "Q_P": tails.chi_square_tail(q, k, max(1, len(populations) - 1)),
            "I2": F.when(k > 0, i2),
        }
    ).drop("_W", "_WB", "_WB2", "_WF", "_W_OBS", "_LOG_P")


def check_meta_inputs(trait_types: Mapping[str, str | None]) -> None:
    """At least two data sets, all binary or none binary."""
    if len(trait_types) < 2:
        raise ValueError("meta-analysis needs at least two population data sets")
    scales = {"binary" if kind == "binary" else "other" for kind in trait_types.values() if kind}
    if len(scales) > 1:
        raise IncompatibleScalesError(f"different effect scales: {sorted(set(filter(None, trait_types.values())))}")


def run_meta(
    assoc: DataFrame,
    populations: Sequence[str],
    trait: str | None = None,
    trait_types: Mapping[str, str | None] | None = None,
    drop_palindromic_maf: float | None = 0.4,
) -> DataFrame:
    """Canonical meta-analysis table with heterogeneity and per-population effects.

    ``assoc`` is the canonical table of all populations (one row per variant and
    population); unwritten order, see ``harmonize.in_genome_order``.
    """
    populations = sorted(populations)
    check_meta_inputs(trait_types if trait_types is not None else dict.fromkeys(populations))
    chosen = assoc.filter(F.col("POPULATION").isin(*populations))
    meta = inverse_variance_meta(align_for_meta(chosen, drop_palindromic_maf), populations)
    constants = {
        "STUDY_ID": COMBINED_META,
        "TRAIT": trait,
        "POPULATION": COMBINED_META,
        "REF": None,
        "ALT": None,
        "OR": None,
        "EA": F.col("A2"),
        "NEA": F.col("A1"),
        "N_EFF": S.effective_n("N_CASES", "N_CONTROLS"),
        "BUILD": "GRCh38",
        "SOURCE_FILE": "fixed_effect_ivw:" + ",".join(populations),
    }
    extra = ["N_POPULATIONS", "POPULATIONS", "DIRECTION", "Q", "Q_DF", "Q_P", "I2"]
    extra += [f"BETA_{p}" for p in populations] + [f"SE_{p}" for p in populations]
    return canonical_projection(meta, constants, extra)
