"""Derived association statistics and scores as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Normal quantile of 0.975 and the median of chi-square with 1 df.
Z_975 = 1.959963984540054
MEDIAN_CHI2_1DF = 0.454936423119572
LN10 = math.log(10.0)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def is_finite(value: Column | str) -> Column:
    """Never null: false for null, NaN and infinities."""
    column = _col(value)
    return F.coalesce(~F.isnan(column) & (F.abs(column) < F.lit(float("inf"))), F.lit(False))


def log_odds(odds: Column) -> Column:
    """BETA = ln(OR), only for a positive odds ratio."""
    return F.when(odds > 0, F.ln(odds))


def se_from_ci(lower: Column, upper: Column) -> Column:
    """Standard error from 95 % bounds of an odds ratio."""
    return F.when((lower > 0) & (upper > 0), (F.ln(upper) - F.ln(lower)) / (2.0 * Z_975))


def effective_n(cases: Column | str, controls: Column | str) -> Column:
    """4 / (1/cases + 1/controls); null unless both are positive."""
    a, b = _col(cases), _col(controls)
    return F.when((a > 0) & (b > 0), 4.0 / (1.0 / a + 1.0 / b))


def z_score(beta: Column, se: Column, given: Column) -> Column:
    return F.coalesce(F.when(se > 0, beta / se), given)


def p_value(given: Column, neg_log10: Column, log_tail: Column) -> Column:
    """Reported P, else from -log10 P, else from the log tail of Z."""
    return F.coalesce(given, F.pow(F.lit(10.0), -neg_log10), F.exp(log_tail))


def neg_log10_p(given: Column, p: Column, log_tail: Column) -> Column:
    """Reported, else -log10 P, else the log tail of Z where P has underflowed."""
    return F.when(given.isNotNull(), given).when(p > 1e-300, -F.log10(p)).otherwise(log_tail * (-1.0 / LN10))


def sample_size_score(n: Column | str) -> Column:
    """min(1, max(0, log10 N / 7)); 0 when N is unknown or not positive."""
    column = _col(n)
    return F.when(column > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.log10(column) / 7.0))).otherwise(0.0)


def splice_class(score: Column | str) -> Column:
    column = _col(score)
    return (
        F.when(column.isNull(), "UNSCORED")
        .when(column >= 0.8, "HIGH_PRECISION")
        .when(column >= 0.5, "RECOMMENDED")
        .when(column >= 0.2, "HIGH_RECALL")
        .otherwise("LOW")
    )


def screen_class(score: Column | str) -> Column:
    """Class of a variant-level shared-variant probability."""
    column = _col(score)
    return (
        F.when(column >= 0.01, "strong")
        .when(column >= 0.001, "moderate")
        .when(column >= 0.0001, "weak")
        .when(column.isNotNull(), "none")
    )


def any_of(probability: Column) -> Column:
    """Aggregate 1 - prod(1 - p), exactly 1 if any p is 1, nulls skipped.

    ``log1p(-1)`` is null in Spark and would drop out of the sum, hence the
    guard on the maximum.
    """
    clipped = F.least(F.lit(1.0), F.greatest(F.lit(0.0), probability))
    return F.when(F.max(clipped) >= 1.0, F.lit(1.0)).otherwise(
        F.coalesce(-F.expm1(F.sum(F.log1p(-clipped))), F.lit(0.0))
    )

