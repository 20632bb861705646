"""Normal and chi-square tails as Column expressions.

Spark SQL has no erf, erfc or chi-square tail.  The complementary error
function is the rational Chebyshev approximation of W. J. Cody (1969), in
three ranges; its logarithm is taken analytically so that a P-value that
underflows still has a finite -log10.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Published coefficients of the three ranges.
CODY_A = (3.1611237438705655, 113.86415415105016, 377.485237685302, 3209.3775891384694, 0.18577770618460315)
CODY_B = (23.601290952344122, 244.02463793444417, 1282.6165260773723, 2844.236833439171)
CODY_C = (
    0.5641884969886701, 8.883149794388377, 66.11919063714163, 298.6351381974001, 881.952221241769,
    1712.0476126340707, 2051.0783778260716, 1230.3393547979972, 2.1531153547440383e-08,
)
CODY_D = (
    15.744926110709835, 117.6939508913125, 537.1811018620099, 1621.3895745666903, 3290.7992357334597,
    4362.619090143247, 3439.3676741437216, 1230.3393548037495,
)
CODY_P = (
    0.30532663496123236, 0.36034489994980445, 0.12578172611122926, 0.016083785148742275,
    0.0006587491615298378, 0.016315387137302097,
)
CODY_Q = (2.568520192289822, 1.8729528499234673, 0.5279051029514285, 0.06051834131244132, 0.0023352049762686918)
NEAR, FAR = 0.46875, 4.0


def _ratio(leading: float, numer: tuple[float, ...], denom: tuple[float, ...], x: Column) -> Column:
    """Horner form of the numerator over the monic denominator of equal degree."""
    top, bottom = F.lit(leading) * x, x
    for n, d in zip(numer[:-1], denom[:-1], strict=True):
        top, bottom = (top + F.lit(n)) * x, (bottom + F.lit(d)) * x
    return (top + F.lit(numer[-1])) / (bottom + F.lit(denom[-1]))


def _log_erfc(u: Column) -> Column:
    """ln erfc(u) from a non-null u >= 0.

    The far range is written in powers of u^2 instead of 1 / u^2 (numerator and
    denominator multiplied through), so that u is all the expression refers to.
    """
    square = u * u
    near = 1.0 - u * _ratio(CODY_A[4], CODY_A[:4], CODY_B, square)
    middle = _ratio(CODY_C[8], CODY_C[:8], CODY_D, u)
    top, bottom = F.lit(CODY_P[4]), F.lit(CODY_Q[4])
    for p, q in zip((*CODY_P[3::-1], CODY_P[5]), (*CODY_Q[3::-1], 1.0), strict=True):
        top, bottom = top * square + F.lit(p), bottom * square + F.lit(q)
    far = (F.lit(1.0 / math.sqrt(math.pi)) - top / (bottom * square)) / u
    return (
        F.when(u <= NEAR, F.ln(near)).when(u <= FAR, F.ln(middle) - square).otherwise(F.ln(far) - square)
    )


def tail_argument(z: Column) -> Column:
    """|z| / sqrt 2, never null."""
    return F.coalesce(F.abs(z) * math.sqrt(0.5), F.lit(0.0))


def log_erfc(t: Column) -> Column:
    """ln erfc(t) for t >= 0; null for null."""
    return F.when(t.isNotNull(), _log_erfc(F.coalesce(t, F.lit(0.0))))


def erfc(t: Column) -> Column:
    """Complementary error function for t >= 0, through its logarithm."""
    return F.exp(log_erfc(t))


def log_two_sided_p(z: Column) -> Column:
    """ln of 2 * P(X > |z|) for a standard normal X."""
    return log_erfc(F.abs(z) * math.sqrt(0.5))


def log_tail_of(argument: str, z: str) -> Column:
    """ln of the two-sided P of column ``z`` from its stored ``tail_argument``.

    With the argument in a column of its own the row's generated code holds it
    once instead of once per polynomial term.
    """
    return F.when(F.col(z).isNotNull(), _log_erfc(F.col(argument)))


def with_log_tail(df: DataFrame, z: str, out: str) -> DataFrame:
    """Add ln of the two-sided P of column ``z``."""
    staged = df.withColumn("_TAIL_AT", tail_argument(F.col(z)))
    return staged.withColumn(out, log_tail_of("_TAIL_AT", z)).drop("_TAIL_AT")


def two_sided_p(z: Column) -> Column:
    """2 * P(X > |z|); zero once it underflows."""
    return F.exp(log_two_sided_p(z))


def neg_log10_two_sided_p(z: Column) -> Column:
    """-log10 of the two-sided P, finite where P itself underflows."""
    return log_two_sided_p(z) * (-1.0 / math.log(10.0))


def chi_square_tail(q: Column, df: Column, max_df: int) -> Column:
    """P(X > q) for integer degrees of freedom 1..max_df; null outside.

    Exact recurrence Q(a + 1, x) = Q(a, x) + x^a e^-x / Gamma(a + 1), started
    from erfc(sqrt x) for odd and e^-x for even degrees of freedom.
    """
    x = q * 0.5
    odd = F.pmod(df.cast("int"), F.lit(2)) == 1
    tail = F.when(odd, erfc(F.sqrt(x))).otherwise(F.exp(-x))
    for k in range(3, max_df + 1):
        a = (k - 2) / 2.0
        term = F.pow(x, F.lit(a)) * F.exp(-x) * (1.0 / math.gamma(a + 1.0))
        tail = tail + F.when((df >= k) & (odd == F.lit(k % 2 == 1)), term).otherwise(0.0)
    return F.when((df >= 1) & (df <= max_df), tail)
