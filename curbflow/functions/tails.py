"""Tail probabilities as column expressions, by continued fractions and series of a bounded number of terms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Terms of a fraction or series, enough for full precision up to many thousand degrees of freedom.
TERMS = 400
_SHIFT = 8


def log_gamma(x: Column) -> Column:
    """Stirling's series at x + 8, brought back by the recurrence. For x > 0."""
    z = x + _SHIFT
    product = x
    for k in range(1, _SHIFT):
        product = product * (x + k)
    series = 1 / (12 * z) - 1 / (360 * F.pow(z, 3)) + 1 / (1260 * F.pow(z, 5)) - 1 / (1680 * F.pow(z, 7))
    return (z - 0.5) * F.log(z) - z + 0.5 * F.log(2 * F.pi()) + series - F.log(product)


def _from_the_last_term(step, first: Column) -> Column:
    """A continued fraction from its innermost term outwards: step(k, value so far) for k from TERMS to 1."""
    count = F.sequence(F.lit(TERMS), F.lit(1), F.lit(-1))
    return F.aggregate(count, first.cast("double"), lambda value, k: step(k.cast("double"), value))


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    def step(k: Column, value: Column) -> Column:
        m = F.floor(k / 2)
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        return 1 + F.when(k % 2 == 1, odd).otherwise(even) / value

    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(1 - x))
    return front / (a * _from_the_last_term(step, F.lit(1.0)))


def incomplete_beta(a: Column, b: Column, x: Column) -> Column:
    """The regularised incomplete beta function."""
    far = x > (a + 1) / (a + b + 2)
    return (
        F.when(x <= 0, 0.0).when(x >= 1, 1.0)
        .when(far, 1 - _beta_fraction(b, a, 1 - x)).otherwise(_beta_fraction(a, b, x))
    )


def upper_gamma(s: Column, x: Column) -> Column:
    """The regularised upper incomplete gamma function."""
    front = F.exp(s * F.log(x) - x - log_gamma(s))

    def grow(acc: Column, k: Column) -> Column:
        term = acc["term"] * x / (s + k)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    start = F.struct((1 / s).alias("term"), (1 / s).alias("total"))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, grow, lambda acc: acc["total"])
    fraction = _from_the_last_term(lambda k, value: x + 2 * k - 1 - s - k * (k - s) / value, x + 2 * TERMS + 1 - s)
    return F.when(x <= 0, 1.0).when(x < s + 1, 1 - front * series).otherwise(front / fraction)


def _unless_nan(value: Column, tail: Column) -> Column:
    return F.when(F.isnan(value), F.lit(float("nan"))).otherwise(tail)


def t_two_sided(t: Column, df: Column) -> Column:
    """P(|T| > |t|) of Student's t."""
    return _unless_nan(t, incomplete_beta(df / 2, F.lit(0.5), df / (df + t * t)))


def f_tail(f: Column, df1: Column, df2: Column) -> Column:
    """P(F > f)."""
    return _unless_nan(f, incomplete_beta(df2 / 2, df1 / 2, df2 / (df2 + df1 * f)))


def chi_square_tail(x: Column, df: Column) -> Column:
    """P(X > x) of a chi-square variable."""
    return _unless_nan(x, upper_gamma(df / 2, x / 2))


def normal_two_sided(z: Column) -> Column:
    """P(|Z| > |z|), as z squared is chi-square with one degree of freedom."""
    return chi_square_tail(z * z, F.lit(1.0))
