"""Aggregate expressions shared by the marts. All are partially aggregated before a shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rows() -> Column:
    return F.count(F.lit(1))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def sum_where(condition: Column, value: Column) -> Column:
    """Sum over matching rows; NULL when none match."""
    return F.sum(F.when(condition, value))


def sum_where_or_zero(condition: Column, value: Column) -> Column:
    """Sum over matching rows, other rows adding zero."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def mean_where(condition: Column, value: Column) -> Column:
    return F.avg(F.when(condition, value))


def mean_of_known(condition: Column, value: Column) -> Column:
    """Mean over matching rows none of which lacks the value. Unlike `mean_where` it needs no buffers of its own beside
    `sum_where` and `count_where` of the same arguments."""
    return ratio(sum_where(condition, value), count_where(condition))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, NULL for a zero or missing denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    return ratio(F.lit(100.0) * part.cast("double"), whole)


def ratio_if_positive(numerator: Column, denominator: Column) -> Column:
    d = denominator.cast("double")
    return F.when(d > 0, numerator.cast("double") / d)


def round_half_away(value: Column, digits: int) -> Column:
    """Round the scaled binary value, ties away from zero.

    Spark's `round` works on the decimal text of a double and so lifts values such as 57.185,
    whose binary form lies below the tie.
    """
    scale = F.lit(10.0**digits)
    return F.signum(value) * F.floor(F.abs(value) * scale + F.lit(0.5)) / scale


def round_half_even(value: Column, digits: int) -> Column:
    """Round the scaled binary value, ties to even."""
    scale = F.lit(10.0**digits)
    return F.rint(value * scale) / scale
