"""Calendar arithmetic on wall-clock (NTZ) timestamps, independent of the session time zone.

`date_trunc`, `timestampdiff` and `unix_timestamp` cast NTZ input to the session zone first and
would shift hours around daylight-saving changes, so these helpers avoid them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def floor_hour(ts: Column) -> Column:
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ts))


def floor_week(ts: Column) -> Column:
    """Monday 00:00 of the week."""
    return F.trunc(F.to_date(ts), "week").cast("timestamp_ntz")


def floor_month(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "month").cast("timestamp_ntz")


def day_of_week(ts: Column) -> Column:
    """Sunday is 0."""
    return F.dayofweek(ts) - F.lit(1)


def is_weekend_day(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7)


def _interval_seconds(interval: Column) -> Column:
    # A single-field interval casts to an exact number; 18 digits keep the decimal in one long.
    return interval.cast("interval second").cast("decimal(18,6)")


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970-01-01 on the same wall clock, with microseconds."""
    return _interval_seconds(ts - F.expr(_EPOCH))


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Exact elapsed seconds, fraction kept."""
    return _interval_seconds(end - start).cast("double")


def second_boundaries(start: Column, end: Column) -> Column:
    """Number of whole-second boundaries crossed: both ends are cut to the second first."""
    first, last = (F.floor(epoch_seconds(t)).cast("bigint") for t in (start, end))
    return last - first
