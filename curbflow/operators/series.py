"""Ordered series without a task that sees all of it: numbers from counts per block, lags over blocks with a halo."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbflow.functions import clock

#: Span of time of a block in which rows are numbered; an hourly series has at most so many rows in one.
BLOCK_HOURS = 1024
#: Rows of a block in which lags are looked up, unless the lags reach further.
BLOCK_ROWS = 1024


def numbered(series: DataFrame, order: str, name: str = "_i", hours: int = BLOCK_HOURS) -> DataFrame:
    """The series with each row's number (from 0) in the order of a wall-clock time, or of a number that counts its hours;
    a missing one comes first.

    Rows are numbered within blocks of time; what a block has to add is the sum of the counts of the blocks before it,
    found over one row per block. Rows with equal times are numbered in no particular order.
    """
    timed = dict(series.dtypes)[order].startswith("timestamp")
    hour = clock.epoch_seconds(F.col(order)) / 3600 if timed else F.col(order)
    block = F.coalesce(F.floor(hour / F.lit(hours)).cast("long"), F.lit(-(1 << 40)))
    placed = series.withColumn("_span", block)
    counts = series.select(block.alias("_of")).groupBy("_of").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_of", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_span").orderBy(order)) - 1
    joined = placed.withColumn("_within", within).join(starts, F.col("_span") == F.col("_of"))
    return joined.select(*series.columns, (F.col("_start") + F.col("_within")).alias(name))


def with_halo(rows: DataFrame, reach: int, number: str = "_i") -> DataFrame:
    """Numbered rows dealt into blocks (`_block`), each with a copy of the `reach` rows before it. `_own` marks the rows
    that are a block's own; every row is so exactly once."""
    size = max(4 * reach, BLOCK_ROWS)
    owner, follower = F.floor(F.col(number) / size), F.floor((F.col(number) + reach) / size)
    copies = rows.withColumn("_block", F.explode(F.array_distinct(F.array(owner, follower))))
    return copies.withColumn("_own", owner == F.col("_block"))


def with_lags(series: DataFrame, order: str, lags: dict[str, tuple[str | Column, int]]) -> DataFrame:
    """The series with columns name -> (column, k): its value k rows earlier, null before the start.

    Row offsets, not time offsets. A block looks back into its halo, so no lag needs the series in one task."""
    reach = max(k for _, k in lags.values())
    in_block = Window.partitionBy("_block").orderBy("_i")
    shifted = {name: F.lag(column, k).over(in_block) for name, (column, k) in lags.items()}
    return with_halo(numbered(series, order), reach).withColumns(shifted).where("_own").drop("_i", "_block", "_own")
