"""Row/column reshaping of small aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_struct(one_row: DataFrame) -> Column:
    """A one-row frame as a scalar-subquery struct: no join, and Spark checks the row count."""
    return one_row.select(F.struct("*").alias("row")).scalar()


def side_by_side(*one_row_frames: DataFrame) -> DataFrame:
    """Columns of several one-row frames as one row.

    The frames are stacked and folded by MAX, which skips the NULLs that fill absent columns: each
    part runs once, in parallel, without joins.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row_frames)
    return stacked.agg(*(F.max(c).alias(c) for c in stacked.columns))


def rows_from_columns(one_row: DataFrame, records: list[dict[str, Column]]) -> DataFrame:
    """One output row per record, each built from the columns of a single-row aggregate."""
    structs = [F.struct(*(v.alias(k) for k, v in record.items())) for record in records]
    return one_row.select(F.inline(F.array(*structs)))
