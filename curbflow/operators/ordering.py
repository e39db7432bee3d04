"""Order of delivered rows, checked as an ordered monoid.

Each file split is folded, in the order in which its task reads it, to a summary: rows, first, last and latest value, and
descents (rows earlier than the row before). Summaries of a file's splits are merged in the order of their offsets: descents
add up, and one more stands wherever a split begins earlier than the one before it ended. No row is shuffled or numbered.

Values are timestamps, dates or whole numbers. Nulls are counted and otherwise passed over; equal values are in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbflow.session import write_and_read

ORDERED_TYPES = ("timestamp_ntz", "timestamp", "date", "bigint", "int", "smallint", "tinyint")
_LEAST = np.iinfo(np.int64).min


def _placed(df: DataFrame, column: str, keep: tuple[str, ...] = ()) -> tuple[DataFrame, str]:
    """(value, file, offset, kept columns) of a file scan, and the type of the value."""
    kind = dict(df.dtypes)[column]
    if kind not in ORDERED_TYPES:
        raise TypeError(f"{column} is a {kind}; order is checked on {', '.join(ORDERED_TYPES)}")
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("offset")]
    return df.select(F.col(column).alias("value"), *place, *keep), kind


def _numbers(values: pa.Array) -> np.ndarray:
    whole = values.cast(pa.int32()) if pa.types.is_date32(values.type) else values
    return whole.cast(pa.int64()).to_numpy(zero_copy_only=False)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The batch cut where the file or the split changes."""
    if not batch.num_rows:
        return
    offsets = batch.column(2).to_numpy(zero_copy_only=False)
    files = batch.column(1).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    new = np.flatnonzero((offsets[1:] != offsets[:-1]) | (files[1:] != files[:-1])) + 1
    for start, end in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows]):
        yield (batch.column(1)[start].as_py(), int(offsets[start])), batch.slice(start, end - start)


def split_summaries(df: DataFrame, column: str) -> DataFrame:
    """(file, offset, row_count, null_count, first, last, latest, descents) of each split that has rows."""
    placed, kind = _placed(df, column)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list] = {}
        value_type = None
        for batch in batches:
            value_type = batch.schema.field(0).type
            for place, run in _runs(batch):
                s = found.setdefault(place, [0, 0, None, None, None, 0])
                v = _numbers(run.column(0).drop_null())
                s[0] += run.num_rows
                s[1] += run.column(0).null_count
                if len(v):
                    s[5] += int((v[1:] < v[:-1]).sum()) + int(s[3] is not None and v[0] < s[3])
                    s[2] = int(v[0]) if s[2] is None else s[2]
                    s[3] = int(v[-1])
                    s[4] = int(v.max()) if s[4] is None else max(s[4], int(v.max()))
        if not found:
            return
        number = pa.int32() if pa.types.is_date32(value_type) else pa.int64()
        as_value = lambda k: pa.array([s[k] for s in found.values()], number).cast(value_type)
        as_count = lambda k: pa.array([s[k] for s in found.values()], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in found]), pa.array([p[1] for p in found], pa.int64()), as_count(0), as_count(1),
             as_value(2), as_value(3), as_value(4), as_count(5)],
            names=["file", "offset", "row_count", "null_count", "first", "last", "latest", "descents"],
        )

    counts = "row_count bigint, null_count bigint"
    return placed.mapInArrow(
        fold, f"file string, offset bigint, {counts}, first {kind}, last {kind}, latest {kind}, descents bigint"
    )


def order_report(df: DataFrame, column: str) -> DataFrame:
    """Per file: row_count, null_count, first, last and latest value, descents, in_order (no descent).

    An empty file has no row; a file of nulls has null values and is in order."""
    before = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    merged = split_summaries(df, column).withColumn("ended", F.last("last", ignorenulls=True).over(before))
    seam = F.coalesce((F.col("first") < F.col("ended")).cast("bigint"), F.lit(0))
    by_offset = lambda c, pick: pick(c, F.when(F.col(c).isNotNull(), F.col("offset"))).alias(c)
    return (
        merged.groupBy("file")
        .agg(
            F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
            by_offset("first", F.min_by), by_offset("last", F.max_by), F.max("latest").alias("latest"),
            F.sum(F.col("descents") + seam).alias("descents"),
        )
        .withColumn("in_order", F.col("descents") == 0)
    )


def out_of_order_rows(df: DataFrame, column: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(file, offset, position, value, latest_before, kept columns) of the rows with a value below an earlier one of their
    file; position counts the rows of the split from 0. Rows with a null are never listed.

    Two scans: the latest value before each split comes from the summaries, the latest before a row inside its split from
    the task that reads it. A split of the second scan that the first did not have is an error, not a wrong answer."""
    before = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    floors = write_and_read(
        split_summaries(df, column).select("file", "offset", F.max("latest").over(before).alias("_floor")), "split-floors"
    )
    floors = floors.withColumn("_known", F.lit(True))
    placed, kind = _placed(df, column, keep)

    def track(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int], tuple[int, int]] = {}
        for batch in batches:
            value_type = batch.schema.field(0).type
            number = pa.int32() if pa.types.is_date32(value_type) else pa.int64()
            for place, run in _runs(batch):
                rows, latest = seen.get(place, (0, _LEAST))
                filled = _numbers(run.column(0).fill_null(pa.scalar(0, number).cast(value_type)))
                v = np.where(run.column(0).is_null().to_numpy(zero_copy_only=False), _LEAST, filled)
                running = np.maximum.accumulate(np.concatenate([[latest], v]))
                seen[place] = (rows + len(v), int(running[-1]))
                prior = pa.array(running[:-1], mask=running[:-1] == _LEAST).cast(number).cast(value_type)
                position = pa.array(np.arange(rows, rows + len(v)), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*run.columns, position, prior], names=[*run.schema.names, "position", "_inside"]
                )

    types = dict(df.dtypes)
    kept = "".join(f", `{c}` {types[c]}" for c in keep)
    rows = placed.mapInArrow(track, f"value {kind}, file string, offset bigint{kept}, position bigint, _inside {kind}")
    split = rows.join(floors, ["file", "offset"], "left")
    checked = F.when(F.col("_known"), F.greatest("_inside", "_floor")).otherwise(
        F.raise_error(F.lit("a split changed between two scans of the same files")).cast(kind)
    )
    return split.withColumn("latest_before", checked).where(F.col("value") < F.col("latest_before")).select(
        "file", "offset", "position", "value", "latest_before", *keep
    )
