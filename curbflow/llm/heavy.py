"""Frequent keys by Misra-Gries summaries, found in bounded memory and verified exactly."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that hold at least this share of the rows are frequent, so there are at most 1 / SHARE.
SHARE = 1 / 4096
#: Counters of a task's summary.
COUNTERS = round(4 / SHARE)


class MisraGries:
    """Counters of one stream. A key's true count exceeds its counter by `error` at most."""

    def __init__(self, counters: int):
        self.limit, self.counts, self.error, self.rows = counters, {}, 0, 0

    def add(self, values: pa.Array) -> None:
        self.rows += len(values)
        for pair in pc.value_counts(values).to_pylist():
            key = pair["values"]
            self.counts[key] = self.counts.get(key, 0) + pair["counts"]
            if len(self.counts) > 2 * self.limit:
                self._decrement()
        if len(self.counts) > self.limit:
            self._decrement()

    def _decrement(self) -> None:
        """Take the (limit + 1)-th largest counter from all and drop those that reach zero."""
        cut = sorted(self.counts.values(), reverse=True)[self.limit]
        self.counts = {k: n - cut for k, n in self.counts.items() if n > cut}
        self.error += cut

    def drop_rare(self, least: float) -> None:
        """Forget counters below `least`, which adds to the error what they may have held."""
        if least > 1:
            self.counts = {k: n for k, n in self.counts.items() if n >= least}
            self.error += int(least)


def frequent(keys: DataFrame, share: float = SHARE, counters: int = COUNTERS) -> DataFrame:
    """Keys (binary column `key`, no nulls) that may hold `share` of the rows, 4 / share of them at most.

    Every key that does hold the share is among them: a key's summed counters fall short of its count by the
    summed errors, which stay under three quarters of the share. An empty input gives no key.
    """

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = MisraGries(counters)
        for batch in batches:
            summary.add(batch.column(0))
        summary.drop_rare(summary.rows * share / 2)
        found = list(summary.counts.items())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _ in found] + [None], pa.binary()),
                pa.array([n for _, n in found] + [summary.rows], pa.int64()),
                pa.array([0] * len(found) + [summary.error], pa.int64()),
            ],
            names=["key", "seen", "error"],
        )

    parts = keys.select("key").mapInArrow(summarise, "key binary, seen long, error long")
    sums = parts.groupBy("key").agg(F.sum("seen").alias("seen"), F.sum("error").alias("error"))
    total = F.broadcast(sums.filter("key is null").select(F.col("seen").alias("rows"), F.col("error").alias("short")))
    least = F.greatest(F.col("rows") * share - F.col("short"), F.col("rows") * share / 4)
    return sums.filter("key is not null").join(total, F.col("seen") >= least).select("key")


def winners(rows: DataFrame, best: F.Column, share: float = SHARE, counters: int = COUNTERS) -> DataFrame:
    """(key, best, size) of every key that holds at least `share` of the rows: 1 / share of them at most.

    `rows` has the column `key`; `best` is an aggregate. Candidates of the summaries are counted exactly on the
    map side, so a candidate that falls short is dropped.
    """
    candidates = frequent(rows, share, counters)
    exact = (
        rows.join(F.broadcast(candidates), "key", "left_semi")
        .groupBy("key")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("size"))
    )
    total = F.broadcast(rows.agg((F.count(F.lit(1)) * share).alias("_least")))
    return exact.join(total, F.col("size") >= F.col("_least")).drop("_least")


def group_winners(rows: DataFrame, best: F.Column, heavy: DataFrame) -> DataFrame:
    """`rows` with best and size of each row's key. Frequent keys (`heavy`, at most 1 / share rows) are settled
    on the map side by a broadcast join; the others are aggregated and joined in an ordinary shuffle, in which
    no key exceeds the share."""
    rows_heavy = rows.join(F.broadcast(heavy), "key")
    rest = rows.join(F.broadcast(heavy.select("key")), "key", "left_anti")
    several = rest.groupBy("key").agg(best.alias("best"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    return rows_heavy.unionByName(rest.join(several, "key", "left"), allowMissingColumns=False)
