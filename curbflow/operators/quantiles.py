"""Exact interpolated quantiles without gathering a large group's values in one task.

The built-in `median`/`percentile` merge one value->count map per group into a single task, so a
group holding a third of a large table can outgrow an executor. Here two scans share the work:

1. a mergeable sketch (KLL) of each group's values puts every wanted rank between two values;
2. a second scan counts what lies below and above that bracket and keeps only the values inside it,
   cut into a bounded number of equal parts. A running sum over the parts' exact counts finds the one
   or two that hold the ranks, and only their values are ranked.

The sketch decides how much is kept, never what the answer is: where the exact counts show that a rank
lies outside its bracket, the group goes to the built-in aggregate. So do the groups beyond the _GROUPS
largest, which have no bracket and hold less than 1 / _GROUPS of the rows each. What is broadcast has a
fixed bound: the brackets, and a bit filter of the groups to take again. Where there is none, the empty
filter ends that branch at run time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbflow.operators.bits import bit_filter, rows_with_bit
from curbflow.operators.shaping import as_struct

# Groups whose brackets are broadcast; a bracket is about a hundred bytes.
_GROUPS = 1024
# Size of a sketch, and the share of the values by which it may misplace a rank: twice the published
# error at 99 percent confidence. Both only steer how many values the second scan keeps.
_SKETCH = 2048
_ERROR = 2 * 2.296 / _SKETCH**0.9723
_BRACKET_PARTS = 4096
_FEW = 4096


@dataclass(frozen=True)
class Quantile:
    """Output column `name` holding the `probability` quantile of `value`."""

    name: str
    value: Column
    probability: float = 0.5


def _holding(buckets: DataFrame, bucket: list[str], order: str) -> DataFrame:
    """The buckets (count `_bn`, within `bucket`, sorted by `order`) that hold rank `_lo` or `_hi`, with `_start`, the
    number of values before them."""
    running = Window.partitionBy(*bucket).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = buckets.withColumn("_start", F.col("_before") + F.coalesce(F.sum("_bn").over(running), F.lit(0)))
    return placed.where((F.col("_start") <= F.col("_hi")) & (F.col("_start") + F.col("_bn") > F.col("_lo")))


def _matching(left: DataFrame, right: DataFrame, columns: list[str], small: bool, how: str = "inner") -> DataFrame:
    """Join on columns that may be NULL; `right` keeps only its other columns."""
    other = right.select(*(F.col(c).alias(f"_r{c}") if c in columns else F.col(c) for c in right.columns))
    test = F.lit(True)
    for c in columns:
        test = test & left[c].eqNullSafe(other[f"_r{c}"])
    return left.join(F.broadcast(other) if small else other, test, how).drop(*(f"_r{c}" for c in columns))


@dataclass(frozen=True)
class _Request:
    """Keys renamed to _k0.., each distinct value expression as _v0.., and the quantiles that use them."""

    keys: list[str]
    metric_of: list[int]
    probabilities: list[float]

    def position(self, total: Column, q: Column) -> Column:
        return F.element_at(F.array(*(F.lit(float(p)) for p in self.probabilities)), q + 1) * (total - 1)


def _renamed(df: DataFrame, by: list[str], wanted: list[Quantile]) -> tuple[DataFrame, _Request]:
    distinct: dict[str, int] = {}
    metric_of = [distinct.setdefault(str(q.value), len(distinct)) for q in wanted]
    value_of = {m: q.value for m, q in zip(metric_of, wanted)}
    keys = [f"_k{i}" for i in range(len(by))]
    rows = df.select(
        *(F.col(c).alias(k) for c, k in zip(by, keys)), *(v.cast("double").alias(f"_v{m}") for m, v in value_of.items())
    )
    return rows, _Request(keys, metric_of, [q.probability for q in wanted])


def _brackets(rows: DataFrame, request: _Request) -> DataFrame:
    """(keys, _lo, _hi) of the _GROUPS largest groups: per quantile two values between which it should lie."""
    metrics = range(max(request.metric_of) + 1)
    sketched = []
    for m in metrics:
        v = F.col(f"_v{m}")
        comparable = F.when(~F.isnan(v), v)
        sketched += [
            F.kll_sketch_agg_double(comparable, _SKETCH).alias(f"_s{m}"),
            F.count(comparable).alias(f"_c{m}"),
        ]
    groups = rows.groupBy(*request.keys).agg(F.count(F.lit(1)).alias("_rows"), *sketched)
    if request.keys:
        groups = groups.orderBy(F.desc("_rows"), *request.keys).limit(_GROUPS)

    def bound(q: int, side: int) -> Column:
        m, p = request.metric_of[q], request.probabilities[q]
        read = lambda rank: F.kll_sketch_get_quantile_double(f"_s{m}", F.lit(min(max(rank, 0.0), 1.0)))
        few = F.col(f"_c{m}") <= _FEW
        # ranks are steps of 1 / count, so few values keep the whole range and many leave room for a step
        return F.when(few & (F.col(f"_c{m}") > 0), read(0.5 + side)).when(~few, read(p + side * (_ERROR + 1 / _FEW)))

    numbers = range(len(request.metric_of))
    return groups.select(
        *request.keys,
        F.array(*(bound(q, -1) for q in numbers)).alias("_lo"), F.array(*(bound(q, 1) for q in numbers)).alias("_hi"),
    )


def _bracketed(rows: DataFrame, request: _Request, brackets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(keys, _q, _a, _z, _w): the values at the two ranks next to a quantile, null where the bracket misses them; and
    the keys of the groups with such a miss, as the exact counts tell."""
    if request.keys:
        placed = _matching(rows, brackets, request.keys, True, "left")
    else:
        placed = rows.select("*", as_struct(brackets).alias("_b")).select("*", "_b.*")

    def state(q: int) -> Column:
        v, lo, hi = F.col(f"_v{request.metric_of[q]}"), F.col("_lo")[q], F.col("_hi")[q]
        part = F.least(F.floor((v - lo) / (hi - lo) * _BRACKET_PARTS), F.lit(_BRACKET_PARTS - 1))
        part = F.when(hi > lo, part).otherwise(0).cast("int")
        # a small group, or one whose values are all NaN, has no bracket; its values count as above it
        side = F.when(v < lo, -1).when((v > hi) | hi.isNull(), _BRACKET_PARTS).otherwise(part)
        inside = (v >= lo) & (v <= hi)
        return F.struct(
            F.lit(q).alias("_q"), F.when(v.isNotNull(), side).alias("_part"), F.when(inside, v).alias("_v")
        )

    states = F.inline(F.array(*(state(q) for q in range(len(request.metric_of)))))
    within = [*request.keys, "_q"]
    counted = (
        placed.select(*request.keys, states).where(F.col("_part").isNotNull())
        .groupBy(*within, "_part", "_v").agg(F.count(F.lit(1)).alias("_bn"))
    )
    parts = counted.groupBy(*within, "_part").agg(F.sum("_bn").alias("_bn"))
    position = request.position(F.sum("_bn").over(Window.partitionBy(*within)), F.col("_q"))
    parts = parts.withColumn("_at", position).withColumns(
        {"_before": F.lit(0).cast("long"), "_lo": F.floor("_at"), "_hi": F.ceil("_at"), "_w": F.col("_at") - F.floor("_at")}
    )
    located = _holding(parts, within, "_part").select(*within, "_part", F.col("_start").alias("_before"), "_lo", "_hi", "_w")
    outside = (F.col("_part") < 0) | (F.col("_part") == _BRACKET_PARTS)
    # at most two parts of each quantile of at most _GROUPS groups
    held = _matching(counted, located.where(~outside), [*within, "_part"], True)
    found = _picked(_holding(held, [*within, "_before"], "_v"), within)
    return found, located.where(outside)


def _picked(ranked: DataFrame, within: list[str]) -> DataFrame:
    def value_at(rank: str) -> Column:
        here = (F.col("_start") <= F.col(rank)) & (F.col("_start") + F.col("_bn") > F.col(rank))
        return F.max(F.when(here, F.col("_v")))

    return ranked.groupBy(*within).agg(value_at("_lo").alias("_a"), value_at("_hi").alias("_z"), F.first("_w").alias("_w"))


def exact_quantiles(df: DataFrame, by: list[str], wanted: list[Quantile]) -> DataFrame:
    """One row per group of `by` (or one row in all) with one column per requested quantile.

    Interpolates linearly between the two nearest ranks; NaN is larger than all other values. Groups whose values are
    all NULL are absent, so callers join the result to their group list from the left. `group_bound` is the largest
    possible number of groups, where the caller can prove one: the branch for further groups is then left out.
    """
    rows, request = _renamed(df, by, wanted)
    keys = request.keys
    brackets = _brackets(rows, request)
    found, missed = _bracketed(rows, request, brackets)
    # other groups may share a bit: they get the same values twice
    again = rows_with_bit(rows, bit_filter(missed, keys), keys)
    a, z, numbered = F.col("_a"), F.col("_z"), list(enumerate(wanted))
    result = F.when(a == z, a).otherwise(a + (z - a) * F.col("_w"))
    exact = again.groupBy(*keys).agg(
        *(F.percentile(f"_v{request.metric_of[i]}", float(q.probability)).alias(q.name) for i, q in numbered)
    )
    # a quantile that both branches give has the same value in both
    both = found.select(*keys, *(F.when(F.col("_q") == i, result).alias(q.name) for i, q in numbered)).unionByName(exact)
    return both.groupBy(*(F.col(k).alias(c) for k, c in zip(keys, by))).agg(*(F.max(q.name).alias(q.name) for q in wanted))


def with_quantiles(grouped: DataFrame, by: str, quantiles: DataFrame) -> DataFrame:
    """Attach group quantiles to an aggregate on the same key (NULL keys match)."""
    other = quantiles.withColumnRenamed(by, f"_{by}")
    return grouped.join(other, F.col(by).eqNullSafe(F.col(f"_{by}")), "left").drop(f"_{by}")
