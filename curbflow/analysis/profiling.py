"""Profiles of the staged trips. Each job is one aggregation pass unless it returns records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbflow.config import Period
from curbflow.functions import clock
from curbflow.functions.labels import distance_bucket, first_match
from curbflow.functions.measures import count_where, mean_where, percent, round_half_away, rows, sum_where
from curbflow.operators.duplicates import duplicate_row_count
from curbflow.operators.shaping import rows_from_columns, side_by_side

DAY_SECONDS = 86_400


def _pickup() -> Column:
    return F.col("tpep_pickup_datetime")


def _dropoff() -> Column:
    return F.col("tpep_dropoff_datetime")


def _seconds() -> Column:
    return clock.second_boundaries(_pickup(), _dropoff())


def _named(**measures: Column) -> list[Column]:
    return [agg.alias(name) for name, agg in measures.items()]


def period_counts(raw: DataFrame, period: Period) -> DataFrame:
    """Rows inside and outside the half-open period, from unfiltered source rows."""
    start, end = (F.lit(t.isoformat(" ")).cast("timestamp_ntz") for t in (period.start, period.end))
    return raw.agg(
        *_named(
            total_source_rows=rows(),
            in_scope_rows=count_where((_pickup() >= start) & (_pickup() < end)),
            out_of_scope_rows=count_where((_pickup() < start) | (_pickup() >= end)),
        )
    )


def temporal_validity(trips: DataFrame) -> DataFrame:
    """Negative, zero and over-24-hour durations; negative and zero together cannot occur."""
    negative, zero = _dropoff() < _pickup(), _dropoff() == _pickup()
    return trips.agg(
        *_named(
            total_rows=rows(),
            negative_duration_rows=count_where(negative),
            zero_duration_rows=count_where(zero),
            duration_over_24h=count_where(_seconds() > DAY_SECONDS),
            impossible_overlap=count_where(negative & zero),
        )
    )


def distance_profile(trips: DataFrame) -> DataFrame:
    miles = F.col("trip_distance")
    return trips.agg(
        *_named(
            total_rows=rows(),
            total_distance=F.sum(miles),
            zero_distance=count_where(miles == 0),
            zero_distance_amount=sum_where(miles == 0, miles),
            negative_distance=count_where(miles < 0),
            distance_over_100_miles=count_where(miles > 100),
            over_100_mile_distance=sum_where(miles > 100, miles),
            distance_over_500_miles=count_where(miles > 500),
            over_500_mile_distance=sum_where(miles > 500, miles),
            max_distance=F.max(miles),
        )
    )


def fare_profile(trips: DataFrame) -> DataFrame:
    """Counts, values and extremes of fares and totals, and the weight of negative totals."""
    fare, total = F.col("fare_amount"), F.col("total_amount")
    return trips.agg(
        *_named(
            total_rows=rows(),
            gross_fare_amount=F.sum(fare),
            gross_total_amount=F.sum(total),
            negative_fare=count_where(fare < 0),
            negative_fare_value=sum_where(fare < 0, fare),
            zero_fare=count_where(fare == 0),
            zero_fare_total_value=sum_where(fare == 0, total),
            negative_total=count_where(total < 0),
            negative_total_value=sum_where(total < 0, total),
            zero_total=count_where(total == 0),
            min_fare=F.min(fare), max_fare=F.max(fare), min_total=F.min(total), max_total=F.max(total),
            negative_total_pct_of_gross=round_half_away(percent(F.abs(sum_where(total < 0, total)), F.sum(total)), 3),
        )
    )


def passenger_profile(trips: DataFrame) -> DataFrame:
    people, total = F.col("passenger_count"), F.col("total_amount")
    return trips.agg(
        *_named(
            total_rows=rows(),
            null_passengers=count_where(people.isNull()),
            zero_passengers=count_where(people == 0),
            negative_passengers=count_where(people < 0),
            passengers_over_6=count_where(people > 6),
            min_passengers=F.min(people), max_passengers=F.max(people),
            avg_non_null_passengers=F.avg(people),
            revenue_null_passenger=sum_where(people.isNull(), total),
            revenue_zero_passenger=sum_where(people == 0, total),
        )
    )


def category_mix(df: DataFrame, column: str) -> DataFrame:
    """Frequency table with the share of all rows; NULL is a category of its own.

    The total is summed over the already grouped categories.
    """
    counts = df.groupBy(column).agg(rows().alias("trip_count"))
    total = counts.agg(F.sum("trip_count")).scalar()
    return counts.withColumn("pct_of_trips", round_half_away(percent(F.col("trip_count"), total), 3)).orderBy(
        F.desc("trip_count"), column
    )


def zone_validity(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips whose pickup or dropoff id is not in the zone table.

    Trips first collapse to zone pairs, so the two lookups join pairs, not trips.
    """
    pairs = trips.groupBy("PULocationID", "DOLocationID").agg(rows().alias("n"))
    known = zones.select("location_id").distinct()
    pickup = known.select(F.col("location_id").alias("PULocationID"), F.lit(True).alias("pickup_known"))
    dropoff = known.select(F.col("location_id").alias("DOLocationID"), F.lit(True).alias("dropoff_known"))
    looked_up = pairs.join(pickup, "PULocationID", "left").join(dropoff, "DOLocationID", "left")

    def missing(flag: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col(flag).isNull(), F.col("n"))), F.lit(0))

    return looked_up.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        missing("pickup_known").alias("invalid_pickup_zone"),
        missing("dropoff_known").alias("invalid_dropoff_zone"),
    )


def unknown_overlap(trips: DataFrame) -> DataFrame:
    """How often a missing passenger count and the unknown payment code coincide."""
    people, code = F.col("passenger_count").isNull(), F.col("payment_type") == 0
    return trips.agg(
        *_named(
            null_passenger=count_where(people),
            payment_type_zero=count_where(code),
            both=count_where(people & code),
            total_amount_both=sum_where(people & code, F.col("total_amount")),
        )
    )


def exact_duplicates(trips: DataFrame) -> DataFrame:
    return duplicate_row_count(trips)


RECORD = (
    "tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance", "fare_amount", "total_amount",
    "passenger_count", "PULocationID", "DOLocationID", "payment_type", "VendorID",
)


def _extremes(df: DataFrame, order: list, k: int) -> DataFrame:
    """Top k by a measure, every record column breaking ties so that the choice is stable."""
    return df.orderBy(*order, *(c for c in df.columns)).limit(k)


def extreme_distance_records(trips: DataFrame, k: int = 20) -> DataFrame:
    far = trips.where(F.col("trip_distance") > 500).select(*RECORD)
    return _extremes(far, [F.desc("trip_distance")], k)


def negative_amount_records(trips: DataFrame, k: int = 20) -> DataFrame:
    negative = trips.where((F.col("fare_amount") < 0) | (F.col("total_amount") < 0)).select(*RECORD)
    return _extremes(negative, [F.col("total_amount")], k)


def invalid_time_records(trips: DataFrame, k: int = 30) -> DataFrame:
    timed = trips.select(
        "tpep_pickup_datetime", "tpep_dropoff_datetime", _seconds().alias("duration_seconds"),
        "trip_distance", "fare_amount", "total_amount", "passenger_count", "payment_type",
    )
    broken = timed.where(
        (_dropoff() < _pickup()) | (F.col("duration_seconds") > DAY_SECONDS)
    )
    return _extremes(broken, [F.col("duration_seconds")], k)


# Display order of the distance buckets.
BUCKET_ORDER = ("<=50 miles", "50-100 miles", "100-500 miles", ">500 miles")


def distance_by_unknowns(trips: DataFrame) -> DataFrame:
    people, code = F.col("passenger_count").isNull(), F.col("payment_type") == 0
    rank = first_match([(F.col("distance_bucket") == b, i) for i, b in enumerate(BUCKET_ORDER)])
    return (
        trips.groupBy(distance_bucket(F.col("trip_distance")).alias("distance_bucket"))
        .agg(
            *_named(
                trips=rows(),
                payment_unknown=count_where(code),
                passenger_unknown=count_where(people),
                both_unknown=count_where(people & code),
                avg_distance=round_half_away(F.avg("trip_distance"), 2),
                total_amount=round_half_away(F.sum("total_amount"), 2),
            )
        )
        .orderBy(rank)
    )


def anomaly_subset_profile(trips: DataFrame) -> DataFrame:
    """Profile of the zero-distance, over-24-hour and negative-duration subsets, one row each.

    The three subsets overlap, so one pass computes three sets of filtered aggregates instead of
    scanning the trips three times.
    """
    subsets = {
        "zero_distance": F.col("trip_distance") == 0,
        "over_24h": _seconds() > DAY_SECONDS,
        "negative_duration": _dropoff() < _pickup(),
    }
    conditions = {
        "payment_unknown": F.col("payment_type") == 0,
        "passenger_unknown": F.col("passenger_count").isNull(),
        "negative_fare": F.col("fare_amount") < 0,
        "negative_total": F.col("total_amount") < 0,
        "negative_duration": _dropoff() < _pickup(),
        "zero_duration": _dropoff() == _pickup(),
        "zero_distance": F.col("trip_distance") == 0,
        "over_100_mile": F.col("trip_distance") > 100,
    }
    measures = {}
    for name, inside in subsets.items():
        measures[f"{name}__trips"] = count_where(inside)
        measures |= {f"{name}__{c}": count_where(inside & cond) for c, cond in conditions.items()}
        measures |= {
            f"{name}__avg_fare": mean_where(inside, F.col("fare_amount")),
            f"{name}__avg_total": mean_where(inside, F.col("total_amount")),
            f"{name}__avg_distance": mean_where(inside, F.col("trip_distance")),
            f"{name}__total_amount": sum_where(inside, F.col("total_amount")),
        }
    totals = trips.agg(*_named(**measures))
    money = ("avg_fare", "avg_total", "avg_distance", "total_amount")
    return rows_from_columns(
        totals,
        [
            {
                "subset": F.lit(name),
                "trips": F.col(f"{name}__trips"),
                **{c: F.col(f"{name}__{c}") for c in conditions},
                **{c: round_half_away(F.col(f"{name}__{c}"), 2) for c in money},
            }
            for name in subsets
        ],
    )


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: type, NULLs, extremes, zeros and mean. One pass over all columns."""
    numeric = {c for c, t in df.dtypes if t in ("int", "bigint", "smallint", "double", "float")}
    measures = {"__rows": rows()}
    for c in df.columns:
        col = F.col(c)
        measures |= {
            f"{c}__null": count_where(col.isNull()),
            f"{c}__min": F.min(col).cast("string"),
            f"{c}__max": F.max(col).cast("string"),
        }
        if c in numeric:
            measures |= {f"{c}__zero": count_where(col == 0), f"{c}__mean": F.avg(col.cast("double"))}
    totals = df.agg(*_named(**measures))
    return rows_from_columns(
        totals,
        [
            {
                "column_name": F.lit(c),
                "data_type": F.lit(t),
                "row_count": F.col("__rows"),
                "null_count": F.col(f"{c}__null"),
                "min_value": F.col(f"{c}__min"),
                "max_value": F.col(f"{c}__max"),
                "zero_count": F.col(f"{c}__zero") if c in numeric else F.lit(None).cast("bigint"),
                "mean_value": F.col(f"{c}__mean") if c in numeric else F.lit(None).cast("double"),
            }
            for c, t in df.dtypes
        ],
    )


def duplicate_key_count(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key value, NULLs counting as one value."""
    return df.groupBy(key).agg(rows().alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_keys"),
    )


def timestamp_steps(series: DataFrame, column: str) -> DataFrame:
    """Histogram of the gaps between consecutive timestamps of a series.

    Distinct timestamps come first; each minute is one window partition, and a minute's first
    timestamp takes its predecessor from the per-minute maxima, so no task orders the whole series
    and a crowded day is spread over its minutes.
    """
    ts = F.col("ts")
    points = series.select(F.col(column).alias("ts")).where(ts.isNotNull())
    minute = F.floor(clock.epoch_seconds(ts) / 60).cast("bigint")
    repeats = points.groupBy("ts").agg((rows() - 1).alias("repeats"), minute.alias("minute"))
    per_minute = repeats.groupBy("minute").agg(F.max("ts").alias("last_ts"))
    carried = per_minute.select("minute", F.lag("last_ts").over(Window.orderBy("minute")).alias("carried_ts"))
    inside = Window.partitionBy("minute").orderBy("ts")
    stepped = repeats.join(carried, "minute").withColumn(
        "previous", F.coalesce(F.lag("ts").over(inside), F.col("carried_ts"))
    )
    gap = clock.elapsed_seconds(F.col("previous"), ts)
    steps = stepped.select(
        F.inline(
            F.array(
                F.struct(gap.alias("step_seconds"), F.lit(1).cast("bigint").alias("n")),
                F.struct(F.lit(0.0).alias("step_seconds"), F.col("repeats").alias("n")),
            )
        )
    ).where(F.col("step_seconds").isNotNull() & (F.col("n") > 0))
    return steps.groupBy("step_seconds").agg(F.sum("n").alias("occurrences")).orderBy(
        F.desc("occurrences"), "step_seconds"
    )


def monthly_counts(trips: DataFrame) -> DataFrame:
    return trips.groupBy(clock.floor_month(_pickup()).alias("pickup_month")).agg(rows().alias("row_count"))


def source_summary(trips: DataFrame) -> DataFrame:
    """Row count, time ranges, NULL counts, numeric ranges and zone coverage.

    Zone coverage counts distinct ids over zone pairs; as a distinct count beside the other
    measures it would multiply every trip row.
    """
    nulls = {
        "null_pickup": "tpep_pickup_datetime", "null_dropoff": "tpep_dropoff_datetime",
        "null_pickup_zone": "PULocationID", "null_dropoff_zone": "DOLocationID",
        "null_passenger_count": "passenger_count", "null_trip_distance": "trip_distance",
        "null_fare_amount": "fare_amount", "null_total_amount": "total_amount",
    }
    ranges = {
        "distance": "trip_distance", "fare": "fare_amount", "total_amount": "total_amount",
        "passengers": "passenger_count",
    }
    pairs = trips.select("PULocationID", "DOLocationID").distinct()
    coverage = pairs.agg(
        *_named(
            distinct_pickup_zones=F.count_distinct("PULocationID"),
            distinct_dropoff_zones=F.count_distinct("DOLocationID"),
        )
    )
    measures = trips.agg(
        *_named(
            total_rows=rows(),
            min_pickup=F.min(_pickup()), max_pickup=F.max(_pickup()),
            min_dropoff=F.min(_dropoff()), max_dropoff=F.max(_dropoff()),
            **{name: count_where(F.col(c).isNull()) for name, c in nulls.items()},
            **{
                f"{how}_{name}": fn(c)
                for name, c in ranges.items()
                for how, fn in (("min", F.min), ("max", F.max), ("avg", F.avg))
            },
        )
    )
    return side_by_side(measures, coverage)

