"""Metrics that are defined for the marts but not stored in them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbflow.analysis.findings import in_hours
from curbflow.functions import clock
from curbflow.functions.labels import canonical_payment
from curbflow.functions.measures import (
    count_where, percent, ratio_if_positive, rows, sum_where,
)
from curbflow.operators.quantiles import Quantile, exact_quantiles, with_quantiles

TAIL = {"p90": 0.90, "p95": 0.95, "p99": 0.99}


def metric_percentiles(metrics: DataFrame) -> DataFrame:
    """P90/P95/P99 of each metric over its own valid population."""
    populations = {
        "total_amount": F.when(F.col("is_revenue_valid"), F.col("total_amount")),
        "trip_distance": F.when(F.col("is_distance_valid"), F.col("trip_distance")),
        "trip_duration_minutes": F.col("trip_duration_minutes"),
    }
    return exact_quantiles(
        metrics, [],
        [Quantile(f"{m}_{p}", value, q) for m, value in populations.items() for p, q in TAIL.items()],
    )


def tip_percentiles(metrics: DataFrame) -> DataFrame:
    """Median and tail percentiles of the recorded tip by canonical payment type."""
    coded = metrics.where("is_revenue_valid").withColumn("code", canonical_payment(F.col("payment_type")))
    tip = F.col("tip_amount")
    return exact_quantiles(
        coded, ["code"],
        [Quantile(f"tip_{p}", tip, q) for p, q in {"p50": 0.5, **TAIL}.items()],
    ).withColumnRenamed("code", "payment_type")


def valid_medians(metrics: DataFrame) -> DataFrame:
    """Median distance of trips with a valid distance, median minutes of trips with a positive valid duration."""
    return exact_quantiles(
        metrics, [],
        [
            Quantile("median_valid_distance", F.when(F.col("is_distance_valid"), F.col("trip_distance"))),
            Quantile("median_valid_minutes", F.col("trip_duration_minutes")),
        ],
    )


def valid_payment_metrics(metrics: DataFrame) -> DataFrame:
    """Valid trips, their median fare and mean recorded tip by canonical payment type."""
    valid = metrics.where("is_revenue_valid").withColumn("code", canonical_payment(F.col("payment_type")))
    medians = exact_quantiles(
        valid, ["code"], [Quantile("median_valid_fare", F.col("fare_amount"))]
    )
    means = valid.groupBy("code").agg(rows().alias("valid_trips"), F.avg("tip_amount").alias("avg_valid_tip"))
    return with_quantiles(means, "code", medians).withColumnRenamed("code", "payment_type")


def top_hour_concentration(summary: DataFrame, n: int = 5) -> DataFrame:
    """Share of demand in the n busiest hours of day, for weekdays and weekends."""
    per_hour = summary.groupBy("is_weekend", "hour_of_day").agg(F.sum("taxi_trip_count").alias("trips"))
    busiest = Window.partitionBy("is_weekend").orderBy(F.desc("trips"), "hour_of_day")
    ranked = per_hour.withColumn("place", F.row_number().over(busiest))
    return ranked.groupBy("is_weekend").agg(
        F.sum("trips").alias("total_trips"),
        sum_where(F.col("place") <= n, F.col("trips")).alias("top_trips"),
        percent(sum_where(F.col("place") <= n, F.col("trips")), F.sum("trips")).alias("top_hour_share_pct"),
    )


def peak_window_share(summary: DataFrame, start: int, end: int) -> DataFrame:
    inside = sum_where(in_hours(start, end), F.col("taxi_trip_count"))
    return summary.agg(
        inside.alias("window_trips"), F.sum("taxi_trip_count").alias("total_trips"),
        percent(inside, F.sum("taxi_trip_count")).alias("window_share_pct"),
    )


def taxi_subway_correlation(summary: DataFrame) -> DataFrame:
    both = summary.where(F.col("subway_ridership").isNotNull())
    return both.agg(
        rows().alias("hours"),
        F.corr("taxi_trip_count", "subway_ridership").alias("raw_correlation"),
    )


def airport_peak_stability(metrics: DataFrame, start: int, end: int) -> DataFrame:
    """Share of days whose busiest airport hour lies in the window; the earlier hour wins a tie."""
    hour = F.hour("pickup_datetime")
    per_hour = (
        metrics.where("is_airport_trip")
        .groupBy("airport_trip_type", F.to_date("pickup_datetime").alias("day"), hour.alias("hour"))
        .agg(rows().alias("n"))
    )
    per_day = per_hour.groupBy("airport_trip_type", "day").agg(
        F.max_by("hour", F.struct("n", -F.col("hour"))).alias("peak_hour")
    )
    return per_day.groupBy("airport_trip_type").agg(
        rows().alias("days"),
        count_where(in_hours(start, end, "peak_hour")).alias("days_in_window"),
        percent(count_where(in_hours(start, end, "peak_hour")), rows()).alias("stability_pct"),
    )


def airport_revenue_per_trip(metrics: DataFrame) -> DataFrame:
    """Valid airport revenue per airport trip by direction and hour of day."""
    paid = F.col("is_revenue_valid")
    return (
        metrics.where("is_airport_trip")
        .groupBy("airport_trip_type", F.hour("pickup_datetime").alias("hour_of_day"))
        .agg(
            rows().alias("airport_trips"),
            sum_where(paid, F.col("total_amount")).alias("airport_revenue"),
            count_where(paid).alias("valid_trips"),
        )
        .withColumn("revenue_per_trip", ratio_if_positive(F.col("airport_revenue"), F.col("valid_trips")))
    )


def hour_volatility(summary: DataFrame) -> DataFrame:
    demand = F.col("taxi_trip_count")
    return (
        summary.groupBy("is_weekend", "hour_of_day")
        .agg(rows().alias("hours"), F.avg(demand).alias("avg_trips"), F.stddev_samp(demand).alias("hourly_sd"))
        .withColumn(
            "cv_pct", F.when(F.col("avg_trips") > 0, percent(F.col("hourly_sd"), F.col("avg_trips")))
        )
    )


def hourly_airport_trips(metrics: DataFrame) -> DataFrame:
    """Airport trips per direction and pickup hour: the baseline of the pilot's sample size."""
    return (
        metrics.where("is_airport_trip")
        .groupBy("airport_trip_type", clock.floor_hour(F.col("pickup_datetime")).alias("pickup_hour"))
        .agg(rows().alias("trips"))
    )
