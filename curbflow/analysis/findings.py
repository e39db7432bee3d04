"""Findings, sensitivity and benchmark analyses over the marts."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.functions.labels import first_match
from curbflow.functions.measures import (
    count_where, mean_where, percent, round_half_away, round_half_even, rows,
)
from curbflow.operators.quantiles import Quantile, exact_quantiles, with_quantiles
from curbflow.operators.shaping import rows_from_columns

# Candidate operating windows: name, first hour, hour after the last.
CANDIDATE_WINDOWS = (("14:00-18:00", 14, 18), ("15:00-19:00", 15, 19), ("16:00-20:00", 16, 20))


def in_hours(start: int, end: int, column: str = "hour_of_day") -> Column:
    return (F.col(column) >= start) & (F.col(column) < end)


def recommendation_sensitivity(summary: DataFrame, windows=CANDIDATE_WINDOWS) -> DataFrame:
    """Demand lift of each window over the hours outside it; one pass serves all windows."""
    demand, measures = F.col("taxi_trip_count"), {}
    for i, (_, start, end) in enumerate(windows):
        inside = in_hours(start, end)
        measures |= {
            f"hours_{i}": count_where(inside),
            f"inside_{i}": mean_where(inside, demand),
            f"outside_{i}": mean_where(~inside, demand),
            f"total_{i}": F.sum(F.when(inside, demand).otherwise(0)),
        }
    totals = summary.agg(*(agg.alias(name) for name, agg in measures.items()))
    return rows_from_columns(
        totals,
        [
            {
                "window_name": F.lit(name),
                "start_hour": F.lit(start),
                "end_hour": F.lit(end),
                "window_hours": F.col(f"hours_{i}"),
                "peak_window_avg_hourly_trips": F.col(f"inside_{i}"),
                "outside_window_avg_hourly_trips": F.col(f"outside_{i}"),
                "window_total_trips": F.col(f"total_{i}"),
                "demand_lift_pct": percent(
                    F.col(f"inside_{i}") - F.col(f"outside_{i}"), F.col(f"outside_{i}")
                ),
            }
            for i, (name, start, end) in enumerate(windows)
        ],
    ).orderBy("start_hour")


def anomaly_kpi_impact(metrics: DataFrame) -> DataFrame:
    """KPIs of all trips beside trips valid on all four metrics; one pass, two filtered sets."""
    amount = F.col("total_amount")
    valid = F.lit(True)
    for m in ("duration", "distance", "revenue", "passenger"):
        valid = valid & F.coalesce(F.col(f"is_{m}_valid"), F.lit(False))
    totals = metrics.agg(
        rows().alias("all_n"), F.coalesce(F.sum(amount), F.lit(0.0)).alias("all_sum"), F.avg(amount).alias("all_avg"),
        count_where(valid).alias("ok_n"),
        F.coalesce(F.sum(F.when(valid, amount)), F.lit(0.0)).alias("ok_sum"),
        mean_where(valid, amount).alias("ok_avg"),
    )
    return rows_from_columns(
        totals,
        [
            {
                "population": F.lit(label),
                "total_trips": F.col(f"{p}_n"),
                "total_revenue": F.col(f"{p}_sum"),
                "avg_amount_per_trip": F.col(f"{p}_avg"),
                "trip_retention_pct": percent(F.col(f"{p}_n"), F.col("all_n")),
                "revenue_retention_pct": percent(F.col(f"{p}_sum"), F.col("all_sum")),
            }
            for p, label in (("all", "All trips"), ("ok", "Quality-valid trips"))
        ],
    )


def weekday_weekend(summary: DataFrame) -> DataFrame:
    return (
        summary.groupBy("is_weekend")
        .agg(
            rows().alias("hours"),
            round_half_away(F.avg("taxi_trip_count"), 2).alias("avg_taxi_trips"),
            F.median("taxi_trip_count").alias("median_taxi_trips"),
            round_half_away(F.avg("subway_ridership"), 2).alias("avg_subway_ridership"),
        )
        .orderBy("is_weekend")
        .select(F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("day_type"),
                "hours", "avg_taxi_trips", "median_taxi_trips", "avg_subway_ridership")
    )


# Display order of the rain intensities. A missing amount falls into the last one.
RAIN_ORDER = ("Dry", "Light rain", "Moderate rain", "Heavy rain")


def weather_impact(summary: DataFrame) -> DataFrame:
    amount = F.col("precipitation")
    intensity = first_match(
        [(amount == 0, RAIN_ORDER[0]), (amount <= 1, RAIN_ORDER[1]), (amount <= 5, RAIN_ORDER[2])], RAIN_ORDER[3]
    )
    rank = first_match([(F.col("precipitation_category") == r, i) for i, r in enumerate(RAIN_ORDER)])
    return (
        summary.groupBy(intensity.alias("precipitation_category"))
        .agg(
            rows().alias("hours"),
            round_half_away(F.avg("taxi_trip_count"), 2).alias("avg_taxi_trips"),
            F.median("taxi_trip_count").alias("median_taxi_trips"),
        )
        .orderBy(rank)
    )


def top_pickup_zones(demand: DataFrame, zones: DataFrame, k: int = 20) -> DataFrame:
    """Demand collapses to zones before names are joined; the id breaks ties."""
    per_zone = demand.groupBy("pickup_location_id").agg(F.sum("trip_count").alias("trips"))
    names = zones.select(
        F.col("location_id").alias("pickup_location_id"),
        F.col("zone").alias("pickup_zone"),
        F.col("borough").alias("pickup_borough"),
    )
    return (
        per_zone.join(names, "pickup_location_id", "left")
        .select("pickup_location_id", "pickup_zone", "pickup_borough", "trips")
        .orderBy(F.desc("trips"), "pickup_location_id")
        .limit(k)
    )


def top_od_pairs(demand: DataFrame, zones: DataFrame, k: int = 20) -> DataFrame:
    """Pairs by zone name, as several ids may share a name."""
    per_pair = demand.groupBy("pickup_location_id", "dropoff_location_id").agg(F.sum("trip_count").alias("n"))

    def names(side: str) -> DataFrame:
        return zones.select(
            F.col("location_id").alias(f"{side}_location_id"), F.col("zone").alias(f"{side}_zone")
        )

    return (
        per_pair.join(names("pickup"), "pickup_location_id", "left")
        .join(names("dropoff"), "dropoff_location_id", "left")
        .groupBy("pickup_zone", "dropoff_zone")
        .agg(F.sum("n").alias("trips"))
        .orderBy(F.desc("trips"), "pickup_zone", "dropoff_zone")
        .limit(k)
    )


def hourly_pattern(summary: DataFrame) -> DataFrame:
    """Profile by hour of day, rounded half to even."""
    return (
        summary.groupBy("hour_of_day")
        .agg(
            rows().alias("observations"),
            round_half_even(F.avg("taxi_trip_count"), 2).alias("avg_taxi_trips"),
            round_half_even(F.median("taxi_trip_count"), 2).alias("median_taxi_trips"),
        )
        .orderBy("hour_of_day")
    )


def peak_and_trough(pattern: DataFrame) -> DataFrame:
    """Busiest and quietest hour of a profile; the earlier hour wins a tie."""
    earlier = -F.col("hour_of_day")
    best = F.max_by(F.struct("hour_of_day", "avg_taxi_trips"), F.struct("avg_taxi_trips", earlier))
    worst = F.min_by(F.struct("hour_of_day", "avg_taxi_trips"), F.struct("avg_taxi_trips", "hour_of_day"))
    return pattern.agg(best.alias("peak"), worst.alias("trough")).select(
        F.col("peak.hour_of_day").alias("peak_hour"),
        F.col("peak.avg_taxi_trips").alias("peak_avg_trips"),
        F.col("trough.hour_of_day").alias("trough_hour"),
        F.col("trough.avg_taxi_trips").alias("trough_avg_trips"),
    )


def weather_conditions(summary: DataFrame) -> DataFrame:
    """Any precipitation outranks rain, which outranks dry."""
    condition = first_match(
        [(F.col("precipitation") > 0, "precipitation"), (F.col("rain") > 0, "rain")], "dry"
    )
    return (
        summary.groupBy(condition.alias("weather_condition"))
        .agg(
            rows().alias("hours"),
            round_half_even(F.avg("taxi_trip_count"), 2).alias("avg_taxi_trips"),
            round_half_even(F.median("taxi_trip_count"), 2).alias("median_taxi_trips"),
            round_half_even(F.avg("precipitation"), 3).alias("avg_precipitation"),
        )
        .orderBy("weather_condition")
    )


def demand_distribution(summary: DataFrame, column: str = "taxi_trip_count") -> DataFrame:
    """Count, moments, quartiles, sample skewness and coefficient of variation."""
    x, n = F.col(column).cast("double"), F.count(column)
    # Population skewness times this factor is the sample-adjusted one.
    adjust = F.sqrt(n * (n - 1)) / (n - 2)
    return summary.agg(
        n.alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
        *(F.percentile(x, q).alias(f"p{int(q * 100)}") for q in (0.25, 0.5, 0.75)),
        F.max(x).alias("max"),
        F.when(n > 2, F.skewness(x) * adjust).alias("skewness"),
        (F.stddev_samp(x) / F.nullif(F.avg(x), F.lit(0.0))).alias("coefficient_of_variation"),
    )


def payment_analysis_raw(metrics: DataFrame) -> DataFrame:
    """Trip-level payment analysis (raw codes), the costly counterpart of reading the mart."""
    grouped = metrics.groupBy("payment_type").agg(
        rows().alias("trips"),
        F.sum("total_amount").alias("total_amount"),
        F.avg("total_amount").alias("avg_amount"),
        F.avg("tip_percentage").alias("avg_tip_percentage"),
    )
    medians = exact_quantiles(metrics, ["payment_type"], [Quantile("median_amount", F.col("total_amount"))])
    return with_quantiles(grouped, "payment_type", medians)


def geographic_analysis_raw(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy(F.col("pickup_location_id").alias("location_id")).agg(
        rows().alias("pickup_trips"),
        F.sum("total_amount").alias("pickup_revenue"),
        F.avg("trip_distance").alias("avg_pickup_distance"),
        F.avg("trip_duration_minutes").alias("avg_pickup_duration_minutes"),
    )


def sample_size(
    df: DataFrame, by: str, metric: str, mde_share: float, alpha: float = 0.05, power: float = 0.80
) -> DataFrame:
    """Units per arm of a two-sided comparison, from each group's baseline mean and deviation.

    The minimum detectable effect is a share of the baseline mean.
    """
    z = NormalDist()
    factor = 2.0 * (z.inv_cdf(1 - alpha / 2) + z.inv_cdf(power)) ** 2
    mean, sd = F.col("baseline_mean"), F.col("baseline_sd")
    effect = F.lit(mde_share) * mean
    return (
        df.groupBy(by)
        .agg(rows().alias("observations"), F.avg(metric).alias("baseline_mean"),
             F.stddev_samp(metric).alias("baseline_sd"))
        .withColumn("effect", effect)
        .withColumn(
            "units_per_arm",
            F.when(F.col("effect") != 0, F.ceil(F.lit(factor) * sd * sd / (F.col("effect") * F.col("effect")))),
        )
    )

