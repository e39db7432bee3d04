"""Executive KPIs and the temporal demand mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbflow.functions.measures import count_where, percent, rows, sum_where_or_zero
from curbflow.operators.quantiles import Quantile, exact_quantiles
from curbflow.operators.shaping import side_by_side


def _trip_totals(metrics: DataFrame) -> DataFrame:
    """Sums and means ignore the validity flags here; only the ratios guard their denominators."""
    fare, total = F.col("fare_amount"), F.col("total_amount")
    miles, minutes = F.col("trip_distance"), F.col("trip_duration_minutes")

    def total_of(column):
        return F.sum(F.coalesce(column, F.lit(0)))

    totals = metrics.agg(
        rows().alias("total_trips"),
        total_of(F.col("passenger_count")).alias("total_passengers"),
        total_of(fare).alias("total_fare_amount"),
        total_of(total).alias("total_amount"),
        sum_where_or_zero(miles > 0, miles).alias("total_distance"),
        sum_where_or_zero(minutes > 0, minutes).alias("total_duration_minutes"),
        F.avg(F.when(miles > 0, fare / miles)).alias("avg_fare_per_mile"),
        F.avg(F.when(minutes > 0, total / minutes)).alias("avg_amount_per_minute"),
        F.avg(total).alias("avg_amount_per_trip"),
        F.avg(miles).alias("avg_distance_per_trip"),
        F.avg(minutes).alias("avg_duration_minutes"),
        F.avg("trip_speed_mph").alias("avg_speed_mph"),
        count_where(F.col("is_tipped")).alias("tipped_trips"),
        F.avg("tip_percentage").alias("avg_tip_percentage"),
        count_where(F.col("is_airport_trip")).alias("airport_trips"),
    )
    medians = exact_quantiles(
        metrics, [],
        [
            Quantile("median_amount_per_trip", total),
            Quantile("median_distance", miles),
            Quantile("median_duration_minutes", minutes),
        ],
    )
    return side_by_side(totals, medians)


def _hour_and_day_figures(summary: DataFrame) -> DataFrame:
    """One row from one pass over the hours: hourly and daily levels and the hour of day with the highest mean demand
    (the earlier hour wins a tie). Each hour carries its day's total and its hour of day's mean."""
    demand = F.col("taxi_trip_count")
    of_day, of_hour = Window.partitionBy("calendar_date"), Window.partitionBy("hour_of_day")
    marked = summary.select(
        "hour_of_day", demand,
        F.avg(demand).over(of_hour).alias("hour_mean"),
        F.when(F.row_number().over(of_day.orderBy("pickup_hour")) == 1, F.sum(demand).over(of_day)).alias("daily_trips"),
    )
    peak = F.max_by(F.struct("hour_of_day", "hour_mean"), F.struct("hour_mean", -F.col("hour_of_day")))
    return marked.agg(
        peak.alias("peak"),
        F.avg(demand).alias("avg_hourly_trips"), F.stddev_samp(demand).alias("hourly_demand_stddev"),
        F.avg("daily_trips").alias("avg_daily_trips"), F.stddev_samp("daily_trips").alias("daily_demand_stddev"),
    ).select(
        F.col("peak.hour_of_day").alias("peak_hour"), F.col("peak.hour_mean").alias("peak_hour_trips"),
        "avg_hourly_trips", "hourly_demand_stddev", "avg_daily_trips", "daily_demand_stddev",
    )


def executive_mobility(metrics: DataFrame, summary: DataFrame) -> DataFrame:
    """One row of KPIs. The one-row parts are folded together, not joined."""
    combined = side_by_side(_trip_totals(metrics), _hour_and_day_figures(summary))
    return combined.withColumns(
        {
            "airport_share_pct": percent(F.col("airport_trips"), F.col("total_trips")),
            "peak_hour_share_pct": percent(F.col("peak_hour_trips"), F.col("avg_daily_trips")),
            "hourly_demand_cv_pct": percent(F.col("hourly_demand_stddev"), F.col("avg_hourly_trips")),
            "daily_demand_cv_pct": percent(F.col("daily_demand_stddev"), F.col("avg_daily_trips")),
        }
    )


TEMPORAL_BASE = (
    "pickup_hour", "calendar_date", "hour_of_day", "day_of_week", "is_weekend", "week_start", "month_start",
    "taxi_trip_count", "taxi_revenue", "taxi_distance", "taxi_duration_seconds",
    "subway_ridership", "subway_transfers", "temperature_2m", "precipitation", "rain", "snowfall",
)


def temporal_demand(summary: DataFrame) -> DataFrame:
    """Each hour beside its hour-of-day and weekday profiles and the overall demand level.

    The windows see one row per hour of the period, so each hour carries its profiles without a second pass."""
    demand = F.col("taxi_trip_count")
    of_hour, of_day = Window.partitionBy("hour_of_day"), Window.partitionBy("day_of_week", "is_weekend")
    overall, mean = Window.partitionBy(), F.col("overall_avg_hourly_demand")
    # a NULL in the weekday pair matches no profile
    known_day = lambda value: F.when(F.col("day_of_week").isNotNull() & F.col("is_weekend").isNotNull(), value)
    known_hour = lambda value: F.when(F.col("hour_of_day").isNotNull(), value)
    return summary.select(
        *TEMPORAL_BASE,
        known_hour(F.avg(demand).over(of_hour)).alias("hour_avg_trips"),
        known_hour(F.median(demand).over(of_hour)).alias("hour_median_trips"),
        known_hour(F.stddev_samp(demand).over(of_hour)).alias("hour_stddev_trips"),
        known_hour(F.sum(demand).over(of_hour)).alias("hour_total_trips"),
        known_hour(rows().over(of_hour)).alias("hour_observations"),
        known_day(F.avg(demand).over(of_day)).alias("day_avg_trips"),
        known_day(F.sum(demand).over(of_day)).alias("day_total_trips"),
        known_day(rows().over(of_day)).alias("day_observations"),
        F.avg(demand).over(overall).alias("overall_avg_hourly_demand"),
        F.stddev_samp(demand).over(overall).alias("overall_stddev_hourly_demand"),
        F.max(demand).over(overall).alias("overall_max_hourly_demand"),
    ).withColumns(
        {
            "demand_index_pct": F.when(mean > 0, percent(demand, mean)),
            "overall_demand_cv_pct": F.when(mean > 0, percent(F.col("overall_stddev_hourly_demand"), mean)),
        }
    )
