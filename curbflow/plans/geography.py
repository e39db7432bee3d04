"""Zone and route relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbflow.functions.measures import (
    count_where, mean_where, percent, ratio_if_positive, rows, sum_where_or_zero,
)


def od_flow(metrics: DataFrame) -> DataFrame:
    miles_ok = F.col("is_distance_valid") & (F.col("trip_distance") > 0)
    return metrics.groupBy("pickup_location_id", "dropoff_location_id").agg(
        rows().alias("trips"),
        sum_where_or_zero(F.col("is_positive_revenue_trip"), F.col("total_amount")).alias("total_revenue"),
        mean_where(miles_ok, F.col("trip_distance")).alias("avg_trip_distance"),
        F.avg("trip_duration_minutes").alias("avg_trip_duration_minutes"),
        mean_where(F.col("is_revenue_valid"), F.col("total_amount")).alias("avg_total_amount"),
        F.avg("fare_per_mile").alias("avg_fare_per_mile"),
        count_where(F.col("is_airport_trip")).alias("airport_trips"),
        count_where(F.col("is_tipped")).alias("tipped_trips"),
    )


def zone_performance(metrics: DataFrame, zones: DataFrame) -> DataFrame:
    """Both ends of every trip from one scan.

    Trips first collapse to zone pairs in the map-side aggregation (a bounded number of rows,
    whatever the trip volume); each pair then contributes a pickup and a dropoff row, which
    replaces two trip scans and a full outer join. Trips without a zone stay apart by end, as the
    outer join would keep them.
    """
    miles_ok = F.col("is_distance_valid") & (F.col("trip_distance") > 0)
    minutes, miles, per_mile = (F.col(c) for c in ("trip_duration_minutes", "trip_distance", "fare_per_mile"))
    pairs = metrics.groupBy("pickup_location_id", "dropoff_location_id").agg(
        rows().alias("n"),
        sum_where_or_zero(F.col("is_positive_revenue_trip"), F.col("total_amount")).alias("revenue"),
        F.sum(minutes).alias("minutes"), F.count(minutes).alias("minutes_n"),
        F.sum(F.when(miles_ok, miles)).alias("miles"), F.count(F.when(miles_ok, miles)).alias("miles_n"),
        F.sum(per_mile).alias("per_mile"), F.count(per_mile).alias("per_mile_n"),
        count_where(F.col("is_airport_pickup")).alias("from_airport"),
        count_where(F.col("is_airport_dropoff")).alias("to_airport"),
    )
    ends = pairs.select(
        "*",
        F.inline(
            F.array(
                F.struct(F.col("pickup_location_id").alias("location_id"), F.lit(True).alias("at_pickup")),
                F.struct(F.col("dropoff_location_id").alias("location_id"), F.lit(False).alias("at_pickup")),
            )
        ),
    )
    pickup, dropoff = F.col("at_pickup"), ~F.col("at_pickup")
    nowhere = F.when(F.col("location_id").isNull(), F.col("at_pickup"))

    def total(side, column):
        return F.sum(F.when(side, F.col(column)))

    def count(side, column):
        return F.coalesce(total(side, column), F.lit(0))

    def money(side, column):
        return F.coalesce(total(side, column), F.lit(0.0))

    def mean(column):
        return ratio_if_positive(total(pickup, column), total(pickup, f"{column}_n"))

    combined = (
        ends.groupBy("location_id", nowhere.alias("end_without_zone"))
        .agg(
            count(pickup, "n").alias("pickup_trips"),
            count(dropoff, "n").alias("dropoff_trips"),
            money(pickup, "revenue").alias("pickup_revenue"),
            money(dropoff, "revenue").alias("dropoff_revenue"),
            mean("minutes").alias("avg_pickup_duration_minutes"),
            mean("miles").alias("avg_pickup_distance"),
            mean("per_mile").alias("avg_fare_per_mile"),
            count(pickup, "from_airport").alias("airport_pickup_trips"),
            count(dropoff, "to_airport").alias("airport_dropoff_trips"),
        )
        .drop("end_without_zone")
    )
    activity = F.col("pickup_trips") + F.col("dropoff_trips")
    revenue = F.col("pickup_revenue") + F.col("dropoff_revenue")
    named = combined.join(zones.select("location_id", "zone", "service_zone"), "location_id", "left")
    return named.withColumns(
        {
            "total_zone_activity": activity,
            "total_zone_revenue": revenue,
            "revenue_per_zone_activity": ratio_if_positive(revenue, activity),
            "airport_pickup_share": ratio_if_positive(F.col("airport_pickup_trips"), F.col("pickup_trips")),
            "airport_dropoff_share": ratio_if_positive(F.col("airport_dropoff_trips"), F.col("dropoff_trips")),
        }
    )


def geographic_performance(zone_perf: DataFrame) -> DataFrame:
    """Ranks and market shares per zone.

    The ranks and totals look at all zones, so these windows run in one task; their input is one row
    per zone (the zone table's size), never trips, and is computed once.
    """
    market = Window.partitionBy()
    activity, revenue = F.col("total_zone_activity"), F.col("total_zone_revenue")
    by_activity, by_revenue = Window.orderBy(activity.desc()), Window.orderBy(revenue.desc())
    below = activity < F.col("median_activity")
    return (
        zone_perf.withColumns(
            {
                "activity_rank": F.rank().over(by_activity),
                "revenue_rank": F.rank().over(by_revenue),
                "activity_percentile": F.percent_rank().over(Window.orderBy(activity)),
                "market_activity": F.sum(activity).over(market),
                "market_revenue": F.sum(revenue).over(market),
                "median_activity": F.median(activity).over(market),
            }
        )
        .withColumns(
            {
                "zone_activity_contribution_pct": percent(activity, F.col("market_activity")),
                "zone_revenue_contribution_pct": percent(revenue, F.col("market_revenue")),
                "below_median_activity_indicator": F.coalesce(below & (activity > 0), F.lit(False)),
                "activity_segment": F.when(below, "Below Median Activity").otherwise("At/Above Median Activity"),
            }
        )
        .drop("market_activity", "market_revenue", "median_activity")
    )
