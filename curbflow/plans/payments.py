"""Fare, payment and airport relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbflow.config import DEFAULT, MobilityConfig
from curbflow.functions.labels import airport_category, canonical_payment, payment_label
from curbflow.functions.measures import (
    count_where, mean_where, percent, ratio_if_positive, rows, sum_where, sum_where_or_zero,
)
from curbflow.operators.quantiles import Quantile, exact_quantiles, with_quantiles


def _valid_money() -> dict:
    """Counts, sums and means over revenue-valid trips."""
    paid = F.col("is_revenue_valid")
    fare, tip, total = F.col("fare_amount"), F.col("tip_amount"), F.col("total_amount")
    return {
        "total_trips": rows(),
        "valid_revenue_trips": count_where(paid),
        "total_fare_revenue": sum_where_or_zero(paid, fare),
        "total_tip_revenue": sum_where_or_zero(paid, tip),
        "total_revenue": sum_where_or_zero(paid, total),
        "avg_fare_amount": mean_where(paid, fare),
        "avg_total_amount": mean_where(paid, total),
        "tipped_trips": count_where(F.col("is_tipped")),
        "avg_tip_percentage": F.avg("tip_percentage"),
        "avg_fare_per_mile": F.avg("fare_per_mile"),
        "avg_total_amount_per_mile": F.avg("total_amount_per_mile"),
    }


def _shares(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "tipped_trip_share": ratio_if_positive(F.col("tipped_trips"), F.col("total_trips")),
            "revenue_per_valid_trip": ratio_if_positive(F.col("total_revenue"), F.col("valid_revenue_trips")),
        }
    )


def fare_payment_metrics(metrics: DataFrame) -> DataFrame:
    """Grouped by the raw code, so several codes can carry the label 'Unknown'."""
    airport = F.col("is_airport_trip")
    measures = {
        **_valid_money(),
        "avg_tip_amount": mean_where(F.col("is_revenue_valid"), F.col("tip_amount")),
        "zero_fare_trips": count_where(F.col("is_zero_fare")),
        "negative_fare_trips": count_where(F.col("is_negative_fare")),
        "zero_total_trips": count_where(F.col("is_zero_total")),
        "negative_total_trips": count_where(F.col("is_negative_total")),
        "airport_trips": count_where(airport),
        "airport_revenue": sum_where_or_zero(airport & F.col("is_revenue_valid"), F.col("total_amount")),
    }
    grouped = metrics.groupBy("payment_type", "payment_type_label").agg(
        *(agg.alias(name) for name, agg in measures.items())
    )
    return _shares(grouped)


def airport_metrics(metrics: DataFrame, config: MobilityConfig = DEFAULT) -> DataFrame:
    miles_ok = F.col("is_distance_valid") & (F.col("trip_distance") > 0)
    passengers = F.col("passenger_count")
    category = airport_category(F.col("pickup_location_id"), F.col("dropoff_location_id"), config)
    measures = {
        **_valid_money(),
        "avg_trip_distance": mean_where(miles_ok, F.col("trip_distance")),
        "avg_trip_duration_minutes": F.avg("trip_duration_minutes"),
        "total_passengers": F.coalesce(F.sum(passengers), F.lit(0)),
        "avg_passengers": mean_where(passengers > 0, passengers),
    }
    grouped = metrics.groupBy(category.alias("airport_category")).agg(
        *(agg.alias(name) for name, agg in measures.items())
    )
    return _shares(grouped)


def fare_payment_analysis(metrics: DataFrame) -> DataFrame:
    """Five canonical payment types with means, exact medians, spread and market shares."""
    coded = metrics.withColumn("canonical", canonical_payment(F.col("payment_type")))
    miles, minutes = F.col("trip_distance"), F.col("trip_duration_minutes")
    fare, total = F.col("fare_amount"), F.col("total_amount")
    grouped = coded.groupBy("canonical").agg(
        rows().alias("trips"),
        F.sum("passenger_count").alias("passengers"),
        F.sum(fare).alias("fare_amount"),
        F.sum(total).alias("total_amount"),
        sum_where(F.col("is_distance_valid"), miles).alias("total_distance"),
        sum_where(F.col("is_duration_valid"), minutes).alias("total_duration_minutes"),
        F.avg(fare).alias("avg_fare"),
        F.avg(total).alias("avg_amount"),
        F.stddev_samp(total).alias("amount_stddev"),
        F.avg(F.when(miles > 0, fare / miles)).alias("avg_fare_per_mile"),
        F.avg(F.when(minutes > 0, total / minutes)).alias("avg_amount_per_minute"),
        F.avg(miles).alias("avg_distance"),
        F.avg(minutes).alias("avg_duration_minutes"),
        F.avg("trip_speed_mph").alias("avg_speed_mph"),
        count_where(F.col("is_tipped")).alias("tipped_trips"),
        F.avg("tip_percentage").alias("avg_tip_percentage"),
        F.sum("tip_amount").alias("total_tips"),
        count_where(F.col("is_airport_trip")).alias("airport_trips"),
    )
    medians = exact_quantiles(
        coded, ["canonical"],
        [
            Quantile("median_fare", F.col("fare_amount")),
            Quantile("median_amount", F.col("total_amount")),
            Quantile("median_tip_percentage", F.col("tip_percentage")),
        ],
    )
    # At most one row per canonical code reaches this window.
    market = Window.partitionBy()
    share = {
        "trip_share_pct": percent(F.col("trips"), F.sum("trips").over(market)),
        "amount_share_pct": percent(F.col("total_amount"), F.sum("total_amount").over(market)),
        "tipping_rate_pct": percent(F.col("tipped_trips"), F.col("trips")),
        "airport_share_pct": percent(F.col("airport_trips"), F.col("trips")),
    }
    return (
        with_quantiles(grouped, "canonical", medians)
        .withColumns(share)
        .withColumn("payment_type_label", payment_label(F.col("canonical")))
        .withColumnRenamed("canonical", "payment_type")
    )
