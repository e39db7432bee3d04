"""Warehouse-level quality metrics and the rule table of anomalies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.config import SEVERITIES
from curbflow.functions.labels import first_match
from curbflow.functions.measures import count_where, percent, rows
from curbflow.operators.shaping import rows_from_columns, side_by_side
from curbflow.plans.weather import all_present


def row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(rows().alias(name))


def _trip_quality() -> dict[str, Column]:
    """Counts over the metric relation; an invalid trip is one whose validity flag is FALSE."""
    counted = {
        "missing_pickup_zone_trips": F.col("is_missing_pickup_zone"),
        "missing_dropoff_zone_trips": F.col("is_missing_dropoff_zone"),
        **{
            f"invalid_{m}_trips": ~F.col(f"is_{m}_valid")
            for m in ("duration", "distance", "revenue", "passenger")
        },
        **{
            f"{kind}_{money}_trips": F.col(f"is_{kind}_{money}")
            for money in ("fare", "total")
            for kind in ("missing", "negative", "zero")
        },
        "unknown_passenger_trips": F.col("is_unknown_passenger"),
        "zero_passenger_trips": F.col("is_zero_passenger"),
        "high_passenger_trips": F.col("is_high_passenger_count"),
        "unknown_payment_trips": F.col("is_unknown_payment"),
        "missing_valid_duration_metric_trips": F.col("trip_duration_minutes").isNull(),
        "non_positive_distance_trips": F.col("trip_distance").isNull() | (F.col("trip_distance") <= 0),
        **{
            f"valid_{name}_trips": F.col(column).isNotNull()
            for name, column in {
                "duration_metric": "trip_duration_minutes",
                "speed_metric": "trip_speed_mph",
                "fare_per_mile": "fare_per_mile",
                "total_per_mile": "total_amount_per_mile",
                "tip_percentage": "tip_percentage",
            }.items()
        },
    }
    return {"total_trips": rows(), **{name: count_where(flag) for name, flag in counted.items()}}


def data_quality_metrics(
    staging_taxi_rows: DataFrame, clean: DataFrame, metrics: DataFrame, zones: DataFrame,
    spine: DataFrame, summary: DataFrame, zone_perf: DataFrame, od: DataFrame,
) -> DataFrame:
    """One row. The staged trips come as their row count, which a build has observed; every other source is aggregated
    once. The one-row results are folded together."""
    trips = metrics.agg(*(agg.alias(name) for name, agg in _trip_quality().items()))
    hours = summary.agg(
        rows().alias("hourly_rows"),
        F.count_distinct("pickup_hour").alias("unique_hours"),
        F.min("pickup_hour").alias("earliest_hour"),
        F.max("pickup_hour").alias("latest_hour"),
        count_where(~all_present()).alias("incomplete_weather_hours"),
        count_where(F.col("subway_ridership").isNull()).alias("missing_subway_hours"),
        count_where(F.col("taxi_trip_count").isNull()).alias("missing_taxi_demand_hours"),
    )
    zone_part = zone_perf.agg(
        rows().alias("zone_rows"),
        F.count_distinct("location_id").alias("unique_zone_locations"),
        count_where(F.col("zone").isNull()).alias("missing_zone_names"),
        count_where(F.col("service_zone").isNull()).alias("missing_service_zones"),
    )
    od_part = od.agg(
        rows().alias("od_rows"),
        F.count_distinct(F.struct("pickup_location_id", "dropoff_location_id")).alias("unique_od_pairs"),
        F.sum("trips").alias("od_trip_total"),
        count_where(F.col("trips") <= 0).alias("invalid_od_rows"),
    )
    combined = side_by_side(
        staging_taxi_rows,
        row_count(clean, "clean_taxi_rows"),
        row_count(metrics, "trip_metric_rows"),
        row_count(zones, "taxi_zone_rows"),
        row_count(spine, "hourly_spine_rows"),
        trips, hours, zone_part, od_part,
    )

    def kept(whole: str, lost: str) -> Column:
        return percent(F.col(whole) - F.col(lost), F.col(whole))

    healthy = (
        (F.col("staging_taxi_rows") == F.col("clean_taxi_rows"))
        & (F.col("clean_taxi_rows") == F.col("trip_metric_rows"))
    )
    for zero in (
        "missing_pickup_zone_trips", "missing_dropoff_zone_trips",
        "incomplete_weather_hours", "missing_subway_hours", "invalid_od_rows",
    ):
        healthy = healthy & (F.col(zero) == 0)
    return combined.withColumns(
        {
            "pickup_zone_completeness_pct": kept("total_trips", "missing_pickup_zone_trips"),
            "dropoff_zone_completeness_pct": kept("total_trips", "missing_dropoff_zone_trips"),
            **{
                f"{m}_validity_pct": kept("total_trips", f"invalid_{m}_trips")
                for m in ("duration", "distance", "revenue", "passenger")
            },
            "weather_completeness_pct": kept("hourly_rows", "incomplete_weather_hours"),
            "subway_completeness_pct": kept("hourly_rows", "missing_subway_hours"),
            "warehouse_quality_status": F.when(healthy, "PASS").otherwise("REVIEW"),
        }
    )


@dataclass(frozen=True)
class Rule:
    issue_id: str
    issue_name: str
    issue_category: str
    flag: str
    kpi_impact: str
    severity: str
    treatment: str


# The rules, severities and treatments are this project's choice; each rests on a quality flag.
RULES = (
    Rule("DQ-01", "Negative duration", "Temporal", "is_negative_duration",
         "Duration and speed", "Critical", "Excluded from duration metrics"),
    Rule("DQ-02", "Zero duration", "Temporal", "is_zero_duration",
         "Duration and speed", "Medium", "No duration value derived"),
    Rule("DQ-03", "Over 24 hours", "Temporal", "is_long_duration",
         "Duration and speed", "High", "Excluded from duration metrics"),
    Rule("DQ-04", "Zero distance", "Distance", "is_zero_distance",
         "Distance and per-mile rates", "Medium", "Excluded from distance metrics"),
    Rule("DQ-05", "Negative distance", "Distance", "is_negative_distance",
         "Distance and per-mile rates", "High", "Excluded from distance metrics"),
    Rule("DQ-06", "Extreme distance", "Distance", "is_extreme_distance",
         "Distance and per-mile rates", "High", "Excluded from distance metrics"),
    Rule("DQ-07", "Negative fare", "Financial", "is_negative_fare",
         "Fare totals and averages", "High", "Kept and flagged"),
    Rule("DQ-08", "Zero fare", "Financial", "is_zero_fare",
         "Fare averages and tip share", "Low", "Kept and flagged"),
    Rule("DQ-09", "Negative total", "Financial", "is_negative_total",
         "Revenue", "Critical", "Excluded from valid revenue"),
    Rule("DQ-10", "Zero total", "Financial", "is_zero_total",
         "Revenue per trip", "Low", "Kept and flagged"),
    Rule("DQ-11", "Unknown passengers", "Passenger", "is_unknown_passenger",
         "Passenger averages", "Medium", "Excluded from passenger metrics"),
    Rule("DQ-12", "Zero passengers", "Passenger", "is_zero_passenger",
         "Passenger averages", "Medium", "Excluded from passenger metrics"),
    Rule("DQ-13", "High passenger count", "Passenger", "is_high_passenger_count",
         "Passenger averages", "Low", "Kept and flagged"),
    Rule("DQ-14", "Unknown payment", "Payment", "is_unknown_payment",
         "Payment mix", "Low", "Grouped as Unknown"),
    Rule("DQ-15", "Missing pickup zone", "Referential", "is_missing_pickup_zone",
         "Zone activity", "Critical", "Kept without a zone"),
    Rule("DQ-16", "Missing dropoff zone", "Referential", "is_missing_dropoff_zone",
         "Zone activity", "Critical", "Kept without a zone"),
)


def severity_rank(severity: Column) -> Column:
    return first_match([(severity == s, i) for i, s in enumerate(SEVERITIES, 1)], len(SEVERITIES) + 1)


def data_quality_anomalies(clean: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per rule from a single pass over the trips. Rules overlap: do not add their rows."""
    counts = {f"{r.issue_id}_rows": count_where(F.col(r.flag)) for r in rules}
    money = {
        f"{r.issue_id}_revenue": F.coalesce(F.sum(F.when(F.col(r.flag), F.col("total_amount"))), F.lit(0.0))
        for r in rules
    }
    totals = clean.agg(
        rows().alias("all_trips"), *(agg.alias(name) for name, agg in {**counts, **money}.items())
    )
    records = [
        {
            "issue_id": F.lit(r.issue_id),
            "issue_name": F.lit(r.issue_name),
            "issue_category": F.lit(r.issue_category),
            "affected_rows": F.col(f"{r.issue_id}_rows"),
            "affected_pct": percent(F.col(f"{r.issue_id}_rows"), F.col("all_trips")),
            "affected_revenue": F.col(f"{r.issue_id}_revenue"),
            "rule": F.lit(r.flag),
            "kpi_impact": F.lit(r.kpi_impact),
            "severity": F.lit(r.severity),
            "treatment": F.lit(r.treatment),
        }
        for r in rules
    ]
    return rows_from_columns(totals, records).orderBy(
        severity_rank(F.col("severity")), F.desc("affected_rows"), "issue_id"
    )


def quality_totals(anomalies: DataFrame) -> DataFrame:
    return anomalies.agg(
        rows().alias("quality_rules"),
        F.sum("affected_rows").alias("issue_flags"),
        F.sum("affected_revenue").alias("flagged_revenue"),
    )
