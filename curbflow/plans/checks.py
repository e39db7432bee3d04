"""Measures of the layers that the validation suites judge; each is one aggregate over one relation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Relation -> measure -> aggregate. They have no DISTINCT, so that they can be observed while a layer is written.
MEASURES: dict[str, dict[str, str]] = {
    "staged": {"staged": "count(1)"},
    "trips_clean": {"clean": "count(1)"},
    "trip_metrics": {
        "metrics": "count(1)",
        "airport_trips": "count_if(is_airport_trip)",
        "non_positive_minutes": "count_if(trip_duration_minutes <= 0)",
        "negative_speed": "count_if(trip_speed_mph < 0)",
        "negative_tip_share": "count_if(tip_percentage < 0)",
        "negative_valid_revenue": "count_if(is_revenue_valid and total_amount < 0)",
    },
    "hourly_taxi_demand": {"demand": "coalesce(sum(trip_count), 0)"},
    "hourly_mobility": {"mobility": "coalesce(sum(trip_count), 0)"},
    "hourly_mobility_summary": {"summary": "coalesce(sum(taxi_trip_count), 0)", "summary_rows": "count(1)"},
    "zone_performance": {
        "negative_zone_trips": "count_if(pickup_trips < 0 or dropoff_trips < 0)",
        "unmapped_zone_rows": "count_if(zone is null)",
    },
    "od_flow": {"od": "coalesce(sum(trips), 0)", "non_positive_od_trips": "count_if(trips <= 0)"},
    "airport_metrics": {
        "airport_categories": "coalesce(sum(total_trips), 0)",
        "airport_rows": "count(1)",
        "airport_mart_trips": "sum(case when airport_category <> 'Non-Airport' then total_trips end)",
        "negative_airport_revenue": "count_if(total_revenue < 0)",
    },
    "fare_payment_metrics": {
        "payment_codes": "coalesce(sum(total_trips), 0)",
        "payment_rows": "count(1)",
        "negative_payment_revenue": "count_if(total_revenue < 0)",
    },
    "fare_payment_analysis": {"payment": "coalesce(sum(trips), 0)"},
    "executive_mobility": {"kpi_trips": "coalesce(sum(total_trips), 0)"},
    "temporal_demand": {"temporal": "coalesce(sum(taxi_trip_count), 0)"},
    "geographic_performance": {"pickups": "coalesce(sum(pickup_trips), 0)"},
    "weather_mobility_metrics": {
        "weather_rows": "count(1)",
        "bad_rain_flags": "count_if(is_raining is null and precipitation is not null)",
    },
}


def aggregates(relation: str) -> list[Column]:
    return [F.expr(measure).cast("bigint").alias(name) for name, measure in MEASURES[relation].items()]
