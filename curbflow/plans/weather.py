"""Weather relations. The two band schemes differ on purpose; both stay available by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbflow.config import (
    PRECIPITATION_COARSE, PRECIPITATION_METEO, TEMPERATURE_COARSE, TEMPERATURE_FINE,
)
from curbflow.functions.labels import band, precipitation_band
from curbflow.functions.measures import ratio_if_positive

COMPLETENESS_COLUMNS = (
    "temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m", "cloud_cover",
)


def all_present(columns=COMPLETENESS_COLUMNS):
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    return present


def weather_mobility_metrics(summary: DataFrame) -> DataFrame:
    rain, heat = F.col("precipitation"), F.col("temperature_2m")
    taxi_per_rider = ratio_if_positive(F.col("taxi_trip_count"), F.col("subway_ridership"))
    return summary.select(
        "pickup_hour", "hour_of_day", "is_weekend", "month_start",
        "taxi_trip_count", "subway_ridership", "subway_transfers",
        "temperature_2m", "relative_humidity_2m", "precipitation", "rain", "wind_speed_10m", "cloud_cover",
        precipitation_band(rain, PRECIPITATION_COARSE).alias("precipitation_category"),
        (rain > 0).alias("is_raining"),
        band(heat, TEMPERATURE_FINE).alias("temperature_category"),
        taxi_per_rider.alias("taxi_to_subway_ratio"),
        taxi_per_rider.alias("taxi_subway_demand_ratio"),
        all_present().alias("weather_complete"),
    )


CATEGORY_MEANS = {
    "category_avg_taxi_trips": "taxi_trip_count",
    "category_avg_taxi_revenue": "taxi_revenue",
    "category_avg_distance_per_trip": "distance_per_trip",
    "category_avg_duration_per_trip": "duration_minutes_per_trip",
    "category_avg_amount_per_trip": "amount_per_trip",
    "category_avg_subway_ridership": "subway_ridership",
    "category_avg_subway_transfers": "subway_transfers",
}


def weather_transit_analysis(summary: DataFrame) -> DataFrame:
    """Per-trip ratios and the mean of each measure over the hour's precipitation category."""
    trips = F.col("taxi_trip_count")
    classified = summary.select(
        "pickup_hour", "calendar_date", "hour_of_day", "day_of_week", "is_weekend", "month_start",
        "taxi_trip_count", "taxi_revenue", "taxi_distance", "taxi_duration_seconds",
        "subway_ridership", "subway_transfers", "temperature_2m", "relative_humidity_2m",
        "precipitation", "rain", "snowfall", "weather_code", "wind_speed_10m", "cloud_cover",
        precipitation_band(F.col("precipitation"), PRECIPITATION_METEO).alias("precipitation_category"),
        band(F.col("temperature_2m"), TEMPERATURE_COARSE).alias("temperature_category"),
        ratio_if_positive(F.col("taxi_revenue"), trips).alias("amount_per_trip"),
        ratio_if_positive(F.col("taxi_distance"), trips).alias("distance_per_trip"),
        ratio_if_positive(F.col("taxi_duration_seconds") / F.lit(60.0), trips).alias("duration_minutes_per_trip"),
        ratio_if_positive(F.col("subway_ridership"), trips).alias("subway_to_taxi_ratio"),
    )
    same_category = Window.partitionBy("precipitation_category")
    return classified.withColumns(
        {name: F.avg(column).over(same_category) for name, column in CATEGORY_MEANS.items()}
    )
