"""The regression dataset: hourly series with lags and calendar controls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.functions import clock
from curbflow.operators.series import with_lags

TAXI_LAGS = (1, 2, 24, 168)
SUBWAY_LAGS = (1, 2, 24)


def lags_of(column: str, steps: tuple[int, ...]) -> dict[str, tuple[str, int]]:
    """Row-offset lags: with absent hours, lag 168 is 168 rows back, not one week."""
    return {f"{column}_lag_{k}": (column, k) for k in steps}


def fill_missing_hours(summary: DataFrame, spine: DataFrame) -> DataFrame:
    """Variant input where lags are time offsets: absent hours appear with zero trips."""
    calendar = [c for c in spine.columns if c != "timestamp_hour"]
    facts = summary.drop(*calendar)
    return spine.withColumnRenamed("timestamp_hour", "pickup_hour").join(
        facts, "pickup_hour", "left"
    ).fillna({"taxi_trip_count": 0})


def statistical_analysis(summary: DataFrame) -> DataFrame:
    base = summary.select(
        "pickup_hour", "calendar_date", "hour_of_day", "day_of_week", "is_weekend", "month_start",
        "taxi_trip_count", "taxi_revenue", "taxi_distance", "taxi_duration_seconds",
        "subway_ridership", "subway_transfers", "temperature_2m", "relative_humidity_2m",
        "precipitation", "rain", "wind_speed_10m", "cloud_cover",
    )
    day = F.col("calendar_date")
    lags = {**lags_of("taxi_trip_count", TAXI_LAGS), **lags_of("subway_ridership", SUBWAY_LAGS)}
    return with_lags(base, "pickup_hour", lags).withColumns(
        {
            "regression_day_of_week": clock.day_of_week(day),
            "regression_month": F.month(day),
            "rain_flag": F.when(F.col("precipitation") > 0, 1).otherwise(0),
        }
    )


