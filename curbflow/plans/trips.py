"""Trip-level relations. Both are narrow projections: no shuffle, one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.config import DEFAULT, UNKNOWN_PAYMENT_CODE, MobilityConfig
from curbflow.functions import clock
from curbflow.functions.labels import airport_direction, first_match, payment_label

# Published source column -> analytical name.
RENAMES = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "RatecodeID": "rate_code_id",
    "store_and_fwd_flag": "store_and_fwd_flag",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
    "payment_type": "payment_type",
    "fare_amount": "fare_amount",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "improvement_surcharge": "improvement_surcharge",
    "total_amount": "total_amount",
    "congestion_surcharge": "congestion_surcharge",
    "Airport_fee": "airport_fee",
}


def _time_columns() -> dict[str, Column]:
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return {
        "pickup_hour": clock.floor_hour(pickup),
        "pickup_date": F.to_date(pickup),
        "pickup_hour_of_day": F.hour(pickup),
        "pickup_day_of_week": clock.day_of_week(pickup),
        "pickup_week": clock.floor_week(pickup),
        "pickup_month": clock.floor_month(pickup),
        "duration_seconds": clock.second_boundaries(pickup, dropoff),
    }


def _sign_flags(stem: str, column: str) -> dict[str, Column]:
    value = F.col(column)
    return {
        f"is_missing_{stem}": value.isNull(),
        f"is_negative_{stem}": value < 0,
        f"is_zero_{stem}": value == 0,
    }


def quality_flags(config: MobilityConfig) -> dict[str, Column]:
    """Three-valued: a comparison with a missing value stays NULL; only the NULL tests are two-valued."""
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    passengers = F.col("passenger_count")
    return {
        "is_missing_pickup_datetime": pickup.isNull(),
        "is_missing_dropoff_datetime": dropoff.isNull(),
        "is_negative_duration": dropoff < pickup,
        "is_zero_duration": dropoff == pickup,
        "is_long_duration": F.col("duration_seconds") > config.long_trip_seconds,
        **_sign_flags("distance", "trip_distance"),
        "is_extreme_distance": F.col("trip_distance") > config.extreme_distance,
        **_sign_flags("fare", "fare_amount"),
        **_sign_flags("total", "total_amount"),
        "is_unknown_passenger": passengers.isNull(),
        "is_zero_passenger": passengers == 0,
        "is_high_passenger_count": passengers > config.high_passengers,
        "is_unknown_payment": F.col("payment_type") == UNKNOWN_PAYMENT_CODE,
        "is_missing_pickup_zone": F.col("pickup_location_id").isNull(),
        "is_missing_dropoff_zone": F.col("dropoff_location_id").isNull(),
    }


# A trip is valid for a metric when none of the metric's flags is raised.
DISQUALIFYING = {
    "is_duration_valid": (
        "is_missing_pickup_datetime", "is_missing_dropoff_datetime", "is_negative_duration", "is_long_duration",
    ),
    "is_distance_valid": (
        "is_missing_distance", "is_negative_distance", "is_zero_distance", "is_extreme_distance",
    ),
    "is_revenue_valid": ("is_missing_total", "is_negative_total"),
    "is_passenger_valid": ("is_unknown_passenger", "is_zero_passenger"),
}

QUALITY_LABELS = {
    "duration_quality": (
        {"is_negative_duration": "Negative Duration", "is_long_duration": "Over 24 Hours",
         "is_zero_duration": "Zero Duration"},
        "Valid Duration",
    ),
    "distance_quality": (
        {"is_negative_distance": "Negative Distance", "is_extreme_distance": "Extreme Distance",
         "is_zero_distance": "Zero Distance"},
        "Valid Distance",
    ),
    "revenue_quality": (
        {"is_negative_total": "Negative Total", "is_zero_total": "Zero Total"},
        "Valid Revenue",
    ),
}


def _none_of(flags: tuple[str, ...]) -> Column:
    raised = F.col(flags[0])
    for name in flags[1:]:
        raised = raised | F.col(name)
    return ~raised


def taxi_trips_clean(staged_trips: DataFrame, config: MobilityConfig = DEFAULT) -> DataFrame:
    """Renamed trips with calendar columns, quality flags, validity flags and labels; no row is dropped."""
    labels = {
        name: first_match([(F.col(flag), text) for flag, text in cases.items()], otherwise)
        for name, (cases, otherwise) in QUALITY_LABELS.items()
    }
    return (
        staged_trips.select(*(F.col(source).alias(name) for source, name in RENAMES.items()))
        .withColumns(_time_columns())
        .withColumns(quality_flags(config))
        .withColumns({name: _none_of(flags) for name, flags in DISQUALIFYING.items()})
        .withColumns({"payment_type_label": payment_label(F.col("payment_type")), **labels})
    )


# Columns of the cleaned trip that the metric relation carries on.
CARRIED = (
    *(name for name in RENAMES.values()),
    "payment_type_label",
    "is_missing_pickup_zone", "is_missing_dropoff_zone",
    *DISQUALIFYING,
    *QUALITY_LABELS,
    "is_missing_fare", "is_negative_fare", "is_zero_fare",
    "is_missing_total", "is_negative_total", "is_zero_total",
    "is_unknown_passenger", "is_zero_passenger", "is_high_passenger_count", "is_unknown_payment",
)


def trip_metrics(clean: DataFrame, config: MobilityConfig = DEFAULT) -> DataFrame:
    return with_economics(clean.select(*CARRIED), config)


def with_economics(clean: DataFrame, config: MobilityConfig = DEFAULT) -> DataFrame:
    """Clean trips and their economics. A ratio is NULL when one of its inputs is not valid."""
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    fare, total, tip = F.col("fare_amount"), F.col("total_amount"), F.col("tip_amount")
    miles = F.col("trip_distance")
    timed = F.col("is_duration_valid") & F.col("has_positive_duration")
    paid, measured = F.col("is_revenue_valid"), F.col("is_distance_valid")
    seconds = clock.elapsed_seconds(pickup, dropoff)
    from_airport = F.coalesce(F.col("pickup_location_id").isin(*config.airport_zones), F.lit(False))
    to_airport = F.coalesce(F.col("dropoff_location_id").isin(*config.airport_zones), F.lit(False))
    return (
        clean.withColumns(
            {
                "has_positive_duration": F.coalesce(dropoff > pickup, F.lit(False)),
                "is_tipped": F.coalesce(tip > 0, F.lit(False)),
                "is_airport_pickup": from_airport,
                "is_airport_dropoff": to_airport,
                "is_positive_revenue_trip": F.coalesce(paid & (total > 0), F.lit(False)),
            }
        )
        .withColumns(
            {
                "trip_duration_minutes": F.when(timed, seconds / F.lit(60.0)),
                "trip_speed_mph": F.when(timed & measured, miles / (seconds / F.lit(3600.0))),
                "fare_per_mile": F.when(measured & paid, fare / miles),
                "total_amount_per_mile": F.when(measured & paid, total / miles),
                "total_amount_per_minute": F.when(timed & paid, total / (seconds / F.lit(60.0))),
                "tip_percentage": F.when(paid & (fare > 0) & (tip >= 0), tip / fare),
                "is_airport_trip": F.col("is_airport_pickup") | F.col("is_airport_dropoff"),
                "airport_trip_type": airport_direction(
                    F.col("is_airport_pickup"), F.col("is_airport_dropoff")
                ),
            }
        )
    )
