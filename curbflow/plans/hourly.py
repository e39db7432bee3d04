"""The hour backbone: demand by hour and zone pair, calendar spine, context and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.config import Period
from curbflow.functions import clock
from curbflow.functions.measures import count_where, mean_of_known, ratio, rows, sum_where
from curbflow.sources.staging import WEATHER_TYPES

CALENDAR = ("calendar_date", "hour_of_day", "day_of_week", "is_weekend", "week_start", "month_start")

# Output column -> flag counted.
ISSUE_COUNTS = {
    "zero_distance_trip_count": "is_zero_distance",
    "extreme_distance_trip_count": "is_extreme_distance",
    "negative_duration_trip_count": "is_negative_duration",
    "long_duration_trip_count": "is_long_duration",
    "negative_total_trip_count": "is_negative_total",
    "unknown_passenger_trip_count": "is_unknown_passenger",
    "unknown_payment_trip_count": "is_unknown_payment",
}


def hourly_taxi_demand(clean: DataFrame) -> DataFrame:
    """One hash aggregation per pickup hour and zone pair.

    Most groups hold few trips, so a task keeps nearly as many groups as it reads trips: means share the sums and counts
    beside them. A trip valid for a metric has the metric's value (see `plans.trips.DISQUALIFYING`); its fare may be missing.
    """
    valid = {m: F.col(f"is_{m}_valid") for m in ("duration", "distance", "revenue", "passenger")}
    total, fare = F.col("total_amount"), F.col("fare_amount")
    miles, seconds = F.col("trip_distance"), F.col("duration_seconds")
    fares, known_fares = sum_where(valid["revenue"], fare), F.count(F.when(valid["revenue"], fare))
    return clean.groupBy("pickup_hour", "pickup_location_id", "dropoff_location_id").agg(
        rows().alias("trip_count"),
        *(count_where(flag).alias(f"{m}_valid_trip_count") for m, flag in valid.items()),
        sum_where(valid["revenue"], total).alias("total_revenue"),
        mean_of_known(valid["revenue"], total).alias("avg_total_amount"),
        fares.alias("total_fare_amount"),
        ratio(fares, known_fares).alias("avg_fare_amount"),
        sum_where(valid["distance"], miles).alias("total_distance"),
        mean_of_known(valid["distance"], miles).alias("avg_distance"),
        sum_where(valid["duration"], seconds).alias("total_duration_seconds"),
        mean_of_known(valid["duration"], seconds).alias("avg_duration_seconds"),
        mean_of_known(valid["passenger"], F.col("passenger_count")).alias("avg_passenger_count"),
        *(count_where(F.col(flag)).alias(name) for name, flag in ISSUE_COUNTS.items()),
    )


def _with_calendar(hours: DataFrame) -> DataFrame:
    ts = F.col("timestamp_hour")
    return hours.select(
        ts,
        F.to_date(ts).alias("calendar_date"),
        F.hour(ts).alias("hour_of_day"),
        clock.day_of_week(ts).alias("day_of_week"),
        clock.is_weekend_day(ts).alias("is_weekend"),
        clock.floor_week(ts).alias("week_start"),
        clock.floor_month(ts).alias("month_start"),
    )


def hourly_spine(spark: SparkSession, period: Period) -> DataFrame:
    """Every hour of the period with its calendar columns."""
    bounds = spark.range(1).select(
        F.lit(period.start.isoformat(" ")).cast("timestamp_ntz").alias("first"),
        F.lit(period.last_hour.isoformat(" ")).cast("timestamp_ntz").alias("last"),
    )
    return _with_calendar(bounds.select(_hours_between("first", "last")))


def observed_spine(clean: DataFrame) -> DataFrame:
    """The spine from the first to the last observed pickup hour."""
    bounds = clean.agg(F.min("pickup_hour").alias("first"), F.max("pickup_hour").alias("last"))
    return _with_calendar(bounds.select(_hours_between("first", "last")))


def _hours_between(first: str, last: str):
    return F.explode(F.sequence(F.col(first), F.col(last), F.expr("interval 1 hour"))).alias("timestamp_hour")


def hourly_context(spine: DataFrame, weather: DataFrame, subway: DataFrame) -> DataFrame:
    return spine.join(weather, "timestamp_hour", "left").join(subway, "timestamp_hour", "left")


def hourly_mobility(demand: DataFrame, context: DataFrame, zones: DataFrame) -> DataFrame:
    """Demand with context and both zone roles. The joined sides stay unhinted: Catalyst and AQE
    broadcast them while they are small and shuffle them otherwise."""

    def role(side: str) -> DataFrame:
        return zones.select(
            F.col("location_id").alias(f"{side}_location_id"),
            *(F.col(c).alias(f"{side}_{c}") for c in ("borough", "zone", "service_zone")),
        )

    joined = (
        demand.join(context.withColumnRenamed("timestamp_hour", "pickup_hour"), "pickup_hour", "left")
        .join(role("pickup"), "pickup_location_id", "left")
        .join(role("dropoff"), "dropoff_location_id", "left")
    )
    keys = ("pickup_hour", "pickup_location_id", "pickup_borough", "pickup_zone", "pickup_service_zone",
            "dropoff_location_id", "dropoff_borough", "dropoff_zone", "dropoff_service_zone")
    facts = [c for c in demand.columns if c not in keys]
    return joined.select(*keys, *CALENDAR, *facts, *WEATHER_TYPES, "total_ridership", "total_transfers")


# Roll-up of the hourly demand facts: output column -> source fact.
ROLLED_UP = {
    "taxi_trip_count": "trip_count",
    "taxi_revenue": "total_revenue",
    "taxi_distance": "total_distance",
    "taxi_duration_seconds": "total_duration_seconds",
    **{name: name for name in ISSUE_COUNTS},
}


def hourly_mobility_summary(mobility: DataFrame) -> DataFrame:
    """Roll-up of the mart to one row per hour; context values repeat within an hour, so MAX takes them."""
    return mobility.groupBy("pickup_hour", *CALENDAR).agg(
        *(F.sum(fact).alias(name) for name, fact in ROLLED_UP.items()),
        *(F.max(c).alias(c) for c in WEATHER_TYPES),
        F.max("total_ridership").alias("subway_ridership"),
        F.max("total_transfers").alias("subway_transfers"),
    )


def _with_context(per_hour: DataFrame, context: DataFrame) -> DataFrame:
    facts = per_hour.columns[1:]
    joined = per_hour.join(context.withColumnRenamed("timestamp_hour", "pickup_hour"), "pickup_hour", "left")
    return joined.select(
        "pickup_hour", *CALENDAR, *facts, *WEATHER_TYPES,
        F.col("total_ridership").alias("subway_ridership"),
        F.col("total_transfers").alias("subway_transfers"),
    )


def hourly_summary_from_trips(clean: DataFrame, context: DataFrame) -> DataFrame:
    """The same summary without the zone-pair stage: trips collapse to one row per hour in the
    map-side aggregation, and the context joins the (at most period-many) hours afterwards."""
    facts = {
        "taxi_trip_count": rows(),
        "taxi_revenue": sum_where(F.col("is_revenue_valid"), F.col("total_amount")),
        "taxi_distance": sum_where(F.col("is_distance_valid"), F.col("trip_distance")),
        "taxi_duration_seconds": sum_where(F.col("is_duration_valid"), F.col("duration_seconds")),
        **{name: count_where(F.col(flag)) for name, flag in ISSUE_COUNTS.items()},
    }
    return _with_context(
        clean.groupBy("pickup_hour").agg(*(agg.alias(name) for name, agg in facts.items())), context
    )


def hourly_summary_from_demand(demand: DataFrame, context: DataFrame) -> DataFrame:
    """The same summary from the demand facts, when these are already written."""
    facts = (F.sum(fact).alias(name) for name, fact in ROLLED_UP.items())
    return _with_context(demand.groupBy("pickup_hour").agg(*facts), context)
