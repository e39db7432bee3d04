"""Source files as the outside world delivers them, written to the shared folder and read by the stagers.

The contents come from the given tables, so readers, lenient parsing and sinks are exercised on data that grows with them.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.config import Period
from curbflow.session import scratch_dir
from curbflow.sources import fixtures, staging


def _folder(spark: SparkSession, name: str) -> str:
    return os.path.join(scratch_dir(spark), f"{name}-{uuid.uuid4().hex}")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather as text, made of the orders of each hour; some codes do not parse."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    hours = orders.groupBy((F.col("o_orderkey") % 2184).alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("k")
    )
    tenths = lambda m: (F.col("k") % m / 10).cast("string")
    time = F.expr("timestampadd(HOUR, h, timestamp_ntz'2024-04-01 00:00:00')")
    values: dict[str, Column] = {
        "temperature_2m": tenths(400),
        "relative_humidity_2m": (F.col("k") % 101).cast("string"),
        "precipitation": tenths(50),
        "rain": tenths(30),
        "snowfall": F.lit("0.0"),
        "weather_code": F.when(F.col("k") % 17 == 0, "n/a").otherwise((F.col("k") % 90).cast("string")),
        "wind_speed_10m": tenths(300),
        "cloud_cover": (F.col("n") % 101).cast("string"),
    }
    return hours.select(
        F.date_format(time, "yyyy-MM-dd'T'HH:mm").alias("time"), *(values[c].alias(c) for c in staging.WEATHER_TYPES)
    )


def weather_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "weather-csv")
    readings(spark, sf_dir).write.csv(path, header=True)
    return staging.stage_weather(spark, path)


def weather_from_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One object of parallel arrays, as the service answers for a period; its size is the hours of the period."""
    path = _folder(spark, "weather-payload")
    numbers = [F.col(c).try_cast("double").alias(c) for c in staging.WEATHER_TYPES]
    rows = readings(spark, sf_dir).select("time", *numbers)
    listed = rows.agg(F.array_sort(F.collect_list(F.struct("time", *staging.WEATHER_TYPES))).alias("r"))
    arrays = [F.col(f"r.{c}").alias(c) for c in ("time", *staging.WEATHER_TYPES)]
    payload = F.to_json(F.struct(F.struct(*arrays).alias("hourly")), {"ignoreNullFields": "false"})
    listed.select(payload).write.text(path)
    return staging.weather_payload_to_rows(spark, path)


def zones_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "zones-csv")
    names = {"location_id": "LocationID", "borough": "Borough", "zone": "Zone"}
    fixtures.zones(spark, sf_dir).withColumnsRenamed(names).write.csv(path, header=True)
    return staging.stage_zones(spark, path)


def subway_from_csv(spark: SparkSession, sf_dir: str, period: Period) -> DataFrame:
    """Counts with a fraction mark as some exports have them, and an unreadable one now and then."""
    path = _folder(spark, "subway-csv")
    hourly = staging.subway_hourly_rollup(fixtures.raw_subway(spark, sf_dir), period)
    riders = F.when(F.col("total_ridership") % 13 == 0, "unknown").otherwise(F.concat(F.col("total_ridership").cast("string"), F.lit(".0")))
    hourly.select(
        F.col("timestamp_hour").cast("string").alias("transit_timestamp"), riders.alias("total_ridership"), "total_transfers"
    ).write.csv(path, header=True)
    return staging.stage_subway(spark, path)


def trips_from_months(spark: SparkSession, trips: DataFrame, period: Period) -> DataFrame:
    """Monthly files in one folder each, read by a glob and cut to a period."""
    path = _folder(spark, "trip-months")
    month = F.month("tpep_pickup_datetime")
    for k in (4, 5, 6):
        trips.where(month == k).write.parquet(f"{path}/trips-2024-{k:02d}")
    return staging.stage_taxi_trips(spark, f"{path}/trips-*", period)


def drifted_months(spark: SparkSession, trips: DataFrame) -> list[str]:
    """Monthly files whose schemas differ: whole fares in one, a missing surcharge in another, a payment code as text."""
    path, month = _folder(spark, "drifted-months"), F.month("tpep_pickup_datetime")
    kept = trips.select("tpep_pickup_datetime", "PULocationID", "payment_type", "fare_amount", "congestion_surcharge")
    shapes = {
        4: lambda d: d.withColumn("fare_amount", F.floor("fare_amount").cast("int")),
        5: lambda d: d.drop("congestion_surcharge"),
        6: lambda d: d.withColumns({"payment_type": F.col("payment_type").cast("string"), "PULocationID": F.col("PULocationID").cast("bigint")}),
    }
    for k, shape in shapes.items():
        shape(kept.where(month == k)).write.parquet(f"{path}/{k}")
    return [f"{path}/{k}" for k in shapes]


def through_csv(df: DataFrame, write) -> DataFrame:
    """A result table written by the CSV sink and read back with its schema."""
    path = _folder(df.sparkSession, "result-csv")
    write(df, path)
    return df.sparkSession.read.schema(df.schema).csv(path, header=True)
