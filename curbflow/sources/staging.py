"""Staging relations. CSV schemas are explicit so that no inference pass reads the files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.config import Period
from curbflow.functions.measures import count_where, rows


@dataclass(frozen=True)
class StagedInputs:
    taxi_trips: DataFrame
    taxi_zones: DataFrame
    weather_hourly: DataFrame
    subway_hourly: DataFrame


# Measurement columns of the hourly weather source and their types.
WEATHER_TYPES = {
    "temperature_2m": "double",
    "relative_humidity_2m": "int",
    "precipitation": "double",
    "rain": "double",
    "snowfall": "double",
    "weather_code": "int",
    "wind_speed_10m": "double",
    "cloud_cover": "int",
}


def within_period(df: DataFrame, column: str, period: Period) -> DataFrame:
    """Half-open period filter; on parquet input it is pushed into the scan."""
    start, end = (F.lit(t.isoformat(" ")).cast("timestamp_ntz") for t in (period.start, period.end))
    return df.where((F.col(column) >= start) & (F.col(column) < end))


def stage_taxi_trips(spark: SparkSession, path: str, period: Period) -> DataFrame:
    return within_period(spark.read.parquet(path), "tpep_pickup_datetime", period)


def stage_zones(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema("LocationID string, Borough string, Zone string, service_zone string").csv(
        path, header=True
    )
    return raw.select(
        F.col("LocationID").try_cast("int").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        "service_zone",
    )


def _typed(raw: DataFrame, timestamp: str, types: dict[str, str]) -> DataFrame:
    """Cast text columns; a value that does not parse becomes NULL and is caught by the contract."""
    return raw.select(
        F.col(timestamp).try_cast("timestamp_ntz").alias("timestamp_hour"),
        *(F.col(c).try_cast("double").cast(t).alias(c) for c, t in types.items()),
    )


def stage_weather(spark: SparkSession, path: str) -> DataFrame:
    schema = ", ".join(f"{c} string" for c in ("time", *WEATHER_TYPES))
    return _typed(spark.read.schema(schema).csv(path, header=True), "time", WEATHER_TYPES)


def stage_subway(spark: SparkSession, path: str) -> DataFrame:
    types = {"total_ridership": "bigint", "total_transfers": "bigint"}
    schema = ", ".join(f"{c} string" for c in ("transit_timestamp", *types))
    return _typed(spark.read.schema(schema).csv(path, header=True), "transit_timestamp", types)


def subway_hourly_rollup(raw: DataFrame, period: Period) -> DataFrame:
    """Station-level rows of the subway mode summed to one row per timestamp."""
    subway = within_period(raw, "transit_timestamp", period).where(F.col("transit_mode") == "subway")
    return subway.groupBy(F.col("transit_timestamp").alias("timestamp_hour")).agg(
        F.sum("ridership").cast("bigint").alias("total_ridership"),
        F.sum("transfers").cast("bigint").alias("total_transfers"),
    )


def weather_payload_to_rows(spark: SparkSession, path: str) -> DataFrame:
    """One row per hour from a JSON object of parallel arrays."""
    fields = ", ".join(f"{c}: array<double>" for c in WEATHER_TYPES)
    payload = spark.read.schema(f"hourly struct<time: array<string>, {fields}>").json(path, multiLine=True)
    arrays = [F.col(f"hourly.{c}").alias(c) for c in ("time", *WEATHER_TYPES)]
    lists = payload.select(*arrays)
    return _typed(lists.select(F.inline(F.arrays_zip("time", *WEATHER_TYPES))), "time", WEATHER_TYPES)


def contract_report(
    df: DataFrame, key: str, non_negative: tuple[str, ...] = (), required: tuple[str, ...] = ()
) -> DataFrame:
    """Source contract as one row: row count, duplicate keys, NULL keys, NULL/negative measures."""
    missing = [c for c in (key, *non_negative, *required) if c not in df.columns]
    if missing:
        raise ValueError(f"source lacks columns {missing}")
    per_key = df.groupBy(key).agg(
        rows().alias("n"),
        *(count_where(F.col(c).isNull()).alias(f"null_{c}") for c in (*non_negative, *required)),
        *(count_where(F.col(c) < 0).alias(f"negative_{c}") for c in non_negative),
    )
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        count_where((F.col("n") > 1) & F.col(key).isNotNull()).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
        *(
            F.coalesce(F.sum(c), F.lit(0)).alias(c)
            for c in per_key.columns
            if c.startswith(("null_", "negative_"))
        ),
    )


def enforce_contract(report: DataFrame) -> dict:
    """Raise when a contract report shows an empty source or any violation."""
    row = report.first().asDict()
    broken = {k: v for k, v in row.items() if k != "row_count" and v}
    if not row["row_count"]:
        raise ValueError("source is empty")
    if broken:
        raise ValueError(f"source contract violated: {broken}")
    return row
