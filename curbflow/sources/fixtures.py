"""The driver's tables mapped onto the four staging relations (see FIXTURES.md).

The joins carry no broadcast hints: Catalyst broadcasts a side only when its measured size is
under the threshold, and AQE splits a skewed key when a side has to be shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.config import DEFAULT, MobilityConfig
from curbflow.sources.staging import StagedInputs, subway_hourly_rollup, within_period


def _after_start(unit: str, amount: str) -> Column:
    return F.expr(f"timestampadd({unit}, {amount}, timestamp_ntz'2024-04-01 00:00:00')")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str, config: MobilityConfig = DEFAULT) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        F.expr("l_orderkey*7919 + l_linenumber*104729 + l_partkey*31").alias("key"),
    )
    order_origin = (
        _table(spark, sf_dir, "orders")
        .join(_table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "c_nationkey")
    )
    suppliers = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    keyed = lines.join(order_origin, F.col("l_orderkey") == F.col("o_orderkey")).join(
        suppliers, F.col("l_suppkey") == F.col("s_suppkey")
    )
    shaped = keyed.withColumns(
        {
            "second": F.expr(
                """cast(floor(key/86400) as bigint) % 91 * 86400 + case
                     when key%5=0 then 61200 + key%10800
                     when key%3=0 then 43200 + cast(floor((key%86400)/2) as bigint)
                     else key%86400 end"""
            ),
            "lasting": F.expr(
                """case when key%211=0 then -300 when key%199=0 then 0
                        when key%397=0 then 90000 else 120 + (key*13)%3600 end"""
            ),
            "fare": F.expr(
                """case when key%61=0 then -floor(l_extendedprice/10)/100
                        when key%67=0 then 0d else floor(l_extendedprice/10)/100 end"""
            ),
            "tip": F.expr("case when l_linenumber=1 then floor(l_extendedprice*l_tax/10)/100 else 0d end"),
        }
    )
    mapped = shaped.select(
        F.expr("cast(1 + l_suppkey%2 as int)").alias("VendorID"),
        _after_start("SECOND", "second").alias("tpep_pickup_datetime"),
        _after_start("SECOND", "second + lasting").alias("tpep_dropoff_datetime"),
        F.expr("case when key%23=0 then null else cast(l_quantity as bigint)%8 end").alias("passenger_count"),
        F.expr(
            """case when key%41=0 then 0d when key%503=0 then 250d when key%601=0 then null
                    when key%1009=0 then 600d else l_quantity/2 + l_discount*10 end"""
        ).alias("trip_distance"),
        F.expr("cast(1 + key%6 as bigint)").alias("RatecodeID"),
        F.expr("case when key%100=0 then 'Y' else 'N' end").alias("store_and_fwd_flag"),
        F.expr("cast(120 + c_nationkey as int)").alias("PULocationID"),
        F.expr("cast(120 + s_nationkey as int)").alias("DOLocationID"),
        F.expr("cast(l_linenumber%6 as bigint)").alias("payment_type"),
        F.col("fare").alias("fare_amount"),
        F.lit(1.0).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        F.col("tip").alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        F.expr("case when fare<0 then fare-5d when key%67=0 then 0d else fare+tip+5d end").alias("total_amount"),
        F.lit(2.5).alias("congestion_surcharge"),
        F.lit(0.0).alias("Airport_fee"),
    )
    return within_period(mapped, "tpep_pickup_datetime", config.period)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.expr("cast(120 + n_nationkey as int)").alias("location_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.expr(
            """case when n_nationkey in (12, 18) then 'Airports'
                    when n_regionkey < 2 then 'Yellow Zone' else 'Boro Zone' end"""
        ).alias("service_zone"),
    )


def weather(spark: SparkSession, config: MobilityConfig = DEFAULT) -> DataFrame:
    i = spark.range(config.period.hours).withColumnRenamed("id", "i")
    wet = "cast((i*7)%100 as double)/10d"
    return i.select(
        _after_start("HOUR", "i").alias("timestamp_hour"),
        F.expr("5d + cast((i*37)%280 as double)/10d").alias("temperature_2m"),
        F.expr("cast(30 + (i*11)%70 as int)").alias("relative_humidity_2m"),
        F.expr(f"case when i%9=0 then {wet} else 0d end").alias("precipitation"),
        F.expr(f"case when i%18=0 then {wet} else 0d end").alias("rain"),
        F.lit(0.0).alias("snowfall"),
        F.expr("cast((i*3)%80 as int)").alias("weather_code"),
        F.expr("cast((i*17)%300 as double)/10d").alias("wind_speed_10m"),
        F.expr("cast((i*29)%101 as int)").alias("cloud_cover"),
    )


def raw_subway(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(
        _after_start("HOUR", "o_orderkey%2184").alias("transit_timestamp"),
        F.expr("case when o_orderkey%10=0 then 'tram' else 'subway' end").alias("transit_mode"),
        F.expr("cast(floor(o_totalprice/100) as bigint)").alias("ridership"),
        F.expr("cast(o_custkey%50 as bigint)").alias("transfers"),
    )


def staged(spark: SparkSession, sf_dir: str, config: MobilityConfig = DEFAULT) -> StagedInputs:
    return StagedInputs(
        taxi_trips=trips(spark, sf_dir, config),
        taxi_zones=zones(spark, sf_dir),
        weather_hourly=weather(spark, config),
        subway_hourly=subway_hourly_rollup(raw_subway(spark, sf_dir), config.period),
    )
