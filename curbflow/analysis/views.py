"""Filtered views behind the interactive pages; every filter is a parameter."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbflow.functions.measures import count_where, percent, round_half_even, rows

# Preset windows and the days each one reaches back, the last day included.
DATE_PRESETS = {"Full period": None, "Past week": 7, "Past month": 30, "Past 3 months": 90}


# Mart -> column and direction it is listed by.
MART_ORDER = {
    "temporal_demand": ("pickup_hour", True),
    "geographic_performance": ("activity_rank", True),
    "fare_payment_analysis": ("total_amount", False),
    "weather_transit_analysis": ("pickup_hour", True),
    "statistical_analysis": ("pickup_hour", True),
}


def listed_mart(mart: DataFrame, name: str) -> DataFrame:
    column, ascending = MART_ORDER[name]
    return mart.orderBy(column, ascending=ascending)


def numbered_listing(mart: DataFrame, name: str, key: str) -> DataFrame:
    """The key and listed column of each row with its place in the listing, ties by key. Marts are small."""
    column, ascending = MART_ORDER[name]
    first = F.col(column).asc() if ascending else F.col(column).desc()
    place = F.row_number().over(Window.orderBy(first, key))
    return listed_mart(mart, name).select(key, column, place.alias("place"))


def filter_preset(df: DataFrame, preset: str) -> DataFrame:
    """Rows of the last days of the data; a window longer than the data keeps everything."""
    days = DATE_PRESETS[preset]
    if days is None:
        return df
    # the marts listed here have one row per hour of the period, so the latest day can ride along
    last = F.max("calendar_date").over(Window.partitionBy())
    return df.withColumn("_last", last).where(F.col("calendar_date") >= F.date_sub("_last", days - 1)).drop("_last")


def filter_dates(df: DataFrame, start: date | None, end: date | None) -> DataFrame:
    """Inclusive date range."""
    if start is not None:
        df = df.where(F.col("calendar_date") >= F.lit(start))
    if end is not None:
        df = df.where(F.col("calendar_date") <= F.lit(end))
    return df


def temporal_view(temporal: DataFrame, preset: str = "Full period", first_hour: int = 0, last_hour: int = 23,
                  start: date | None = None, end: date | None = None) -> DataFrame:
    chosen = filter_dates(filter_preset(temporal, preset), start, end)
    return chosen.where(F.col("hour_of_day").between(first_hour, last_hour))


def temporal_filtered_summary(view: DataFrame) -> DataFrame:
    return (
        view.groupBy("hour_of_day")
        .agg(
            round_half_even(F.avg("taxi_trip_count"), 0).alias("avg_trips"),
            F.sum("taxi_trip_count").alias("total_trips"),
            rows().alias("observations"),
        )
        .orderBy("hour_of_day")
    )


def temporal_extremes(view: DataFrame) -> DataFrame:
    """Busiest and quietest hour of the selection and the gap between them."""
    means = view.groupBy("hour_of_day").agg(F.avg("taxi_trip_count").alias("mean"))
    hour_and_mean = F.struct("hour_of_day", "mean")
    ends = means.agg(
        F.max_by(hour_and_mean, F.struct("mean", -F.col("hour_of_day"))).alias("peak"),
        F.min_by(hour_and_mean, F.struct("mean", -F.col("hour_of_day"))).alias("low"),
    )
    high, low = F.col("peak.mean"), F.col("low.mean")
    return ends.select(
        F.col("peak.hour_of_day").alias("peak_hour"), high.alias("peak_demand"),
        F.col("low.hour_of_day").alias("low_hour"), low.alias("low_demand"),
        F.when(low > 0, (high - low) / low * 100).otherwise(F.lit(0.0)).alias("demand_gap_pct"),
    )


def geography_view(geo: DataFrame, zones: DataFrame, borough: str | None = None,
                   service_zone: str | None = None) -> DataFrame:
    """Zones of a borough and/or service zone; the borough comes from the zone table."""
    named = geo.join(zones.select("location_id", "borough"), "location_id", "left")
    if borough is not None:
        named = named.where(F.col("borough") == borough)
    if service_zone is not None:
        named = named.where(F.col("service_zone") == service_zone)
    return named


def top_zones(view: DataFrame, n: int = 15) -> DataFrame:
    return (
        view.orderBy(F.desc("total_zone_activity"), "location_id")
        .limit(n)
        .select(
            "location_id", "zone", "service_zone", "total_zone_activity", "total_zone_revenue",
            "revenue_per_zone_activity", "zone_activity_contribution_pct", "zone_revenue_contribution_pct",
            "activity_rank", "revenue_rank", "activity_segment",
        )
    )


def low_activity_zones(view: DataFrame) -> DataFrame:
    return (
        view.where("below_median_activity_indicator")
        .orderBy("total_zone_activity", "location_id")
        .select(
            "location_id", "zone", "service_zone", "total_zone_activity", "total_zone_revenue",
            "zone_activity_contribution_pct", "zone_revenue_contribution_pct", "activity_segment",
        )
    )


def geography_kpis(view: DataFrame) -> DataFrame:
    lowest_id = -F.col("location_id")
    # one row per zone, so its place in the ranking can be a column
    place = F.row_number().over(Window.orderBy(F.desc("total_zone_activity"), "location_id"))
    return view.withColumn("_place", place).agg(
        F.max_by("zone", F.struct("total_zone_activity", lowest_id)).alias("top_activity_zone"),
        F.max("total_zone_activity").alias("top_activity"),
        F.max_by("zone", F.struct("total_zone_revenue", lowest_id)).alias("top_revenue_zone"),
        F.max("total_zone_revenue").alias("top_revenue"),
        count_where(F.col("below_median_activity_indicator")).alias("low_activity_zones"),
        F.sum(F.when(F.col("_place") <= 10, F.col("zone_activity_contribution_pct"))).alias("top_10_activity_share_pct"),
    )


def payment_view(payments: DataFrame, label: str | None = None) -> DataFrame:
    return payments if label is None else payments.where(F.col("payment_type_label") == label)


def revenue_by_payment_label(view: DataFrame) -> DataFrame:
    """Regrouped by label, which also guards against a label occurring twice."""
    return (
        view.groupBy("payment_type_label")
        .agg(F.sum("total_amount").alias("total_amount"), (rows() > 1).alias("is_duplicate_label"))
        .orderBy(F.desc("total_amount"))
    )


def payment_leader(view: DataFrame) -> DataFrame:
    return (
        view.orderBy(F.desc("amount_share_pct"), "payment_type")
        .limit(1)
        .select("payment_type_label", "amount_share_pct", "trip_share_pct")
    )


def weather_view(transit: DataFrame, category: str | None = None, start: date | None = None,
                 end: date | None = None) -> DataFrame:
    chosen = filter_dates(transit, start, end)
    return chosen if category is None else chosen.where(F.col("precipitation_category") == category)


def weather_evidence(view: DataFrame) -> DataFrame:
    """Observed hours and mean demand per category, beside the dry mean and the difference to it."""
    evidence = view.groupBy("precipitation_category").agg(
        rows().alias("hours"), F.max("category_avg_taxi_trips").alias("category_avg_taxi_trips")
    )
    mean = F.col("category_avg_taxi_trips")
    # a handful of categories: the dry one is looked up among them
    dry = F.max(F.when(F.col("precipitation_category") == "Dry", mean)).over(Window.partitionBy())
    return (
        evidence.withColumn("_dry", dry)
        .withColumn("vs_dry_pct", percent(mean - F.col("_dry"), F.col("_dry")))
        .drop("_dry")
        .orderBy(F.desc("hours"), "precipitation_category")
    )


MAP_METRICS = {
    "Trip Activity": "total_zone_activity",
    "Revenue": "total_zone_revenue",
    "Revenue per Activity": "revenue_per_zone_activity",
}


def map_values(geo: DataFrame, metric: str) -> DataFrame:
    """Value shown per zone: winsorised at 2% and 98% of the positive values when more than ten
    zones have one, or a 0/1 mark of below-median activity."""
    zones = Window.partitionBy()  # one row per zone
    if metric == "Low-Activity Zones":
        activity = F.col("total_zone_activity")
        marked = geo.withColumn("_median", F.median(activity).over(zones))
        return marked.select(
            "location_id",
            F.coalesce((activity < F.col("_median")) & (activity > 0), F.lit(False)).cast("double").alias("map_value"),
        )
    shown = geo.select("location_id", F.coalesce(F.col(MAP_METRICS[metric]).cast("double"), F.lit(0.0)).alias("v"))
    positive = F.when(F.col("v") > 0, F.col("v"))
    limits = {
        "n": F.count(positive).over(zones),
        "lower": F.percentile(positive, 0.02).over(zones),
        "upper": F.percentile(positive, 0.98).over(zones),
    }
    lower, upper = F.col("lower"), F.col("upper")
    clipped = F.least(F.greatest(F.col("v"), lower), upper)
    return shown.withColumns(limits).select(
        "location_id", F.when((F.col("n") > 10) & (upper > lower), clipped).otherwise(F.col("v")).alias("map_value")
    )
