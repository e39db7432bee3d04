"""Validation jobs. Each returns rows saying what was expected, found and whether it passed."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.functions import clock
from curbflow.functions.measures import count_where, rows
from curbflow.operators.duplicates import duplicate_groups, is_unique
from curbflow.operators.series import with_lags
from curbflow.operators.shaping import rows_from_columns, side_by_side
from curbflow.warehouse import Warehouse

TRIP_KEY = (
    "pickup_datetime", "dropoff_datetime", "vendor_id", "pickup_location_id", "dropoff_location_id",
    "passenger_count", "trip_distance", "total_amount",
)


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(rows().alias(name))


def _total(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.coalesce(F.sum(column), F.lit(0)).cast("bigint").alias(name))


def _verdicts(measures: DataFrame, checks: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    return rows_from_columns(
        measures,
        [
            {
                "check_name": F.lit(name),
                "expected": expected.cast("bigint"),
                "actual": actual.cast("bigint"),
                "passed": expected.cast("bigint").eqNullSafe(actual.cast("bigint")),
            }
            for name, (expected, actual) in checks.items()
        ],
    )


def expected_row_counts(w: Warehouse, expected: Mapping[str, int | DataFrame]) -> DataFrame:
    """Rows of each staged source against a number, or against the rows of a source it must agree with."""
    sources = {
        "taxi": w.inputs.taxi_trips, "zones": w.inputs.taxi_zones,
        "weather": w.inputs.weather_hourly, "subway": w.inputs.subway_hourly,
    }
    independent = {n: v for n, v in expected.items() if isinstance(v, DataFrame)}
    counts = side_by_side(
        *(_count(sources[n], n) for n in expected), *(_count(v, f"expected_{n}") for n, v in independent.items())
    )
    wanted = {n: F.col(f"expected_{n}") if n in independent else F.lit(v) for n, v in expected.items()}
    return _verdicts(counts, {n: (wanted[n], F.col(n)) for n in expected})


def layer_reconciliation(w: Warehouse) -> DataFrame:
    """Trips survive every layer: each layer's total equals the staged row count."""
    totals = w.measured(
        "staged", "trips_clean", "trip_metrics", "hourly_taxi_demand", "hourly_mobility", "hourly_mobility_summary",
        "od_flow", "airport_metrics", "fare_payment_metrics",
    )
    layers = ("clean", "metrics", "demand", "mobility", "summary", "od", "airport_categories", "payment_codes")
    return _verdicts(totals, {f"staged_to_{c}": (F.col("staged"), F.col(c)) for c in layers})


# Relation -> declared grain.
GRAINS = {
    "hourly_taxi_demand": ("pickup_hour", "pickup_location_id", "dropoff_location_id"),
    "hourly_spine": ("timestamp_hour",),
    "hourly_context": ("timestamp_hour",),
    "hourly_mobility": ("pickup_hour", "pickup_location_id", "dropoff_location_id"),
    "hourly_mobility_summary": ("pickup_hour",),
    "zone_performance": ("location_id",),
    "od_flow": ("pickup_location_id", "dropoff_location_id"),
    "fare_payment_metrics": ("payment_type", "payment_type_label"),
    "airport_metrics": ("airport_category",),
    "weather_mobility_metrics": ("pickup_hour",),
    "temporal_demand": ("pickup_hour",),
    "geographic_performance": ("location_id",),
    "fare_payment_analysis": ("payment_type",),
    "weather_transit_analysis": ("pickup_hour",),
    "statistical_analysis": ("pickup_hour",),
}


def grain_uniqueness(w: Warehouse, relations: tuple[str, ...] = tuple(GRAINS)) -> DataFrame:
    """Rows against distinct key tuples per relation; a tuple with NULL members counts."""
    parts = [
        is_unique(getattr(w, name).select(*GRAINS[name]), list(GRAINS[name])).select(
            F.lit(name).alias("relation"),
            F.lit(", ".join(GRAINS[name])).alias("grain"),
            "total_rows",
            "distinct_keys",
            (F.col("total_rows") == F.col("distinct_keys")).alias("passed"),
        )
        for name in relations
    ]
    return reduce(DataFrame.unionByName, parts)


def duplicate_trips(w: Warehouse, key: tuple[str, ...] = TRIP_KEY) -> DataFrame:
    """Trip groups sharing a key; the key is a parameter."""
    return duplicate_groups(w.trip_metrics, list(key))


# Counts of values outside their domain.
DOMAIN_COUNTS = (
    "non_positive_minutes", "negative_speed", "negative_tip_share", "negative_valid_revenue", "negative_zone_trips",
    "unmapped_zone_rows", "non_positive_od_trips",
)


def domain_checks(w: Warehouse) -> DataFrame:
    """Values outside their domain, per rule; zero is expected everywhere."""
    found = w.measured("trip_metrics", "zone_performance", "od_flow")
    return _verdicts(found, {c: (F.lit(0), F.col(c)) for c in DOMAIN_COUNTS})


def spine_coverage(w: Warehouse) -> DataFrame:
    """Hours missing from, or outside of, the spine for each hourly source (two-way anti-joins)."""
    spine = w.hourly_spine.select("timestamp_hour")
    hourly = {
        "weather": w.inputs.weather_hourly.select("timestamp_hour"),
        "subway": w.inputs.subway_hourly.select("timestamp_hour"),
        "taxi": w.hourly_taxi_demand.select(F.col("pickup_hour").alias("timestamp_hour")).distinct(),
    }
    counts = [
        part
        for name, hours in hourly.items()
        for part in (
            _count(spine.join(hours, "timestamp_hour", "left_anti"), f"missing_{name}_hours"),
            _count(hours.join(spine, "timestamp_hour", "left_anti"), f"extra_{name}_hours"),
        )
    ]
    found = side_by_side(*counts)
    return _verdicts(found, {c: (F.lit(0), F.col(c)) for c in found.columns})


def _unmapped(pairs: DataFrame, side: str, zones: DataFrame, name: str) -> DataFrame:
    ids = pairs.groupBy(F.col(f"{side}_location_id").alias("location_id")).agg(F.sum("trips").alias("trips"))
    return _total(ids.join(zones.select("location_id"), "location_id", "left_anti"), "trips", name)


def zone_mapping(w: Warehouse) -> DataFrame:
    """Trips whose zone ids are not in the zone table; pairs are looked up, not trips."""
    found = side_by_side(
        _unmapped(w.od_flow, "pickup", w.zones, "unmapped_pickup_trips"),
        _unmapped(w.od_flow, "dropoff", w.zones, "unmapped_dropoff_trips"),
    )
    return _verdicts(found, {c: (F.lit(0), F.col(c)) for c in found.columns})


def spine_gaps(spine: DataFrame) -> DataFrame:
    """Consecutive spine hours that are not one hour apart."""
    ordered = spine.select(F.col("timestamp_hour").alias("pickup_hour"))
    return with_lags(ordered, "pickup_hour", {"previous_hour": ("pickup_hour", 1)}).where(
        clock.elapsed_seconds(F.col("previous_hour"), F.col("pickup_hour")) != 3600
    )


def quality_suite(w: Warehouse) -> DataFrame:
    """The fifteen warehouse tests as (test_id, test_name, passed)."""
    layers = side_by_side(
        w.measured(
            "staged", "trips_clean", "trip_metrics", "hourly_taxi_demand", "hourly_mobility", "hourly_mobility_summary"
        ),
        _count(duplicate_trips(w), "duplicate_groups"),
        _unmapped(w.od_flow, "pickup", w.zones, "unmapped_pickup"),
        _unmapped(w.od_flow, "dropoff", w.zones, "unmapped_dropoff"),
        _count(spine_gaps(w.hourly_spine), "gaps"),
        w.hourly_context.agg(
            count_where(F.col("temperature_2m").isNull()).alias("no_weather"),
            count_where(F.col("total_ridership").isNull()).alias("no_subway"),
        ),
        w.hourly_mobility_summary.agg(F.count_distinct("pickup_hour").alias("summary_hours")),
    )
    c = F.col
    tests = [
        ("staging rows equal clean rows", c("staged") == c("clean")),
        ("clean rows equal metric rows", c("clean") == c("metrics")),
        ("no duplicate trip groups", c("duplicate_groups") == 0),
        ("every pickup zone is known", c("unmapped_pickup") == 0),
        ("every dropoff zone is known", c("unmapped_dropoff") == 0),
        ("spine has no gap", c("gaps") == 0),
        ("weather present in every hour", c("no_weather") == 0),
        ("ridership present in every hour", c("no_subway") == 0),
        ("demand keeps all trips", c("demand") == c("metrics")),
        ("mobility mart keeps all trips", c("mobility") == c("metrics")),
        ("hourly summary keeps all trips", c("summary") == c("metrics")),
        ("hourly summary has one row per hour", c("summary_rows") == c("summary_hours")),
        ("no negative valid revenue", c("negative_valid_revenue") == 0),
        ("derived minutes are positive", c("non_positive_minutes") == 0),
        ("tip share is not negative", c("negative_tip_share") == 0),
    ]
    return rows_from_columns(
        layers,
        [
            {"test_id": F.lit(f"DQ-TEST-{i:02d}"), "test_name": F.lit(name), "passed": F.coalesce(ok, F.lit(False))}
            for i, (name, ok) in enumerate(tests, 1)
        ],
    )


def enforce_suite(results: DataFrame) -> None:
    """Raise with the names of all failed tests."""
    failed = [f"{r.test_id} {r.test_name}" for r in results.where(~F.col("passed")).collect()]
    if failed:
        raise RuntimeError("quality suite failed: " + "; ".join(failed))


def mart_reconciliation(w: Warehouse) -> DataFrame:
    """Seven cross-mart checks as (check_name, expected, actual, status), values as text."""
    totals = side_by_side(
        w.measured(
            "staged", "trips_clean", "trip_metrics", "executive_mobility", "fare_payment_analysis", "temporal_demand",
            "geographic_performance",
        ),
        w.data_quality_metrics.select(F.col("warehouse_quality_status").alias("status_found")),
    )
    checks = {
        "staging_to_clean_rows": ("staged", "clean"),
        "clean_to_trip_metrics_rows": ("clean", "metrics"),
        "trip_metrics_to_total_trips": ("metrics", "kpi_trips"),
        "payment_mart_to_total_trips": ("metrics", "payment"),
        "temporal_mart_to_total_trips": ("metrics", "temporal"),
        "geographic_pickups_to_total_trips": ("metrics", "pickups"),
    }
    pairs = {n: (F.col(e).cast("string"), F.col(a).cast("string")) for n, (e, a) in checks.items()}
    pairs["warehouse_quality_status"] = (F.lit("PASS"), F.col("status_found"))
    return rows_from_columns(
        totals,
        [
            {
                "check_name": F.lit(name),
                "expected": expected,
                "actual": actual,
                "status": F.when(expected.eqNullSafe(actual), "PASS").otherwise("FAIL"),
            }
            for name, (expected, actual) in pairs.items()
        ],
    )


def post_conditions(w: Warehouse) -> DataFrame:
    """Conditions each analytical relation must meet once built."""
    found = side_by_side(
        w.measured(
            "fare_payment_metrics", "airport_metrics", "weather_mobility_metrics", "hourly_mobility_summary", "trip_metrics"
        ),
        w.weather_mobility_metrics.agg(F.count_distinct("pickup_hour").alias("weather_hours")),
        w.data_quality_metrics.agg(
            rows().alias("quality_rows"),
            count_where(F.col("warehouse_quality_status") == "PASS").alias("quality_pass"),
        ),
    )
    c, zero, one = F.col, F.lit(0), F.lit(1)
    return _verdicts(
        found,
        {
            "payment_metrics_not_empty": (one, F.when(c("payment_rows") > 0, 1).otherwise(0)),
            "payment_revenue_not_negative": (zero, c("negative_payment_revenue")),
            "airport_metrics_not_empty": (one, F.when(c("airport_rows") > 0, 1).otherwise(0)),
            "airport_trips_reconcile": (c("airport_trips"), F.coalesce(c("airport_mart_trips"), zero)),
            "airport_revenue_not_negative": (zero, c("negative_airport_revenue")),
            "weather_metrics_keep_hours": (c("summary_rows"), c("weather_rows")),
            "weather_metrics_unique_hours": (c("summary_rows"), c("weather_hours")),
            "weather_rain_flags_complete": (zero, c("bad_rain_flags")),
            "quality_metrics_one_row": (one, c("quality_rows")),
            "quality_status_is_pass": (one, c("quality_pass")),
        },
    )


# Shares of the quality metrics that must lie within 0 and 100.
BOUNDED_PERCENTAGES = (
    "pickup_zone_completeness_pct", "dropoff_zone_completeness_pct", "duration_validity_pct", "distance_validity_pct",
    "revenue_validity_pct", "passenger_validity_pct", "weather_completeness_pct", "subway_completeness_pct",
)


def metric_bounds(w: Warehouse) -> DataFrame:
    """Quality shares that are missing or outside 0 to 100, and demand rows with an hour outside 0 to 23."""
    outside = lambda c, low, high: ~F.coalesce(F.col(c).between(low, high), F.lit(False))
    shares = w.data_quality_metrics.agg(*(count_where(outside(c, 0, 100)).alias(c) for c in BOUNDED_PERCENTAGES))
    hours = w.temporal_demand.agg(count_where(outside("hour_of_day", 0, 23)).alias("hour_of_day"))
    found = side_by_side(shares, hours)
    return _verdicts(found, {f"{c}_out_of_bounds": (F.lit(0), F.col(c)) for c in found.columns})


# Columns the models need.
REGRESSION_COLUMNS = (
    "taxi_trip_count", "temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m",
    "cloud_cover", "subway_ridership", "subway_transfers", "day_of_week",
)


def regression_readiness(w: Warehouse, expected_hours: int, complete_columns: tuple[str, ...],
                         minimum_rows: int) -> DataFrame:
    """Row count, unique hours, NULLs per model column, and enough complete rows for the models."""
    base = w.statistical_analysis
    complete = F.lit(True)
    for column in complete_columns:
        complete = complete & F.col(column).isNotNull()
    found = base.agg(
        rows().alias("rows"),
        F.count_distinct("pickup_hour").alias("hours"),
        *(count_where(F.col(col).isNull()).alias(f"null_{col}") for col in REGRESSION_COLUMNS),
        count_where(complete).alias("complete"),
    )
    c = F.col
    return _verdicts(
        found,
        {
            "row_count": (F.lit(expected_hours), c("rows")),
            "unique_hours": (F.lit(expected_hours), c("hours")),
            **{f"no_null_{col}": (F.lit(0), c(f"null_{col}")) for col in REGRESSION_COLUMNS},
            "enough_complete_rows": (F.lit(1), F.when(c("complete") >= minimum_rows, 1).otherwise(0)),
        },
    )
