"""Registered queries: name -> function of a warehouse over the given tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow import pipeline as sinks
from curbflow.analysis import dictionary, findings, profiling, validation, views
from curbflow.config import Period
from curbflow.functions import clock
from curbflow.operators import ordering
from curbflow.operators.duplicates import duplicate_groups
from curbflow.plans import hourly, quality
from curbflow.session import scratch_dir
from curbflow.sources import drift, exchanges, fixtures, manifest, staging
from curbflow.stats import design, gram, models
from curbflow.warehouse import LAYERS, Warehouse, with_sources

# Doubles are rounded once, on the final rows, so that two engines' summation orders agree. The
# nudge moves exact ties (common in quotients by powers of two) off the rounding boundary.
DIGITS = 6
COARSER = {"executive_mobility": 4, "fare_payment_analysis": 4, "payment_view_of_a_label": 4}


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    nudge = 10.0 ** -(digits + 3)
    return df.select(
        *(F.round(F.col(c) + nudge, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes)
    )


def open_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(spark, fixtures.staged(spark, sf_dir))


# Layers that a validation looks at. They are written first, as a build does, and report what the checks ask for while
# they are written; small layers are then read back.
_DEMAND, _SUMMARY, _MOBILITY = "hourly_taxi_demand", "hourly_mobility_summary", "hourly_mobility"
_ZONES, _PAIRS = "zone_performance", "od_flow"
_MARTS = ("executive_mobility", "fare_payment_analysis", "temporal_demand", "geographic_performance")
BUILT_LAYERS: dict[str, tuple[str, ...]] = {
    "validate_domains": (_ZONES, _PAIRS),
    "validate_layers": (_DEMAND, _MOBILITY, _SUMMARY, _PAIRS, "airport_metrics", "fare_payment_metrics"),
    "validate_grains": tuple(validation.GRAINS),
    "validate_zone_mapping": (_PAIRS,),
    "validate_suite": (_DEMAND, _MOBILITY, _SUMMARY, _PAIRS, "hourly_context"),
    "validate_marts": (*_MARTS, "data_quality_metrics"),
    "validate_metric_bounds": ("data_quality_metrics", "temporal_demand"),
    "validate_post_conditions": (
        "fare_payment_metrics", "airport_metrics", "weather_mobility_metrics", _SUMMARY, "data_quality_metrics",
    ),
}


def written_layers(w: Warehouse, layers: tuple[str, ...]) -> Warehouse:
    """The warehouse with the given layers and their sources written to a folder of its own."""
    root = os.path.join(scratch_dir(w.spark), f"layers-{uuid.uuid4().hex}")
    return w.build(root, with_sources(layers)) if layers else w


QUERIES: dict[str, Callable[[Warehouse, str], DataFrame]] = {}


def query(name: str):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        return fn

    return register


def runnable() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(name, fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            w = written_layers(open_warehouse(spark, sf_dir), BUILT_LAYERS.get(name, ()))
            return rounded(fn(w, sf_dir), COARSER.get(name, DIGITS))

        return run

    return {name: bind(name, fn) for name, fn in QUERIES.items()}


# Relations registered as they stand; the spine is registered below over the observed hours.
for _name in LAYERS:
    if _name != "hourly_spine":
        QUERIES["taxi_trips_clean" if _name == "trips_clean" else _name] = (
            lambda w, sf_dir, _name=_name: getattr(w, _name)
        )


@query("stage_taxi_trips")
def _(w, sf_dir):
    return w.inputs.taxi_trips


@query("stage_taxi_zones")
def _(w, sf_dir):
    return w.inputs.taxi_zones


@query("subway_hourly_rollup")
def _(w, sf_dir):
    return w.inputs.subway_hourly


@query("hourly_spine")
def _(w, sf_dir):
    return hourly.observed_spine(w.trips_clean)


@query("hourly_mobility_rollup")
def _(w, sf_dir):
    return hourly.hourly_mobility_summary(w.hourly_mobility)


@query("quality_totals")
def _(w, sf_dir):
    return quality.quality_totals(w.data_quality_anomalies)


# --- analyses -------------------------------------------------------------------------------


@query("recommendation_sensitivity")
def _(w, sf_dir):
    return findings.recommendation_sensitivity(w.hourly_mobility_summary)


@query("anomaly_kpi_impact")
def _(w, sf_dir):
    return findings.anomaly_kpi_impact(w.trip_metrics)


@query("weekday_weekend")
def _(w, sf_dir):
    return findings.weekday_weekend(w.hourly_mobility_summary)


@query("weather_impact")
def _(w, sf_dir):
    return findings.weather_impact(w.hourly_mobility_summary)


@query("top_pickup_zones")
def _(w, sf_dir):
    return findings.top_pickup_zones(w.hourly_taxi_demand, w.zones)


@query("top_od_pairs")
def _(w, sf_dir):
    return findings.top_od_pairs(w.hourly_taxi_demand, w.zones)


@query("hourly_pattern")
def _(w, sf_dir):
    return findings.hourly_pattern(w.hourly_mobility_summary)


@query("peak_and_trough")
def _(w, sf_dir):
    return findings.peak_and_trough(findings.hourly_pattern(w.hourly_mobility_summary))


@query("weather_conditions")
def _(w, sf_dir):
    return findings.weather_conditions(w.hourly_mobility_summary)


@query("demand_distribution")
def _(w, sf_dir):
    return findings.demand_distribution(w.hourly_mobility_summary)


@query("payment_analysis_raw")
def _(w, sf_dir):
    return findings.payment_analysis_raw(w.trip_metrics)


@query("geographic_analysis_raw")
def _(w, sf_dir):
    return findings.geographic_analysis_raw(w.trip_metrics)


@query("pilot_sample_size")
def _(w, sf_dir):
    return findings.sample_size(dictionary.hourly_airport_trips(w.trip_metrics), "airport_trip_type", "trips", 0.05)


@query("temporal_filtered_summary")
def _(w, sf_dir):
    return views.temporal_filtered_summary(views.temporal_view(w.hourly_mobility_summary, "Past month", 6, 20))


@query("temporal_extremes")
def _(w, sf_dir):
    return views.temporal_extremes(views.temporal_view(w.hourly_mobility_summary, "Past 3 months"))


@query("geography_top_zones")
def _(w, sf_dir):
    return views.top_zones(views.geography_view(w.geographic_performance, w.zones), 15)


@query("geography_low_activity")
def _(w, sf_dir):
    return views.low_activity_zones(views.geography_view(w.geographic_performance, w.zones))


@query("geography_kpis")
def _(w, sf_dir):
    return views.geography_kpis(
        views.geography_view(w.geographic_performance, w.zones, service_zone="Boro Zone")
    )


@query("geography_borough_view")
def _(w, sf_dir):
    return views.geography_view(w.geographic_performance, w.zones, borough="ASIA")


@query("revenue_by_payment_label")
def _(w, sf_dir):
    return views.revenue_by_payment_label(views.payment_view(w.fare_payment_analysis))


@query("payment_leader")
def _(w, sf_dir):
    return views.payment_leader(views.payment_view(w.fare_payment_analysis))


@query("weather_evidence")
def _(w, sf_dir):
    return views.weather_evidence(
        views.weather_view(w.weather_transit_analysis, start=date(2024, 4, 15), end=date(2024, 6, 15))
    )


@query("map_values_revenue")
def _(w, sf_dir):
    return views.map_values(w.geographic_performance, "Revenue")


@query("map_values_low_activity")
def _(w, sf_dir):
    return views.map_values(w.geographic_performance, "Low-Activity Zones")


# --- dictionary metrics ---------------------------------------------------------------------


@query("metric_percentiles")
def _(w, sf_dir):
    return dictionary.metric_percentiles(w.trip_metrics)


@query("tip_percentiles")
def _(w, sf_dir):
    return dictionary.tip_percentiles(w.trip_metrics)


@query("valid_medians")
def _(w, sf_dir):
    return dictionary.valid_medians(w.trip_metrics)


@query("valid_payment_metrics")
def _(w, sf_dir):
    return dictionary.valid_payment_metrics(w.trip_metrics)


@query("top_hour_concentration")
def _(w, sf_dir):
    return dictionary.top_hour_concentration(w.hourly_mobility_summary)


@query("peak_window_share")
def _(w, sf_dir):
    return dictionary.peak_window_share(w.hourly_mobility_summary, 16, 20)


@query("taxi_subway_correlation")
def _(w, sf_dir):
    return dictionary.taxi_subway_correlation(w.hourly_mobility_summary)


@query("airport_peak_stability")
def _(w, sf_dir):
    return dictionary.airport_peak_stability(w.trip_metrics, 15, 20)


@query("airport_revenue_per_trip")
def _(w, sf_dir):
    return dictionary.airport_revenue_per_trip(w.trip_metrics)


@query("hour_volatility")
def _(w, sf_dir):
    return dictionary.hour_volatility(w.hourly_mobility_summary)


# --- profiles -------------------------------------------------------------------------------

_TRIP_PROFILES = {
    "profile_temporal_validity": profiling.temporal_validity,
    "profile_distance": profiling.distance_profile,
    "profile_fares": profiling.fare_profile,
    "profile_passengers": profiling.passenger_profile,
    "profile_unknown_overlap": profiling.unknown_overlap,
    "profile_exact_duplicates": profiling.exact_duplicates,
    "profile_extreme_distances": profiling.extreme_distance_records,
    "profile_negative_amounts": profiling.negative_amount_records,
    "profile_invalid_times": profiling.invalid_time_records,
    "profile_distance_by_unknowns": profiling.distance_by_unknowns,
    "profile_anomaly_subsets": profiling.anomaly_subset_profile,
    "profile_monthly_counts": profiling.monthly_counts,
    "profile_source_summary": profiling.source_summary,
}
for _name, _profile in _TRIP_PROFILES.items():
    QUERIES[_name] = lambda w, sf_dir, _profile=_profile: _profile(w.inputs.taxi_trips)


@query("profile_period_counts")
def _(w, sf_dir):
    # Order dates span years, so they exercise both sides of a period; the trips all lie inside theirs.
    orders = w.spark.read.parquet(f"{sf_dir}/orders.parquet")
    dated = orders.select(F.col("o_orderdate").cast("timestamp_ntz").alias("tpep_pickup_datetime"))
    return profiling.period_counts(dated, Period(datetime(1994, 1, 1), datetime(1995, 1, 1)))


@query("profile_trip_period_counts")
def _(w, sf_dir):
    return profiling.period_counts(w.inputs.taxi_trips, Period(datetime(2024, 4, 15), datetime(2024, 6, 1)))


@query("profile_payment_mix")
def _(w, sf_dir):
    return profiling.category_mix(w.inputs.taxi_trips, "payment_type")


@query("profile_vendor_mix")
def _(w, sf_dir):
    return profiling.category_mix(w.inputs.taxi_trips, "VendorID")


@query("profile_zone_validity")
def _(w, sf_dir):
    return profiling.zone_validity(w.inputs.taxi_trips, w.zones)


@query("profile_columns_subway")
def _(w, sf_dir):
    return profiling.column_profile(w.inputs.subway_hourly)


@query("profile_columns_trips")
def _(w, sf_dir):
    return profiling.column_profile(w.inputs.taxi_trips)


@query("profile_columns_weather")
def _(w, sf_dir):
    return profiling.column_profile(w.inputs.weather_hourly)


@query("profile_columns_zones")
def _(w, sf_dir):
    return profiling.column_profile(w.zones)


@query("profile_weather_codes")
def _(w, sf_dir):
    return profiling.category_mix(w.inputs.weather_hourly, "weather_code")


@query("profile_boroughs")
def _(w, sf_dir):
    return profiling.category_mix(w.zones, "borough")


@query("profile_ridership_summary")
def _(w, sf_dir):
    return findings.demand_distribution(w.inputs.subway_hourly, "total_ridership")


@query("profile_zone_duplicate_ids")
def _(w, sf_dir):
    return profiling.duplicate_key_count(w.zones, "location_id")


@query("profile_service_zones")
def _(w, sf_dir):
    return profiling.category_mix(w.zones, "service_zone")


@query("profile_event_steps")
def _(w, sf_dir):
    events = w.spark.read.parquet(f"{sf_dir}/events.parquet")
    return profiling.timestamp_steps(events.select(F.col("ts").cast("timestamp_ntz").alias("ts")), "ts")


@query("profile_subway_steps")
def _(w, sf_dir):
    return profiling.timestamp_steps(w.inputs.subway_hourly, "timestamp_hour")


# --- validation -----------------------------------------------------------------------------


@query("validate_expected_rows")
def _(w, sf_dir):
    read = lambda name: w.spark.read.parquet(f"{sf_dir}/{name}.parquet")
    ridden = read("orders").where("o_orderkey % 10 <> 0").select(F.expr("o_orderkey % 2184")).distinct()
    return validation.expected_row_counts(
        w, {"taxi": read("lineitem"), "zones": read("nation"), "weather": w.config.period.hours, "subway": ridden}
    )


_VALIDATIONS = {
    "validate_layers": validation.layer_reconciliation,
    "validate_grains": validation.grain_uniqueness,
    "validate_domains": validation.domain_checks,
    "validate_spine_coverage": validation.spine_coverage,
    "validate_zone_mapping": validation.zone_mapping,
    "validate_suite": validation.quality_suite,
    "validate_marts": validation.mart_reconciliation,
    "validate_metric_bounds": validation.metric_bounds,
    "validate_post_conditions": validation.post_conditions,
    "validate_duplicate_trips": validation.duplicate_trips,
}
for _name, _check in _VALIDATIONS.items():
    QUERIES[_name] = lambda w, sf_dir, _check=_check: _check(w)


@query("validate_duplicate_orders")
def _(w, sf_dir):
    # (order, line) repeats in the line items, so this key has duplicate groups to find.
    lines = w.spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return duplicate_groups(lines, ["l_orderkey", "l_linenumber"])


@query("validate_regression_base")
def _(w, sf_dir):
    return validation.regression_readiness(
        w, w.config.period.hours, ("taxi_trip_count_lag_168", "subway_ridership_lag_24"), w.config.minimum_model_rows
    )


@query("validate_subway_contract")
def _(w, sf_dir):
    return staging.contract_report(w.inputs.subway_hourly, "timestamp_hour", ("total_ridership", "total_transfers"))


@query("validate_order_of_orders")
def validate_order_of_orders(w: Warehouse, sf_dir: str) -> DataFrame:
    """Whether the delivered orders ascend by their key, and by their date; over all files of the table."""
    orders = w.spark.read.parquet(f"{sf_dir}/orders.parquet")

    def totals(column: str) -> DataFrame:
        return ordering.order_report(orders, column).agg(
            F.lit(column).alias("column_name"), F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
            F.sum("descents").alias("descents"), F.bool_and("in_order").alias("in_order"),
        )

    return totals("o_orderkey").unionByName(totals("o_orderdate"))


@query("out_of_order_orders")
def out_of_order_orders(w: Warehouse, sf_dir: str) -> DataFrame:
    """Orders dated before an order that was delivered earlier."""
    orders = w.spark.read.parquet(f"{sf_dir}/orders.parquet")
    return ordering.out_of_order_rows(orders, "o_orderdate", ("o_orderkey",)).select("o_orderkey", "value", "latest_before")


@query("validate_zone_contract")
def _(w, sf_dir):
    return staging.contract_report(w.zones, "location_id", required=("zone", "service_zone"))


# --- source files ---------------------------------------------------------------------------

_SOURCE_TABLES = [
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation",
    "orders", "pages", "part", "region", "supplier",
]


@query("source_manifest")
def _(w, sf_dir):
    return manifest.source_manifest(w.spark, sf_dir, _SOURCE_TABLES)


@query("source_rows_per_table")
def _(w, sf_dir):
    counts = [
        w.spark.read.parquet(f"{sf_dir}/{t}.parquet").agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(t).alias("table_name"), "row_count")
        for t in _SOURCE_TABLES
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


@query("read_trip_months")
def _(w, sf_dir):
    return exchanges.trips_from_months(w.spark, w.inputs.taxi_trips, Period(datetime(2024, 4, 15), datetime(2024, 6, 2, 12)))


def _drifted(w: Warehouse) -> list[drift.Group]:
    return drift.grouped_by_schema(w.spark, exchanges.drifted_months(w.spark, w.inputs.taxi_trips))


@query("read_drifted_months")
def _(w, sf_dir):
    return drift.reconciled(w.spark, _drifted(w))


@query("schema_drift_report")
def _(w, sf_dir):
    # the rows of each group beside its report tie the report to the files
    groups = _drifted(w)
    counts = [
        w.spark.read.schema(g.schema).parquet(*g.files).agg(F.lit(k).alias("schema_group"), F.count(F.lit(1)).alias("row_count"))
        for k, g in enumerate(groups)
    ]
    return drift.drift_report(w.spark, groups).join(reduce(DataFrame.unionByName, counts), "schema_group")


@query("read_zones_csv")
def _(w, sf_dir):
    return exchanges.zones_from_csv(w.spark, sf_dir)


@query("read_weather_csv")
def _(w, sf_dir):
    return exchanges.weather_from_csv(w.spark, sf_dir)


@query("read_weather_payload")
def _(w, sf_dir):
    return exchanges.weather_from_payload(w.spark, sf_dir)


@query("read_subway_csv")
def _(w, sf_dir):
    return exchanges.subway_from_csv(w.spark, sf_dir, w.config.period)


@query("result_through_csv")
def _(w, sf_dir):
    return exchanges.through_csv(findings.weather_conditions(w.hourly_mobility_summary), sinks.write_csv)


# Listed marts, with the place of each row in the listing.
for _mart, (_column, _ascending) in views.MART_ORDER.items():
    if _mart in ("geographic_performance", "fare_payment_analysis"):
        QUERIES[f"listed_{_mart}"] = lambda w, sf_dir, _mart=_mart: views.numbered_listing(
            getattr(w, _mart), _mart, {"geographic_performance": "location_id", "fare_payment_analysis": "payment_type"}[_mart]
        )


@query("payment_view_of_a_label")
def _(w, sf_dir):
    return views.payment_view(w.fare_payment_analysis, "Cash")


@query("weather_evidence_of_a_category")
def _(w, sf_dir):
    return views.weather_evidence(views.weather_view(w.weather_transit_analysis, "Dry", date(2024, 4, 15), date(2024, 6, 15)))


# --- linear models --------------------------------------------------------------------------

_REDUCED = "model_4_reduced"


def _prediction(name: str, job: Callable[[models.PredictionStudy], DataFrame]) -> None:
    QUERIES[name] = lambda w, sf_dir: job(models.PredictionStudy(w.statistical_analysis, w.config))


def _association(name: str, job: Callable[[models.AssociationStudy], DataFrame]) -> None:
    QUERIES[name] = lambda w, sf_dir: job(models.AssociationStudy(w.statistical_analysis))


def _reduced_design(study: models.PredictionStudy) -> DataFrame:
    spec = study.specs[_REDUCED]
    return design.design_matrix(study.hours, spec, known_levels=study.levels).frame


def _reduced_gram(study: models.PredictionStudy) -> DataFrame:
    spec = study.specs[_REDUCED]
    train = design.design_matrix(study.hours.where("is_train"), spec, known_levels=study.levels)
    return gram.named_cross_products(train.frame, (*train.terms, "y"))


_prediction("chronological_split", lambda s: s.hours.select("pickup_hour", "is_train"))
_prediction("design_matrix", _reduced_design)
_prediction("gram_matrix", _reduced_gram)
_prediction("model_coefficients", lambda s: s.coefficients())
_prediction("model_inference", lambda s: s.coefficients().select("model", "feature", "p_value", "ci_lower", "ci_upper", "significant_05"))
_prediction("model_fit_summary", lambda s: s.fit_summary())
_prediction("model_comparison", lambda s: s.comparison())
_prediction(
    "model_test_predictions",
    lambda s: s.test_errors(_REDUCED).select("pickup_hour", "taxi_trip_count", "prediction", "residual"),
)
_prediction("test_error_by_hour", lambda s: s.error_by(_REDUCED, "hour_of_day"))
_prediction("test_error_by_weekend", lambda s: s.error_by(_REDUCED, "is_weekend"))
_prediction("worst_predictions", lambda s: s.worst_predictions(_REDUCED))
_prediction("residual_diagnostics", lambda s: s.residual_diagnostics(_REDUCED))
_prediction("vif_reduced_model", lambda s: s.vif(_REDUCED))
_prediction("training_residuals", lambda s: s.training_residuals(_REDUCED))
_prediction("subway_residuals", lambda s: s.subway_residuals())
_prediction("subway_residual_correlation", lambda s: s.subway_residual_correlation())

_association("association_coefficients", lambda s: s.association_coefficients())
_association(
    "association_inference",
    lambda s: s.association_coefficients().select("model", "feature", "p_value", "ci_lower", "ci_upper", "significant_05"),
)
_association("association_comparison", lambda s: s.association_comparison())
_association("subway_lag_coefficients", lambda s: s.subway_lag_coefficients())
_association("demand_lag_comparison", lambda s: s.ladder_comparison())
_association("demand_lag_coefficients", lambda s: s.ladder_coefficients())
_association("hac_sensitivity", lambda s: s.hac_sensitivity())
_association("vif_ambient", lambda s: s.vif())
_association("diagnostic_coefficients", lambda s: s.diagnostic_coefficients())
_association("diagnostic_summary", lambda s: s.diagnostic_summary())
_association("residual_autocorrelation", lambda s: models.autocorrelation(s.diagnostic()[1], "residual"))
_association("residual_ljung_box", lambda s: models.ljung_box(s.diagnostic()[1], "residual"))
_association("residual_ljung_box_test", lambda s: models.ljung_box(s.diagnostic()[1], "residual"))
_association("lag_products", lambda s: models.lag_products(s.hours, "taxi_trip_count", 24))
