from datetime import datetime

import pytest

from curbflow import pipeline
from curbflow.analysis import findings, profiling, validation, views
from curbflow.config import DEFAULT


def test_suite_passes_except_for_missing_ridership(small_built):
    found = {r.test_id: r.passed for r in validation.quality_suite(small_built).collect()}
    assert len(found) == 15
    assert [t for t, ok in found.items() if not ok] == ["DQ-TEST-08"]
    with pytest.raises(RuntimeError, match="DQ-TEST-08"):
        validation.enforce_suite(validation.quality_suite(small_built))


def test_duplicate_trip_fails_the_suite(make_trips, make_warehouse):
    w = make_warehouse(make_trips({}, {}, {"PULocationID": 77}))
    failed = {r.test_name for r in validation.quality_suite(w).collect() if not r.passed}
    assert {"no duplicate trip groups", "every pickup zone is known"} <= failed
    assert [r.row_count for r in validation.duplicate_trips(w).collect()] == [2]


def test_layers_and_grains_hold(small_built):
    assert all(r.passed for r in validation.layer_reconciliation(small_built).collect())
    assert all(r.passed for r in validation.grain_uniqueness(small_built).collect())
    assert all(r.passed for r in validation.zone_mapping(small_built).collect())


def test_spine_gap_is_found(spark):
    spine = spark.createDataFrame([(datetime(2024, 4, 1, h),) for h in (0, 1, 3)], "timestamp_hour timestamp_ntz")
    assert [r.pickup_hour.hour for r in validation.spine_gaps(spine).collect()] == [3]


def test_expected_counts_are_parameters(small_built):
    found = validation.expected_row_counts(small_built, {"taxi": 6000, "zones": 26}).collect()
    assert {r.check_name: r.passed for r in found} == {"taxi": True, "zones": False}


def test_exact_duplicates_count_every_copy(make_trips):
    assert profiling.exact_duplicates(make_trips({}, {}, {"VendorID": 2})).first()[0] == 2


def test_timestamp_steps_cross_days_and_count_repeats(spark):
    hours = [datetime(2024, 4, 1, 22), datetime(2024, 4, 1, 23), datetime(2024, 4, 2, 0), datetime(2024, 4, 4, 0), datetime(2024, 4, 4, 0)]
    df = spark.createDataFrame([(h,) for h in hours], "t timestamp_ntz")
    found = {r.step_seconds: r.occurrences for r in profiling.timestamp_steps(df, "t").collect()}
    assert found == {3600.0: 2, 172800.0: 1, 0.0: 1}


def test_zone_validity_counts_missing_ids(make_trips, make_warehouse):
    w = make_warehouse(make_trips({}, {"PULocationID": None}, {"DOLocationID": 99}))
    r = profiling.zone_validity(w.inputs.taxi_trips, w.zones).first()
    assert (r.total_rows, r.invalid_pickup_zone, r.invalid_dropoff_zone) == (3, 1, 1)


def test_sensitivity_handles_any_windows(small_built):
    r = findings.recommendation_sensitivity(small_built.hourly_mobility_summary, (("all", 0, 24),)).first()
    assert r.outside_window_avg_hourly_trips is None and r.demand_lift_pct is None and r.window_total_trips == 6000


def test_date_presets_clamp_to_the_data(small_built):
    days = {
        p: views.temporal_view(small_built.temporal_demand, p).select("calendar_date").distinct().count()
        for p in ("Full period", "Past week", "Past 3 months")
    }
    assert days == {"Full period": 91, "Past week": 7, "Past 3 months": 90}


def test_listed_marts_follow_their_order(small_built):
    amounts = [r.total_amount for r in views.listed_mart(small_built.fare_payment_analysis, "fare_payment_analysis").collect()]
    assert amounts == sorted(amounts, reverse=True)
    ranks = [r.activity_rank for r in views.listed_mart(small_built.geographic_performance, "geographic_performance").collect()]
    assert ranks == sorted(ranks)


def test_map_values_clip_only_with_enough_zones(spark):
    rows = [(i, i, float(i), 1.0) for i in range(1, 13)]
    geo = spark.createDataFrame(rows, "location_id int, total_zone_activity bigint, total_zone_revenue double, revenue_per_zone_activity double")
    many = {r.location_id: r.map_value for r in views.map_values(geo, "Revenue").collect()}
    assert many[1] == pytest.approx(1.22) and many[12] == pytest.approx(11.78)
    few = {r.location_id: r.map_value for r in views.map_values(geo.limit(5), "Revenue").collect()}
    assert few == {i: float(i) for i in range(1, 6)}


def test_pipeline_writes_layers_and_results(spark, make_trips, make_warehouse, tmp_path):
    weather = [(datetime(2024, 4, 1, 10), 10.0, 50, 0.0, 0.0, 0.0, 1, 5.0, 10)]
    w = make_warehouse(make_trips({}, {"payment_type": 2}), weather=weather, subway=[(datetime(2024, 4, 1, 10), 9, 1)])
    built = pipeline.run(w, str(tmp_path / "warehouse"), str(tmp_path / "results"), enforce=False, models=False)
    assert built.executive_mobility.first().total_trips == 2
    back = spark.read.csv(str(tmp_path / "results" / "anomaly_kpi_impact"), header=True)
    assert back.count() == 2 and "trip_retention_pct" in back.columns
    with pytest.raises(RuntimeError):
        pipeline.run(w, str(tmp_path / "w2"), str(tmp_path / "r2"), enforce=True, models=False)
    assert DEFAULT.period.hours == 2184
