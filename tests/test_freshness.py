"""Results follow the files, nothing stays persisted, and checks cost no further scan of the trips."""

import shutil

import pytest

import __spark_entry__ as entry
from curbflow.analysis import validation
from curbflow.plans import checks
from tests.conftest import SMALL

TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem")


@pytest.mark.parametrize("name", ["geographic_performance", "validate_layers", "profile_exact_duplicates"])
def test_a_rewritten_table_is_read_anew(spark, tmp_path, name):
    for table in TABLES:
        shutil.copy(f"{SMALL}/{table}.parquet", tmp_path / f"{table}.parquet")
    run = entry.queries()[name]
    figure = {
        "geographic_performance": lambda: sum(r.pickup_trips for r in run(spark, str(tmp_path)).collect()),
        "validate_layers": lambda: {r.actual for r in run(spark, str(tmp_path)).collect()},
        "profile_exact_duplicates": lambda: run(spark, str(tmp_path)).first()[0],
    }[name]
    before = figure()
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet").limit(1000)
    (tmp_path / "lineitem.parquet").unlink()
    lines.unionByName(lines.limit(10)).write.parquet(str(tmp_path / "lineitem.parquet"))
    after = figure()
    expected = {"geographic_performance": (6000, 1010), "validate_layers": ({6000}, {1010}), "profile_exact_duplicates": (0, 20)}
    assert (before, after) == expected[name]
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_checks_read_what_the_writes_observed(small_built):
    assert small_built.observed["trips_clean"] == {"clean": 6000}
    assert set(small_built.observed) >= set(checks.MEASURES)
    for suite in (validation.layer_reconciliation, validation.domain_checks, validation.zone_mapping, validation.mart_reconciliation,
                  validation.post_conditions, validation.grain_uniqueness, validation.metric_bounds):
        files = " ".join(suite(small_built).inputFiles())
        assert "trips_clean" not in files and "lineitem" not in files, suite.__name__


def test_observed_measures_equal_scanned_ones(small_built):
    scanned = small_built.with_staged_trips(small_built.inputs.taxi_trips)
    assert small_built.measured(*checks.MEASURES).first().asDict() == scanned.measured(*checks.MEASURES).first().asDict()


def test_trips_are_written_without_an_exchange(spark, make_warehouse, make_trips, tmp_path):
    make_trips({}, {"PULocationID": 3}).write.parquet(str(tmp_path / "staged"))
    built = make_warehouse(spark.read.parquet(str(tmp_path / "staged")))
    plan = built._observing("trips_clean", {})._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_quality_metrics_of_a_build_take_the_observed_staged_rows(small_built):
    raw = small_built.with_staged_trips(small_built.inputs.taxi_trips)
    built = small_built.with_staged_trips(small_built.inputs.taxi_trips)
    for name in small_built.written - {"data_quality_metrics"}:
        built.__dict__[name] = getattr(small_built, name)
    built.observed = dict(small_built.observed)
    files = " ".join(built.data_quality_metrics.inputFiles())
    assert "lineitem" not in files and "orders" not in files
    assert built.data_quality_metrics.first().staging_taxi_rows == raw.data_quality_metrics.first().staging_taxi_rows == 6000
