import json
import os
import subprocess
import sys

from pyspark.sql import functions as F

from curbflow import warehouse
from curbflow.functions.measures import mean_where
from curbflow.session import with_settings

# Writes the clean trips in a session of its own, whose event log shows the plans of its writes.
BUILD = """
import sys
from curbflow.registry import open_warehouse
from curbflow.session import build_session

spark = build_session("writes", "local[2]", **{
    "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2", "spark.eventLog.enabled": "true",
    "spark.eventLog.dir": sys.argv[2], "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
w = open_warehouse(spark, sys.argv[1])
built = w.build(sys.argv[3], ("trips_clean",))
assert sorted(built.trips_clean.collect(), key=str) == sorted(w.trips_clean.collect(), key=str)
spark.stop()
"""


def test_trips_are_written_by_month_without_a_sort_of_wide_rows(tmp_path):
    log, root = tmp_path / "log", tmp_path / "warehouse"
    log.mkdir()
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run(
        [sys.executable, "-c", BUILD, "/root/testdata/sf0.001", str(log), str(root)],
        check=True, timeout=300, env={**os.environ, "PYTHONPATH": repo},
    )
    events = [json.loads(line) for file in log.iterdir() for line in file.open()]
    writes = [e["physicalPlanDescription"] for e in events if "InsertIntoHadoopFs" in e.get("physicalPlanDescription", "")]
    assert writes and not any("ASC NULLS FIRST" in plan for plan in writes)
    assert len([p for p in (root / "trips_clean").iterdir() if p.name.startswith("pickup_month=")]) == 3


def test_settings_return_after_the_block(spark):
    known, unset = "spark.sql.shuffle.partitions", "spark.curbflow.unknown"
    before = spark.conf.get(known)
    with with_settings(spark, {known: "3", unset: "1"}):
        assert (spark.conf.get(known), spark.conf.get(unset)) == ("3", "1")
    assert spark.conf.get(known) == before and spark.conf.get(unset, None) is None


def test_layers_are_read_in_small_splits_while_a_build_runs(spark, make_trips, make_warehouse, tmp_path, monkeypatch):
    key, seen, write = "spark.sql.files.maxPartitionBytes", {}, warehouse._write_layer

    def noting(root, name, df):
        seen[name] = spark.conf.get(key)
        write(root, name, df)

    monkeypatch.setattr(warehouse, "_write_layer", noting)
    before = spark.conf.get(key)
    built = make_warehouse(make_trips({}, {"PULocationID": 3})).build(str(tmp_path), ("trips_clean", "hourly_taxi_demand"))
    assert seen == {"trips_clean": "32m", "hourly_taxi_demand": "32m"} and spark.conf.get(key) == before
    assert built.hourly_taxi_demand.count() == 2


def test_demand_means_need_no_buffers_of_their_own(make_trips, make_warehouse):
    absent = {"passenger_count": None, "fare_amount": None, "total_amount": None, "trip_distance": None, "tpep_dropoff_datetime": None}
    w = make_warehouse(make_trips(
        {}, {"fare_amount": 7.0, "passenger_count": 4, "total_amount": 9.5}, {"fare_amount": None}, {"total_amount": -3.0},
        {"trip_distance": 0.0}, absent, {**absent, "PULocationID": 3}, {"PULocationID": 3, "passenger_count": 0, "fare_amount": None},
    ))
    keys = ("pickup_hour", "pickup_location_id", "dropoff_location_id")
    means = {
        "avg_total_amount": ("revenue", "total_amount"), "avg_fare_amount": ("revenue", "fare_amount"),
        "avg_distance": ("distance", "trip_distance"), "avg_duration_seconds": ("duration", "duration_seconds"),
        "avg_passenger_count": ("passenger", "passenger_count"),
    }
    expected = w.trips_clean.groupBy(*keys).agg(
        *(mean_where(F.col(f"is_{m}_valid"), F.col(value)).alias(name) for name, (m, value) in means.items())
    )
    found = w.hourly_taxi_demand.select(*keys, *means)
    assert found.schema.simpleString() == expected.schema.simpleString()
    assert sorted(found.collect(), key=str) == sorted(expected.collect(), key=str)
    assert "avg(" not in w.hourly_taxi_demand._jdf.queryExecution().optimizedPlan().toString()
