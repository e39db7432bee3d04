import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from curbflow.config import DEFAULT
from curbflow.sources import manifest, staging


def test_zone_csv(spark, tmp_path):
    (tmp_path / "zones.csv").write_text('LocationID,Borough,Zone,service_zone\n1,EWR,Newark Airport,EWR\nx,Q,"A, B",Boro\n')
    found = {r.zone: r.location_id for r in staging.stage_zones(spark, str(tmp_path / "zones.csv")).collect()}
    assert found == {"Newark Airport": 1, "A, B": None}


def test_weather_and_subway_csv_with_bad_numbers(spark, tmp_path):
    header = "time," + ",".join(staging.WEATHER_TYPES)
    (tmp_path / "w.csv").write_text(f"{header}\n2024-04-01T00:00,5.5,60,0.0,0.0,0.0,3,7.1,80\n2024-04-01T01:00,bad,61,,0,0,3,7,8\n")
    a, b = staging.stage_weather(spark, str(tmp_path / "w.csv")).orderBy("timestamp_hour").collect()
    assert a.timestamp_hour == datetime(2024, 4, 1) and (a.temperature_2m, a.cloud_cover) == (5.5, 80)
    assert b.temperature_2m is None and b.precipitation is None
    (tmp_path / "s.csv").write_text("transit_timestamp,total_ridership,total_transfers\n2024-04-01T00:00:00.000,12.0,3\n")
    r = staging.stage_subway(spark, str(tmp_path / "s.csv")).first()
    assert (r.timestamp_hour, r.total_ridership, r.total_transfers) == (datetime(2024, 4, 1), 12, 3)


def test_weather_payload(spark, tmp_path):
    hours = ["2024-04-01T00:00", "2024-04-01T01:00"]
    payload = {"hourly": {"time": hours, **{c: [i, i + 1] for i, c in enumerate(staging.WEATHER_TYPES)}}}
    (tmp_path / "p.json").write_text(json.dumps(payload, indent=1))
    a, b = staging.weather_payload_to_rows(spark, str(tmp_path / "p.json")).orderBy("timestamp_hour").collect()
    assert (a.temperature_2m, a.cloud_cover, b.relative_humidity_2m) == (0.0, 7, 2)
    assert b.timestamp_hour == datetime(2024, 4, 1, 1)


def test_rollup_keeps_the_period_and_mode(spark):
    rows = [
        (datetime(2024, 4, 1), "subway", 5, 1), (datetime(2024, 4, 1), "subway", 7, 0), (datetime(2024, 4, 1), "tram", 9, 9),
        (datetime(2024, 3, 31, 23), "subway", 1, 1), (datetime(2024, 7, 1), "subway", 1, 1),
    ]
    raw = spark.createDataFrame(rows, "transit_timestamp timestamp_ntz, transit_mode string, ridership bigint, transfers bigint")
    assert [tuple(r) for r in staging.subway_hourly_rollup(raw, DEFAULT.period).collect()] == [(datetime(2024, 4, 1), 12, 1)]


def test_period_filter_reaches_the_scan(spark, make_trips, tmp_path):
    make_trips({}, {"tpep_pickup_datetime": datetime(2024, 7, 1)}).write.parquet(str(tmp_path / "t"))
    staged = staging.stage_taxi_trips(spark, str(tmp_path / "t"), DEFAULT.period)
    assert staged.count() == 1
    plan = staged.select("VendorID")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in plan and ", Less" in plan
    assert "total_amount" not in plan


def test_contracts(spark):
    good = spark.createDataFrame([(1, 5), (2, 0)], "k int, v bigint")
    staging.enforce_contract(staging.contract_report(good, "k", ("v",)))
    bad = spark.createDataFrame([(1, -5), (1, None), (None, 1)], "k int, v bigint")
    report = staging.contract_report(bad, "k", ("v",)).first().asDict()
    assert report == {"row_count": 3, "duplicate_keys": 1, "null_keys": 1, "null_v": 1, "negative_v": 1}
    with pytest.raises(ValueError, match="violated"):
        staging.enforce_contract(staging.contract_report(bad, "k", ("v",)))
    with pytest.raises(ValueError, match="empty"):
        staging.enforce_contract(staging.contract_report(good.limit(0), "k"))
    with pytest.raises(ValueError, match="lacks"):
        staging.contract_report(good, "k", ("missing",))


def test_manifest_and_fingerprint(spark, tmp_path):
    found = {r.file_name: r for r in manifest.source_manifest(spark, SMALL, ["nation", "orders"], "2024-04").collect()}
    with open(f"{SMALL}/nation.parquet", "rb") as f:
        content = f.read()
    nation = found["nation.parquet"]
    assert nation.sha256 == hashlib.sha256(content).hexdigest() and nation.file_size_bytes == len(content)
    assert nation.row_count == 25 and "n_name" in nation.columns
    spark.range(3).write.parquet(str(tmp_path / "a"))
    spark.range(3).write.parquet(str(tmp_path / "b"))
    spark.range(3).select(F.col("id").cast("int")).write.parquet(str(tmp_path / "c"))
    prints = {r.file_name: r.schema_fingerprint for r in manifest.schema_drift(spark, [str(tmp_path / x) for x in "abc"]).collect()}
    assert prints["a"] == prints["b"] != prints["c"]
    assert manifest.files_in_scan(spark.read.parquet(f"{SMALL}/nation.parquet")).count() == 1
    assert manifest.describe(spark.range(1)).collect()[0].column_name == "id"
