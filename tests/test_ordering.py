from datetime import datetime, timedelta

import numpy as np
import pytest

from curbflow.operators import ordering

START = datetime(2024, 4, 1)


def deliver(path, values):
    path.write_text("ts\n" + "\n".join("n/a" if v is None else str(START + timedelta(hours=int(v))) for v in values) + "\n")


def read(spark, path, split=None):
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    return spark.read.schema("ts timestamp_ntz").csv(str(path), header=True)


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    yield "2000"
    for n, v in before.items():
        spark.conf.set(n, v)


def brute(values):
    late, latest, descents, last = [], None, 0, None
    for v in values:
        if v is None:
            continue
        if latest is not None and v < latest:
            late.append((v, latest))
        descents += last is not None and v < last
        last, latest = v, v if latest is None else max(v, latest)
    return descents, sorted(late)


def hours(t):
    return round((t - START) / timedelta(hours=1))


def test_rows_of_one_file(spark, tmp_path):
    deliver(tmp_path / "o.csv", (0, 1, 3, 2, 4))
    found = ordering.out_of_order_rows(read(spark, tmp_path / "o.csv"), "ts").collect()
    assert [(hours(r.value), hours(r.latest_before), r.position) for r in found] == [(2, 3, 3)]


@pytest.mark.parametrize("seed", range(3))
def test_several_splits_of_several_files(spark, tmp_path, small_splits, seed):
    rng = np.random.default_rng(seed)
    deliveries = {}
    for k in range(3):
        values = np.arange(900) + (rng.random(900) < 0.02) * rng.integers(-200, 200, 900)
        values = [None if x < 0.01 else int(v) for v, x in zip(values, rng.random(900))]
        deliveries[f"f{k}.csv"] = values
        deliver(tmp_path / f"f{k}.csv", values)
    df = read(spark, tmp_path, small_splits)
    splits = ordering.split_summaries(df, "ts").groupBy("file").count().collect()
    assert len(splits) == 3 and min(r["count"] for r in splits) > 3
    report = {r.file.rsplit("/", 1)[1]: r for r in ordering.order_report(df, "ts").collect()}
    late = {name: [] for name in deliveries}
    for r in ordering.out_of_order_rows(df, "ts").collect():
        late[r.file.rsplit("/", 1)[1]].append((hours(r.value), hours(r.latest_before)))
    for name, values in deliveries.items():
        descents, expected = brute(values)
        r, there = report[name], [v for v in values if v is not None]
        assert (r.descents, r.in_order) == (descents, descents == 0)
        assert (r.row_count, r.null_count) == (900, values.count(None))
        assert (hours(r["first"]), hours(r["last"]), hours(r.latest)) == (there[0], there[-1], max(there))
        assert sorted(late[name]) == expected


def test_a_descent_at_the_seam_of_two_splits(spark, tmp_path, small_splits):
    deliver(tmp_path / "s.csv", [*range(500, 1000), *range(500)])
    df = read(spark, tmp_path / "s.csv", small_splits)
    assert ordering.order_report(df, "ts").first().descents == 1
    assert ordering.out_of_order_rows(df, "ts").count() == 500


def test_empty_null_and_other_types(spark, tmp_path):
    spark.sql("select cast(null as date) d, 1 n where false").write.parquet(str(tmp_path / "none"))
    assert ordering.order_report(spark.read.parquet(str(tmp_path / "none")), "d").count() == 0
    spark.sql("select cast(null as date) d, 'x' s from range(3)").coalesce(1).write.parquet(str(tmp_path / "nulls"))
    nulls = spark.read.parquet(str(tmp_path / "nulls"))
    row = ordering.order_report(nulls, "d").first()
    assert (row.row_count, row.null_count, row["first"], row.descents, row.in_order) == (3, 3, None, 0, True)
    assert ordering.out_of_order_rows(nulls, "d", ("s",)).count() == 0
    with pytest.raises(TypeError, match="string"):
        ordering.order_report(nulls, "s")
    spark.range(5).selectExpr("date_add(date'2024-01-01', cast(5 - id as int)) d").coalesce(1).write.parquet(str(tmp_path / "down"))
    assert ordering.order_report(spark.read.parquet(str(tmp_path / "down")), "d").first().descents == 4
