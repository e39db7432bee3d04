"""Common types of drifted files, and values that survive them."""

from curbflow.sources import drift


def test_common_types():
    assert drift.common_type(["int", "int"]) == "int" and drift.common_type(["int", "double"]) == "double"
    assert drift.common_type(["bigint", "int"]) == "bigint" and drift.common_type(["date", "timestamp_ntz"]) == "timestamp_ntz"
    assert drift.common_type(["bigint", "double"]) is None and drift.common_type(["string", "int"]) is None


def test_drifted_files_become_one_relation(spark, tmp_path):
    a = spark.createDataFrame([(1, 5, "x")], "id int, fare int, code string")
    b = spark.createDataFrame([(2, 5.5, 7)], "id int, fare double, code bigint")
    c = spark.createDataFrame([(3, "y")], "id int, code string")
    for name, df in {"a": a, "b": b, "c": c, "d": a}.items():
        df.coalesce(1).write.parquet(str(tmp_path / name))
    groups = drift.grouped_by_schema(spark, [str(tmp_path / n) for n in "abcd"])
    assert sorted(len(g.files) for g in groups) == [1, 1, 2]
    out = drift.reconciled(spark, groups)
    assert dict(out.dtypes) == {"id": "int", "fare": "double", "code": "string"}
    assert sorted((r.id, r.fare, r.code) for r in out.collect() if r.id != 3) == [(1, 5.0, "x"), (1, 5.0, "x"), (2, 5.5, "7")]
    assert out.where("id = 3").first().fare is None
    report = {(r.column_name, r.own_type): r.status for r in drift.drift_report(spark, groups).collect()}
    assert report == {
        ("id", "int"): "same", ("fare", "int"): "widened", ("fare", "double"): "same", ("fare", None): "missing",
        ("code", "string"): "conflict", ("code", "bigint"): "conflict",
    }
