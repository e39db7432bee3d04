import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curbflow.operators.duplicates import duplicate_groups, duplicate_row_count, is_unique
from curbflow.operators import quantiles
from curbflow.operators.quantiles import Quantile, exact_quantiles

PROBABILITIES = (0.0, 0.02, 0.5, 0.9, 0.99, 1.0)


def quantile_table(df, by):
    wanted = [Quantile(f"q{int(p * 100)}", F.col("v"), p) for p in PROBABILITIES]
    return {
        r[0] if by else None: [r[f"q{int(p * 100)}"] for p in PROBABILITIES]
        for r in exact_quantiles(df, by, wanted).collect()
    }


def test_quantiles_match_numpy_with_a_hot_group_and_hot_value(spark):
    rng = random.Random(3)
    data = [("hot", round(rng.gauss(20, 15), 2)) for _ in range(3000)]
    data += [("hot", 0.0)] * 1500 + [(None, rng.expovariate(0.1)) for _ in range(500)]
    data += [("one", 7.5), ("wide", 1e300), ("wide", -1e300), ("wide", 1e-300), ("none", None)]
    df = spark.createDataFrame(data, "k string, v double").repartition(7)
    found = quantile_table(df, ["k"])
    for key in ("hot", None, "one", "wide"):
        values = [v for k, v in data if k == key and v is not None]
        assert np.allclose(found[key], np.quantile(values, PROBABILITIES), rtol=1e-12, atol=0), key
    assert found.get("none") in (None, [None] * len(PROBABILITIES))


def test_global_quantiles_of_several_metrics(spark):
    df = spark.range(1, 1002).select((F.col("id") % 100).cast("double").alias("v"), F.col("id").cast("double").alias("w"))
    row = exact_quantiles(
        df, [], [Quantile("a", F.col("v")), Quantile("b", F.col("w")), Quantile("c", F.col("w"), 0.95)]
    ).first()
    ids = np.arange(1, 1002)
    assert (row.a, row.b, row.c) == (np.median(ids % 100), np.median(ids), np.quantile(ids, 0.95))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=40))
def test_quantiles_of_any_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = exact_quantiles(df, [], [Quantile("m", F.col("v"))]).first()
    assert np.isclose(row.m, np.median(np.array(values, dtype=float)), rtol=1e-12, atol=1e-30)


def test_many_distinct_tiny_values_of_one_group_spread_over_buckets(spark):
    """200,000 distinct values below 0.0005: no bucket of the first level holds more than a few percent of them."""
    df = spark.range(200_000).select(((F.col("id") + 1) * 2.4e-9).alias("v"))
    assert quantile_table(df, [])[None] == pytest.approx(list(np.quantile((np.arange(200_000) + 1) * 2.4e-9, PROBABILITIES)), rel=1e-12)


def test_quantiles_of_neighbouring_and_infinite_doubles(spark):
    values = [1.0]
    for _ in range(300):
        values.append(float(np.nextafter(values[-1], 2)))
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert quantile_table(df, [])[None] == list(np.quantile(values, PROBABILITIES))
    edges = spark.createDataFrame([(float("-inf"),), (5e-324,), (float("inf"),)], "v double")
    assert exact_quantiles(edges, [], [Quantile("m", F.col("v"))]).first().m == 5e-324


def test_quantiles_are_exact_where_the_sketch_is_far_off(spark, monkeypatch):
    def misled(rows, request):
        """Brackets above all values in one group, below all in another, around the wrong ranks in a third."""
        off = {"above": (2e9, 3e9), "below": (-9.0, -8.0), "wrong": (4.0, 5.0), "right": (0.0, 1e6), None: (7.5, 7.5)}
        n = len(request.metric_of)
        return rows.sparkSession.createDataFrame(
            [(k, [lo] * n, [hi] * n) for k, (lo, hi) in off.items()], "_k0 string, _lo array<double>, _hi array<double>"
        )

    monkeypatch.setattr(quantiles, "_brackets", misled)
    rng = random.Random(9)
    data = [(k, rng.uniform(0, 1000)) for k in ("above", "below", "wrong", "right", None) for _ in range(400)]
    df = spark.createDataFrame(data, "k string, v double").repartition(5)
    found = quantile_table(df, ["k"])
    for key in {k for k, _ in data}:
        values = [v for k, v in data if k == key]
        assert np.allclose(found[key], np.quantile(values, PROBABILITIES), rtol=1e-12, atol=0), key


def test_quantiles_of_more_groups_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "_GROUPS", 3)
    df = spark.range(700).selectExpr("case when id % 7 = 6 then null else id % 7 end as k", "cast(id * id as double) as v")
    found = quantile_table(df, ["k"])
    assert len(found) == 7
    for key in (None, 0, 1, 5):
        values = [float(i * i) for i in range(700) if i % 7 == (6 if key is None else key)]
        assert np.allclose(found[key], np.quantile(values, PROBABILITIES), rtol=1e-12), key


def test_nan_is_the_largest_value(spark):
    nan = float("nan")
    data = [("some", 1.0), ("some", 2.0), ("some", nan), ("some", nan), ("some", nan), ("all", nan), ("none", None)]
    df = spark.createDataFrame(data, "k string, v double")
    found = {r.k: (r.a, r.b) for r in exact_quantiles(df, ["k"], [Quantile("a", F.col("v"), 0.25), Quantile("b", F.col("v"), 0.75)]).collect()}
    assert found["some"][0] == 2.0 and np.isnan(found["some"][1]) and np.isnan(found["all"][0])
    assert found.get("none") in (None, (None, None))


def test_duplicates_under_forced_collisions(spark):
    data = [(k % 40, str(k % 7)) for k in range(90)]
    df = spark.createDataFrame(data, "x int, z string")
    brute = {k: data.count(k) for k in set(data) if data.count(k) > 1}
    for hash_of in (lambda *_: F.lit(5).cast("long"), lambda x, z: F.col(x).cast("long") % 3, F.xxhash64):
        assert {(r.x, r.z): r.row_count for r in duplicate_groups(df, ["x", "z"], hash_of=hash_of).collect()} == brute


def test_duplicates_need_equal_keys_not_equal_hashes(spark):
    data = [(1, None, "a"), (None, 1, "a"), (1, None, "a"), (2, 2, "b"), (2, 2, "b"), (2, 2, "b"), (3, 3, None)]
    df = spark.createDataFrame(data, "x int, y int, z string")
    found = {(r.x, r.y, r.z): r.row_count for r in duplicate_groups(df, ["x", "y", "z"]).collect()}
    # NULL keys group like values; an anti-case would be two different tuples hashing alike
    brute = {k: data.count(k) for k in set(data) if data.count(k) > 1}
    assert found == brute
    assert duplicate_row_count(df).first()[0] == sum(brute.values())
    unique = is_unique(df, ["x", "y"]).first()
    assert (unique.total_rows, unique.distinct_keys) == (7, 4)
