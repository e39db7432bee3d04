"""Numbers, lags and lag products over blocks against the plain sequence."""

import random
from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from curbflow.operators import series
from curbflow.stats import models

START = datetime(2024, 4, 1)


def sparse_hours(spark, n, seed=4):
    rng = random.Random(seed)
    hours = sorted(rng.sample(range(n * 3), n))
    rows = [(START + timedelta(hours=h), float(rng.randrange(100)) if rng.random() > 0.1 else None) for h in hours]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    return rows, spark.createDataFrame(shuffled, "pickup_hour timestamp_ntz, v double").repartition(5)


def test_lags_count_rows_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(series, "BLOCK_ROWS", 8)
    monkeypatch.setattr(series.numbered, "__defaults__", ("_i", 24))
    rows, df = sparse_hours(spark, 300)
    wanted = {f"v_{k}": ("v", k) for k in (1, 2, 24)}
    got = series.with_lags(df, "pickup_hour", wanted).orderBy("pickup_hour").collect()
    assert [r.pickup_hour for r in got] == [t for t, _ in rows]
    for i, r in enumerate(got):
        assert (r.v_1, r.v_2, r.v_24) == tuple(rows[i - k][1] if i >= k else None for k in (1, 2, 24))


def test_numbers_follow_the_time_with_missing_times_first(spark):
    df = spark.createDataFrame([(START + timedelta(days=400 * k),) for k in (2, 0, 1)] + [(None,)], "t timestamp_ntz")
    found = series.numbered(df, "t").orderBy("_i").collect()
    assert [r._i for r in found] == [0, 1, 2, 3] and found[0].t is None and found[1].t == START


def test_lag_products_equal_numpy(spark):
    rows, df = sparse_hours(spark, 3000, 7)
    df = df.fillna(0.0)
    d = np.array([v or 0.0 for _, v in rows])
    d -= d.mean()
    got = {r.lag: (r.product_sum, r.pairs) for r in models.lag_products(df, "v", 5).collect()}
    for k in range(6):
        assert np.isclose(got[k][0], (d[k:] * d[: len(d) - k]).sum()) and got[k][1] == len(d) - k


def test_a_long_series_is_spread_over_tasks(spark):
    """Two million hours: the largest block holds a small share, and the lagged sums are right."""
    n = 2_000_000
    first = "timestamp_ntz'0001-01-01 00:00:00'"
    df = spark.range(n, numPartitions=8).select(F.expr(f"timestampadd(HOUR, cast(id % 1000000 as int), {first})").alias("t"), "id").where("id < 1000000")
    lagged = series.with_lags(df, "t", {"back": ("id", 168)})
    found = lagged.agg(F.sum(F.col("id") - F.col("back")).alias("s"), F.count("back").alias("n"), F.count("*").alias("rows")).first()
    assert (found.rows, found.n, found.s) == (1_000_000, 1_000_000 - 168, 168 * (1_000_000 - 168))
    blocks = series.with_halo(series.numbered(df, "t"), 168).groupBy("_block").count().agg(F.max("count"), F.count("*")).first()
    assert blocks[0] <= 1024 + 168 and blocks[1] > 900
