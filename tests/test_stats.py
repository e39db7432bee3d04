import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbflow.functions import tails
from curbflow.registry import open_warehouse
from curbflow.stats import distributions as dist
from curbflow.stats.design import Spec, all_levels, chronological_split, complete_rows, design_matrix
from curbflow.stats.models import (
    ASSOCIATION_SPECS, AssociationStudy, PredictionStudy, autocorrelation, lag_products, ljung_box,
)
from curbflow.stats.ols import ols, regression_metrics, vif, with_hac
from tests.conftest import MEDIUM


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stats") / "base")
    open_warehouse(spark, MEDIUM).statistical_analysis.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def association(base):
    return AssociationStudy(base)


def numpy_design(design):
    pdf = design.frame.toPandas().sort_values(design.key)
    return pdf[list(design.terms)].to_numpy(), pdf["y"].to_numpy()


def brute_hac(x, u, lags):
    g = x * u[:, None]
    meat = g.T @ g
    for lag in range(1, lags + 1):
        product = g[lag:].T @ g[:-lag]
        meat += (1 - lag / (lags + 1)) * (product + product.T)
    inverse = np.linalg.inv(x.T @ x)
    return inverse @ meat @ inverse


def test_distribution_tails():
    # Published table entries.
    assert abs(dist.t_quantile(0.975, 10) - 2.228138852) < 1e-8
    assert abs(dist.t_quantile(0.975, 1) - 12.7062047362) < 1e-8


def tail_values(spark, expression):
    return spark.range(1).select(expression).first()[0]


def test_tails_as_expressions(spark):
    lit = lambda v: F.lit(float(v))
    value = lambda e: tail_values(spark, e)
    assert abs(value(tails.t_two_sided(lit(2.0), lit(5))) - 0.1019394788) < 1e-9
    assert abs(value(tails.chi_square_tail(lit(3.841458821), lit(1))) - 0.05) < 1e-9
    assert abs(value(tails.chi_square_tail(lit(18.307038053), lit(10))) - 0.05) < 1e-9
    assert abs(value(tails.chi_square_tail(lit(1.0), lit(2))) - math.exp(-0.5)) < 1e-12
    assert abs(value(tails.normal_two_sided(lit(1.959963984540054))) - 0.05) < 1e-11
    assert value(tails.t_two_sided(lit(40.0), lit(1576))) < 1e-200
    assert abs(value(tails.f_tail(lit(4.0), lit(1), lit(7))) - value(tails.t_two_sided(lit(2.0), lit(7)))) < 1e-12
    assert math.isnan(value(tails.t_two_sided(lit("nan"), lit(7))))
    for df in (1, 3, 30, 1600):
        for t in (0.0, 0.3, 1.0, 5.0):
            assert abs(value(tails.t_two_sided(lit(t), lit(df))) - dist.t_two_sided(t, df)) < 1e-10
    for z in (0.0, 0.5, 1.0, 3.0, 8.0):
        assert abs(value(tails.normal_two_sided(lit(z))) - math.erfc(z / math.sqrt(2))) < 1e-11


def test_ljung_box_of_a_constant_or_empty_series(spark):
    rows = [(datetime(2024, 4, 1) + timedelta(hours=k), 5.0) for k in range(10)]
    constant = spark.createDataFrame(rows, "pickup_hour timestamp_ntz, residual double")
    assert [(r.lag, r.lb_stat, r.lb_pvalue) for r in ljung_box(constant, "residual", (1, 2)).collect()] in ([(1, None, None), (2, None, None)], [(2, None, None), (1, None, None)])
    assert ljung_box(constant.where("false"), "residual", (1, 2)).collect() == []



def test_ols_matches_numpy(base):
    spec = Spec("m", ("taxi_trip_count_lag_1", "temperature_2m", "precipitation"), ("hour_of_day", "day_of_week"))
    design = design_matrix(complete_rows(base, spec.inputs), spec)
    fit = ols(design, "m")
    x, y = numpy_design(design)
    b, *_ = np.linalg.lstsq(x, y, rcond=None)
    u = y - x @ b
    assert np.allclose(fit.coefficients, b, rtol=1e-7, atol=1e-9)
    assert fit.n == len(y) and fit.rank == x.shape[1]
    assert abs(fit.ssr - u @ u) < 1e-6 * (u @ u)
    se = np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * (u @ u) / (len(y) - x.shape[1]))
    assert np.allclose(np.sqrt(np.diag(fit.covariance)), se, rtol=1e-7)
    assert abs(fit.r_squared - (1 - u @ u / ((y - y.mean()) ** 2).sum())) < 1e-10
    expected_aic = len(y) * (math.log(2 * math.pi) + 1 + math.log(u @ u / len(y))) + 2 * x.shape[1]
    assert abs(fit.aic - expected_aic) < 1e-6
    residual = fit.with_residuals(design).agg(F.sum("residual"), F.max(F.abs("residual"))).first()
    assert abs(residual[0]) < 1e-6 and abs(residual[1] - abs(u).max()) < 1e-7


@pytest.mark.parametrize("lags", [1, 24, 168])
def test_hac_matches_a_direct_lag_loop(association, lags):
    spec = ASSOCIATION_SPECS[2]
    fit, design = association.fit(spec)[spec.name]
    robust = with_hac(fit, design, (lags,))[lags]
    pdf = design.frame.toPandas().sort_values(design.key)
    x, y = pdf[list(fit.terms)].to_numpy(), pdf["y"].to_numpy()
    assert np.allclose(robust.covariance, brute_hac(x, y - x @ fit.coefficients, lags), rtol=1e-6, atol=1e-13)


def test_hac_blocks_cover_series_longer_than_one_block(spark):
    rng = np.random.default_rng(5)
    n, lags = 3000, 6
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.normal(size=n), rng.normal(size=n)))]
    df = spark.createDataFrame(rows, "pickup_hour int, x double, taxi_trip_count double").repartition(5)
    spec = Spec("s", ("x",))
    design = design_matrix(df, spec)
    fit = ols(design, "s")
    x, y = numpy_design(design)
    assert np.allclose(
        with_hac(fit, design, (lags,))[lags].covariance, brute_hac(x, y - x @ fit.coefficients, lags), rtol=1e-9
    )


def test_vif_equals_auxiliary_regressions(base):
    columns = ("subway_ridership", "temperature_2m", "taxi_trip_count_lag_1")
    complete = complete_rows(base, columns)
    x = complete.select(*columns).toPandas().to_numpy(dtype=float)
    for centred in (True, False):
        found = dict(vif(complete, columns, centred))
        for j, name in enumerate(columns):
            others = np.delete(x, j, axis=1)
            if centred:
                others = np.column_stack([np.ones(len(x)), others])
            r = x[:, j] - others @ np.linalg.lstsq(others, x[:, j], rcond=None)[0]
            spread = ((x[:, j] - x[:, j].mean()) ** 2).sum() if centred else (x[:, j] ** 2).sum()
            assert abs(found[name] / (spread / (r @ r)) - 1) < 1e-8


def test_rank_deficient_design_is_reported_and_still_predicts(spark):
    rows = [(i, float(i), 2.0 * i, 3.0 + i) for i in range(50)]
    df = spark.createDataFrame(rows, "pickup_hour int, a double, b double, taxi_trip_count double")
    fit = ols(design_matrix(df, Spec("d", ("a", "b"))), "d")
    assert fit.rank == 2
    x = np.column_stack([np.ones(50), np.arange(50), 2.0 * np.arange(50)])
    assert np.allclose(x @ fit.coefficients, 3.0 + np.arange(50), atol=1e-6)


def test_too_few_rows_are_refused(spark, base):
    df = spark.createDataFrame([(1, 1.0, 2.0)], "pickup_hour int, a double, taxi_trip_count double")
    with pytest.raises(ValueError, match="cannot support"):
        ols(design_matrix(df, Spec("d", ("a",))), "d")
    with pytest.raises(ValueError, match="too few"):
        PredictionStudy(base.limit(300))


def test_split_is_chronological_and_floors(spark):
    df = spark.createDataFrame([(i,) for i in (5, 3, 9, 1, 7, 2, 8)], "pickup_hour int")
    train = [r.pickup_hour for r in chronological_split(df, 0.2).where("is_train").collect()]
    assert sorted(train) == [1, 2, 3, 5, 7]


def test_levels_drop_the_first_in_numeric_order(spark):
    df = spark.createDataFrame([(1, 10, 0.0), (2, 9, 1.0), (3, 10, 2.0)], "pickup_hour int, hour_of_day int, taxi_trip_count double")
    assert all_levels(df, ("hour_of_day",)) == {"hour_of_day": [9, 10]}
    assert design_matrix(df, Spec("s", (), ("hour_of_day",))).terms == ("const", "hour_of_day_10")
    with pytest.raises(ValueError, match="declared"):
        all_levels(df, ("pickup_hour",))


def test_metrics_use_the_samples_own_mean(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 3.0), ("b", 5.0, 5.0)], "g string, y double, prediction double")
    found = {r.g: (r.mae, r.rmse, r.r2) for r in regression_metrics(df, ("g",)).collect()}
    assert found["a"] == (0.5, math.sqrt(0.5), 0.5)
    assert found["b"] == (0.0, 0.0, None)


def test_serial_diagnostics_match_numpy(spark):
    rng = np.random.default_rng(11)
    e = np.convolve(rng.normal(size=403), [1, 0.6, 0.3, 0.1])[:400]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(e)], "pickup_hour int, residual double").repartition(3)
    acf = {r.lag: r.autocorrelation for r in autocorrelation(df, "residual", (1, 3, 24)).collect()}
    for k, value in acf.items():
        assert abs(value - np.corrcoef(e[k:], e[:-k])[0, 1]) < 1e-12
    d = e - e.mean()
    products = {r.lag: (r.product_sum, r.pairs) for r in lag_products(df, "residual", 12).collect()}
    for k in range(13):
        assert abs(products[k][0] - d[k:] @ d[: len(d) - k]) < 1e-9 and products[k][1] == 400 - k
    rho = [(d[k:] @ d[: len(d) - k]) / (d @ d) for k in range(7)]
    q = 400 * 402 * sum(rho[k] ** 2 / (400 - k) for k in range(1, 7))
    found = {r.lag: r for r in ljung_box(df, "residual", (1, 6)).collect()}
    assert abs(found[6].lb_stat - q) < 1e-8
    assert abs(found[6].lb_pvalue - tail_values(spark, tails.chi_square_tail(F.lit(float(q)), F.lit(6.0)))) < 1e-12
