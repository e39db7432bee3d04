import numpy as np
import pandas as pd
import pytest

from curbflow.stats import gram
from curbflow.stats.design import CONST, Design
from curbflow.stats.ols import ols_family, vif


def frame_of(spark, x, y, parts):
    columns = {f"x{k}": x[:, k] for k in range(x.shape[1])}
    return spark.createDataFrame(pd.DataFrame({CONST: 1.0, **columns, "y": y})).repartition(parts)


def design_of(frame, k):
    return Design(frame=frame, terms=(CONST, *(f"x{i}" for i in range(k))), key="y")


@pytest.mark.parametrize("condition", (1e3, 1e9))
def test_ill_conditioned_fits_equal_numpy(spark, condition):
    rng = np.random.default_rng(1)
    common = rng.normal(size=3000)
    x = np.column_stack([common, common + rng.normal(size=3000) / condition, rng.normal(size=3000) * 1e6])
    y = 2 + x[:, 0] - 3 * x[:, 2] / 1e6 + rng.normal(size=3000)
    fit = ols_family(design_of(frame_of(spark, x, y, 7), 3), {"m": (CONST, "x0", "x1", "x2")})["m"]
    a = np.column_stack([np.ones(3000), x])
    unit = np.linalg.norm(a, axis=0)
    b, ssr, rank, _ = np.linalg.lstsq(a / unit, y, rcond=1e-14)
    b /= unit
    assert (fit.rank, fit.n) == (4, 3000) and rank == 4
    assert np.allclose(a @ fit.coefficients, a @ b, atol=1e-6)
    assert np.allclose(fit.coefficients, b, rtol=1e-3 if condition > 1e6 else 1e-8)
    assert np.isclose(fit.ssr, ssr[0], rtol=1e-9)
    assert np.isclose(fit.sst, ((y - y.mean()) ** 2).sum(), rtol=1e-9)
    r = np.linalg.qr(a, mode="r")
    assert np.allclose(np.sqrt(np.diag(fit.inverse)), np.linalg.norm(np.linalg.inv(r), axis=1), rtol=1e-4)


def test_a_large_mean_does_not_cancel(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 1)) + 1e7
    y = 1e8 + x[:, 0] + rng.normal(size=2000) / 100
    fit = ols_family(design_of(frame_of(spark, x, y, 3), 1), {"m": (CONST, "x0")})["m"]
    exact = np.polyfit(x[:, 0] - x.mean(), y - y.mean(), 1, full=True)
    assert np.isclose(fit.ssr, exact[1][0], rtol=1e-4) and np.isclose(fit.coefficients[1], exact[0][0], rtol=1e-6)


def test_dependent_terms_are_resolved_and_models_share_the_pass(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 2))
    x = np.column_stack([x, x[:, 0] + x[:, 1]])
    y = x[:, 0] + rng.normal(size=500)
    fits = ols_family(design_of(frame_of(spark, x, y, 5), 3), {"all": (CONST, "x0", "x1", "x2"), "two": (CONST, "x0", "x1")})
    assert (fits["all"].rank, fits["two"].rank) == (3, 3)
    assert np.isclose(fits["all"].ssr, fits["two"].ssr)


def test_merges_of_many_tasks_and_of_none(spark, monkeypatch):
    monkeypatch.setattr(gram, "FAN_IN", 3)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 2))
    frame = frame_of(spark, x, x[:, 0], 31)  # 31 tasks: 11 groups, then 4, which meet on the driver
    r, n = gram.triangle(frame, ("x0", "x1"))
    assert n == 400 and np.allclose(r.T @ r, x.T @ x)
    r, n = gram.triangle(frame.limit(0), ("x0", "x1"))
    assert n == 0 and not r.any()


def test_inflation_equals_the_auxiliary_regressions(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 3)) + 50
    x[:, 2] += x[:, 0]
    found = dict(vif(frame_of(spark, x, x[:, 0], 4), ("x0", "x1", "x2"), True))
    centred = x - x.mean(axis=0)
    for k in range(3):
        others = np.delete(centred, k, axis=1)
        rest = centred[:, k] - others @ np.linalg.lstsq(others, centred[:, k])[0]
        assert np.isclose(found[f"x{k}"], (centred[:, k] ** 2).sum() / (rest**2).sum(), rtol=1e-8)
