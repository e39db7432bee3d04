"""Least squares and Newey-West inference from triangular factors."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.functions import tails
from curbflow.functions.measures import count_where, rows
from curbflow.operators.series import numbered, with_halo
from curbflow.stats import distributions as dist
from curbflow.stats.design import CONST, Design, Spec, complete_rows, design_matrix, term_names
from curbflow.stats.gram import solved, triangle

_FOUND = "model string, feature string, coefficient double, std_error double, statistic double, df double, quantile double"


def inference(found: DataFrame) -> DataFrame:
    """Rows of coefficients with p-values and intervals: Student t with df degrees of freedom, normal where df is null."""
    t, df, half = F.col("statistic"), F.col("df"), F.col("quantile") * F.col("std_error")
    p = F.when(df.isNull(), tails.normal_two_sided(t)).otherwise(tails.t_two_sided(t, F.coalesce(df, F.lit(1.0))))
    return found.withColumns(
        {"p_value": p, "ci_lower": F.col("coefficient") - half, "ci_upper": F.col("coefficient") + half}
    ).withColumn("significant_05", F.col("p_value") < 0.05).drop("df", "quantile")


def coefficient_table(spark: SparkSession, fits: list["Fit"], only: tuple[str, ...] | None = None) -> DataFrame:
    return inference(spark.createDataFrame([row for f in fits for row in f.coefficient_rows(only)], _FOUND))


@dataclass(frozen=True)
class Fit:
    """A fitted model: p-sized arrays and scalars only."""

    name: str
    terms: tuple[str, ...]
    coefficients: np.ndarray
    inverse: np.ndarray
    covariance: np.ndarray
    n: int
    rank: int
    ssr: float
    sst: float
    robust: bool = False

    @property
    def df_resid(self) -> int:
        return self.n - self.rank

    @property
    def r_squared(self) -> float:
        return 1.0 - self.ssr / self.sst if self.sst else math.nan

    @property
    def adjusted_r_squared(self) -> float:
        return 1.0 - (1.0 - self.r_squared) * (self.n - 1) / self.df_resid

    @property
    def f_statistic(self) -> float:
        """All terms but the constant against none; needs a constant and at least one other term."""
        explained = (self.sst - self.ssr) / (self.rank - 1) if self.rank > 1 else math.nan
        return explained / (self.ssr / self.df_resid)

    @property
    def _deviance(self) -> float:
        return self.n * (math.log(2.0 * math.pi) + 1.0 + math.log(self.ssr / self.n))

    @property
    def aic(self) -> float:
        return self._deviance + 2.0 * self.rank

    @property
    def bic(self) -> float:
        return self._deviance + math.log(self.n) * self.rank

    def coefficient_rows(self, only: tuple[str, ...] | None = None) -> list[tuple]:
        """Term, coefficient, standard error, statistic, and what its inference needs: Student t, or normal for a robust
        covariance."""
        df = None if self.robust else float(self.df_resid)
        quantile = dist.normal_quantile(0.975) if self.robust else dist.t_quantile(0.975, self.df_resid)
        out = []
        for i, (term, b) in enumerate(zip(self.terms, self.coefficients)):
            if only is None or term in only:
                se = math.sqrt(max(float(self.covariance[i, i]), 0.0))
                out.append((self.name, term, float(b), se, float(b) / se if se else math.nan, df, quantile))
        return out

    def predicted(self) -> Column:
        """Prediction as one codegen expression over the term columns."""
        parts = [F.col(t) * F.lit(float(b)) for t, b in zip(self.terms, self.coefficients)]
        return reduce(lambda a, b: a + b, parts)

    def with_residuals(self, design: Design) -> DataFrame:
        return design.frame.withColumn("prediction", self.predicted()).withColumn(
            "residual", F.col("y") - F.col("prediction")
        )


def ols_family(design: Design, models: dict[str, tuple[str, ...]]) -> dict[str, Fit]:
    """Several models over the same rows, each using a subset of the design's terms.

    One pass serves all of them: the triangular factor of terms, target and a column of ones stands for the rows, as
    orthogonal factors change neither coefficients nor lengths of residuals.
    """
    frame = design.frame.withColumn("_one", F.lit(1.0))
    factor, n = triangle(frame, (*design.terms, "y", "_one"))
    target, ones = factor[:, -2], factor[:, -1]
    fits = {}
    for name, terms in models.items():
        x = factor[:, [design.terms.index(t) for t in terms]]
        b, inverse, rank = solved(x, target)
        if n <= rank:
            raise ValueError(f"{name}: {n} rows cannot support {rank} terms")
        rest = target - x @ b
        ssr = float(rest @ rest)
        spread = target - ones * (ones @ target / n) if CONST in terms else target
        fits[name] = Fit(
            name=name,
            terms=terms,
            coefficients=b,
            inverse=inverse,
            covariance=inverse * (ssr / (n - rank)),
            n=n,
            rank=rank,
            ssr=ssr,
            sst=float(spread @ spread),
        )
    return fits


def ols(design: Design, name: str) -> Fit:
    return ols_family(design, {name: design.terms})[name]


def hac_meats(residuals: DataFrame, terms: tuple[str, ...], lags: tuple[int, ...], order: str) -> dict[int, np.ndarray]:
    """Bartlett-weighted long-run sums of score products, one matrix per lag choice, in one pass.

    The ordered series is cut into blocks of a few lag lengths, and each block receives a copy of
    the rows its lags reach back to. Blocks are independent tasks of bounded size; their matrices
    are summed by a shuffle on the cell number.
    """
    scores = residuals.select(order, F.col("residual").alias("_u"), *terms)
    blocked = with_halo(numbered(scores, order), max(lags)).drop(order)
    upper = np.triu_indices(len(terms))

    def partial(block):
        block = block.sort_values("_i")
        g = block[list(terms)].to_numpy(dtype=float) * block["_u"].to_numpy(dtype=float)[:, None]
        t = np.arange(len(g), dtype=float)[:, None]
        plain = np.vstack([np.zeros(g.shape[1]), np.cumsum(g, axis=0)])
        indexed = np.vstack([np.zeros(g.shape[1]), np.cumsum(t * g, axis=0)])
        own = block["_own"].to_numpy(dtype=bool)
        now = np.arange(len(g))
        cells = []
        for lag in lags:
            since = np.maximum(now - lag, 0)
            width = lag + 1.0
            # sum over the lag's frame of (1 - (t-j)/width) * g_j, from two running sums
            z = (1.0 - t / width) * (plain[now] - plain[since]) + (indexed[now] - indexed[since]) / width
            across = g[own].T @ z[own]
            cells.append((g[own].T @ g[own] + across + across.T)[upper])
        return pd.DataFrame({"lag": list(lags), "cells": cells})

    parts = blocked.groupBy("_block").applyInPandas(partial, "lag int, cells array<double>")
    summed = (
        parts.select("lag", F.posexplode("cells").alias("cell", "v"))
        .groupBy("lag", "cell")
        .agg(F.sum("v").alias("total"))
    )
    meats = {lag: np.zeros((len(terms), len(terms))) for lag in lags}
    for r in summed.collect():
        i, j = upper[0][r.cell], upper[1][r.cell]
        meats[r.lag][i, j] = meats[r.lag][j, i] = r.total
    return meats


def with_hac(fit: Fit, design: Design, lags: tuple[int, ...]) -> dict[int, Fit]:
    """The same coefficients with Newey-West covariances and normal inference, per lag choice."""
    meats = hac_meats(fit.with_residuals(design), fit.terms, lags, design.key)
    return {
        lag: replace(fit, covariance=fit.inverse @ meat @ fit.inverse, robust=True) for lag, meat in meats.items()
    }


def fit_specs(df: DataFrame, specs: tuple[Spec, ...], levels: dict[str, list[int]]) -> dict[str, tuple[Fit, Design]]:
    """Fit each spec on its own complete rows, sharing passes among specs with the same rows."""

    def complete(columns: tuple[str, ...]) -> Column:
        return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))

    every = tuple(dict.fromkeys(c for s in specs for c in s.inputs))
    counts = df.agg(
        count_where(complete(every)).alias("shared"),
        *(count_where(complete(s.inputs)).alias(f"n_{k}") for k, s in enumerate(specs)),
    ).first()
    # A spec complete on as many rows as all specs together is complete on exactly those rows.
    together = [s for k, s in enumerate(specs) if counts[f"n_{k}"] == counts["shared"]]
    groups = ([together] if together else []) + [[s] for s in specs if s not in together]
    fitted: dict[str, tuple[Fit, Design]] = {}
    for group in groups:
        numeric = tuple(dict.fromkeys(c for s in group for c in s.continuous))
        calendar = tuple(dict.fromkeys(c for s in group for c in s.categorical))
        union = Spec("shared", numeric, calendar, group[0].target)
        design = design_matrix(complete_rows(df, union.inputs), union, known_levels=levels)
        fits = ols_family(design, {s.name: term_names(s, levels) for s in group})
        fitted |= {name: (fit, design) for name, fit in fits.items()}
    return {s.name: fitted[s.name] for s in specs}


def regression_metrics(predictions: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """MAE, RMSE and R2 of `y` against `prediction`; R2 is around the evaluated sample's own mean."""
    error = F.col("y") - F.col("prediction")
    return predictions.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (
            F.lit(1.0) - F.sum(error * error) / F.nullif(F.var_pop("y") * rows(), F.lit(0.0))
        ).alias("r2"),
    )


def vif(df: DataFrame, columns: tuple[str, ...], centred: bool) -> list[tuple[str, float]]:
    """Variance inflation from one triangular factor of the columns.

    Without a constant the auxiliary R2 is uncentred; with one it is centred.
    """
    names = (CONST, *columns) if centred else columns
    frame = df.withColumn(CONST, F.lit(1.0)) if centred and CONST not in df.columns else df
    factor, n = triangle(frame, names)
    _, inverse, _ = solved(factor, factor[:, 0])
    lengths = factor - np.outer(factor[:, 0], factor[:, 0] @ factor / n) if centred and n else factor
    factors = (lengths * lengths).sum(axis=0) * np.diag(inverse)
    return [(term, float(f)) for term, f in zip(names, factors) if term != CONST]
