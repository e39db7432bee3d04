"""Cross-product matrices and triangular factors as Spark jobs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cross_products(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rows (i, j, total) of the upper triangle of X'X.

    Each task folds its Arrow batches into one triangle; the triangles are summed by a shuffle on
    the cell number, so neither rows nor partial matrices gather in one place.
    """
    upper = np.triu_indices(len(columns))

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(columns), len(columns)))
        for batch in batches:
            x = batch.to_numpy(dtype=float)
            total += x.T @ x
        yield pd.DataFrame({"cells": [total[upper]]})

    cells = df.select(*columns).mapInPandas(partial, "cells array<double>")
    summed = cells.select(F.posexplode("cells").alias("cell", "v")).groupBy("cell").agg(F.sum("v").alias("total"))
    rows_of, cols_of = (F.array(*(F.lit(int(k)) for k in axis)) for axis in upper)
    return summed.select(
        F.element_at(rows_of, F.col("cell") + 1).alias("i"),
        F.element_at(cols_of, F.col("cell") + 1).alias("j"),
        "total",
    )


def named_cross_products(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    names = F.array(*map(F.lit, columns))
    return cross_products(df, columns).select(
        F.element_at(names, F.col("i") + 1).alias("term_i"),
        F.element_at(names, F.col("j") + 1).alias("term_j"),
        "total",
    )


#: Triangles merged in one group of a round.
FAN_IN = 256


def _triangle(x: np.ndarray) -> np.ndarray:
    """R of a QR factorisation, padded with zero rows to a square."""
    r = np.linalg.qr(x, mode="r")
    return np.vstack([r, np.zeros((x.shape[1] - len(r), x.shape[1]))])


def triangle(df: DataFrame, columns: tuple[str, ...]) -> tuple[np.ndarray, int]:
    """R with R'R = X'X over all rows, and their number. X'X itself is never formed, so nothing cancels that
    orthogonal factors would keep.

    Each task factors its rows batch by batch; the triangles of FAN_IN tasks are stacked and factored again, and so are the
    triangles of FAN_IN such groups. The driver receives one triangle per FAN_IN**2 tasks. No rows give zeros. Rows with a
    null have to be dropped before (`complete_rows`)."""
    width = len(columns)
    kind = "block bigint, n bigint, cells array<double>"

    def row(block: int, n: int, r: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"block": [block], "n": [n], "cells": [r.ravel()]})

    def stack(parts: pd.DataFrame) -> np.ndarray:
        return _triangle(np.concatenate([np.asarray(c).reshape(width, width) for c in parts["cells"]]))

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r, n, block = np.zeros((width, width)), 0, 0
        for batch in batches:
            if len(batch):
                block = int(batch["_task"].iloc[0])
                r = _triangle(np.vstack([r, batch[list(columns)].to_numpy(dtype=float)]))
                n += len(batch)
        if n:
            yield row(block, n, r)

    def merge(parts: pd.DataFrame) -> pd.DataFrame:
        return row(int(parts["block"].iloc[0]) // FAN_IN, int(parts["n"].sum()), stack(parts))

    parts = df.select(*columns, F.spark_partition_id().alias("_task")).mapInPandas(partial, kind)
    for _ in range(2):
        parts = parts.groupBy(F.floor(F.col("block") / FAN_IN)).applyInPandas(merge, kind)
    last = parts.toPandas()
    if not len(last):
        return np.zeros((width, width)), 0
    return stack(last), int(last["n"].sum())


def solved(r: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Least-squares solution of r b = z, (r'r)^-1 and the rank; dependent terms are resolved, not dropped.

    Terms are scaled to unit length first, so that the rank test compares like with like.
    """
    scale = np.sqrt((r * r).sum(axis=0))
    scale[scale == 0] = 1.0
    u, values, vt = np.linalg.svd(r / scale, full_matrices=False)
    kept = values > values.max(initial=0.0) * len(values) * 1e-12
    half = vt[kept].T / values[kept]
    b = (half @ (u[:, kept].T @ z)) / scale
    return b, (half @ half.T) / np.outer(scale, scale), int(kept.sum())
