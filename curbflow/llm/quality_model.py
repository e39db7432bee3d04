"""Quality scores from a regularised quadratic discriminant.

Each class has a Gaussian over transformed document statistics, its covariance shrunk towards a scaled identity. A score is
the posterior of the good class, from the difference of the two log densities; Cholesky factors are computed once and
kept with the model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm.quality_rules import MEASURES, measure
from curbflow.llm.tables import fold, table, written

STATISTICS = (
    "log_words", "word_length", "symbols", "repeated_lines", "repeated_words", "line_length", "exclamations",
    "letter_words", "upper_case", "stutters", "distinct_words", "bars",
)


@dataclass(frozen=True)
class Settings:
    """shrinkage: weight of the scaled identity against a class's own covariance. prior: share of the good class
    before a text is seen; None takes it from the labels."""

    shrinkage: float = 0.1
    prior: float | None = None


@dataclass
class Gaussian:
    mean: np.ndarray
    factor: np.ndarray  # lower Cholesky factor of the shrunk covariance
    log_det: float

    def log_density(self, x: np.ndarray) -> np.ndarray:
        """Up to a constant that all classes share: minus half the squared Mahalanobis distance and log determinant."""
        whitened = np.linalg.solve(self.factor, (x - self.mean).T)
        return -0.5 * ((whitened**2).sum(axis=0) + self.log_det)


@dataclass
class Model:
    centre: np.ndarray
    scale: np.ndarray
    bad: Gaussian | None
    good: Gaussian | None
    log_prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.bad is None or self.good is None:
            odds = np.full(len(x), self.log_prior)
        else:
            z = (x - self.centre) / self.scale
            odds = self.good.log_density(z) - self.bad.log_density(z) + self.log_prior
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of one whole text, in the order of STATISTICS. Rates get half a count more, so that
    empty texts are defined and rare marks don't make a column constant."""
    m = dict(zip(MEASURES, measure(text), strict=True))
    raw = (text or "").encode("utf-8", "surrogatepass")
    words, lines, chars = m["n_words"], m["n_lines"], len(raw)
    upper = chars - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    lowered = raw.lower().split()
    stutters = sum(map(bytes.__eq__, lowered, lowered[1:]))
    rate = lambda n, of: float(np.log((n + 0.5) / (of + 10)))
    return [
        float(np.log1p(words)),
        float(np.log((m["word_chars"] + 5) / (words + 1))),
        rate(m["n_symbols"], words),
        rate(m["n_dup_lines"], lines),
        rate(m["n_repeat_words"], words),
        float(np.log((words + 1) / (lines + 1))),
        rate(m["n_exclaims"], words),
        float(np.log((m["n_letter_words"] + 1) / (words + 1))),
        rate(upper, m["word_chars"]),
        rate(stutters, words),
        float(np.log((len(set(lowered)) + 1) / (words + 1))),
        rate(raw.count(b"|"), words),
    ]


def described(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, x0, x1 ...): the statistics of every whole text, in one pass without a shuffle."""
    names = [f"x{k}" for k in range(len(STATISTICS))]
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([statistics(t.as_py()) for t in batch.column(1)]).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, found.T.copy())], names=["doc_id", *names])

    schema = ", ".join([f"doc_id {id_type}", *(f"{n} double" for n in names)])
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def moments(labelled: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Per label: rows, means and covariance of x0, x1 ..., from sums over all rows."""
    names = [f"x{k}" for k in range(len(STATISTICS))]
    pairs = list(combinations_with_replacement(range(len(names)), 2))
    sums = [F.sum(F.col(n)) for n in names] + [F.sum(F.col(names[i]) * F.col(names[j])) for i, j in pairs]
    out = {}
    for row in labelled.groupBy("label").agg(F.count(F.lit(1)), *sums).collect():  # one row per label
        n, first, second = row[1], np.array(row[2 : 2 + len(names)]), row[2 + len(names) :]
        mean, cov = first / row[1], np.zeros((len(names), len(names)))
        for (i, j), s in zip(pairs, second, strict=True):
            cov[i, j] = cov[j, i] = s / n - mean[i] * mean[j]
        out[int(row[0])] = (n, mean, cov)
    return out


def fit(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """A model of rows (label 0 or 1, x0, x1 ...). If one class has no row, every score is the share of the good
    class with half a row added to each; without any row it is 0.5."""
    found = moments(labelled)
    n_bad, n_good = (found.get(k, (0,))[0] for k in (0, 1))
    share = (n_good + 0.5) / (n_bad + n_good + 1) if settings.prior is None else settings.prior
    log_prior = float(np.log(share / (1 - share)))
    d = len(STATISTICS)
    if not n_bad or not n_good:
        return Model(np.zeros(d), np.ones(d), None, None, log_prior)
    total = n_bad + n_good
    centre = sum(found[k][0] * found[k][1] for k in (0, 1)) / total
    spread = sum(found[k][0] * (np.diag(found[k][2]) + (found[k][1] - centre) ** 2) for k in (0, 1)) / total
    scale = np.sqrt(np.maximum(spread, 1e-12))
    classes = []
    for k in (0, 1):
        _, mean, cov = found[k]
        cov = cov / np.outer(scale, scale)
        shrunk = (1 - settings.shrinkage) * cov + settings.shrinkage * max(np.trace(cov) / d, 1e-3) * np.eye(d)
        factor = np.linalg.cholesky(shrunk + 1e-9 * np.eye(d))
        classes.append(Gaussian((mean - centre) / scale, factor, 2 * float(np.log(np.diag(factor)).sum())))
    return Model(centre, scale, classes[0], classes[1], log_prior)


def scored(features: DataFrame, model: Model) -> DataFrame:
    """features with a column score."""
    names = [f"x{k}" for k in range(len(STATISTICS))]
    schema = ", ".join([f"doc_id {features.schema['doc_id'].dataType.simpleString()}", "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(k + 1).to_numpy() for k in range(len(names))], axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], names=["doc_id", "score"])

    return features.select("doc_id", *names).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(fold(id_col, 3) == 1, F.lit(False))


def op9(spark: SparkSession, sf_dir: str, settings: Settings = Settings()) -> DataFrame:
    """Texts are read once: their statistics are written, and labels join those narrow rows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out() & F.col("quality").isin(0, 1))
    features = written(described(docs), "quality-statistics")
    labelled = features.join(labels.select("doc_id", F.col("quality").alias("label")), "doc_id")
    result = scored(features, fit(labelled, settings))
    return result.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
