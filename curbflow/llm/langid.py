"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

Weights are learned with follow-the-regularised-leader (proximal, per-coordinate rates) under an elastic-net penalty;
a temperature fitted on examples kept aside calibrates the scores.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curbflow.llm.tables import extended, fold, free_name, table, text_of

ORDERS = (1, 2, 3)
BITS = 15
BUCKETS = 1 << BITS
#: Code points taken at once; long texts are counted piece by piece, with pieces overlapping by the longest n-gram.
PIECE = 1 << 18
UNKNOWN = "und"
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


@dataclass(frozen=True)
class Settings:
    """per_language bounds the sample the weights are fitted on: so many texts of each language, by hash of the id.
    Document frequencies are counted over all texts to learn from."""

    per_language: int = 1_000
    epochs: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02
    kept_aside: int = 5


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    settings: Settings = field(default_factory=Settings)


def _folded_alphabet() -> np.ndarray:
    """Code points of the basic plane in lower case; what is no letter becomes a space."""
    out = np.full(0x10000, 32, np.uint32)
    for point in range(0x10000):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            out[point] = ord(low[0])
    return out


_ALPHABET: list[np.ndarray] = []


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and counts of the hashed character n-grams of a whole text. Runs of other characters count as one
    space each character; letters beyond the basic plane stay as they are."""
    if not _ALPHABET:
        _ALPHABET.append(_folded_alphabet())
    total = np.zeros(BUCKETS, np.int64)
    for start in range(0, max(len(text), 1), PIECE):
        piece = text[start : start + PIECE + max(ORDERS) - 1]
        points = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.where(points < 0x10000, _ALPHABET[0][np.minimum(points, 0xFFFF)], points)
        for order in ORDERS:
            n = min(PIECE, len(points) - order + 1)
            if n <= 0:
                continue
            mixed = np.full(n, order, np.uint32)
            for k in range(order):
                mixed = (mixed + points[k : k + n]) * _MULTIPLIERS[k]
                mixed ^= mixed >> np.uint32(15)
            total += np.bincount(mixed & np.uint32(BUCKETS - 1), minlength=BUCKETS)
    found = np.flatnonzero(total)
    return found, total[found]


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit-length TF-IDF weights; n-grams that no text to learn from had weigh nothing."""
    buckets, counts = ngram_counts(text)
    values = (1 + np.log(counts)) * idf[buckets]
    norm = np.sqrt(values @ values)
    return buckets, values / norm if norm > 0 else values


def document_frequencies(docs: DataFrame, text_col: str) -> np.ndarray:
    """In how many texts each bucket occurs, over all rows of docs, and their number as last entry."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for text in batch.column(0):
                seen[ngram_counts(text.as_py())[0]] += 1
                seen[BUCKETS] += 1
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(seen[found])], names=["bucket", "docs"])

    parts = docs.select(text_of(text_col)).mapInArrow(count, "bucket long, docs long")
    out = np.zeros(BUCKETS + 1, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("docs")).collect():  # BUCKETS + 1 rows at most
        out[bucket] = n
    return out


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], classes: int, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Weights (BUCKETS x classes) and bias after s.epochs passes in a fixed shuffled order."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights(at):
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - s.l1, 0)
        return -shrunk / ((s.beta + np.sqrt(n[at])) / s.alpha + s.l2)

    rng = np.random.default_rng(7)
    for _ in range(s.epochs):
        for k in rng.permutation(len(examples)):
            buckets, values, label = examples[k]
            at, x = np.append(buckets, BUCKETS), np.append(values, 1.0)
            w = weights(at)
            logits = x @ w
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            g = x[:, None] * p
            rate = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / s.alpha
            z[at] += g - rate * w
            n[at] += g * g
    final = weights(slice(None))
    return final[:BUCKETS], final[BUCKETS]


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits, on a fine grid, that makes the kept-aside labels likeliest."""
    if not len(labels):
        return 1.0
    grid = np.geomspace(0.02, 20, 200)

    def loss(t: float) -> float:
        scaled = logits / t
        top = scaled.max(axis=1)
        return float(np.mean(top + np.log(np.exp(scaled - top[:, None]).sum(axis=1)) - scaled[np.arange(len(labels)), labels]))

    return float(min(grid, key=loss))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          settings: Settings = Settings()) -> Model | None:
    """A model of the languages that occur in docs; rows without a language teach nothing. None without any.

    Of rows that repeat an id and a language the smallest text is the example; without an id a row is counted in the
    document frequencies only."""
    known = docs.select(id_col, text_col, lang_col).filter(F.col(lang_col).isNotNull())
    frequency = document_frequencies(known, text_col)
    if not frequency[BUCKETS]:
        return None
    idf = np.where(frequency[:BUCKETS] > 0, np.log((1 + frequency[BUCKETS]) / (1 + frequency[:BUCKETS])) + 1, 0.0)
    order = Window.partitionBy(lang_col).orderBy(F.xxhash64(F.col("chosen").cast("string")), "chosen")
    # A hash threshold leaves about twice the wanted rows of a language, so no task ranks a whole language.
    ids = known.select(F.col(id_col).alias("chosen"), F.col(lang_col).alias(lang_col))
    sizes = ids.groupBy(lang_col).agg(F.count(F.lit(1)).alias("_texts"))
    place = F.pmod(F.xxhash64(F.col("chosen").cast("string"), F.lit("place")), F.lit(1 << 20))
    chosen = (
        ids.join(F.broadcast(sizes), lang_col)
        .filter(place * F.col("_texts") <= F.lit(2.0 * settings.per_language * (1 << 20)))
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= settings.per_language)
        .select("chosen")
    )
    sample = known.join(F.broadcast(chosen), F.col(id_col) == F.col("chosen"), "left_semi")
    # rows that repeat an id and a language are one example: the sample stays within its bound
    sample = sample.groupBy(lang_col, id_col).agg(F.min(text_col).alias(text_col))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [vector(t.as_py(), idf) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([b.astype(np.int32) for b, _ in found], pa.list_(pa.int32())),
                 pa.array([v.astype(np.float32) for _, v in found], pa.list_(pa.float32()))],
                names=["lang", "buckets", "values"],
            )

    rows = sample.select(F.col(lang_col).cast("string").alias("lang"), text_of(text_col)).mapInArrow(
        vectors, "lang string, buckets array<int>, values array<float>"
    ).toArrow()
    names = sorted(set(rows.column("lang").to_pylist()))
    examples = sorted(
        ((np.asarray(b.values), np.asarray(v.values, np.float64), names.index(lang.as_py()))
         for lang, b, v in zip(rows.column("lang"), rows.column("buckets"), rows.column("values"), strict=True)),
        key=lambda e: (e[2], len(e[0]), e[1].sum()),
    )
    aside = examples[:: settings.kept_aside]
    weights, bias = ftrl([e for k, e in enumerate(examples) if k % settings.kept_aside], len(names), settings)
    logits = np.array([v @ weights[b] + bias for b, v, _ in aside]).reshape(len(aside), len(names))
    t = temperature(logits, np.array([label for _, _, label in aside], int))
    return Model(names, idf, weights.astype(np.float32), bias, t, settings)


def classify(text: str | None, model: Model | None) -> tuple[str, float]:
    if not text or model is None or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0
    buckets, values = vector(text, model.idf)
    logits = (values @ model.weights[buckets] + model.bias) / model.temperature
    p = np.exp(logits - logits.max())
    best = int(p.argmax())
    return model.languages[best], float(p[best] / p.sum())


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` with lang_pred and score (the calibrated probability of lang_pred), in one pass.

    A text that is null or has no letter, and every text without a model, is `und` with score 0. Of equally likely
    languages the first by name is taken. Rows that repeat are predicted each for itself; no rows give no rows. If `keep`
    has columns of these names, the new ones get underscores in front.
    """
    kept = docs.select(*keep)
    passed, raw = len(keep), free_name(docs, "_text")
    names = [free_name(kept, n) for n in ("lang_pred", "score")]
    schema = extended(kept, f"`{names[0]}` string, `{names[1]}` double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [classify(t.as_py(), model) for t in batch.column(passed)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:passed], pa.array([x for x, _ in found], pa.string()),
                 pa.array([x for _, x in found], pa.float64())],
                names=[*keep, *names],
            )

    return docs.select(*keep, F.col(text_col).alias(raw)).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(fold(id_col, 5) == 0, F.lit(False))


def op3(spark: SparkSession, sf_dir: str, settings: Settings = Settings()) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.filter(~held_out()), settings=settings)
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
