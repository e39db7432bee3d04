"""Toxic spans and document scores from a linear-chain conditional random field.

States are 0 (ordinary) and 1 (toxic). A token's features are its folded word and that word's beginnings; features that
mark toxic documents form the lexicon, and tokens to learn from are labelled toxic where they have such a feature in a
toxic document. Forward-backward gives each token's marginal; marginals give the spans and, through a logistic curve
fitted on documents to learn from, the score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm.tables import extended, fold, free_name, table, text_of, written

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
BEGINNINGS = (4, 5, 6, 7, 8)
SEGMENT = 16
#: Words whose potential a task remembers; the memory is emptied when full.
REMEMBERED = 300_000


@dataclass(frozen=True)
class Settings:
    """per_class bounds the labelled sample (documents of each label, by hash of the id), lexicon the features kept,
    segments the labelled token segments used to fit the field."""

    per_class: int = 2_500
    lexicon: int = 4_000
    segments: int = 15_000
    least_toxic: int = 4
    least_ratio: float = 8.0
    steps: int = 150
    rate: float = 0.1
    l2: float = 1e-4


def folded(token: str) -> str:
    return token.strip(EDGES).lower()


def features(word: str) -> list[str]:
    """The word and its beginnings, told apart by a mark."""
    if not word:
        return []
    return [f"={word}", *(f"^{word[:n]}" for n in BEGINNINGS if len(word) > n)]


@dataclass
class Model:
    """lexicon: weight of each feature for state 1; transition[i, j]: from state i to j, as log potentials."""

    lexicon: dict[str, float]
    bias: float
    transition: np.ndarray
    curve: np.ndarray | None

    @cached_property
    def powers(self) -> list[np.ndarray]:
        """powers[k]: 2 ** k steps over background tokens, scaled to a largest entry of 1."""
        m = np.exp(self.transition) * np.array([1.0, np.exp(self.bias)])
        out = [m / m.max()]
        for _ in range(40):
            m = out[-1] @ out[-1]
            out.append(m / m.max())
        return out

    def over(self, v: np.ndarray, steps: int, backward: bool) -> np.ndarray:
        for k in range(steps.bit_length()):
            if steps >> k & 1:
                v = self.powers[k] @ v if backward else v @ self.powers[k]
        return v / v.sum()


def potential(model: Model, token: str) -> float:
    """What a token's lexicon features add to state 1."""
    return sum(model.lexicon.get(f, 0.0) for f in features(folded(token)))


def marginals(model: Model, at: np.ndarray, extra: np.ndarray, n: int) -> np.ndarray:
    """Probability of state 1 at the token positions `at` (ascending) of n tokens, exact forward-backward.

    extra: their potentials. All other tokens have the same potentials, so a run of them is one matrix power."""
    m = np.exp(model.transition)
    forward, backward = [], []
    v, last = None, -1
    for p, e in zip(at.tolist(), extra.tolist(), strict=True):
        own = np.array([1.0, np.exp(model.bias + e)])
        if v is None:
            first = np.array([1.0, np.exp(model.bias)])
            v = own if p == 0 else model.over(first / first.sum(), p - 1, False) @ m * own
        else:
            v = model.over(v, p - last - 1, False) @ m * own
        v, last = v / v.sum(), p
        forward.append(v)
    v, last = np.array([0.5, 0.5]), n
    own = None
    for p, e in zip(at.tolist()[::-1], extra.tolist()[::-1], strict=True):
        if own is not None:
            v = m @ (own * v)
        v = model.over(v, last - p - 1, True)
        backward.append(v)
        own, last = np.array([1.0, np.exp(model.bias + e)]), p
    both = np.array(forward) * np.array(backward[::-1])
    return both[:, 1] / both.sum(axis=1)


class Tagger:
    """Tags whole texts; one per task."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def tokens(self, text: str) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of tokens; positions and potentials of those with a lexicon feature."""
        words, known = text.encode("utf-8", "surrogatepass").split(), self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(filterfalse(known.__contains__, words)):
            known[w] = potential(self.model, w.decode("utf-8", "surrogatepass"))
        extra = np.fromiter(map(known.__getitem__, words), float, len(words))
        at = np.flatnonzero(extra)
        return len(words), at, extra[at]

    def tag(self, text: str | None) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of tokens; positions of tokens with a lexicon feature and their marginals."""
        n, at, extra = self.tokens(text or "")
        return n, at, marginals(self.model, at, extra, n) if len(at) else extra


def summary(n: int, marginal: np.ndarray) -> np.ndarray:
    """What the document score is made of: a constant, the expected toxic tokens, the largest marginal, the share."""
    expected, most = float(marginal.sum()), float(marginal.max(initial=0.0))
    return np.array([1.0, np.log1p(expected), most, np.log1p(100 * expected / max(n, 1))])


def score(model: Model, n: int, marginal: np.ndarray) -> float:
    if model.curve is None:
        return 0.0
    return float(1 / (1 + np.exp(-np.clip(summary(n, marginal) @ model.curve, -30, 30))))


def spans(text: str, at: np.ndarray, marginal: np.ndarray, least: float = 0.5) -> list[tuple[int, int]]:
    """Code-point offsets (end exclusive) of runs of tokens whose marginal reaches `least`."""
    chosen = set(at[marginal >= least].tolist())
    out: list[tuple[int, int]] = []
    last = -2
    if chosen:
        for k, found in enumerate(WORD.finditer(text)):
            if k in chosen:
                start = out.pop()[0] if k == last + 1 else found.start()
                out.append((start, found.end()))
                last = k
    return out


def lexicon_of(sample: DataFrame, s: Settings) -> list[str]:
    """Features that occur in toxic documents far more often than in others, the strongest first."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for toxic, text in zip(batch.column(0), batch.column(1), strict=True):
                seen = {f for w in set(map(folded, text.as_py().split())) for f in features(w)}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([toxic.as_py()] * len(seen), pa.int32()), pa.array(sorted(seen), pa.string())],
                    names=["toxic", "feature"],
                )

    counts = (
        sample.select("toxic", "text").mapInArrow(emit, "toxic int, feature string")
        .groupBy("feature").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("fine"))
    )
    totals = sample.agg(F.sum("toxic").alias("all_bad"), F.sum(1 - F.col("toxic")).alias("all_fine"))
    ratio = (F.col("bad") + 0.5) / (F.col("all_bad") + 1) / ((F.col("fine") + 0.5) / (F.col("all_fine") + 1))
    strongest = (
        counts.filter(F.col("bad") >= s.least_toxic).join(F.broadcast(totals))
        .withColumn("ratio", ratio).filter(F.col("ratio") >= s.least_ratio)
        .orderBy(F.col("bad").desc(), F.col("ratio").desc(), "feature").limit(s.lexicon)
    )
    return [r.feature for r in strongest.select("feature").collect()]


def segments_of(sample: DataFrame, lexicon: list[str], s: Settings) -> list[tuple[int, list[list[int]], int]]:
    """(toxic, lexicon features of each token, tokens): segments with a lexicon feature, and each document's first."""
    index = {f: k for k, f in enumerate(lexicon)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, list[list[int]], int]] = []
            for toxic, text in zip(batch.column(0), batch.column(1), strict=True):
                found = [[index[f] for f in features(folded(w)) if f in index] for w in text.as_py().split()]
                for k in range(0, len(found), SEGMENT):
                    part = found[k : k + SEGMENT]
                    if k == 0 or any(part):
                        out.append((toxic.as_py(), part, len(part)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.list_(pa.list_(pa.int32()))),
                 pa.array([o[2] for o in out], pa.int32())],
                names=["toxic", "tokens", "n"],
            )

    rows = sample.select("toxic", "text").mapInArrow(cut, "toxic int, tokens array<array<int>>, n int")
    rows = rows.orderBy(F.xxhash64(F.to_json(F.struct("tokens"))), "toxic").limit(s.segments)
    return [(r.toxic, r.tokens, r.n) for r in rows.collect()]


def fit_field(segments: list[tuple[int, list[list[int]], int]], size: int, s: Settings) -> tuple[np.ndarray, float, np.ndarray]:
    """Feature weights, bias and transitions by gradient steps on the conditional log-likelihood of the segments."""
    count = len(segments)
    lengths = np.array([n for _, _, n in segments])
    rows, steps, feats = [], [], []
    gold = np.zeros((count, SEGMENT), int)
    for k, (toxic, tokens, _) in enumerate(segments):
        for t, own in enumerate(tokens):
            rows += [k] * len(own)
            steps += [t] * len(own)
            feats += own
            gold[k, t] = int(bool(toxic and own))
    feats, cells = np.array(feats, int), np.array(rows, int) * SEGMENT + np.array(steps, int)
    inside = np.arange(SEGMENT) < lengths[:, None]
    both = inside[:, 1:] & inside[:, :-1]
    theta, first, second = np.zeros(size + 4), np.zeros(size + 4), np.zeros(size + 4)
    theta[size] = -2.0
    wanted = np.concatenate([
        np.bincount(feats, gold.ravel()[cells], size), [(gold * inside).sum()],
        [(both & (gold[:, :-1] == a) & (gold[:, 1:] == b)).sum() for a, b in ((0, 1), (1, 0), (1, 1))],
    ])
    for step in range(1, s.steps + 1):
        move = np.exp([[0.0, theta[size + 1]], [theta[size + 2], theta[size + 3]]])
        own = np.bincount(cells, theta[feats], count * SEGMENT).reshape(count, SEGMENT) + theta[size]
        node = np.stack([np.ones_like(own), np.where(inside, np.exp(np.clip(own, -30, 30)), 1.0)], axis=2)
        alpha, beta = node.copy(), np.ones_like(node)
        for t in range(1, SEGMENT):
            alpha[:, t] = np.where(inside[:, t, None], alpha[:, t - 1] @ move * node[:, t], alpha[:, t - 1])
        for t in range(SEGMENT - 2, -1, -1):
            beta[:, t] = np.where(inside[:, t + 1, None], (node[:, t + 1] * beta[:, t + 1]) @ move.T, 1.0)
        z = alpha[:, -1].sum(axis=1)
        p1 = alpha[:, :, 1] * beta[:, :, 1] / z[:, None] * inside
        later = node[:, 1:] * beta[:, 1:] / z[:, None, None] * both[:, :, None]
        pairs = [float((alpha[:, :-1, a] * move[a, b] * later[:, :, b]).sum()) for a, b in ((0, 1), (1, 0), (1, 1))]
        expected = np.concatenate([np.bincount(feats, p1.ravel()[cells], size), [p1.sum()], pairs])
        gradient = (wanted - expected) / max(count, 1) - s.l2 * theta
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta += s.rate * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    trans = np.array([[0.0, theta[size + 1]], [theta[size + 2], theta[size + 3]]])
    return theta[:size], float(theta[size]), trans


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps; classes count equally."""
    w = np.zeros(x.shape[1])
    mass = np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1)) * len(y)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (mass * (y - p)) - ridge * w
        hessian = (x * (mass * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        change = np.linalg.solve(hessian, gradient)
        w += np.clip(change, -5, 5)
        if np.abs(change).max() < 1e-8:
            break
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, s: Settings, text_col: str, id_col: str, label_col: str) -> DataFrame:
    """(toxic, text) of the first per_class documents of each label by hash of the id. An id with both labels teaches
    nothing; of rows that repeat an id the smallest text is taken."""
    known = labels.filter(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("chosen")).agg(
        F.min(F.col(label_col).cast("int")).alias("toxic"), F.max(F.col(label_col).cast("int")).alias("_most")
    ).filter(F.col("toxic") == F.col("_most")).drop("_most")
    order = (F.xxhash64(F.col("chosen").cast("string")), F.col("chosen"))
    picked = None
    for label in (0, 1):
        part = known.filter(F.col("toxic") == label).orderBy(*order).limit(s.per_class)
        picked = part if picked is None else picked.unionByName(part)
    joined = docs.select(F.col(id_col).alias("chosen"), text_of(text_col).alias("text")).join(F.broadcast(picked), "chosen")
    once = joined.groupBy("chosen", "toxic").agg(F.min("text").alias("text"))
    return written(once.select("toxic", "text"), "toxicity-sample")


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), text_col: str = "text",
          id_col: str = "doc_id", label_col: str = "toxic") -> Model:
    """A model of the labelled documents. Without labels of both classes it tags nothing and scores 0."""
    sample = labelled_sample(docs, labels, settings, text_col, id_col, label_col)
    lexicon = lexicon_of(sample, settings)
    if not lexicon:
        return Model({}, 0.0, np.zeros((2, 2)), None)
    weights, bias, transition = fit_field(segments_of(sample, lexicon, settings), len(lexicon), settings)
    model = Model(dict(zip(lexicon, weights.tolist(), strict=True)), bias, transition, None)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for batch in batches:
            tagged = [tagger.tag(t.as_py()) for t in batch.column(1)]
            rows = [summary(n, m).tolist() for n, _, m in tagged]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["toxic", "x"])

    rows = sample.select("toxic", "text").mapInArrow(summarise, "toxic int, x array<double>").collect()
    rows.sort(key=lambda r: (r.toxic, r.x))
    model.curve = fit_curve(np.array([r.x for r in rows]), np.array([r.toxic for r in rows]))
    return model


def tagged(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` with score, toxic_tokens (the expected number) and spans (code-point offsets, end
    exclusive), in one pass over the whole texts. Null and empty texts have no token and score as such. A token is in a
    span where its marginal is one half or more. Rows that repeat are scored each for itself; no rows give no rows. If
    `keep` has columns of these names, the new ones get underscores in front."""
    kept = docs.select(*keep)
    names = [free_name(kept, n) for n in ("score", "toxic_tokens", "spans")]
    schema = extended(kept, f"`{names[0]}` double, `{names[1]}` double, `{names[2]}` array<struct<start: int, end: int>>")
    passed, pair = len(keep), pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for batch in batches:
            scores, counts, found = [], [], []
            for value in batch.column(passed):
                text = value.as_py() or ""
                n, at, marginal = tagger.tag(text)
                scores.append(score(model, n, marginal))
                counts.append(float(marginal.sum()))
                found.append([{"start": a, "end": b} for a, b in spans(text, at, marginal)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:passed], pa.array(scores, pa.float64()), pa.array(counts, pa.float64()),
                 pa.array(found, pa.list_(pair))],
                names=[*keep, *names],
            )

    return docs.select(*keep, F.col(text_col).alias("_text")).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(fold(id_col, 3) == 1, F.lit(False))


def op8(spark: SparkSession, sf_dir: str, settings: Settings = Settings()) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~held_out())
    return tagged(docs, train(docs, labels, settings)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.size("spans").alias("n_spans"),
    )
