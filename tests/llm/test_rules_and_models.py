import itertools
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbflow.llm import langid, quality_model, quality_rules, toxicity
from curbflow.llm.quality_rules import BIT, LENIENT, STANDARD, measure
from tests.conftest import MEDIUM

TEXTS = [
    "", "one", "a b c d e f g h a b c d e f g h x", "x x x x x x x x x x", "# * $ % & | < >\n\n\nline\nline\n line\nline",
    "é ü ß\x0bq\x0c!\r\n! 12 3-4", "a b c d e f g h\n" * 3, "a b c d e f g i a b c d e f g j",
]


def naive(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    often, covered = Counter(windows), set()
    for k, w in enumerate(windows):
        if often[w] > 1:
            covered |= set(range(k, k + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
        len(lines), text.count("!"), sum(bool(re.search(r"[^!-@\[-`{-~]", w)) for w in words),
    )


@pytest.mark.parametrize("text", TEXTS)
def test_measures(text):
    assert measure(text) == naive(text)


def test_ledger_policies_and_ablations(make_docs):
    prose = " ".join(f"word{k}" for k in range(30))
    texts = [prose, "short", " ".join(["a!!"] * 40), " ".join(f"x{k}%%%" for k in range(30)), None]
    rows = quality_rules.ledger(make_docs(*texts))
    name = quality_rules.ledger_column(make_docs())
    bits = {r.doc_id: r.b for r in rows.select("doc_id", F.col(f"{name}.failed").alias("b")).collect()}
    assert bits[0] == 0 and bits[1] == BIT["few_words"] == bits[4]
    assert bits[2] & BIT["exclamations"] and bits[2] & BIT["repeated_passages"] and bits[3] == BIT["symbols"]
    found = quality_rules.ablations(rows.select(F.col(f"{name}.failed").alias("failed")), (STANDARD, LENIENT)).collect()
    for r in found:
        policy = {p.version: p for p in (STANDARD, LENIENT)}[r.policy]
        bit, rest = BIT[r.rule], policy.mask & ~BIT[r.rule]
        want = [sum(map(bool, x)) for x in zip(*(
            (b & bit, b & bit and not b & rest, b & policy.mask, b & rest) for b in bits.values()), strict=True)]
        assert [r.fails, r.alone, r.rejected, r.rejected_without] == want


def test_language_scores_are_calibrated_and_held_out(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    rows = langid.op3(spark, MEDIUM, langid.Settings(per_language=150)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    aside = [r for r in rows if r.held_out]
    right = [r.lang_pred == r.lang for r in aside]
    assert np.mean(right) > 0.97
    assert abs(np.mean([r.score for r in aside]) - np.mean(right)) < 0.05


def test_language_without_letters_or_labels(make_docs):
    docs = make_docs("123 --", None, "", "hello")
    model = langid.Model(["xx"], np.ones(langid.BUCKETS), np.zeros((langid.BUCKETS, 1)), np.zeros(1))
    assert [r.lang_pred for r in langid.predict(docs, model).orderBy("doc_id").collect()] == ["und", "und", "und", "xx"]
    assert {tuple(r)[1:] for r in langid.predict(docs, None).collect()} == {("und", 0.0)}


def test_ngrams_of_pieces_equal_the_whole(monkeypatch):
    text = "Abc dé.fG " * 50
    whole = langid.ngram_counts(text)
    monkeypatch.setattr(langid, "PIECE", 7)
    for a, b in zip(whole, langid.ngram_counts(text), strict=True):
        assert (a == b).all()


def test_quality_density_equals_definition():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(6, 6))
    cov, mean, x = a @ a.T + np.eye(6), rng.normal(size=6), rng.normal(size=(4, 6))
    factor = np.linalg.cholesky(cov)
    g = quality_model.Gaussian(mean, factor, 2 * np.log(np.diag(factor)).sum())
    want = [-0.5 * ((v - mean) @ np.linalg.inv(cov) @ (v - mean) + np.linalg.slogdet(cov)[1]) for v in x]
    assert np.allclose(g.log_density(x), want)


def scores(spark, query, label):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    rows = query(spark, MEDIUM).join(labels, "doc_id").filter("held_out").collect()
    return np.array([r.score for r in rows]), np.array([r[label] for r in rows]), np.array([r.predicted for r in rows])


def area(score, label):
    pairs = [(a > b) + 0.5 * (a == b) for a in score[label == 1] for b in score[label == 0]]
    return np.mean(pairs)


def test_quality_on_held_out_labels(spark):
    score, label, predicted = scores(spark, quality_model.op9, "quality")
    assert area(score, label) > 0.95 and (predicted == label).mean() > 0.95 and ((score >= 0) & (score <= 1)).all()


def test_toxicity_on_held_out_labels(spark):
    score, label, predicted = scores(spark, toxicity.op8, "toxic")
    assert area(score, label) > 0.9 and predicted[label == 0].mean() < 0.05 and ((score >= 0) & (score <= 1)).all()


def test_one_class_scores_its_share(spark):
    x = {f"x{k}": 0.5 * k for k in range(len(quality_model.STATISTICS))}
    rows = spark.createDataFrame([(1, 1, *x.values())], ["doc_id", "label", *x])
    assert quality_model.scored(rows, quality_model.fit(rows)).collect()[0].score == pytest.approx(0.75)
    assert quality_model.scored(rows, quality_model.fit(rows.limit(0))).collect()[0].score == pytest.approx(0.5)


@pytest.mark.parametrize("n,at", [(1, [0]), (6, [0, 5]), (9, [3, 4, 8]), (10, [2])])
def test_marginals_equal_enumeration(n, at):
    model = toxicity.Model({}, -1.3, np.array([[0.0, -0.7], [0.4, 1.1]]), None)
    extra = np.linspace(2.0, 3.5, len(at))
    own = np.full(n, model.bias)
    own[at] += extra
    total, hit = 0.0, np.zeros(n)
    for path in itertools.product((0, 1), repeat=n):
        w = math.exp(sum(own[k] for k in range(n) if path[k]) + sum(model.transition[a, b] for a, b in zip(path, path[1:], strict=False)))
        total += w
        hit += w * np.array(path)
    assert np.allclose(toxicity.marginals(model, np.array(at), extra, n), (hit / total)[at])


def test_spans_are_code_points():
    text = "ok 😀 bad, worse  fine bad"
    assert toxicity.spans(text, np.array([2, 3, 5]), np.array([0.9, 0.8, 0.6])) == [(5, 15), (22, 25)]
