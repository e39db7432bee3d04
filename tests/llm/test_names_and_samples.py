"""Clashing names, repeated ids in samples, letters and ties of the models."""

import numpy as np
import pytest

from curbflow.llm import bpe, langid, toxicity


def test_new_columns_get_free_names(spark):
    df = spark.createDataFrame([(1, "some plain text", 0.5, "a", "b", "c", "d")], "doc_id long, text string, score double, spans string, ids string, lang_pred string, decoded string")
    keep = ("doc_id", "score", "spans", "ids", "lang_pred", "decoded")
    empty = toxicity.Model({}, 0.0, np.zeros((2, 2)), None)
    for out in (langid.predict(df, None, keep=keep), toxicity.tagged(df, empty, keep=keep), bpe.encoded(df, bpe.default_path(), keep=keep)):
        row = out.select(*keep, *out.columns[len(keep):]).first()
        assert tuple(row[: len(keep)]) == (1, 0.5, "a", "b", "c", "d") and len(set(out.columns)) == len(out.columns)
    back = bpe.decoded(bpe.encoded(df.drop("ids"), bpe.default_path(), keep=("doc_id", "decoded")), bpe.default_path(), keep=("doc_id", "decoded"))
    assert back.first()["_decoded"] == "some plain text"


@pytest.mark.parametrize("text", ["\u00b2\u00b3", "\u00bd \u00be", "\u2460\u2461", "\u2167", "12 34", "_ !", "", None, "\u0301"])
def test_texts_without_a_letter_are_undetermined(text):
    model = langid.Model(["aa", "bb"], np.zeros(langid.BUCKETS), np.zeros((langid.BUCKETS, 2), np.float32), np.zeros(2), 1.0, langid.Settings())
    assert langid.classify(text, model) == (langid.UNKNOWN, 0.0)
    # equally likely languages: the first by name
    assert langid.classify("1 a", model) == ("aa", 0.5)


def test_repeated_ids_stay_within_the_sample(spark):
    docs = spark.createDataFrame([(k % 5, f"text {k} word", "en" if k % 2 else "de") for k in range(200)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(0, 1), (0, 1), (1, 0), (1, 1), (2, 0), (2, 0), (3, None)], "doc_id long, toxic int")
    sample = toxicity.labelled_sample(docs, labels, toxicity.Settings(per_class=2), "text", "doc_id", "toxic").collect()
    assert sorted(r.toxic for r in sample) == [0, 1]  # the id with both labels teaches nothing
    assert langid.train(docs, settings=langid.Settings(per_language=3, epochs=1)) is not None
