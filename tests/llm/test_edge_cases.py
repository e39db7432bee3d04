"""Every operator over odd rows, and over no rows."""

import corpus_pipeline
import pytest

from curbflow.llm import (
    bpe, exact_dedup, langid, line_dedup, merkle, mixing, near_dedup, quality_model, quality_rules, secrets, toxicity, warc,
)
from curbflow.llm.registry import QUERIES

SMALL = langid.Settings(per_language=20, epochs=1)
OPERATORS = {
    "verdicts": exact_dedup.verdicts,
    "copies": exact_dedup.without_copies,
    "lines": line_dedup.deduplicated,
    "language": lambda d: langid.predict(d, langid.train(d, settings=SMALL)),
    "ledger": quality_rules.ledger,
    "accepted": quality_rules.accepted,
    "near": near_dedup.grouped,
    "near copies": near_dedup.without_near_copies,
    "secrets": lambda d: secrets.scanned(d, secrets.train(d)),
    "tokens": lambda d: bpe.round_trip(d, bpe.default_path(), keep=tuple(d.columns)),
    "toxicity": lambda d: toxicity.tagged(d, toxicity.train(d, d.selectExpr("doc_id", "cast(label as int) as toxic"))),
    "statistics": lambda d: quality_model.scored(f := quality_model.described(d), quality_model.fit(f.selectExpr("*", "1 as label"))),
    "manifest": merkle.manifest,
    "archives": lambda d: warc.archived(d, id_col="doc_id", url_col="source", html_col="text"),
    "mixing": lambda d: mixing.sampled(mixing.weighed(d), mixing.Settings(sweeps=1)),
    "mixed": lambda d: mixing.mixed(d, mixing.Settings(sweeps=1)),
}
ONE_ROW_EACH = {"verdicts", "lines", "language", "ledger", "near", "secrets", "tokens", "toxicity", "statistics", "mixing", "manifest", "archives"}
SAME_COLUMNS = {"copies", "accepted", "near copies", "mixed"}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(name, odd_docs):
    out = OPERATORS[name](odd_docs)
    rows = out.collect()
    if name in ONE_ROW_EACH:
        assert len(rows) == odd_docs.count()
    if name in SAME_COLUMNS:
        assert out.columns == odd_docs.columns


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows(name, no_docs):
    out = OPERATORS[name](no_docs)
    assert out.collect() == []
    if name in SAME_COLUMNS:
        assert out.columns == no_docs.columns


@pytest.mark.parametrize("name", QUERIES)
def test_queries_over_empty_tables(name, spark, no_docs, as_table):
    assert QUERIES[name](spark, as_table(no_docs)).collect() == []


def test_pipeline_over_odd_rows(spark, odd_docs, as_table):
    folder, docs = as_table(odd_docs), odd_docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == odd_docs.columns
    last = corpus_pipeline.STAGES[-1][1](spark, odd_docs, folder)
    assert set(odd_docs.columns) <= set(last.columns)
    texts = {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id and r.doc_id > 1}
    assert all(r.text == (texts[r.doc_id] or "") for r in last.collect() if r.doc_id and r.doc_id > 1)


def test_pipeline_over_no_rows(spark, no_docs, as_table):
    assert corpus_pipeline.run(spark, as_table(no_docs)).collect() == []
