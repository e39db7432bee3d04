"""The pipeline against a brute-force version of its stages over a small table."""

from collections import Counter

import corpus_pipeline
import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from curbflow.llm import mixing
from curbflow.llm.quality_rules import MEASURES, RULES
from tests.conftest import SMALL
from tests.llm.test_dedup import brute_force
from tests.llm.test_rules_and_models import naive


def expected(rows, tmp_path):
    """What each stage leaves, as {doc_id: row}."""
    kept = []
    for r in rows:
        measured = dict(zip(MEASURES, naive(r.text), strict=True))
        if not any(eval(test, {}, measured) for _, test in RULES):  # noqa: S307 - the rules are fixed text
            kept.append(r)
    by_text = {}
    for r in sorted(kept, key=lambda r: r.doc_id):
        by_text[r.text] = r
    kept = sorted(by_text.values(), key=lambda r: r.doc_id)
    groups = brute_force([r.text for r in kept], 5, 80)
    kept = [r for k, r in enumerate(kept) if groups[k][1] == k]
    con = duckdb.connect()
    con.execute("create table left_over (doc_id bigint, text varchar, lang varchar, source varchar)")
    con.executemany("insert into left_over values (?, ?, ?, ?)", [(r.doc_id, r.text, r.lang, r.source) for r in kept])
    copies = dict(con.execute(f"select doc_id, copies from ({mixing.sql(mixing.EXPECTED, documents='left_over')}) where kept").fetchall())
    return {r.doc_id: r for r in kept if r.doc_id in copies}, copies


def test_pipeline_equals_brute_force(spark, tmp_path):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    want, copies = expected(rows, tmp_path)
    found = corpus_pipeline.run(spark, SMALL).collect()
    got = {r.doc_id: r for r in found}
    assert got.keys() == want.keys() and 0 < len(got) < len(rows)
    assert Counter(r.doc_id for r in found) == copies
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for k, r in got.items():
        assert (r.text, r.lang, r.source, r.n_chars) == (want[k].text, want[k].lang, want[k].source, want[k].n_chars)
        assert r.ids == library.encode(r.text, add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "source_mixing", "bpe"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES) - 1))
def test_stage_schemas(spark, stage):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(20)
    out = corpus_pipeline.STAGES[stage][1](spark, docs, SMALL)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema]
