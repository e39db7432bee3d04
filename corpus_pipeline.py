"""The corpus pipeline: documents pass through the stages in order, each written as Parquet and read again.

Stages return the columns of documents; the last one adds the tokens. Rows with nulls, empty or very long texts, and
repeated rows pass through as the operators' docstrings say; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm import bpe, exact_dedup, mixing, near_dedup, quality_rules
from curbflow.llm.tables import free_name
from curbflow.session import scratch_dir


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the standard policy of the quality rules accepts."""
    return quality_rules.accepted(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: the one with the largest doc_id."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8): the smallest doc_id."""
    return near_dedup.without_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with nine tenths of the tokens in expectation, in the tempered shares of sources, languages and topics.
    Documents of cells whose rate exceeds 1 stand more than once."""
    return mixing.mixed(docs, mixing.EXPECTED)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their text as decoded from its tokens, the token ids and their number."""
    others = [c for c in docs.columns if c != "text"]
    kept = docs.select(*others)
    ids, text, count = free_name(kept, "ids"), free_name(kept, "decoded"), free_name(docs, "n_tokens")
    tokens = bpe.round_trip(docs, bpe.default_path(), keep=tuple(others))
    return tokens.select(*others, F.col(text).alias("text"), F.col(ids), F.size(ids).cast("long").alias(count))


STAGES = [
    ("quality_rules", keep_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("bpe", tokenize),
]

#: Near-duplicate groups and tokens cannot be stated in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{scratch_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = f"{folder}/{k}-{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
