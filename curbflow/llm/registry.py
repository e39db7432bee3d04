"""Queries of the corpus operators over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from curbflow.llm import (
    bpe, exact_dedup, langid, lexical, line_dedup, merkle, mixing, near_dedup, quality_model, quality_rules, secrets, toxicity, warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": exact_dedup.op1,
    "op2_line_dedup": line_dedup.op2,
    "op3_language_id": langid.op3,
    "op4_quality_rules": quality_rules.op4,
    "op5_near_dedup": near_dedup.op5,
    "op6_secret_scan": secrets.op6,
    "op7_bpe": bpe.op7,
    "op8_toxicity": toxicity.op8,
    "op9_quality_classifier": quality_model.op9,
    "op10_source_mixing": mixing.op10,
    "op10_source_mixing_expected": mixing.op10_expected,
    "op2_line_dedup_whole": line_dedup.op2_whole,
    "op4_quality_rules_ablations": quality_rules.op4_ablations,
    "op11_warc": warc.op11,
    "op12_merkle_manifest": merkle.op12,
    "op13_lexical_search": lexical.op13,
}
ORACLES: dict[str, str] = {
    "op1_exact_dedup": exact_dedup.OP1_SQL,
    "op2_line_dedup": line_dedup.OP2_SQL,
    "op4_quality_rules": quality_rules.OP4_SQL,
    "op10_source_mixing": mixing.OP10_SQL,
    "op10_source_mixing_expected": mixing.OP10_EXPECTED_SQL,
    "op2_line_dedup_whole": line_dedup.OP2_WHOLE_SQL,
    "op4_quality_rules_ablations": quality_rules.OP4_ABLATIONS_SQL,
    "op11_warc": warc.OP11_SQL,
    "op12_merkle_manifest": merkle.OP12_SQL,
    "op13_lexical_search": lexical.OP13_SQL,
}
