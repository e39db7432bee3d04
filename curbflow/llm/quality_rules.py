"""Quality rules as a ledger of bits.

Every rule is evaluated once per document. The ledger stores the measurements and one failure bit per rule; versioned
policies pick the bits that reject, and ablations of a policy are bitwise aggregates over the ledger, so no text is
read again when a policy changes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm.tables import extended, free_name, table

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_exclaims", "n_letter_words",
)
#: Rules by bit position. A rule never changes its bit; new ones are appended. The conditions mark failures.
RULES = (
    ("few_words", "n_words < 20"),
    ("repeated_passages", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "10 * n_symbols > 3 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 14 * n_words"),
    ("exclamations", "10 * n_exclaims > 5 * n_words"),
    ("no_letters", "100 * n_letter_words < 60 * n_words"),
)
BIT = {name: 1 << k for k, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A document is rejected if it fails any of `rules`."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_passages"))
STANDARD = Policy("standard-1", tuple(name for name, _ in RULES))
LENIENT = Policy("lenient-1", ("few_words", "repeated_passages", "symbols", "exclamations"))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of so many words found twice or more, the first ones included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    rolled = np.zeros(n, np.uint64)
    for k in range(window):
        rolled = rolled * np.uint64(0xBF58476D1CE4E5B9) + mixed[k : k + n]
    rolled.sort()
    if not (rolled[1:] == rolled[:-1]).any():  # windows that are equal have equal hashes
        return 0
    width, rank = 1, ids  # exact: ranks of windows of 1, 2, 4 ... words
    while width < window:
        step = min(width, window - width)
        pair = rank[:-step] * (int(rank.max()) + 1) + rank[step:]
        rank, width = np.unique(pair, return_inverse=True)[1], width + step
    often = np.bincount(rank)[rank] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += often
    edges[window : window + n] -= often
    return int((np.cumsum(edges[:-1]) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one whole text, in the order of MEASURES. Null has none of anything."""
    if not text:
        return (0,) * len(MEASURES)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes.split() cuts at exactly the six ASCII white-space characters
    seen: set[bytes] = set()
    lines = repeats = 0
    for line in raw.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            if line in seen:
                repeats += 1
            else:
                seen.add(line)
    digits_and_marks = raw.translate(None, b"0123456789!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    return (
        len(words),
        len(text) - sum(map(text.count, " \t\n\x0b\x0c\r")),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        repeats,
        repeated_words(words),
        lines,
        raw.count(b"!"),
        len(digits_and_marks.split()),
    )


def ledger(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """docs (or its columns `keep`) with a struct column `ledger` of all measurements and `failed`, the failure bits.

    One row per row of docs, in one pass without a shuffle. A null text measures as an empty one and fails
    `few_words`; ratios are compared as products, so no division meets zero. If docs has a column `ledger` already,
    the new one gets underscores in front (`ledger_column` tells).
    """
    columns = [c for c in docs.columns if keep is None or c in keep]
    name, raw = ledger_column(docs), free_name(docs, "measured_text")
    kept = docs.select(*columns)
    fields = ", ".join(f"{m}: bigint" for m in MEASURES)
    schema = extended(kept, f"`{name}` struct<{fields}>")
    passed = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(t.as_py()) for t in batch.column(passed)]
            parts = [pa.array(x, pa.int64()) for x in zip(*found, strict=True)] or [pa.array([], pa.int64())] * len(MEASURES)
            struct = pa.StructArray.from_arrays(parts, names=list(MEASURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[:passed], struct], names=[*columns, name])

    measured = docs.select(*columns, F.col(text_col).alias(raw)).mapInArrow(run, schema)
    return measured.withColumn(name, F.col(name).withField("failed", failures(name)))


def ledger_column(docs: DataFrame) -> str:
    return free_name(docs, "ledger")


def failures(name: str) -> Column:
    """The bits of all rules that fail."""
    bits = F.lit(0).cast("long")
    for rule, condition in RULES:
        test = F.expr(re.sub(r"[a-z]\w+", rf"`{name}`.\g<0>", condition))
        bits = bits.bitwiseOR(F.when(test, F.lit(BIT[rule])).otherwise(F.lit(0)).cast("long"))
    return bits


def rejected(failed: Column, policy: Policy) -> Column:
    return failed.bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def ablations(failed_bits: DataFrame, policies: tuple[Policy, ...], column: str = "failed") -> DataFrame:
    """What each rule does in each policy: documents that fail it, that it alone rejects, and what the policy rejects
    with and without it. The ledger is first summed by its bits, so the rest runs over 2 ** rules rows at most. An
    empty ledger gives zeros."""
    masks = failed_bits.groupBy(F.col(column).alias("bits")).agg(F.count(F.lit(1)).alias("docs"))
    totals = []
    for p in policies:
        for r in p.rules:
            bit, others = BIT[r], p.mask & ~BIT[r]
            count = lambda test: F.coalesce(F.sum(F.when(test, F.col("docs"))), F.lit(0))
            has = lambda m: F.col("bits").bitwiseAND(F.lit(m).cast("long")) != 0
            totals.append(
                F.struct(
                    F.lit(p.version).alias("policy"), F.lit(r).alias("rule"),
                    count(has(bit)).alias("fails"),
                    count(has(bit) & ~has(others)).alias("alone"),
                    count(has(p.mask)).alias("rejected"),
                    count(has(others)).alias("rejected_without"),
                )
            )
    return masks.agg(F.array(*totals).alias("rows")).select(F.inline("rows"))


def accepted(docs: DataFrame, policy: Policy = STANDARD, text_col: str = "text") -> DataFrame:
    """The rows of docs that the policy keeps, with their columns."""
    name = ledger_column(docs)
    return ledger(docs, text_col).filter(~rejected(F.col(f"{name}.failed"), policy)).select(*docs.columns)


def op4(spark: SparkSession, sf_dir: str, policy: Policy = STANDARD) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    failed = F.col("ledger.failed")
    return ledger(docs, keep=("doc_id",)).select(
        "doc_id", *(f"ledger.{m}" for m in MEASURES[:5]),
        rejected(failed, BASE).alias("base_failed"),
        (~rejected(failed, BASE) & ~rejected(failed, policy)).alias("kept"),
        failed.alias("failed_bits"),
    )


def op4_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule does in each policy, over the ledger of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    bits = ledger(docs, keep=("doc_id",)).select(F.col("ledger.failed").alias("failed"))
    return ablations(bits, (BASE, STANDARD, LENIENT))


_JUDGED = r"""
with docs as (
    select doc_id, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
           string_split(coalesce(text, ''), chr(10)) as lines
    from documents
), shingles as (
    select doc_id, k, words[k:k + 7] as shingle
    from (select doc_id, words, unnest(range(1, len(words) - 6)) as k from docs where len(words) >= 8)
), twice as (
    select doc_id, k from (select doc_id, k, count(*) over (partition by doc_id, shingle) as n from shingles) where n > 1
), covered as (
    select doc_id, count(distinct k + j) as n_repeat_words from twice, range(8) as offsets(j) group by doc_id
), lines as (
    select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
    from (select doc_id, unnest(lines) as line from docs)
    where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id
), measured as (
    select doc_id, len(words)::bigint as n_words,
           coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::bigint as word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
           coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
           coalesce(n_lines, 0)::bigint as n_lines,
           length(regexp_replace(text, '[^!]', '', 'g'))::bigint as n_exclaims,
           len(list_filter(words, lambda w: regexp_matches(w, '[^!-@\[-`{-~]')))::bigint as n_letter_words
    from docs left join covered using (doc_id) left join lines using (doc_id)
), judged as (
    select *, {bits} as failed_bits from measured
)
""".replace("{bits}", " + ".join(f"case when {test} then {BIT[name]} else 0 end" for name, test in RULES))
OP4_SQL = _JUDGED + """
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
       failed_bits = 0 as kept, failed_bits
from judged
"""
OP4_ABLATIONS_SQL = _JUDGED + " union all ".join(
    f"""select '{p.version}' as policy, '{r}' as rule, count(*) filter (failed_bits & {BIT[r]} <> 0) as fails,
       count(*) filter (failed_bits & {p.mask} = {BIT[r]}) as alone, count(*) filter (failed_bits & {p.mask} <> 0) as rejected,
       count(*) filter (failed_bits & {p.mask & ~BIT[r]} <> 0) as rejected_without from judged"""
    for p in (BASE, STANDARD, LENIENT) for r in p.rules
)
