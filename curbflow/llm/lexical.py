"""Ranked lexical search of a stated set of items against all documents, by bag deduplication.

A document counts for an item only through the terms of the items' vocabulary, its length and nothing else. One pass over
the texts leaves of each document its number of terms and the frequencies of vocabulary terms (its bag). Documents with
the same bag and the same length factor m have the same score for every item: they form a class, found by hash and
verified by the whole vector. Each class is scored once, for all items at a time, and the classes at the top are expanded
to their members by ascending id. Tasks hand on the best rows of each item, never a row per document and item.

The items are taken in blocks of bounded text, so that the vocabulary a task holds is bounded, whatever their number.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curbflow.llm.tables import table, text_of, written

#: ASCII letters to lower case, digits and all bytes of other characters as they are, everything else to a blank.
LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
#: Integers below this are exact in a double, sums of them too.
EXACT = 1 << 53
#: The saturated frequency of a term stays below this.
SATURATED = 1_000_000


@dataclass(frozen=True)
class Settings:
    """top: rows per item. block: bytes of item texts in a block. together: classes scored in one matrix product."""

    top: int = 20
    block: int = 4 << 20
    together: int = 1024


def terms(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


def bags(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term: n counts all its terms, the arrays hold the numbers of its
    vocabulary terms in ascending order and their frequencies."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for batch in batches:
            rows, counts, found, times = [], [], [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                words = terms(text)
                if not words:
                    continue
                frequency = Counter(words)
                bag = sorted((vocabulary[w], frequency[w]) for w in frequency.keys() & known)
                rows.append(k)
                counts.append(len(words))
                found.append([t for t, _ in bag])
                times.append([n for _, n in bag])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())), pa.array(counts, pa.int64()),
                    pa.array(found, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "terms", "tfs"],
            )

    rows = docs.select(F.col(id_col), text_of(text_col).cast("binary"))
    return rows.mapInArrow(run, f"doc_id {id_type}, n long, terms array<int>, tfs array<long>")


def classes(rows: DataFrame, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(m, terms, tfs, members): members are the `top` smallest ids of a class, a null id being larger than all others.

    Rows are dealt out by the hash of the vector, and equal hashes are told apart by the vector itself. A class that holds
    a large share of the rows sends at most `top` of them per task."""
    m = F.lit(75) + F.expr(f"(25L * n * {n_docs}L) div {n_terms}L")
    vectors = rows.filter(F.size("terms") > 0).select(m.alias("m"), "terms", "tfs", "doc_id")
    vectors = vectors.withColumn("h", F.xxhash64("m", "terms", "tfs"))
    same = ["h", "m", "terms", "tfs"]
    order = Window.partitionBy(*same).orderBy(F.col("doc_id").asc_nulls_last())
    least = vectors.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top)
    members = F.sort_array(F.collect_list(F.struct("place", "doc_id")))["doc_id"]
    return least.groupBy(*same).agg(members.alias("members")).drop("h")


def weights_of(items: list[list[bytes]], vocabulary: dict[bytes, int], df: dict[int, int], n_docs: int) -> np.ndarray:
    """(vocabulary x items): a term's weight times its number of occurrences in the item."""
    weights = np.zeros((len(vocabulary), len(items)), np.int64)
    for k, words in enumerate(items):
        for word, times in Counter(words).items():
            found = df.get(vocabulary[word], 0)
            if found:
                weights[vocabulary[word], k] = times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * found + 1)))
    return weights


def scored(weights: np.ndarray, rows: list[tuple[int, list[int], list[int]]]) -> np.ndarray:
    """(rows x items) scores of (m, terms, tfs) rows, in whole numbers.

    The product runs in doubles where every sum stays below 2**53, which makes it exact, and in 64-bit integers otherwise.
    """
    used, at = np.unique(np.concatenate([np.asarray(t, np.int64) for _, t, _ in rows]), return_inverse=True)
    lengths = [len(t) for _, t, _ in rows]
    tf = np.concatenate([np.asarray(n, np.int64) for _, _, n in rows])
    m = np.repeat(np.array([m for m, _, _ in rows], np.int64), lengths)
    dense = np.zeros((len(rows), len(used)), np.int64)
    dense[np.repeat(np.arange(len(rows)), lengths), at] = 1_000_000_000 * tf // (1000 * tf + 12 * m)
    part = weights[used]
    if int(part.sum(axis=0).max(initial=0)) * SATURATED < EXACT:
        return np.rint(dense.astype(np.float64) @ part.astype(np.float64)).astype(np.int64)
    return dense @ part


def _order(members: list) -> list[tuple[bool, object]]:
    return [(d is None, 0 if d is None else d) for d in members]


class Best:
    """The best rows of every item that a task has seen: (-score, id) in order, `top` of them."""

    def __init__(self, items: int, top: int):
        self.top, self.rows = top, [[] for _ in range(items)]

    def add(self, scores: np.ndarray, members: list[list]) -> None:
        """Among classes with equal scores those with the smallest first members suffice: `top` classes per item."""
        keys = [_order(m) for m in members]
        by_first = sorted(range(len(keys)), key=lambda k: keys[k][0])
        ranks = np.empty(len(keys), np.int64)
        ranks[by_first] = np.arange(len(keys))
        for item in range(scores.shape[1]):
            column, rows = scores[:, item], self.rows[item]
            least = max(1, -rows[-1][0]) if len(rows) == self.top else 1
            candidates = np.flatnonzero(column >= least)
            if not len(candidates):
                continue
            if len(candidates) > self.top:
                bar = np.partition(column[candidates], len(candidates) - self.top)[len(candidates) - self.top]
                candidates = candidates[column[candidates] >= bar]
                candidates = candidates[np.lexsort((ranks[candidates], -column[candidates]))][: self.top]
            rows.extend((-int(column[k]), key) for k in candidates.tolist() for key in keys[k])
            rows.sort()
            del rows[self.top :]


def ranked(docs: DataFrame, block: list[tuple], item_type: str, settings: Settings, id_col: str, text_col: str) -> DataFrame:
    """(place, item_id, doc_id, score) of the best rows per task for a block of (place, item_id, text) items."""
    words = [terms(text) for _, _, text in block]
    vocabulary = {w: k for k, w in enumerate(sorted({w for ws in words for w in ws}))}
    rows = written(bags(docs, vocabulary, id_col, text_col), "lexical-bags")
    totals = rows.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    # one row per vocabulary term, whose number is bounded by the block
    frequencies = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()
    n_docs, n_terms = totals.docs, totals.terms or 1
    weights = weights_of(words, vocabulary, {r.term: r.df for r in frequencies}, n_docs)
    id_type = docs.schema[id_col].dataType.simpleString()
    places, ids = [p for p, _, _ in block], [i for _, i, _ in block]
    top, together = settings.top, settings.together

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, kinds = Best(len(places), top), None
        for batch in batches:
            kinds = batch.schema.field("members").type.value_type
            ms, ts, ns, members = (c.to_pylist() for c in batch.columns)
            for start in range(0, len(ms), together):
                part = slice(start, start + together)
                found.add(scored(weights, list(zip(ms[part], ts[part], ns[part], strict=True))), members[part])
        out = [(places[k], ids[k], None if key[0] else key[1], -s) for k, rows in enumerate(found.rows) for s, key in rows]
        if out:
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1]), pa.array(columns[2], kinds), pa.array(columns[3], pa.int64())],
                names=["place", "item_id", "doc_id", "score"],
            )

    grouped = classes(rows, n_docs, n_terms, top)
    return grouped.mapInArrow(best, f"place long, item_id {item_type}, doc_id {id_type}, score long")


def search(
    docs: DataFrame, items: DataFrame, settings: Settings = Settings(),
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` documents of each row of items by score, equal scores by ascending id, a
    null id last; rows that repeat an id are ranked one after the other. Documents with score 0 are left out.

    A null text, of a document or an item, has no terms and no results. Items that repeat an id or a text are ranked each
    for themselves. Other columns play no part. No documents or no items give no rows.
    """
    spark = docs.sparkSession
    item_type = items.schema[item_col].dataType.simpleString()
    id_type = docs.schema[id_col].dataType.simpleString()
    place = F.monotonically_increasing_id()
    listed = items.select(place.alias("place"), F.col(item_col).alias("item_id"), text_of(item_text_col).cast("binary").alias("text"))
    listed = written(listed, "lexical-items")
    size = listed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // settings.block + 1
    found = None
    for k in range(blocks):
        block = listed.filter(F.pmod(F.xxhash64("place"), F.lit(blocks)) == k).collect()
        if any(terms(r.text) for r in block):
            part = ranked(docs, [tuple(r) for r in block], item_type, settings, id_col, text_col)
            found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id {id_type}, score long")
    order = Window.partitionBy("place").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    rank = F.row_number().over(order)
    return found.withColumn("rank", rank).filter(F.col("rank") <= settings.top).select("item_id", "rank", "doc_id", "score")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = (
    "unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
)
OP13_SQL = f"""
with doc_terms as (select doc_id, {_TERMS} as term from documents),
item_terms as (select item_id, term, count(*) as times from (select item_id, {_TERMS} as term from benchmark) group by all),
tfs as (select doc_id, term, count(*) as tf from doc_terms group by all),
lengths as (select doc_id, sum(tf)::bigint as n from tfs group by doc_id),
totals as (select count(*)::bigint as nd, sum(n)::bigint as nl from lengths),
factors as (select doc_id, 75 + (25 * n * nd) // nl as m from lengths, totals),
weights as (
  select term, floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1)::double))::bigint as w
  from tfs, totals where term in (select term from item_terms) group by term, nd
),
scores as (
  select item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
  from item_terms join weights using (term) join tfs using (term) join factors using (doc_id)
  group by all
)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
from scores where score > 0
qualify rank <= 20
"""
