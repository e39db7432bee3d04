"""Exact deduplication with a heavy-hitter split.

Misra-Gries summaries find the digests that hold a large share of the rows. Their winners are verified by an exact
count and broadcast (at most 1 / share rows), so their copies are removed on the map side. All other digests go
through an ordinary shuffle, where no key exceeds the share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curbflow.llm import heavy
from curbflow.llm.tables import free_name, table, text_of, written


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tie, key): key is the SHA-256 of the whole text, tie tells apart rows that repeat a doc_id."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.monotonically_increasing_id().alias("tie"),
        F.unhex(F.sha2(text_of(text_col).cast("binary"), 256)).alias("key"),
    )


def verdicts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    share: float = heavy.SHARE, counters: int = heavy.COUNTERS,
) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays, a null doc_id being the smallest; of rows that repeat
    that doc_id too, one stays. A null text equals the empty one. No rows give no rows. Other columns play no part.
    """
    rows = written(digests(docs, id_col, text_col), "digests")
    best = F.max(F.struct("doc_id", "tie"))
    found = written(heavy.winners(rows, best, share, counters), "heavy-digests")
    marked = heavy.group_winners(rows, best, found)
    own = F.struct("doc_id", "tie")
    return marked.select(
        "doc_id",
        F.coalesce(F.col("best"), own)["doc_id"].alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("best")["tie"] == F.col("tie"), F.lit(True)).alias("kept"),
        F.lower(F.hex("key")).alias("text_sha256"),
    )


def without_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    share: float = heavy.SHARE, counters: int = heavy.COUNTERS,
) -> DataFrame:
    """The rows of docs that `verdicts` keeps, with all their columns. Of rows that repeat both text and largest
    doc_id, any one stays.

    Copies of frequent texts end on the map side. The remaining rows are dealt out once by digest; the first row of
    each digest is already picked before that shuffle where a task sees several.
    """
    key, rank, best, size = (free_name(docs, c) for c in ("key", "rank", "best", "size"))
    keyed = docs.withColumn(key, F.unhex(F.sha2(text_of(text_col).cast("binary"), 256)))
    rows = keyed.select(F.col(id_col).alias("doc_id"), F.col(key).alias("key"))
    rows = written(rows, "digests")
    found = written(heavy.winners(rows, F.max("doc_id"), share, counters), "heavy-digests")
    found = found.select(F.col("key").alias(key), F.col("best").alias(best), F.col("size").alias(size))
    left = keyed.join(F.broadcast(found), key, "left").filter(
        F.col(size).isNull() | F.col(id_col).eqNullSafe(F.col(best))
    )
    order = Window.partitionBy(key).orderBy(F.col(id_col).desc_nulls_last())
    return left.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) == 1).select(*docs.columns)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "documents"))


OP1_SQL = """
select doc_id,
       max(doc_id) over (partition by coalesce(text, '')) as keep_id,
       count(*) over (partition by coalesce(text, '')) as group_size,
       doc_id = max(doc_id) over (partition by coalesce(text, '')) as kept,
       sha256(coalesce(text, '')) as text_sha256
from documents
"""
