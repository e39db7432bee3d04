"""Duplicate detection that shuffles hashes, and full rows only for suspects."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.functions.measures import rows
from curbflow.operators.bits import filter_of_hashes, rows_with_bit


def duplicate_groups(
    df: DataFrame, keys: list[str], count_name: str = "row_count", hash_of: Callable[..., Column] = F.xxhash64
) -> DataFrame:
    """Key groups occurring more than once, with their row count.

    A 64-bit hash of the key is counted first (8 bytes per row cross the network instead of the
    whole key, and map-side combining absorbs hot keys). Hashes seen twice set a bit in a filter of
    fixed size, built by a mergeable aggregate; the second scan keeps the rows whose bit is set and
    groups them by the real key. Hash collisions and shared bits cost time but never change the answer.
    """
    keyed = df.select(*keys)
    hashes = keyed.select(hash_of(*keys).alias("_h"))
    repeated = hashes.groupBy("_h").agg(rows().alias("_n")).where(F.col("_n") > 1)
    suspects = rows_with_bit(keyed, filter_of_hashes(repeated), keys, hash_of)
    return suspects.groupBy(*keys).agg(rows().alias(count_name)).where(F.col(count_name) > 1)


def duplicate_row_count(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows that share all key columns with another row."""
    groups = duplicate_groups(df, keys or df.columns)
    return groups.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("duplicate_rows"))


def is_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: total rows and distinct key tuples (NULL members count, as tuples)."""
    return df.groupBy(*keys).agg(rows().alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), rows().alias("distinct_keys")
    )
