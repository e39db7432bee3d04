"""A bit filter of keys: of fixed size whatever it holds, so it may be broadcast without a look at the data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words of 64 bits: at most this many rows of two longs are broadcast.
WORDS = 1 << 18
_BIT = "shiftleft(1L, cast(_h & 63 as int))"
# Never null, so that no null filter is pushed below it and plans that share a part stay equal.
_WORD = f"shiftright(_h, 6) & {WORDS - 1}L"


def hashed(keys: list[str], hash_of: Callable[..., Column]) -> Column:
    return hash_of(*keys) if keys else F.lit(0).cast("long")


def bit_filter(df: DataFrame, keys: list[str], hash_of: Callable[..., Column] = F.xxhash64) -> DataFrame:
    """(_word, _bits) with the bit of every key in df set; words without a bit are absent."""
    return filter_of_hashes(df.select(hashed(keys, hash_of).alias("_h")))


def filter_of_hashes(hashes: DataFrame) -> DataFrame:
    """The filter of 64-bit hashes in column _h: an aggregate that tasks combine before the shuffle."""
    return hashes.groupBy(F.expr(_WORD).alias("_word")).agg(F.bit_or(F.expr(_BIT)).alias("_bits"))


def rows_with_bit(df: DataFrame, words: DataFrame, keys: list[str], hash_of: Callable[..., Column] = F.xxhash64) -> DataFrame:
    """Rows whose key has its bit set: all rows with a key of the filter, and some others."""
    marked = df.withColumn("_h", hashed(keys, hash_of)).withColumn("_at", F.expr(_WORD))
    found = marked.join(F.broadcast(words), F.col("_at") == F.col("_word"))
    return found.where(F.col("_bits").bitwiseAND(F.expr(_BIT)) != 0).select(*df.columns)
