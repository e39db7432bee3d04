"""Shared helpers: reading tables, unused column names and written intermediates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from curbflow.session import write_and_read


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, with underscores in front until no column of df has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def text_of(column: str = "text") -> Column:
    """The whole text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage through a table in the shared folder, so that lost executors cost no recomputation."""
    return write_and_read(df, name)


def fold(column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts. A null id falls in no fold."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def extended(kept: DataFrame, added: str) -> StructType:
    """The schema of kept with more columns, given as DDL."""
    return StructType([*kept.schema.fields, *StructType.fromDDL(added).fields])
