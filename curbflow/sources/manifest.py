"""Descriptions of source files: size, digest, rows, columns and schema drift."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.functions.measures import rows


BLOCK = 1 << 20


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for path in batch.column("path").to_pylist():
            store, inner = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
            digest = hashlib.sha256()
            with store.open_input_stream(inner) as stream:
                while block := stream.read(BLOCK):
                    digest.update(block)
            found.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("file_name"), batch.column("file_size_bytes"), pa.array(found, pa.string())],
            names=["file_name", "file_size_bytes", "sha256"],
        )


def file_digests(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Name, size and sha256 of every file. Tasks stream files block by block, so a file's size does not matter.

    Spark lists the files; the executors open them through Arrow, which knows local, HDFS, S3 and GCS paths.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    listed = files.select(
        "path", F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("file_size_bytes")
    )
    return listed.mapInArrow(_digests, "file_name string, file_size_bytes long, sha256 string")


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows per file of a scan; parquet answers this without reading any column."""
    return df.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(rows().alias("row_count"))


def files_in_scan(df: DataFrame) -> DataFrame:
    return df.select(F.col("_metadata.file_name").alias("file_name")).distinct().orderBy("file_name")


def describe(df: DataFrame) -> DataFrame:
    """Column position, name and type as rows."""
    return df.sparkSession.createDataFrame(
        [(i, n, t) for i, (n, t) in enumerate(df.dtypes, 1)], "position int, column_name string, data_type string"
    )


def schema_fingerprint(df: DataFrame) -> str:
    """sha256 of the ordered (name, type) list."""
    return hashlib.sha256(json.dumps(df.dtypes).encode("utf-8")).hexdigest()


def schema_drift(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Fingerprint per path; only footers are read."""
    found = [(p.rsplit("/", 1)[-1], schema_fingerprint(spark.read.parquet(p))) for p in paths]
    return spark.createDataFrame(found, "file_name string, schema_fingerprint string")


def source_manifest(spark: SparkSession, path: str, names: list[str], period: str | None = None) -> DataFrame:
    """One row per parquet file: size, digest, rows, column list, schema fingerprint, period."""
    parts = []
    for name in names:
        df = spark.read.parquet(f"{path}/{name}.parquet")
        described = rows_per_file(df).select(
            F.lit(f"{name}.parquet").alias("source"),
            "file_name",
            "row_count",
            F.array(*map(F.lit, df.columns)).alias("columns"),
            F.lit(schema_fingerprint(df)).alias("schema_fingerprint"),
            F.lit(period).alias("period"),
        )
        digests = file_digests(spark, f"{path}/{name}.parquet")
        parts.append(digests.join(described, "file_name"))
    manifest = parts[0]
    for part in parts[1:]:
        manifest = manifest.unionByName(part)
    return manifest
