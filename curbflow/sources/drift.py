"""One relation from files whose schemas drifted: grouped by schema, widened where that loses nothing, and reported."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Each type and those it may be widened to without loss, in order. Fixed rules of this project.
WIDENINGS = {
    "tinyint": ("smallint", "int", "bigint", "double"),
    "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"),
    "bigint": (),
    "float": ("double",),
    "date": ("timestamp_ntz",),
}


@dataclass(frozen=True)
class Group:
    """Files with the same columns and types."""

    schema: StructType
    files: tuple[str, ...]

    @property
    def types(self) -> dict[str, str]:
        return {f.name: f.dataType.simpleString() for f in self.schema}


def grouped_by_schema(spark: SparkSession, files: list[str]) -> list[Group]:
    """Files by their ordered names and types, read from the footers."""
    found: dict[str, tuple[StructType, list[str]]] = {}
    for path in sorted(files):
        schema = spark.read.parquet(path).schema
        found.setdefault(schema.simpleString(), (schema, []))[1].append(path)
    return [Group(schema, tuple(paths)) for schema, paths in found.values()]


def common_type(types: list[str]) -> str | None:
    """The narrowest type that all of them are or widen to; None if there is none."""
    reachable = [(t, *WIDENINGS.get(t, ())) for t in types]
    return next((t for t in reachable[0] if all(t in r for r in reachable)), None)


def plan_of(groups: list[Group]) -> dict[str, str | None]:
    """Column -> common type, in the order of first appearance; None where the types conflict."""
    columns = dict.fromkeys(c for g in groups for c in g.types)
    return {c: common_type([g.types[c] for g in groups if c in g.types]) for c in columns}


def reconciled(spark: SparkSession, groups: list[Group]) -> DataFrame:
    """All rows under the common types. A column that a group lacks is NULL there; one whose types conflict is text, so
    that no value is lost."""
    target = {c: t or "string" for c, t in plan_of(groups).items()}
    parts = [
        spark.read.schema(g.schema).parquet(*g.files).select(
            *((F.col(c) if c in g.types else F.lit(None)).cast(t).alias(c) for c, t in target.items())
        )
        for g in groups
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def drift_report(spark: SparkSession, groups: list[Group]) -> DataFrame:
    """One row per column and group: its type there, the common type, and same, widened, missing or conflict."""
    rows = []
    for column, common in plan_of(groups).items():
        for number, g in enumerate(groups):
            own = g.types.get(column)
            status = "missing" if own is None else "conflict" if common is None else "same" if own == common else "widened"
            rows.append((column, number, len(g.files), own, common, status))
    return spark.createDataFrame(
        rows, "column_name string, schema_group int, files int, own_type string, common_type string, status string"
    )
