"""Design columns and chronological splits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.functions.measures import rows
from curbflow.operators.series import numbered

CONST = "const"
# Categorical terms are calendar parts with these levels.
LEVELS = {"hour_of_day": range(24), "day_of_week": range(7), "regression_month": range(1, 13)}


@dataclass(frozen=True)
class Spec:
    """A linear model: a target, numeric terms and categorical terms (one-hot, first level dropped)."""

    name: str
    continuous: tuple[str, ...]
    categorical: tuple[str, ...] = ()
    target: str = "taxi_trip_count"
    intercept: bool = True

    @property
    def inputs(self) -> tuple[str, ...]:
        return (self.target, *self.continuous, *self.categorical)


@dataclass(frozen=True)
class Design:
    """Rows of a spec: the identifying column, the target `y` and one double column per term."""

    frame: DataFrame
    terms: tuple[str, ...]
    key: str


def all_levels(df: DataFrame, columns: tuple[str, ...]) -> dict[str, list[int]]:
    """Levels of every categorical column that occur, among those its calendar part can have (LEVELS)."""
    if not columns:
        return {}
    unknown = [c for c in columns if c not in LEVELS]
    if unknown:
        raise ValueError(f"no levels are declared for {unknown}")
    present = df.agg(*(F.bool_or(F.col(c) == v).alias(f"{c}_{v}") for c in columns for v in LEVELS[c])).first()
    return {c: [v for v in LEVELS[c] if present[f"{c}_{v}"]] for c in columns}


def term_names(spec: Spec, known_levels: dict[str, list[int]]) -> tuple[str, ...]:
    dummies = (f"{c}_{v}" for c in spec.categorical for v in known_levels[c][1:])
    return (*((CONST,) if spec.intercept else ()), *spec.continuous, *dummies)


def complete_rows(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return df.dropna(subset=list(dict.fromkeys(columns)))


def design_matrix(df: DataFrame, spec: Spec, key: str = "pickup_hour", carry: tuple[str, ...] = (),
                  known_levels: dict[str, list[int]] | None = None) -> Design:
    """Terms in order: constant, numeric columns, then each categorical's levels but the first."""
    found = known_levels or all_levels(df, spec.categorical)
    terms = {CONST: F.lit(1.0)} if spec.intercept else {}
    terms |= {c: F.col(c).cast("double") for c in spec.continuous}
    for column in spec.categorical:
        terms |= {f"{column}_{v}": (F.col(column) == v).cast("double") for v in found[column][1:]}
    frame = df.select(
        F.col(key), *carry, F.col(spec.target).cast("double").alias("y"),
        *(value.alias(name) for name, value in terms.items()),
    )
    return Design(frame, tuple(terms), key)


def chronological_split(df: DataFrame, test_share: float) -> DataFrame:
    """Mark the first floor(n * (1 - test_share)) rows in time order as the training sample."""
    total = df.agg(rows()).scalar()
    placed = numbered(df, "pickup_hour", "_place")
    return placed.withColumn("is_train", F.col("_place") < F.floor(total * F.lit(1.0 - test_share))).drop("_place")
