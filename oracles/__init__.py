"""DuckDB statements that state each query's result independently of the Spark code."""

from __future__ import annotations


def statements() -> dict[str, str]:
    from oracles.analysis import ANALYSIS_SQL, PROFILE_SQL, VALIDATION_SQL
    from oracles.relations import RELATION_SQL
    from oracles.stats import STATS_SQL

    return {**RELATION_SQL, **ANALYSIS_SQL, **PROFILE_SQL, **VALIDATION_SQL, **STATS_SQL}
