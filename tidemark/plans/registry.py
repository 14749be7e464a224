"""Registry of named queries and their DuckDB oracle SQL.

A query is a callable ``(spark, sf_dir) -> DataFrame``. ``sql`` is the
equivalent ANSI SQL over the test tables (DuckDB dialect); ``None`` marks a
model or random operator that is only checked for rows/schema.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql.strip()
        return fn
    return deco


def oracle_of(name: str) -> str:
    """The SQL of a query that is registered already (for totals over its rows)."""
    return _SQL[name]


def _load_all() -> None:
    # importing the modules registers their queries
    from tidemark.plans import (q_churn, q_clean, q_profile, q_joins, q_state,  # noqa: F401
                                q_encode, q_text, q_sample, q_metrics, q_models, q_stream, q_sources, q_rules)


def queries() -> dict[str, Query]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_SQL)
