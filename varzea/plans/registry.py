"""The registry of the library's own queries and their SQL. Query modules register with `query` when they are imported."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its name, with the SQL of the same rows."""

    def register(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def _load() -> None:
    from varzea.plans import curation_queries, insight_queries, layer_queries, lifecycle_queries, record_queries, resolve_queries, rule_queries, text_queries  # noqa: F401
    from varzea.streaming import stream_queries  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
