"""Registry: query key -> (Spark query over a source dir, reference SQL).

``__spark_entry__`` re-exports :func:`queries` and :func:`oracle_sql`.
adapter), so its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridmix.plans import models
from gridmix.plans import oracle as O

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    """Decorator: register a Spark query and (optionally) its reference SQL."""
    def deco(fn: QueryFn) -> QueryFn:
        if key in _QUERIES:
            raise ValueError(f"duplicate query key {key}")
        _QUERIES[key] = fn
        if sql is not None:
            _SQL[key] = sql
        return fn
    return deco


def _load_all() -> None:
    # importing the modules registers their keys
    from gridmix.plans import queries_core  # noqa: F401
    from gridmix.plans import queries_ops  # noqa: F401
    from gridmix.plans import queries_bi  # noqa: F401
    from gridmix.plans import queries_changes  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_SQL)


__all__ = ["register", "queries", "oracle_sql", "models", "O"]
