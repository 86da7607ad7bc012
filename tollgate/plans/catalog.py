"""Registry of named queries: key -> (Spark plan, optional DuckDB oracle SQL).

Each plan module decorates its query builders with ``@query(key, sql)``.
A builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}

PLAN_MODULES = (
    "tollgate.plans.lifecycle",
    "tollgate.plans.signals",
    "tollgate.plans.usage",
    "tollgate.plans.release",
    "tollgate.plans.scalars",
    "tollgate.plans.streams",
    "tollgate.plans.ml_io",
)


def query(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in _QUERIES:
            raise ValueError(f"duplicate query key {key}")
        _QUERIES[key] = fn
        if sql is not None:
            _ORACLE[key] = sql
        return fn
    return deco


def _load() -> None:
    for m in PLAN_MODULES:
        importlib.import_module(m)


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)
