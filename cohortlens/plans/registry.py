"""Query registry: name → (Spark callable, DuckDB oracle SQL or None).

Query modules call ``register`` at import time; ``__spark_entry__`` exposes
the registry through ``queries()`` and ``oracle_sql()``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn
    return deco


def _load():
    # import for side effects (registration)
    from cohortlens.plans import (q_clean, q_metrics, q_privacy, q_cohort, q_fhir,  # noqa: F401
                                  q_encode, q_ml, q_reports, q_synth)


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
