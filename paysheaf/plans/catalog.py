"""Query catalog: key -> (Spark query builder, DuckDB oracle text or None).

Query modules register themselves with ``@query(key, oracle=...)``; the driver contract
in ``__spark_entry__.py`` reads ``queries()`` and ``oracle_sql()`` from here.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    key: str
    build: Builder
    oracle: str | None
    doc: str


_REGISTRY: dict[str, Query] = {}

_MODULES = (
    "q_analytics", "q_quality", "q_cleaners", "q_salary_etl", "q_documents",
    "q_links", "q_pages", "q_stats", "q_sinks",
)


def query(key: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        if key in _REGISTRY:
            raise ValueError(f"duplicate query key {key!r}")
        _REGISTRY[key] = Query(key, fn, oracle, (fn.__doc__ or "").strip())
        return fn
    return deco


def _load() -> dict[str, Query]:
    for m in _MODULES:
        try:
            importlib.import_module(f"{__package__}.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"{__package__}.{m}":
                raise
    return _REGISTRY


def catalog() -> dict[str, Query]:
    return dict(_load())
