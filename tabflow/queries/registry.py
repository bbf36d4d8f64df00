"""Query registry: ``name -> (callable(spark, sf_dir) -> DataFrame, oracle SQL)``."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tabflow.sources.tables import table

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    ids: str


REGISTRY: dict[str, Query] = {}
_MODULES = ("scans", "projections", "quality", "joins", "aggregations", "windows",
            "sorting", "streams", "udfs_ml", "jobs", "reports", "skew", "layout", "series")


def query(name: str, ids: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``; ``sql=None`` means rows-only check."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql.strip() if sql else None, ids)
        return fn
    return deco


def tbl(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name)


def _load() -> None:
    for mod in _MODULES:
        importlib.import_module(f"tabflow.queries.{mod}")


def all_queries() -> dict[str, QueryFn]:
    _load()
    return {name: q.fn for name, q in REGISTRY.items()}


def oracle_sqls() -> dict[str, str]:
    _load()
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}
