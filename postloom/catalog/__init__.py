"""Named queries over the test tables, each with its SQL twin where SQL can say the same."""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

_MODULES = ["scans", "scalars", "relational", "ranked", "texts", "vectors", "clusterings", "reports", "streams"]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


def sql_of(name: str) -> str:
    """SQL of a query registered before."""
    return _SQL[name]


def _load() -> None:
    for module in _MODULES:
        importlib.import_module(f"{__name__}.{module}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
