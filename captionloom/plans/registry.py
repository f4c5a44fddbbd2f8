"""Every registered query of the engine's own operators, with the SQL that checks it."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
_MODULES = ("audit", "parse", "route", "prompt", "tag", "rate", "caption")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its name, with its SQL if there is some."""

    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _load() -> None:
    for name in _MODULES:
        importlib.import_module(f"captionloom.plans.queries_{name}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
