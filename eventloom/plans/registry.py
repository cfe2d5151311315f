"""Every named query with its builder and, where SQL can say it, the independent check text."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Builder] = {}
_CHECKS: dict[str, str] = {}
_MODULES = ("clickstream", "warehouse", "market", "flights", "quality", "observability", "delivery")


def query(name: str, sql: str | None = None):
    """Register a builder under ``name``; ``sql`` is the same result in DuckDB's dialect."""

    def add(fn: Builder) -> Builder:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")
        _QUERIES[name] = run
        if sql is not None:
            _CHECKS[name] = sql
        return fn

    return add


def _load() -> None:
    for module in _MODULES:
        import_module(f"eventloom.plans.{module}")


def all_queries() -> dict[str, Builder]:
    _load()
    return dict(_QUERIES)


def all_checks() -> dict[str, str]:
    _load()
    return dict(_CHECKS)
