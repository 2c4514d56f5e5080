"""Registry of the named queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillwright.plans.shop import Shop

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(shop) -> DataFrame`` under ``name``."""

    def register(fn: Callable[[Shop], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Shop(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return fn

    return register
