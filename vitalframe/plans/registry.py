"""Registry of named queries: a Spark builder and, where SQL can say it, the
equivalent DuckDB text over the same driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vitalframe.sources.adapters import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(sql, *views) if views else sql
        return fn
    return deco
