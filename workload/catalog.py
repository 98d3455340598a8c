"""Registry of the workload's queries and their SQL statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the DuckDB statement of the same result."""
    def add(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add
