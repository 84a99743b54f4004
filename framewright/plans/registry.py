"""Where queries are kept with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def joined(values: Column) -> Column:
    """An array as text, so that any engine's rows compare alike."""
    return F.array_join(values.cast("array<string>"), ",")


def query(sql: str | None = None, *ctes: str, recursive: bool = False):
    """Registers a query under its function's name; sql is what DuckDB runs, after the given common table expressions."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = (f"WITH {'RECURSIVE ' * recursive}{', '.join(ctes)} " if ctes else "") + sql
        return f

    return put
