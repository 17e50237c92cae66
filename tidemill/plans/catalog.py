"""The catalogue of queries over the test tables, filled by the modules of this package."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL if SQL can say it."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


for _module in ("summaries", "texts", "scores", "authors", "timeline", "collector", "vectors", "evidence", "features", "states", "reports"):
    importlib.import_module(f"tidemill.plans.{_module}")
