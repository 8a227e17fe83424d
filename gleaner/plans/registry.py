"""All queries of the library with their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a plan under a name, with SQL that gives the same rows."""

    def put(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


def load() -> None:
    """Import the modules whose plans register themselves."""
    from gleaner.plans import areas, dashboard, evaluation, funnel, prep, readside, scoring, sources, texts  # noqa: F401
