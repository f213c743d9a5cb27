"""Registration of queries: the Spark plan and, where SQL can say the same, the SQL beside it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a plan under its function's name."""

    def register(plan: Query) -> Query:
        key = name or plan.__name__
        QUERIES[key] = plan
        if sql:
            ORACLES[key] = sql
        return plan

    return register
