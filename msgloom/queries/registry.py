"""Registered queries, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL."""

    def register(fn: Query) -> Query:
        name = fn.__name__
        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register
