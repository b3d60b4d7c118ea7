"""The registered queries of this package, with the SQL they equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def load() -> tuple[dict[str, Query], dict[str, str]]:
    from catloom.llm import queries, queries_spans  # noqa: F401

    return dict(QUERIES), dict(ORACLES)
