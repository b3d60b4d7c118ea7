"""Named queries over the test tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catloom.context import RunContext

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CTX = RunContext(
    connection_qn="default/bi/1",
    connection_name="BI",
    connector_name="bi",
    workflow_id="wf",
    run_id="run-1",
    run_at_ms=1700000000000,
    host="https://bi.example.com",
)


def query(name: str, sql: str | None = None):
    """Register a query; without ``sql`` only its rows are checked."""

    def add(fn: Query) -> Query:
        from catloom.session import configure

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return add
