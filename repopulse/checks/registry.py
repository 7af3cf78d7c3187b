"""Named queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

RUNS: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query; without ``sql`` only its rows are checked here, its values in the tests."""

    def register(run: Run) -> Run:
        if name in RUNS:
            raise ValueError(f"{name} is registered twice")
        RUNS[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register
