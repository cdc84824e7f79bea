"""What is registered: name -> Spark job, and name -> DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadcast.plans.fixtures import duck_sql

Job = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Job] = {}
ORACLES: dict[str, str] = {}


def register(name: str, job: Job, sql: str | None = None) -> None:
    QUERIES[name] = job
    if sql is not None:
        ORACLES[name] = duck_sql(sql)
