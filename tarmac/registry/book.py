"""The book of registered queries: key, Spark query, and SQL to check it against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarmac.registry.binding import Tables
from tarmac.registry.oracle import with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, **changed: str):
    """Register a function of ``Tables`` under its own name, with its SQL (over tables with conditions on their rows)."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(spark, sf_dir))

        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLES[build.__name__] = with_tables(sql, **changed)
        return build

    return register
