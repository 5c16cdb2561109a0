"""The book of this subpackage's queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its own name, with its SQL where there is one."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register
