"""Where queries are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, folder) -> DataFrame under its name."""

    def register(function):
        name = function.__name__.rstrip("_")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register
