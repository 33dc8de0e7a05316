"""Access to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def collector(checks: dict):
    """Decorator adding a query and its SQL to a module's checks."""

    def check(sql: str | None, name: str | None = None):
        def add(fn: Query) -> Query:
            checks[name or fn.__name__] = (fn, sql)
            return fn

        return add

    return check
