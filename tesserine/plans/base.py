"""Registration of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of a directory, read when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")


def query(sql: str | None = None):
    """Registers fn(tables) under its name; sql gives the same rows in DuckDB."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


def r6(c: Column | str) -> Column:
    """Six decimals, so that results don't depend on the order of sums."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def listed(c: Column | str) -> Column:
    """A sorted list as text."""
    return F.array_join(F.array_sort(F.col(c) if isinstance(c, str) else c), ",")
