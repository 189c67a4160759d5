from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register the function with the SQL that gives the same rows, by default as its name."""

    def register(build: Query) -> Query:
        QUERIES[name or build.__name__] = build
        ORACLES[name or build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
