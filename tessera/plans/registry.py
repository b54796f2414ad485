"""Every query of the library's own operators by name, and its oracle.

A query's name starts with the ids of the operators that it covers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

FLAGSHIP = "top05_pip04_hybrid_retrieval"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of a folder, read by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable:
    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            ORACLES[name] = sql
        return f

    return register
