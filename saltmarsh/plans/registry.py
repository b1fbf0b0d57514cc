"""Queries and their DuckDB equivalents, collected by module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Plans:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None):
        """Register a function of (spark, sf_dir); ``sql`` is what DuckDB runs on the same tables."""

        def add(f):
            self.queries[name] = f
            if sql:
                self.oracles[name] = sql
            return f

        return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
