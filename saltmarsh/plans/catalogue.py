"""All queries over the driver's tables and their DuckDB equivalents, gathered from the plans' modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import factors, filing, joining, messaging, portfolios, summaries, texts, validation, work

MODULES = (validation, factors, joining, texts, summaries, portfolios, work, filing, messaging)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q for m in MODULES for name, q in m.ORACLES.items()}
