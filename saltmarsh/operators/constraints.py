"""Checks of tables as data: stated one by one, compiled to one aggregate a table, one a table and key, and one join a pair of tables.

Conditions are SQL expressions over a table's columns. A condition that is null doesn't hold.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rows:
    """Every row of a table (``where``) fulfils ``ok``; a failure is a row."""

    name: str
    table: str
    ok: str
    where: str = "true"


@dataclass(frozen=True)
class Groups:
    """Every group of rows with equal keys fulfils ``ok``, an expression of aggregates; a failure is a group."""

    name: str
    table: str
    keys: tuple[str, ...]
    ok: str


@dataclass(frozen=True)
class Subset:
    """Every row of a table (``where``) has a row of another with equal keys (``other_where``); a failure is a row of the first."""

    name: str
    table: str
    other: str
    keys: tuple[str, ...]
    where: str = "true"
    other_where: str = "true"


@dataclass(frozen=True)
class Totals:
    """Two tables' aggregates agree, to ``tolerance``; not agreeing, or null on one side only, is one failure."""

    name: str
    table: str
    value: str
    other: str
    other_value: str
    tolerance: float = 1e-9


Check = Rows | Groups | Subset | Totals


def _failing(condition: Column) -> Column:
    return F.count_if(~F.coalesce(condition, F.lit(False)))


def plans(tables: dict[str, DataFrame], checks: Sequence[Check]) -> dict[str, DataFrame]:
    """By what it reads, one frame of one row each: a column ``c<i>`` for check i (a Totals' two sides: ``c<i>`` and ``d<i>``)."""
    single, grouped, paired = defaultdict(list), defaultdict(list), defaultdict(list)
    for i, c in enumerate(checks):
        if isinstance(c, Rows):
            single[c.table].append(F.count_if(F.expr(c.where) & ~F.coalesce(F.expr(c.ok), F.lit(False))).alias(f"c{i}"))
        elif isinstance(c, Groups):
            grouped[c.table, c.keys].append((i, c))
        elif isinstance(c, Subset):
            paired[c.table, c.other, c.keys].append((i, c))
        else:
            single[c.table].append(F.expr(c.value).cast("double").alias(f"c{i}"))
            single[c.other].append(F.expr(c.other_value).cast("double").alias(f"d{i}"))
    out = {t: tables[t].agg(*columns) for t, columns in single.items()}
    for (t, keys), found in grouped.items():
        sums = tables[t].groupBy(*keys).agg(*[F.expr(c.ok).alias(f"g{i}") for i, c in found])
        out[f"{t} by {', '.join(keys)}"] = sums.agg(*[_failing(F.col(f"g{i}")).alias(f"c{i}") for i, _ in found])
    for (t, other, keys), found in paired.items():
        # keys before the join, on both sides: a pair of tables meets in as many rows as it has different keys
        left = tables[t].groupBy(*keys).agg(*[F.count_if(F.expr(c.where)).alias(f"n{i}") for i, c in found])
        right = tables[other].groupBy(*keys).agg(*[F.bool_or(F.expr(c.other_where)).alias(f"r{i}") for i, c in found])
        # a key with a null in it matches nothing
        met = left.join(right, list(keys), "left")
        out[f"{t} in {other} by {', '.join(keys)}"] = met.agg(*[F.coalesce(F.sum(F.when(~F.coalesce(F.col(f"r{i}"), F.lit(False)), F.col(f"n{i}"))), F.lit(0)).alias(f"c{i}") for i, _ in found])
    return out


def evaluate(tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """check, ok, failures in order of statement. The driver gets one row for each of ``plans``."""
    names = [c.name for c in checks]
    if len(set(names)) < len(names):
        raise ValueError("two checks have one name")
    values: dict[str, float | int | None] = {}
    for frame in plans(tables, checks).values():
        values |= frame.first().asDict()
    rows = []
    for i, c in enumerate(checks):
        failures = values[f"c{i}"]
        if isinstance(c, Totals):
            a, b = values[f"c{i}"], values[f"d{i}"]
            failures = int(a is not b if a is None or b is None else not abs(a - b) <= c.tolerance)
        rows.append((c.name, failures == 0, int(failures)))
    session = next(iter(tables.values())).sparkSession
    return session.createDataFrame(rows, "check string, ok boolean, failures long")
