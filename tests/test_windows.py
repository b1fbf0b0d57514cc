"""Recurrences as scans against plain loops: gaps, several years in different tasks, short units."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from saltmarsh.operators import windows


def series(n: int = 900) -> list[tuple]:
    r, rows = random.Random(3), []
    for symbol in ("a", "b", "c", None):
        day = date(2019, 11, 3)
        for i in range(n if symbol == "a" else 150):
            day += timedelta(days=r.choice([1, 1, 1, 3, 40 if symbol == "b" else 1]))
            gap = symbol == "b" and i < 5 or r.random() < 0.15 or symbol == "a" and 300 < i < 420
            rows.append((symbol, day, None if gap or symbol == "c" and i < 149 else r.gauss(100, 20), r.choice([0.05, 0.2, 0.9, 1.0])))
    return rows


def loop(rows, alpha, fading):
    out, y, gap, now = {}, None, 0, object()
    for symbol, day, x, a in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        if symbol != now:
            now, y, gap = symbol, None, 0
        a = alpha or a
        if x is None:
            gap += 1
        else:
            old = (1 - a) ** (gap + 1)
            y = x if y is None else (old * y + a * x) / (old + a) if fading else a * x + (1 - a) * y
            gap = 0
        out[symbol, day] = y
    return out


@pytest.mark.parametrize("unit", [4, 128])
@pytest.mark.parametrize(("alpha", "fading"), [(0.2, True), (0.9, True), (1.0, True), (None, False), (1.0, False)])
def test_scan_is_the_loop(spark, monkeypatch, unit, alpha, fading):
    monkeypatch.setattr(windows, "UNIT", unit)
    rows = series()
    df = spark.createDataFrame(rows, "symbol string, date date, x double, a double").repartition(6)
    got = windows._recurrent(df, "x", F.lit(alpha) if alpha else F.col("a"), "y", fading)
    assert got.columns == ["symbol", "date", "x", "a", "y"]
    want, n = loop(rows, alpha, fading), 0
    for r in got.collect():
        n += 1
        w = want[r["symbol"], r["date"]]
        assert r["y"] == w if w is None else r["y"] == pytest.approx(w, rel=1e-9)
    assert n == len(rows)


def test_no_python_workers_and_years_apart(spark):
    df = spark.createDataFrame(series(), "symbol string, date date, x double, a double")
    out = windows.ewm(df, "x", 10, "y")
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan
    assert windows.ewm(df.limit(0), "x", 10, "y").count() == 0


def test_larger_tables_get_more_tasks_and_no_other_shuffle(spark, monkeypatch):
    from saltmarsh import shared
    from saltmarsh.operators import windows
    from saltmarsh.sources import market

    from .conftest import SMALL

    rows = spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    monkeypatch.setattr(shared, "TASK_ROWS", rows // 50, raising=False)
    grown = windows.equity(market.bars(spark, SMALL).withColumn("ret", windows.change("close") / 100))
    plan = grown._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert grown.rdd.getNumPartitions() >= 50


@pytest.mark.parametrize("name", ["w2_adaptive_ema", "w4_flow_proxy", "w6_atr_risk", "w8_value_score"])
def test_recurrences_leave_rows_where_they_are_and_store_nothing(spark, monkeypatch, name):
    from saltmarsh import shared
    from saltmarsh.plans import factors

    from .conftest import SMALL

    monkeypatch.setattr(shared, "shared_path", None)
    plan = factors.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan
