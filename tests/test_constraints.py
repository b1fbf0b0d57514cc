"""Checks as data: each kind with rows that fail it, nulls, and how often a table is read."""

from __future__ import annotations

import pytest
from saltmarsh.operators import constraints as C
from saltmarsh.operators import portfolio


def test_each_kind_counts_its_failures(spark):
    a = spark.createDataFrame([(1, "x", 2.0), (1, "y", -1.0), (2, "x", None), (None, "z", 4.0)], "k int, v string, n double")
    b = spark.createDataFrame([(1, "x", True), (1, "y", False), (None, "z", True)], "k int, v string, good boolean")
    checks = [
        C.Rows("positive", "a", "n > 0"),
        C.Rows("positive where x", "a", "n > 0", "v = 'x'"),
        C.Groups("sums", "a", ("k",), "sum(n) > 0.5"),
        C.Groups("one", "a", ("k", "v"), "count(*) = 1"),
        C.Subset("in b", "a", "b", ("k", "v")),
        C.Subset("in good b", "a", "b", ("k", "v"), "true", "good"),
        C.Subset("x in b", "a", "b", ("k",), "v = 'x'"),
        C.Totals("counts", "a", "count(*)", "b", "count(*) + 1"),
        C.Totals("sums differ", "a", "sum(n)", "b", "count(*)"),
        C.Totals("null", "a", "max(case when false then n end)", "b", "count(*)"),
        C.Totals("nulls", "a", "max(case when false then n end)", "b", "max(case when false then k end)"),
    ]
    got = {r["check"]: (r["ok"], r["failures"]) for r in C.evaluate({"a": a, "b": b}, checks).collect()}
    assert {k: v[1] for k, v in got.items()} == {"positive": 2, "positive where x": 1, "sums": 1, "one": 0, "in b": 2, "in good b": 3, "x in b": 1, "counts": 0, "sums differ": 1, "null": 1, "nulls": 0}
    assert all(ok == (n == 0) for ok, n in got.values())
    assert [len(x) for x in (C.plans({"a": a, "b": b}, checks), checks)] == [6, 11]
    with pytest.raises(ValueError):
        C.evaluate({"a": a}, checks[:1] * 2)
    empty = C.evaluate({"a": a.limit(0), "b": b}, checks[:6]).collect()
    assert all(r["ok"] for r in empty)


def test_all_checks_of_a_portfolio_fail_on_what_breaks_them(spark):
    assert len(portfolio.CHECKS) >= 30
    day = "date '2025-01-01'"
    weights = spark.sql(f"select 1 track, {day} date, 5 code, 70.0 weight_pct union all select 1, {day}, 5, 40.0 union all select 1, {day}, null, -5.0")
    trades = spark.sql(f"select 1 track, {day} date, 6 code, 'new' kind, -1.0 delta union all select 1, {day}, 6, 'odd', 0.0 union all select 1, date '2025-02-01', 7, 'more', 1.0 union all select 1, {day}, 7, 'less', -1.0 union all select 1, {day}, 9, 'sold', -1.0")
    timeline = spark.sql("select 1 track, date '2024-01-01' date, 8 code, 'added' change union all select 1, date '2024-01-01', 9, 'removed'")
    deltas = spark.sql(f"select 1 track, {day} date, 7 code, 0.01 delta")
    curve = spark.sql("select 2 track, date '2025-03-01' date, 0.0 ret, -1.0 equity union all select 2, date '2025-03-01', 0.0, -1.0")
    models = spark.sql("select 'a' model_id, double('nan') score, 1 rank union all select 'a', 1.0, 2")
    summary = spark.sql("select 'LIVE' mode, false real_ledger, 0.3 axis_cap, 0.6 corr_threshold, 9 weights, 9 trades, 9.0 best_equity, date '2020-01-01' last_day, 'b' model_id")
    tables = {"weights": weights, "trades": trades, "timeline": timeline, "deltas": deltas, "curve": curve, "models": models, "summary": summary}
    passed = [r["check"] for r in C.evaluate(tables, portfolio.CHECKS).collect() if r["ok"]]
    assert passed == ["weights_slots_not_exceeded", "summary_mode_known"]
    assert len(C.plans(tables, portfolio.CHECKS)) <= 20


def test_weights_that_just_meet_their_sum_do_so_in_any_order(spark):
    for weights in ([19.8, 7.6, 12.9, 5.6, 21.2, 32.7], [9.6, 29.8, 26.5, 8.0, 13.3, 13.0], [26.2, 17.6, 19.7, 5.9, 11.1, 19.7]):
        down = 0.0
        for w in sorted(weights, reverse=True):
            down += w
        for order in (sorted(weights), sorted(weights, reverse=True), weights):
            held = spark.createDataFrame([(1, "2025-01-01", k, w, None) for k, w in enumerate(order)], "track int, date string, code int, weight_pct double, change string").coalesce(1)
            checks = [c for c in portfolio.CHECKS if c.name == "weights_daily_sum_approx_100"]
            assert C.evaluate({"weights": held}, checks).first()["ok"] == (abs(down - 100) <= 0.2)
            trades, curve = spark.createDataFrame([], "track int, date string, code int, kind string, delta double"), held.select("track", "date").distinct()
            assert portfolio.consistency(held, trades, curve).where("check = 'weights_sum_to_100'").first()["ok"] == (abs(down - 100) <= 0.2)
