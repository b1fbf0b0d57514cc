"""First-in-first-out valuation against a plain loop, without frames that are read again for each row."""

from __future__ import annotations

import random
from collections import deque

import pytest
from saltmarsh.operators import ledger


def test_fifo_is_the_loop_and_reads_no_frame_again(spark):
    r = random.Random(4)
    rows = [(i, f"2025-01-{r.randint(1, 28):02d}", s, r.choice(["BUY", "SELL"]), float(r.randint(1, 9)), r.randint(1, 99) / 4, 0.25, 0.5) for s in ("a", "b") for i in range(200 if s == "a" else 7)]
    rows += [(0, "2025-01-01", "c", "BUY", 3.0, 2.0, 0.0, 0.0)]
    out = ledger.fifo(spark.createDataFrame(rows, "row_no long, ts string, symbol string, side string, qty double, price double, fee double, tax double"))
    got = {x["symbol"]: x for x in out.collect()}
    for symbol in "abc":
        lots, realised, uncovered = deque(), 0.0, 0.0
        for _, _, _, side, qty, price, fee, tax in sorted((x for x in rows if x[2] == symbol), key=lambda x: (x[1], x[0])):
            if side == "BUY":
                lots.append([qty, (qty * price + fee + tax) / qty])
                continue
            realised += qty * price - fee - tax
            while qty and lots:
                take = min(qty, lots[0][0])
                realised -= take * lots[0][1]
                qty, lots[0][0] = qty - take, lots[0][0] - take
                if not lots[0][0]:
                    lots.popleft()
            uncovered += qty
        x = got[symbol]
        assert [x["realised"], x["uncovered"], x["open_qty"], x["open_cost"]] == pytest.approx([realised, uncovered, sum(n for n, _ in lots), sum(n * c for n, c in lots)])
    plan = out._jdf.queryExecution().executedPlan().toString().lower()
    assert "unboundedpreceding$(), currentrow$()" in plan and "currentrow$(), unboundedfollowing$()" not in plan
