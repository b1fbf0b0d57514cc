"""Vector codes against Lloyd's rounds in plain Python, and the heaps against comparing everything again."""

from __future__ import annotations

import math
from hashlib import sha256

import numpy as np
import pytest
from saltmarsh.llm import vector_codes

from ..conftest import SMALL, table
from .test_models import VECTORS, usable, vectors


def plain_lloyd(rows, parts, entries, rounds, scale):
    kept = [(i, label, [math.floor(float(np.float32(c)) * scale) for c in e]) for i, e, label, *_ in rows if usable(e)]
    width = -(-max((len(x) for *_, x in kept), default=0) // parts)
    kept = [(i, label, x + [0] * (width * parts - len(x))) for i, label, x in kept]
    cut = lambda x: [x[p * width : p * width + width] for p in range(parts)]
    start = [cut(x) for _, _, x in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]]
    books = [[x[p] for x in start] for p in range(parts)]
    gap = lambda a, b: sum((s - t) ** 2 for s, t in zip(a, b, strict=True))
    for k in range(rounds + 1):
        at = [[min(range(len(books[p])), key=lambda e: (gap(x, books[p][e]), e)) for p, x in enumerate(cut(v))] for *_, v in kept]
        if k == rounds:
            break
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut(v)[p] for (*_, v), a in zip(kept, at, strict=True) if a[p] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    errors = [sum(gap(x, books[p][a[p]]) for p, x in enumerate(cut(v))) for (*_, v), a in zip(kept, at, strict=True)]
    name = sha256(",".join(str(c) for p in books for e in p for c in e).encode()).hexdigest()
    totals = {}
    for (_, label, _), e in zip(kept, errors, strict=True):
        totals[label] = totals.get(label, 0) + e
    return sorted((str(i), "".join(f"{e:02x}" for e in a), err, totals[label], name) for (i, label, _), a, err in zip(kept, at, errors, strict=True))


def ours(df, **how):
    return sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in vector_codes.encode(df, **how)[0].collect())


def test_codes(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "COMPONENTS", 64 * 32)  # several blocks a partition
    data = vectors()
    data[25] = (25, [3e5] * 32, 1, 0, "")
    data += [(None, data[3][1], None, 0, ""), (5, data[5][1], 1, 0, ""), (5, data[6][1], 0, 0, ""), (900, [], 0, 0, ""), (901, [0.5] * 31, 0, 0, ""), (902, [-0.0] * 32, 0, 0, "")]
    df = spark.createDataFrame(data, VECTORS).repartition(3)
    for how in ({"parts": 16, "entries": 64, "rounds": 2, "scale": 256}, {"parts": 5, "entries": 7, "rounds": 6, "scale": 16}, {"parts": 4, "entries": 1, "rounds": 1, "scale": 256}):
        assert ours(df, **how) == plain_lloyd(data, **how)
    assert vector_codes.encode(df.limit(0))[0].count() == 0
    few = [r for r in data if r[0] in (1, 2, 3)]
    assert ours(spark.createDataFrame(few, VECTORS)) == plain_lloyd(few, 16, 64, 2, 256)
    with pytest.raises(ValueError, match="don't fit"):
        vector_codes.encode(spark.createDataFrame([(1, [1e30], 0)], "vec_id long, embedding array<float>, label int"))


def test_label_sums_in_shares(spark, monkeypatch):
    df = spark.createDataFrame([r for r in vectors() if r[0] != 25], VECTORS)
    whole = ours(df)
    monkeypatch.setattr(vector_codes, "BROADCAST_ROWS", 0)
    assert ours(df) == whole


def test_heaps_leave_out_what_cannot_move():
    r = np.random.default_rng(3)
    centres = r.integers(-4000, 4000, (3, 20, 4))
    x = np.stack([centres[p][r.integers(0, 20, 3000)] + r.integers(-60, 60, (3000, 4)) for p in range(3)], 1)
    books, drift = np.stack([centres[p] + 30 for p in range(3)]), np.zeros((3, 20))
    block = vector_codes.Block(x, 20)
    block.enter_all(books, drift)
    compared = 0
    for k in range(8):
        new = books + r.integers(-40 >> k, (40 >> k) + 1, books.shape)
        drift, books = drift + vector_codes.moved(books, new), new
        compared += block.move(books, drift)
        for p in range(3):
            assert (block.at[:, p] == vector_codes.distances(x[:, p], books[p]).argmin(1)).all()
    assert compared < 0.3 * 8 * 9000
    wide = x * (1 << 30)
    assert (vector_codes.distances(wide[:50, 0], books[0] * (1 << 30)) == vector_codes.distances(x[:50, 0], books[0]).astype(object) * (1 << 60)).all()


def test_codes_query(spark, duck):
    from saltmarsh.llm import queries as llm

    got, want = llm.queries()["op12_vector_codes"](spark, SMALL), duck.sql(llm.oracle_sql()["op12_vector_codes"])
    assert table(got.columns, got.collect()) == table(want.columns, want.fetchall())
