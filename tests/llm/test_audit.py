"""The audit of filters against a plain loop over documents and orders."""

from __future__ import annotations

import re
from itertools import permutations

from saltmarsh.llm import filter_audit

from ..conftest import SMALL, table

DOCS = "doc_id long, text string, source string, n int, part string, fails int"


def documents() -> list[tuple]:
    long = " ".join(f"word{i}" for i in range(60))
    texts = [long, long, long.upper(), "few words", "#" + long, " ".join(["same"] * 70), " ".join(["Same", "SAME"] * 40) + " $", None, "", "\t\n ", long, "A" * 60, "ÄÖÜ " + long, "a b " * 30 + long]
    rows = [(i, t, ["x", "y", None, ""][i % 4], 0, "", 0) for i, t in enumerate(texts)]
    return [*rows, rows[1], rows[3], (None, long, "x", 0, "", 0), (None, "only here", "x", 0, "", 0), (40, " ".join(f"w{i}" for i in range(200_000)), "y", 0, "", 0), (7, long, "z", 0, "", 0)]


LABELS = [(0, 1, 0), (1, 1, 1), (1, 0, 0), (2, None, 1), (3, 1, None), (6, 0, 1), (10, 1, 0), (None, 1, 1), (99, 1, 1)]


def by_loop(rows, labels) -> set:
    good, toxic = {d for d, q, _ in labels if d is not None and q == 1}, {d for d, _, t in labels if d is not None and t == 1}
    fails = []
    for doc_id, text, *_ in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails.append(
            {
                f
                for f, yes in (
                    ("A", len(words) < 50),
                    ("B", 100 * len(set(words)) < 65 * len(words)),
                    ("C", 100 * len(re.findall("[A-Z]", t)) > 5 * len(t)),
                    ("D", bool(re.search(r"[#$%&*|]", t))),
                    ("E", doc_id is not None and any(o[0] is not None and o[0] < doc_id and (o[1] or "") == t for o in rows)),
                )
                if yes
            }
        )
    out = {}
    for part in {r[2] or "" for r in rows}:
        own = [(f, r[0]) for f, r in zip(fails, rows, strict=True) if (r[2] or "") == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for k, c in enumerate(order, 1):
                before = set(order[: k - 1])
                gone = [d for f, d in own if not f & before and c in f]
                removed_by[c] += len(gone)
                kept = sum(not f & (before | {c}) for f, _ in own)
                out[part, "".join(order), k] = [kept, len(gone), sum(bool(f & before) and c in f for f, _ in own), sum(f == {c} for f, _ in own), sum(d in good for d in gone), sum(d in toxic for d in gone), c]
        for key, v in out.items():
            if key[0] == part:
                v[6] = removed_by[v[6]]
    return {(*k, *v) for k, v in out.items()}


def test_filter_audit(spark):
    rows = documents()
    docs, labels = spark.createDataFrame(rows, DOCS).repartition(5), spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(docs, labels).collect()
    assert len(got) == 4 * 600
    assert {tuple(r) for r in got} == by_loop(rows, LABELS)
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    assert {r["good_lost"] for r in filter_audit.audit(docs, labels.limit(0)).collect()} == {0}


def test_filter_audit_query(spark, duck):
    from saltmarsh.llm import queries as llm

    got, want = llm.queries()["op11_filter_audit"](spark, SMALL), duck.sql(llm.oracle_sql()["op11_filter_audit"])
    assert table(got.columns, got.collect()) == table(want.columns, want.fetchall())
