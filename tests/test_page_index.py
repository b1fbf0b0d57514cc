"""The stored index of pages: replaced, gone and missing pages, and which files a refresh touches."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F
from saltmarsh.operators import page_index

DOCS = "doc_key string, channel string, kind string, message_date date, declared_pages int, signature string"
PAGES = "doc_key string, page_no int, text_chars int, has_render boolean"


def state(index):
    return {r["doc_key"]: (r["pages"], r["with_text"], r["with_render"], r["placeholders"], r["grade"]) for r in index.graded().collect()}


def test_refresh(spark, tmp_path, monkeypatch):
    index = page_index.PageIndex(spark, f"file://{tmp_path}/index")
    assert index.totals().count() == 0
    docs = [(f"d{i}", f"c{i % 3}", "pdf", date(2025, 1 + i % 2, 5), 3, "v1") for i in range(40)]
    pages = [(f"d{i}", p, 10 * (p != 3), p == 3) for i in range(40) for p in (1, 2, 3)]
    frames = lambda d, p: (spark.createDataFrame(d, DOCS), spark.createDataFrame(p, PAGES))
    first = index.refresh(*frames(docs, [*pages, ("d1", 0, 5, True), ("d1", 2, 99, None), ("stray", 1, 5, True)]))
    assert len(first) > 10 and set(state(index).values()) == {(3, 2, 1, 0, "B")}
    assert index.refresh(*frames(docs, pages)) == []

    def files():
        return {p: p.stat().st_mtime_ns for p in (tmp_path / "index").rglob("*.parquet")}

    before = files()
    docs[4] = ("d4", "c9", "pdf", None, 5, "v2")
    pages = [p for p in pages if p[0] != "d4"] + [("d4", 1, 10, False), ("d4", 7, 0, False)]
    touched = index.refresh(*frames([d for d in docs if d[0] != "d9"] + [("d4", "old", "pdf", None, 1, "v0"), (None, "c", "k", None, 1, "v")], pages))
    got = state(index)
    assert got["d4"] == (6, 1, 0, 5, "C") and "d9" not in got and len(got) == 39
    assert index.pages().where("doc_key = 'd9'").count() == 0
    after = files()
    assert 1 <= len(touched) <= 2
    assert {p for p in before.keys() & after.keys() if before[p] == after[p]} == {p for p in before if int(p.parent.name.removeprefix("bucket=")) not in touched}
    # a refresh that is lost between pages and documents is made again
    docs[5] = ("d5", "c2", "scan", date(2025, 3, 1), 1, "v2")
    kept = page_index.stored
    with monkeypatch.context() as m:
        m.setattr(page_index, "stored", lambda df, name: kept(df, name) if name != "documents" else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            index.refresh(*frames(docs, []))
    assert index.refresh(*frames(docs, [("d5", 1, 4, True)]))
    assert state(index)["d5"] == (1, 1, 1, 0, "A")
    assert {(r["what"], r["key"]): (r["documents"], r["channels"]) for r in index.totals().collect()}["all", ""] == (40, 4)  # c9 is d4's new one


def test_documents_are_worked_out_once_a_refresh_and_large_buckets_get_more_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(page_index, "FILE_ROWS", 8, raising=False)
    index = page_index.PageIndex(spark, f"file://{tmp_path}/index")
    worked = spark.sparkContext.accumulator(0)

    def sign(key):
        worked.add(1)
        return f"v-{key}"

    docs = [(f"d{i}", f"c{i % 3}", "pdf", date(2025, 1, 5), 5, None) for i in range(400)]
    pages = spark.createDataFrame([(f"d{i}", p, 10 if p < 4 else -5, p == 4) for i in range(400) for p in (1, 2, 2, 3, 4)], PAGES)
    index.refresh(spark.createDataFrame(docs, DOCS).withColumn("signature", F.udf(sign)("doc_key")), pages)
    assert worked.value == 400
    assert set(state(index).values()) == {(5, 3, 1, 1, "B")} and index.pages().where("page_no = 4 and text_chars = -5").count() == 400
    files = {}
    for p in (tmp_path / "index/pages").rglob("*.parquet"):
        files.setdefault(p.parent.name, []).append(p)
    assert len(files) > 50 and sum(len(f) > 1 for f in files.values()) > 40
    assert {(r["what"], r["key"], r["documents"], r["pages"], r["channels"]) for r in index.totals().collect()} == {("all", "", 400, 2000, 3), ("month", "2025-01", 400, 2000, 3), ("kind", "pdf", 400, 2000, 3), ("grade", "B", 400, 2000, 3)}
