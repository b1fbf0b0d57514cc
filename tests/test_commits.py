"""The commit log: writers that meet, jobs that are lost at each step, readers meanwhile, and what is kept."""

from __future__ import annotations

import threading
import time

import pytest
from saltmarsh.sources import commits


def ids(df) -> list[int]:
    return sorted(r[0] for r in df.select("id").collect())


def test_publish_and_read(spark, tmp_path):
    table = commits.Table(spark, f"file://{tmp_path}/t")
    assert table.entry() is None
    with pytest.raises(FileNotFoundError):
        table.read()
    first = table.publish(spark.range(3), "s1", None)
    held = table.read()  # a reader that has resolved the first entry
    second = table.publish(spark.range(3, 8), "s2", first, expected="s1")
    assert ids(held) == [0, 1, 2] and ids(table.read()) == [3, 4, 5, 6, 7] and ids(table.read(first)) == [0, 1, 2]
    with pytest.raises(ValueError):
        table.publish(spark.range(1), "s3", second, expected="s1")
    table.append(spark.range(8, 10), "s3")
    assert ids(table.read()) == [3, 4, 5, 6, 7, 8, 9]
    with pytest.raises(ValueError):
        table.append(spark.range(2).selectExpr("cast(id as string) as id"), "s4")
    commits.upsert(table, spark.range(9, 12), ["id"], "s4")
    assert ids(table.read()) == list(range(3, 12))
    assert [tuple(r) for r in table.history().orderBy("number").collect()] == [(1, "s1", 1, 3), (2, "s2", 1, 5), (3, "s3", 2, 7), (4, "s4", 1, 9)]


def test_of_two_writers_one_learns_of_it(spark, tmp_path):
    table, other = (commits.Table(spark, f"file://{tmp_path}/t") for _ in range(2))
    base = table.publish(spark.range(1), "s0", None)
    seen = other.entry()
    table.publish(spark.range(2), "s1", base)
    with pytest.raises(commits.Conflict):
        other.publish(spark.range(3), "s1b", seen)
    assert ids(table.read()) == [0, 1]
    # many at once on one number: exactly one gets it
    after, got = table.entry().number, []

    def write(k):
        try:
            got.append(commits.Log(spark, f"{table.root}/log").add({"parts": [], "schema": spark.range(0).schema.jsonValue(), "sync": str(k)}, after))
        except commits.Conflict:
            pass

    threads = [threading.Thread(target=write, args=(k,)) for k in range(8)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert len(got) == 1 and table.entry().state["sync"] == got[0].state["sync"]
    # a store's moves don't replace an entry either
    log = commits.Log(spark, f"file://{tmp_path}/log")
    log._move("{}", "x", 1)
    with pytest.raises(commits.Conflict):
        log._move("{}", "y", 1)
    assert [e.number for e in log.newest(5)] == [1]
    # appends don't hurt each other
    table.publish(spark.range(0), "s2", table.entry())
    threads = [threading.Thread(target=lambda k=k: commits.Table(spark, table.root).append(spark.range(k * 10, k * 10 + 2), f"a{k}")) for k in range(4)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert ids(table.read()) == [0, 1, 10, 11, 20, 21, 30, 31]


def test_lost_jobs_leave_the_table_as_it_was(spark, tmp_path, monkeypatch):
    table = commits.Table(spark, f"file://{tmp_path}/t")
    base = table.publish(spark.range(2), "s1", None)

    def lost(*_a, **_k):
        raise KeyboardInterrupt

    for name in ("_written", "_committed"):  # before the part is written, and before it is named
        with monkeypatch.context() as m:
            m.setattr(commits.Table, name, lost)
            with pytest.raises(KeyboardInterrupt):
                table.publish(spark.range(5), "s2", base)
        assert ids(commits.Table(spark, table.root).read()) == [0, 1]
    # while the part is written
    with pytest.raises(Exception, match="(?i)divi"):
        table.publish(spark.range(5).selectExpr("id div (id - 3) as id"), "s2", base)
    # while the entry is written: a file aside isn't an entry
    (tmp_path / "t/log/0123.aside").write_text('{"parts": [')
    assert ids(table.read()) == [0, 1] and table.entry() == base
    assert ids(table.read(table.publish(spark.range(5), "s2", base))) == [0, 1, 2, 3, 4]


def test_retention(spark, tmp_path):
    table = commits.Table(spark, f"file://{tmp_path}/t")
    entry = None
    for k in range(4):
        entry = table.publish(spark.range(k), f"s{k}", entry)
    orphan = tmp_path / "t/parts/orphan"
    spark.range(1).write.parquet(f"file://{orphan}")
    assert len(table.retain(keep=2)) == 2 and orphan.exists()
    assert ids(table.read()) == [0, 1, 2] and [e.number for e in table.log.newest(9)] == [4, 3]
    assert table.retain(keep=2, now=time.time() + 13 * 3600) == ["orphan"]
    assert ids(table.read(table.log.read(3))) == [0, 1]
    # a reader of the kept entries isn't disturbed by what comes next
    held = table.read()
    table.publish(spark.range(9), "s9", table.entry())
    table.retain(keep=2)
    assert ids(held) == [0, 1, 2]
