"""Sidecars by path, where paths and sidecars repeat."""

from __future__ import annotations

from saltmarsh.operators import joins


def test_an_item_stays_one_row_whatever_sidecars_its_path_has(spark):
    items = spark.createDataFrame([(1, "p", "x"), (2, "p", None), (3, "p", "y"), (4, "q", "z"), (5, "r", "x"), (6, None, "x"), (7, "s", "x")], "id int, path string, sha1 string")
    side = spark.createDataFrame([("p", "x", "b"), ("p", "x", "c"), ("p", "w", "a"), ("q", None, "n"), ("q", "z", "o"), ("s", None, "m"), (None, "x", "l")], "path string, sha1 string, sidecar string")
    got = joins.sidecars(items, side)
    assert got.columns == ["id", "path", "sha1", "sidecar"]
    assert sorted((r["id"], r["sidecar"]) for r in got.collect()) == [(1, "b"), (2, "a"), (3, None), (4, "o"), (5, None), (6, None), (7, "m")]
