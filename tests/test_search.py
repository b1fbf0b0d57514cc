"""Search by postings against reading every text, and what it reads."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from saltmarsh.operators import search

ROWS = "id long, updated timestamp, text string, status string"


def rows(n: int = 3000) -> list[tuple]:
    r = random.Random(7)
    words = ["urgent", "Review", "closed", "re-view", "größe", "a1", "proof", "risk", "삼성", "x"]
    out = []
    for i in range(n):
        at = None if i % 97 == 0 else datetime(2023, 1, 1) + timedelta(hours=i * 7 // 3)
        out.append((i, at, None if i % 89 == 0 else " ".join(r.choices(words, k=r.randrange(0, 9))) + r.choice(["", "!", " rareword" if i % 700 == 3 else ""]), "s"))
    return out


def test_search_is_the_scan(spark, tmp_path):
    data = rows()
    df, folder = spark.createDataFrame(data, ROWS).repartition(5), f"file://{tmp_path}/index"
    search.build(df, folder)
    for words in (["urgent"], ["URG", "view"], ["re-view", "proof"], ["review closed"], ["rareword"], ["größe", "삼"], ["absent"], [], ["!"], ["urgent", "risk", "x", "a1", "proof"]):
        for n in (5, 10_000):
            got = search.search(df, folder, words, n)
            assert [tuple(r) for r in got.rows.collect()] == [tuple(r) for r in search.scan(df, words, n).collect()], words
    few, all_ = search.search(df, folder, ["urgent"], 5), search.search(df, folder, ["urgent"], 10_000)
    assert few.segments == 1 and few.postings < all_.postings / 5
    whole = search.search(df, folder, ["rareword"], 10_000)
    assert whole.segments == all_.segments > 5 and whole.postings == sum("rareword" in (t or "") for _, _, t, _ in data)


def test_an_empty_index(spark, tmp_path):
    df = spark.createDataFrame([(1, None, None, "s")], ROWS)
    search.build(df, f"file://{tmp_path}/one")
    assert search.search(df, f"file://{tmp_path}/one", ["a"], 5).rows.count() == 0
    assert search.search(df, f"file://{tmp_path}/one", [], 5).rows.count() == 1
