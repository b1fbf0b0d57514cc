"""Conflicts over resources: against all pairs, and a resource that thousands want."""

from __future__ import annotations

import random

from pyspark.sql import functions as F
from saltmarsh.operators import joins


def test_conflicts_are_all_pairs_once(spark):
    r = random.Random(4)
    rows = [(i, r.random() < 0.8, [r.choice(["a", "b", None, *map(str, range(30))]) for _ in range(r.randrange(0, 5))]) for i in range(200)]
    rows += [(300, True, None), (None, True, ["a"]), (7, True, ["extra"]), (8, True, ["extra", "a"])]
    wants: dict[int, set] = {}
    for i, active, rs in rows:
        if active and i is not None:
            wants.setdefault(i, set()).update(x for x in rs or () if x)
    want = sorted((a, b) for a in wants for b in wants if a < b and wants[a] & wants[b])
    df = spark.createDataFrame(rows, "id long, active boolean, resources array<string>").repartition(4)
    for tile in (4, 1024):
        assert sorted(tuple(x) for x in joins.conflicts(df, tile).collect()) == want
    assert joins.conflicts(df.limit(0)).count() == 0


def test_a_resource_that_thousands_want(spark):
    n = 10_000
    tasks = spark.range(n).select("id", F.lit(True).alias("active"), F.array(F.lit("hot"), F.concat(F.lit("own"), (F.col("id") % 2000).cast("string"))).alias("resources"))
    out = joins.conflicts(tasks)
    assert out.agg(F.count("*"), F.sum("a"), F.sum("b")).first()[:] == (n * (n - 1) // 2, sum(i * (n - 1 - i) for i in range(n)), sum(i * i for i in range(n)))
