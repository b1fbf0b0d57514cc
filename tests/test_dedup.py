"""Greedy de-duplication: lines of decisions, several runs on one registry, and who is matched."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
from saltmarsh.functions import text as X
from saltmarsh.operators import dedup
from saltmarsh.plans.portfolios import keyed
from saltmarsh.sources import commits

KINDS = ("url", "title_date", "content")
DOCS = "id long, url array<string>, title_date array<string>, content array<string>"


def by_loop(rows, owners=None) -> dict:
    owners, out = {} if owners is None else owners, {}
    for i, *kinds in sorted(rows):
        hit = next(((KINDS[k], min(owners[k, v] for v in values if (k, v) in owners)) for k, values in enumerate(kinds) if any((k, v) in owners for v in values)), (None, None))
        out[i] = (hit[0] is None, *hit)
        if hit[0] is None:
            for k, values in enumerate(kinds):
                owners |= {(k, v): i for v in values if v}
    return out


def documents(n: int, spread: int, seed: int = 0) -> list[tuple]:
    r = random.Random(seed)
    return [(i, *([str(x) for x in r.sample(range(spread), r.choice([0, 0, 1, 1, 2, 3]))] for _ in KINDS)) for i in range(n)]


def decided(df) -> dict:
    return {r["id"]: (r["kept"], r["kind"], r["matched"]) for r in df.collect()}


@pytest.mark.parametrize("spread", [15, 80, 400])
def test_greedy_is_the_loop(spark, spread):
    rows = documents(160, spread, spread)
    assert decided(dedup.greedy(spark.createDataFrame(rows, DOCS).repartition(5))) == by_loop(rows)


def test_a_chain_takes_few_rounds(spark, monkeypatch):
    """Ten thousand documents, each sharing a key with the next: every other one stays, and steps double."""
    written = []
    kept = dedup.stored
    monkeypatch.setattr(dedup, "stored", lambda df, name: written.append(name) or kept(df, name))
    n = 10_000
    docs = spark.range(n).select("id", F.array(F.format_string("k%d", "id"), F.format_string("k%d", F.col("id") + 1)).alias("url"))
    out = dedup.greedy(docs, ["url"])
    assert out.where(F.col("kept") != (F.col("id") % 2 == 0)).count() == 0 and out.count() == n
    assert out.where("not kept and matched <> id - 1").count() == 0
    assert written.count("undecided") == 1 and written.count("chain") <= 20


def test_runs_on_one_registry_are_one_run(spark, tmp_path):
    rows = documents(240, 120, 9)
    registry = commits.Table(spark, f"file://{tmp_path}/registry")
    whole, seen = by_loop(rows), {}
    for k in range(3):
        seen |= decided(dedup.deduplicated(spark.createDataFrame(rows[k * 80 : k * 80 + 80], DOCS), registry, f"run-{k}"))
    assert seen == whole
    assert {(r["kind"], r["v"]): r["owner"] for r in registry.read().collect()} == {(KINDS[k], v): i for i, *kinds in rows if whole[i][0] for k, values in enumerate(kinds) for v in values}
    # a run that has been lost before its entry registers nothing; one that was overtaken learns of it
    late = registry.entry()
    registry.append(spark.createDataFrame([("url", "new", 999)], registry.read().schema), "other")
    with pytest.raises(commits.Conflict):
        registry.extend(registry.read(late), "late", late)
    assert registry.read().where("v = 'new'").count() == 1
    assert decided(dedup.greedy(spark.createDataFrame([(1000, ["new"], [], None)], DOCS), registry=registry.read())) == {1000: (False, "url", 999)}


def test_empty(spark):
    df = spark.createDataFrame([], DOCS)
    assert dedup.greedy(df).count() == 0
    one = spark.createDataFrame([(1, None, [], [None, ""])], DOCS)
    assert decided(dedup.greedy(one)) == {1: (True, None, None)}


def test_other_signs_are_those_that_a_negated_class_finds(spark):
    """Every code point, and no slow class in the plan of d1's keys."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    rows = spark.createDataFrame([("".join(points[k : k + 4096]),) for k in range(0, len(points), 4096)], "t string")
    for kept, other in ((X.KEPT, X.OTHER), (f"{X.KEPT} ", X.OTHER_BUT_BLANKS)):
        assert rows.where(F.regexp_replace("t", f"[^{kept}]", "_") != F.regexp_replace("t", f"[{other}]", "_")).count() == 0
    keys = keyed(spark.createDataFrame([(1, "a", "en")], "doc_id long, text string, lang string"))
    assert "regexp_replace" in (plan := keys._jdf.queryExecution().optimizedPlan().toString()) and "[^0-9a-z" not in plan


def test_content_fingerprints_are_those_of_the_whole_and_its_parts(spark):
    word = "Größe 가나 x1, "
    texts = [word * 9 + "\n \n" + "https://a.b/c?d\n\n" + "\t\n\n" + word * 8 + "!", word * 8 + "\n" + word * 10 + "https://x.y", "short", "\n\n", "", None, word * 20, "== " * 40]

    def normal(t):
        return re.sub(r"[^0-9a-z가-힣]+", " ", re.sub(r"https?://\S+", " ", (t or "").lower())).strip(" ")

    def parts(t):
        ps = [p for p in re.split(r"\n\s*\n+", t or "") if p.strip(" ")]
        return ps if len(ps) > 1 else [p for p in re.split(r"\n+", t or "") if p.strip(" ")]

    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string").select("id", X.content_fingerprints("t").alias("f")).collect()
    want = {i: list(dict.fromkeys(hashlib.sha1(n.encode()).hexdigest() for n in map(normal, [t, *parts(t)]) if len(n) >= 80)) for i, t in enumerate(texts)}
    assert {r["id"]: r["f"] for r in got} == want and len(want[0]) == 3
