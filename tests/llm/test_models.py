"""Vectors, mixing, the n-gram model, WARC derivatives, components and the pipeline."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from saltmarsh.llm import kneser_ney, mixing, near_vectors, topk_nra, warc
from saltmarsh.llm import queries as llm
from saltmarsh.llm.components import connected_components
from saltmarsh.llm.scratch import Scratch

from ..conftest import SMALL
from .test_documents import components

VECTORS = "vec_id long, embedding array<float>, label int, k long, v string"


def vectors() -> list[tuple]:
    r = np.random.default_rng(5)
    rows, centres = [], r.standard_normal((30, 32))
    for i in range(400):
        x = centres[i % 30] + r.standard_normal(32) * (0.22 if i % 3 else 1.0)
        rows.append([i, x.astype(np.float32).tolist(), i % 2, 0, ""])
    rows[10][1] = rows[12][1] = rows[14][1]
    rows[20][1], rows[21][1], rows[22][1], rows[23][1] = None, [0.0] * 32, [math.nan] * 32, [None] * 32
    rows[24][2], rows[25][1] = None, [1e30] * 32
    return [tuple(x) for x in rows]


def usable(x) -> bool:
    return x is not None and all(c is not None and math.isfinite(c) for c in x)


def test_near_vectors(spark):
    data = vectors()
    good = {i: np.array(e, float) for i, e, label, *_ in data if usable(e) and any(e) and label is not None}
    label = {i: lab for i, _, lab, *_ in data}
    links = [(a, b) for a in good for b in good if a < b and label[a] == label[b] and good[a] @ good[b] / math.sqrt(good[a] @ good[a]) / math.sqrt(good[b] @ good[b]) >= 0.93]
    count = {i: sum(i in x for x in links) for i in label}
    whole = components(label, links)
    df = spark.createDataFrame(data, VECTORS).repartition(3)
    rows = near_vectors.near_components(df, cosine=0.93).collect()
    assert {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in rows} == {(i, count[i], whole[i], whole[i] == i) for i in label}
    assert len(links) > 200
    assert near_vectors.near_components(df.limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    r = np.random.default_rng(1)
    x = r.standard_normal((300, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a, b = np.arange(0, 150), np.arange(150, 300)
    errors = []
    for seed in range(30):
        spun, signs, factor = near_vectors.codes(x, seed)
        errors.append(np.einsum("ij,ij->i", signs[a], spun[b]) / factor[a] - np.einsum("ij,ij->i", x[a], x[b]))
        assert not near_vectors.ruled_out(spun, signs, factor, a, a, 0.93, 5.0).any()
    assert abs(np.mean(errors)) < 0.005


def best_of(x: dict[int, list[int]], queries, k: int) -> set:
    want = set()
    for q in queries:
        best = sorted((-sum(a * b for a, b in zip(x[q], x[c], strict=True)), c) for c in x if c != q)[:k]
        want |= {(q, r, c, -s) for r, (s, c) in enumerate(best, 1)}
    return want


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk_nra, "TILE", 90)  # several tiles, and queries in several blocks
    monkeypatch.setattr(topk_nra, "QUERIES", 12)
    data = vectors()
    data[25] = (25, [float(np.float32(2.0**20))] + [0.5] * 31, 1, 0, "")  # a score beyond 2**53 with itself
    data[40] = (40, [float(np.float32(2.0**20))] + [-0.5] * 31, 1, 0, "")
    x = {i: [math.floor(float(np.float32(c)) * 1024) for c in e] for i, e, *_ in data if usable(e)}
    df = topk_nra.integers(spark.createDataFrame(data, VECTORS), 1024)
    got = topk_nra.top_k(df, df.where("vec_id % 20 = 0 or vec_id = 25"), k=7).collect()
    want = best_of(x, [q for q in x if q % 20 == 0 or q == 25], 7)
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert max(r["score"] for r in got) > 1 << 53
    few = df.where("vec_id < 3")
    assert topk_nra.top_k(few, few.where("vec_id = 0"), 10).count() == 2
    assert topk_nra.top_k(df.limit(0), df.limit(0), 10).count() == 0
    repeated = df.where("vec_id = 1").unionByName(df.where("vec_id = 1")).unionByName(df.where("vec_id = 2"))
    assert [r["vec_id"] for r in topk_nra.top_k(repeated, df.where("vec_id = 2"), 10).orderBy("rank").collect()] == [1, 1]


def test_scores_that_do_not_fit_are_an_error(spark):
    df = topk_nra.integers(spark.createDataFrame([(1, [1e12, 1.0]), (2, [1e12, 2.0])], "vec_id long, embedding array<double>"), 1024)
    with pytest.raises(Exception, match="64 bits"):
        topk_nra.top_k(df, df, 1).collect()


def test_search_is_brute_force():
    r = np.random.default_rng(0)
    for trial in range(120):
        n, d, m, k, kind = int(r.integers(1, 300)), int(r.integers(1, 12)), 6, int(r.integers(1, 12)), trial % 4
        x = np.floor(r.standard_normal((n, d)) * [5, 1000, 1e5, 3][kind] + (0, 300, -1e5, 0)[kind])
        q = np.floor(r.standard_normal((m, d)) * 50 + (0, 40, 0, 0)[kind])
        q[0] = 0
        ids = r.integers(0, max(2, n // 2) if kind == 3 else 10**6, n)
        own = np.array([ids[0], -1, ids[-1], -2, -3, -4])
        want = [sorted((-int(q[j] @ x[i]), int(ids[i])) for i in range(n) if ids[i] != own[j])[:k] for j in range(m)]
        known = np.array([-w[-1][0] if len(w) == k else -np.inf for w in want], float)
        for bars in (np.full(m, -np.inf), known):
            col, row, score, _ = topk_nra.search(x, ids, q, own, k, bars)
            assert [[(-int(score[t]), int(ids[row[t]])) for t in np.flatnonzero(col == j)] for j in range(m)] == want


def test_queries_of_a_tile_read_together(monkeypatch):
    monkeypatch.setattr(topk_nra, "STEP", 7)
    monkeypatch.setattr(topk_nra, "PAIRS", 50)
    r = np.random.default_rng(5)
    x = np.floor(r.standard_normal((700, 9)) * 100)
    ids, own = r.permutation(700), np.arange(0, 700, 5)
    q = x[np.argsort(ids)[own]]
    calls = []
    upper = topk_nra.Lists.upper
    monkeypatch.setattr(topk_nra.Lists, "upper", lambda self, at: calls.append(at) or upper(self, at))
    whole = q @ x.T
    whole[np.arange(140), np.argsort(ids)[own]] = -np.inf
    best = np.sort(whole, 1)[:, ::-1]
    for bars, most in ((np.full(140, -np.inf), 4), (best[:, 3], 4), (best[:, 1], 2), (best[:, 0] + 1, 0)):
        calls.clear()
        col, _, score, _ = topk_nra.search(x, ids, q, own, 4, bars)
        assert 1 <= len(calls) <= topk_nra.BLOCKS  # one bound of the tile a depth, however many queries
        # what doesn't reach a bar known from elsewhere isn't given back
        assert [score[col == j].tolist() for j in range(140)] == [[s for s in best[j, :most].tolist() if s >= bars[j]] for j in range(140)]


def test_lists_are_read_in_part_only():
    r = np.random.default_rng(3)
    centres = r.standard_normal((40, 64))
    x = np.floor((centres[np.arange(4000) % 40] + 0.2 * r.standard_normal((4000, 64))) * 1024)
    ids = np.arange(4000)
    q = x[::100]
    _, first, score, entries = topk_nra.search(x, ids, q, ids[::100], 10, np.full(40, -np.inf))
    whole = x @ q.T
    whole[ids[::100], np.arange(40)] = -np.inf
    assert (np.sort(score.reshape(40, 10), 1)[:, ::-1] == np.sort(whole, 0)[::-1][:10].T).all() and len(first) == 400
    assert entries < 0.6 * 40 * x.size
    # a bar from elsewhere saves more
    assert topk_nra.search(x, ids, q, ids[::100], 10, score.reshape(40, 10)[:, -1])[3] <= entries


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(500), r.randrange(500)) for _ in range(300)] + [(i, i + 1) for i in range(1000, 1200)] + [(7, 7)]
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    out = connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test")).collect()
    assert {r["node"]: r["component"] for r in out} == components(nodes, [e for e in edges if e[0] != e[1]])


DOCS = "doc_id long, text string, lang string, source string, n_chars long, stream string"


def spoken(r: random.Random, n: int) -> str:
    parts = ["ka", "lo", "mi", "ten", "sur", "ve", "ran", "do"]
    return " ".join("".join(r.choices(parts, k=r.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def judged(spark):
    r = random.Random(9)
    rows = [(i, spoken(r, r.randint(20, 120)), "xx", "a", 0, "") for i in range(200)]
    rows += [(1000 + i, "".join(r.choices("qxzjw#@%$!&*(0123456789", k=400)), "xx", "a", 0, "") for i in range(10)]
    rows += [(2000, None, "xx", "a", 0, ""), (2001, "", None, None, 0, ""), (2002, spoken(r, 50), None, "b", 0, ""), rows[5]]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(150)] + [(1000, 0, 0), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_perplexity(judged):
    docs, labels = judged
    rows = kneser_ney.decide(docs, labels).collect()
    assert len(rows) == docs.count()
    rejected = {r["doc_id"] for r in rows if not r["keep"]}
    assert rejected >= {1000 + i for i in range(10)} and len(rejected) <= 14
    assert all(r["keep"] for r in rows if r["doc_id"] in (2000, 2001))
    sharded = kneser_ney.decide(docs, labels, table_rows=0).collect()
    key = lambda r: (r["doc_id"], r["tk"])
    for a, b in zip(sorted(rows, key=key), sorted(sharded, key=key), strict=True):
        assert a["keep"] == b["keep"] and (a["perplexity"] is None or math.isclose(a["perplexity"], b["perplexity"], rel_tol=1e-9))
    assert kneser_ney.decide(docs, labels.limit(0)).where("not keep").count() == 0
    assert kneser_ney.decide(docs.limit(0), labels).count() == 0
    kept = kneser_ney.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == docs.count() - len([r for r in rows if not r["keep"]])


def test_probabilities_add_up_to_one(judged):
    docs, _ = judged
    spark = docs.sparkSession
    texts = docs.where("doc_id < 60").select("text", F.lit(0).cast("long").alias("half"))
    known = kneser_ney.characters(texts)
    counts = kneser_ney.count_grams(texts, 3)
    model = kneser_ney.Model.of(kneser_ney.train(counts, known + 2, Scratch(spark, "test"), 3).toArrow(), 3)
    seen = {ord(c) + kneser_ney.CHARACTERS for r in texts.collect() for c in r["text"]}
    # one symbol that no text has stands for all unseen ones
    vocabulary = np.array([kneser_ney.BEHIND, 0x4E00, *sorted(seen)])
    for context in ((0, 0), (ord("k") + 2, ord("a") + 2), (5, 5), (2, 2)):
        keys = kneser_ney.keys_of([np.full(len(vocabulary), context[0]), np.full(len(vocabulary), context[1]), vocabulary])
        assert math.isclose(model.probabilities(*keys).sum(), 1, rel_tol=1e-9)


def test_grams_of_many_texts_at_once(monkeypatch):
    r = random.Random(3)
    odd = ["\0", "\1", "\2", "a", "b", "\u4e00", "\ud800", "\udc00", "\U0010ffff"]
    texts = ["".join(r.choices(odd, k=r.choice([0, 1, 3, 7, 8, 14, 40]))) for _ in range(200)] + ["".join(map(chr, range(0x3000, 0x3000 + 9000)))]
    halves = np.array([r.randrange(2) for _ in texts])
    for at_once in (7, 1 << 19):
        monkeypatch.setattr(kneser_ney, "AT_ONCE", at_once)
        for order in (1, 3, 5, 6):
            groups = list(kneser_ney._by_half(texts, halves, order))
            assert len(groups) == 2 or at_once == 7  # short texts share a group
            got = [{} for _ in texts]
            for half, rows, parts in groups:
                hi, lo, at, bounds = kneser_ney.grams(parts, order)
                assert len(set(zip(hi.tolist(), lo.tolist(), strict=True))) == len(hi)
                for i, row in enumerate(rows.tolist()):
                    assert halves[row] == half
                    for g in at[bounds[i] : bounds[i + 1]].tolist():
                        key = int(hi[g]) << 3 * kneser_ney.WIDTH | int(lo[g])
                        got[row][key] = got[row].get(key, 0) + 1
            for text, found in zip(texts, got, strict=True):
                symbols = [kneser_ney.BEFORE] * (order - 1) + [ord(c) + kneser_ney.CHARACTERS for c in text] + [kneser_ney.BEHIND]
                want = {}
                for i in range(len(text) + 1):
                    key = sum(s << kneser_ney.WIDTH * (order - 1 - j) for j, s in enumerate(symbols[i : i + order]))
                    want[key] = want.get(key, 0) + 1
                assert found == want


def test_nothing_left_for_unseen_ones_is_no_chance_in_either_path(judged):
    docs, _ = judged
    scratch = Scratch(docs.sparkSession, "test")
    model = kneser_ney.train(kneser_ney.count_grams(kneser_ney._keyed(docs).where("doc_id < 60")), 50, scratch)
    some = model.where("n = 5").orderBy("hi", "lo").first()
    model = model.withColumn("p", F.when((F.col("n") == 5) & (F.col("hi") == some["hi"]) & (F.col("lo") == some["lo"]), 0.0).otherwise(F.col("p")))
    totals = []
    for table_rows, common in ((10**6, 0), (0, 0), (0, 10**6)):
        rows = kneser_ney.score(docs, model, scratch, 5, table_rows, common).collect()
        totals.append([r["total"] for r in sorted(rows, key=lambda r: (r["doc_id"], r["tk"]))])
    assert 0 < sum(math.isinf(x) for x in totals[0]) < len(totals[0])
    for other in totals[1:]:
        assert all(math.isclose(a, b, rel_tol=1e-9) for a, b in zip(totals[0], other, strict=True))


def plain_model(texts: list[str], order: int, vocabulary: int):
    """Interpolated modified Kneser-Ney by its definition, over strings."""
    grams = {n: {} for n in range(1, order + 1)}
    for t in texts:
        s = "\0" * (order - 1) + t + "\1"
        for i in range(order - 1, len(s)):
            g = s[i - order + 1 : i + 1]
            grams[order][g] = grams[order].get(g, 0) + 1
    for n in range(order - 1, 0, -1):
        for g in grams[n + 1]:
            grams[n][g[1:]] = grams[n].get(g[1:], 0) + 1

    def discount(n, c):
        k = [sum(x == i for x in grams[n].values()) for i in (1, 2, 3, 4)]
        if not k[0] or not k[1]:
            return 0.5
        y, c = k[0] / (k[0] + 2 * k[1]), min(c, 3)
        return min(float(c), max(0.0, c - (c + 1) * y * k[c] / k[c - 1])) if k[c - 1] else 0.5

    def p(g):
        n = len(g)
        if not n:
            return 1 / vocabulary
        with_context = {x: c for x, c in grams[n].items() if x[:-1] == g[:-1]}
        total = sum(with_context.values())
        if not total:
            return p(g[1:])
        left = sum(discount(n, c) for c in with_context.values()) / total
        c = grams[n].get(g, 0)
        return ((c - discount(n, c)) / total if c else 0.0) + left * p(g[1:])

    return p


def test_scores_follow_the_definition(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "AT_ONCE", 7)  # texts in parts
    r = random.Random(3)
    odd = "".join(map(chr, range(0x4E00, 0x4E40)))
    rows = [(i, spoken(r, 8) if i % 3 else "".join(r.choices(odd, k=20)), "xx", "a", 0, "") for i in range(40)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    half = {x["doc_id"]: x["half"] for x in kneser_ney._keyed(docs).collect()}
    vocabulary = len({c for x in rows for c in x[1]}) + 2
    scratch = Scratch(spark, "test")
    models = {h: plain_model([x[1] for x in rows if x[0] < 30 and half[x[0]] == h], 5, vocabulary) for h in (0, 1)}
    texts = kneser_ney._keyed(docs).where("doc_id < 30")
    counts = kneser_ney.count_grams(texts).collect()
    assert sum(x["c"] for x in counts) == sum(len(x[1]) + 1 for x in rows if x[0] < 30)
    model = kneser_ney.train(kneser_ney.count_grams(texts), vocabulary, scratch).withColumn("half", 1 - F.col("half"))
    for table_rows, common in ((10**6, 0), (0, 0), (0, 50), (0, 10**6)):
        got = {x["doc_id"]: (x["n"], x["total"]) for x in kneser_ney.score(docs, model, scratch, 5, table_rows, common).collect()}
        for i, text, *_ in rows:
            s, p = "\0" * 4 + text + "\1", models[1 - half[i]]
            want = -sum(math.log(p(s[k - 4 : k + 1])) for k in range(4, len(s)))
            assert got[i][0] == len(text) + 1 and math.isclose(got[i][1], want, rel_tol=1e-9)


def test_mixing(spark):
    r = random.Random(4)
    rows = [(i, "x" * r.randint(0, 300), "en", r.choice(["big"] * 6 + ["mid", "mid", "low", None]), 0, "old") for i in range(3000)]
    docs = spark.createDataFrame([*rows, (None, None, None, "low", 0, ""), rows[0]], DOCS).repartition(4)
    out = mixing.schedule(docs, {"big": 0.5, "mid": 0.3, "low": 0.15, "": 0.05}, block_size=1000, cycle=100).collect()
    assert len(out) == docs.count()
    for stream in {x["stream"] for x in out}:
        at = 0
        for x in sorted((x for x in out if x["stream"] == stream), key=lambda x: x["start"]):
            assert x["start"] == at and x["block"] == at // 1000 and x["release"] <= x["slot"] < x["deadline"]
            at += x["mass"]
    shares = spark.createDataFrame([("a", 57), ("b", 30), ("c", 12), ("d", 1)], "name string, share long")
    slots = sorted(mixing.cycle_slots(shares, 100).collect(), key=lambda x: x["slot"])
    had = dict.fromkeys("abcd", 0)
    assert [x["slot"] for x in slots] == list(range(100))
    for x in slots:
        had[x["name"]] += 1
        assert all(abs(had[s["name"]] - (x["slot"] + 1) * s["share"] / 100) < 1 for s in shares.collect())
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and 0 < mixed.count() <= docs.count()
    assert mixing.schedule(docs.limit(0)).count() == 0


def test_mixing_drops_nothing_without_stated_weights(spark):
    rows = [(i, "x" * 1000, "en", "big", 0, "") for i in range(3000)] + [(5000 + i, "y" * 100, "en", f"tiny{i:03}", 0, "") for i in range(300)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    assert mixing.schedule(docs, block_size=1000).where("not selected").count() == 0
    assert sorted(r[0] for r in mixing.mixed(docs).select("doc_id").collect()) == sorted(r[0] for r in rows)
    stated = {"big": 0.5} | {f"tiny{i:03}": 0.5 / 300 for i in range(300)}
    assert mixing.schedule(docs, stated, block_size=1000).where("not selected").count() > 0


def test_mixing_meets_the_weights_of_many_sources(spark):
    # 601 sources, the smallest with the largest weight; none but the first runs out within the slots looked at
    names = [f"s{i:03}" for i in range(600)]
    rows = [(i * 1000 + j, "x" * 100, "en", x, 0, "") for i, x in enumerate(names) for j in range(3)] + [(10**6 + j, "y" * 50, "en", "small", 0, "") for j in range(600)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    weights = {"small": 0.4} | dict.fromkeys(names, 0.001)
    out = mixing.schedule(docs, weights, block_size=100).collect()
    assert len(out) == len(rows) and {x["stream"] for x in out} == {"small", *names}
    assert all(x["release"] <= x["slot"] < x["deadline"] for x in out)
    at = {x["slot"]: x["stream"] for x in out}
    had = dict.fromkeys(weights, 0)
    for slot in range(700):
        had[at[slot]] += 1
        assert all(abs(had[x] - (slot + 1) * w) < 1 for x, w in weights.items())


def test_mixing_rounds_no_weight():
    weights = mixing.whole_weights({"a": 1, "b": 2, "c": 3}, {"a": 0.0004, "b": 0.3337, "c": 0.6659})
    assert weights["a"] * 6659 == weights["c"] * 4 and weights["b"] * 4 == weights["a"] * 3337
    had = dict.fromkeys("abc", 0)
    for x, _, release, deadline, slot in mixing.earliest_deadlines(weights, {"a": 40, "b": 33_370, "c": 66_590}):
        had[x] += 1
        assert release <= slot < deadline
        assert all(abs(had[n] - (slot + 1) * w) < 1 for n, w in (("a", 0.0004), ("b", 0.3337), ("c", 0.6659)))
    assert sum(had.values()) == 100_000


PAGES = "page_id long, url string, html string"


def test_warc(spark, tmp_path):
    html = "<html lang=\"de\"><title>A &amp; B</title><p>x&#8217;s &#x1F600; &#xD800; &#0;</p><script>no</script><a href=\"u\">z</a>"
    rows = [(1, "http://a/", html), (2, None, None), (3, "u", ""), (3, "u", ""), (None, "n", "<p>n</p>"), (5, "long", "<p>word </p>" * 50_000)]
    pages = spark.createDataFrame(rows, PAGES).withColumns({c: F.lit("clash") for c in ("block", "_text", "record", "payload", "message", "head")})
    parsed = warc.responses(pages)
    assert {(r["http_status"], r["http_headers"].count("\r\n")) for r in parsed.collect()} == {(200, 4), (404, 3), (301, 4), (200, 3), (503, 3)}
    assert sorted(r["payload"] for r in parsed.collect()) == sorted(x[2] or "" for x in rows)
    out = warc.derive(parsed)
    rows = out.collect()
    assert len(rows) == 12
    text = next(r for r in rows if r["source_id"] == 1 and r["warc_type"] == "conversion")
    assert text["block"] == "A & B\nx\u2019s \U0001F600 &#xD800; &#0;\nz"
    assert {r["refers_to"] for r in rows} == {r["record_id"] for r in parsed.collect()}
    assert next(r for r in rows if r["source_id"] == 5 and r["warc_type"] == "conversion")["block"].count("word") == 50_000
    raw = warc.serialised(out).where("source_id = 1 and warc_type = 'conversion'").first()["record"]
    head, _, body = bytes(raw).partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: conversion") and body == text["block"].encode() + b"\r\n\r\n"
    assert warc.derive(warc.responses(pages.limit(0))).count() == 0


def warc_record(kind: str, uri: str, block: bytes, length: int | None = None, version: str = "1.1") -> bytes:
    head = f"WARC/{version}\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:{uri}>\r\nWARC-Target-URI: {uri}\r\nWARC-Date: 2026-02-03T04:05:06Z\r\nContent-Length: {len(block) if length is None else length}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def test_warc_files_are_read(spark, tmp_path):
    import gzip

    ok = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=%s\r\n\r\n%s"
    good = "HTTP/1.1 404 Not Found\r\nServer: s\r\nContent-Type: text/html\r\n\r\n<p>gone ü</p>\r\n\r\nrest".encode()
    nested = b"HTTP/1.1 200 OK\r\n\r\na file begins WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1."
    first = [("warcinfo", "i", b"software: x\r\n"), ("response", "http://a/", good), ("response", "http://n/", nested), ("request", "http://q/", b"GET / HTTP/1.1\r\n\r\n"), ("response", "http://b/", b"no http at all"), ("response", "http://e/", b"")]
    (tmp_path / "x.warc").write_bytes(b"".join(warc_record(*r) for r in first) + warc_record("response", "http://cut/", b"HTTP/1.1 200 OK\r\n\r\nx", 500))
    text = "größe – Ж"
    second = [("http://l1/", ok % (b"ISO-8859-1", "größe".encode("latin-1"))), ("http://cp/", ok % (b"windows-1252", "größe –".encode("cp1252"))), ("http://kr/", ok % (b"EUC-KR", "삼성".encode("euc-kr"))), ("http://??/", ok % (b"no-such", text.encode())), ("http://bad/", ok % (b"utf-8", b"a\xff\xfeb"))]
    meta = b'HTTP/1.1 200 OK\r\n\r\n<meta charset="koi8-r">' + "Ж".encode("koi8-r")
    members = [warc_record("response", u, b, version="1.0") for u, b in [*second, ("http://m/", meta)]]
    (tmp_path / "y.warc.gz").write_bytes(b"".join(gzip.compress(m) for m in members))
    (tmp_path / "z.warc").write_bytes(b"WARC/1.0\r\nWARC-Type: response\r\n\r\nno length\r\n\r\nWARC/1.0\r\nno end of headers")
    read = warc.read_warc(spark, f"file://{tmp_path}")
    rows = {r["target_uri"]: r for r in warc.parsed(read.where("problem is null")).collect()}
    assert {k: (r["http_status"], r["payload"]) for k, r in rows.items()} == {
        "http://a/": (404, "<p>gone ü</p>\r\n\r\nrest"), "http://n/": (200, nested.decode().partition("\r\n\r\n")[2]), "http://b/": (None, "no http at all"), "http://e/": (None, ""),
        "http://l1/": (200, "größe"), "http://cp/": (200, "größe –"), "http://kr/": (200, "삼성"), "http://??/": (200, text), "http://bad/": (200, "a\ufffd\ufffdb"), "http://m/": (200, '<meta charset="koi8-r">Ж'),
    }
    assert rows["http://l1/"]["payload_digest"] == "sha256:" + hashlib.sha256("größe".encode("latin-1")).hexdigest()
    assert rows["http://a/"]["warc_date"] == "2026-02-03T04:05:06Z" and "Server: s" in rows["http://a/"]["http_headers"]
    problems = sorted((r["path"].rsplit("/", 1)[1], r["target_uri"], r["problem"]) for r in read.where("problem is not null").collect())
    assert problems == [("x.warc", "http://cut/", "cut short"), ("z.warc", None, "headers don't end"), ("z.warc", None, "no content length")]


def test_warc_files_are_written(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/\r\nX: y", "<p>\r\n\r\nWARC/1.1\r\nü</p>"), (2, None, None), (None, "n", ""), (3, "u", "x" * 300_000)], "page_id long, url string, html string")
    warc.write_warc(warc.messages(pages), f"file://{tmp_path}/out", "1.0")
    read = warc.read_warc(spark, f"file://{tmp_path}/out")
    assert read.where("problem is not null").count() == 0
    assert {(r["source_id"] or None, r["payload"]) for r in warc.parsed(read).collect()} == {("1", "<p>\r\n\r\nWARC/1.1\r\nü</p>"), ("2", ""), (None, ""), ("3", "x" * 300_000)}
    warc.write_warc(warc.messages(pages.limit(0)), f"file://{tmp_path}/none")
    assert warc.derive(warc.parsed(warc.read_warc(spark, f"file://{tmp_path}/none"))).count() == 0


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_same_as_duckdb(name, same_as_duck):
    same_as_duck(llm.queries()[name], llm.oracle_sql()[name])


def test_packed_sequences_follow_the_mixing(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(6)
    # three files, and a source whose texts fill whole sequences
    sizes = {"a": (120, 3000), "b": (2500, 60), "c": (900, 60)}
    rows = [(i, spoken(r, n), "en", x, 0, "") for i, (x, n) in enumerate((x, n) for x, (copies, n) in sizes.items() for _ in range(copies))]
    path = f"{tmp_path}/docs"
    spark.createDataFrame(rows, DOCS).repartition(3, "source").write.partitionBy("lang").parquet(path)
    docs = spark.read.schema(DOCS).parquet(path)
    source = {i: x for i, _, _, x, _, _ in rows}
    pieces = corpus_pipeline.packed(spark, docs, SMALL).select("doc_id", "length", "sequence_id").orderBy("sequence_id").collect()
    assert {p["doc_id"] for p in pieces} == source.keys()
    all_of = dict.fromkeys(sizes, 0)
    for p in pieces:
        all_of[source[p["doc_id"]]] += p["length"]
    total, had, at = sum(all_of.values()), dict.fromkeys(sizes, 0), 0
    assert total > 8 << 16
    bound = (1 << 16) + 2 * mixing.BLOCK  # a group, and two blocks, of which a token is a character at least
    for p in pieces:
        had[source[p["doc_id"]]] += p["length"]
        at += p["length"]
        assert all(abs(had[x] - at * all_of[x] / total) <= bound for x in sizes)


AWKWARD = "doc_id long, text string, lang string, source string, n_chars long, did long, tk long, _did long, spans string, kept string, n_words string, row string, stream string, slot long, share string, gram string, low string, name string"


@pytest.mark.parametrize("stage", range(5))
def test_stages_on_awkward_rows(spark, tmp_path, stage):
    """Null, empty, very long and repeated rows, columns with the operators' own names, and no rows at all."""
    import corpus_pipeline

    r = random.Random(8)
    long = spoken(r, 30_000)
    texts = [None, "", " \n", "one", spoken(r, 80), spoken(r, 80), long, "e\u0301 T\u0308 W\u030a x", "\u4e00" * 500]
    texts += [texts[4]] * 5 + [texts[4] + " more"]
    rows = [(i if i != 3 else None, t, "xx" if i % 2 else None, None if i % 3 == 0 else "s", i, 7, 8, 9, "sp", "k", "nw", "r", "st", 5, "sh", "g", "lo", f"n{i}") for i, t in enumerate(texts)]
    rows.append(rows[5])
    path = f"{tmp_path}/docs"
    spark.createDataFrame(rows, AWKWARD).repartition(3).write.parquet(path)
    docs = spark.read.schema(AWKWARD).parquet(path)
    spark.createDataFrame([(4, 1, 0), (5, 1, 0), (None, 1, 1), (6, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    f = corpus_pipeline.STAGES[stage][1]
    out = f(spark, docs, str(tmp_path))
    if stage < 4:
        got = [tuple(x) for x in out.collect()]
        assert out.columns == docs.columns
        # a row that stays keeps all its values, but for a text without its repeated passages
        rest = {tuple(v for c, v in zip(docs.columns, x, strict=True) if c != "text") for x in rows}
        assert {tuple(v for c, v in zip(docs.columns, x, strict=True) if c != "text") for x in got} <= rest
        kept = {x[0] for x in got}
        # the classifier may reject what it has seen no such text of; null and empty texts stay
        assert ({0, 1} if stage == 0 else {0, 1, 2, None}) <= kept
        if stage == 1:
            assert 4 in kept and not {9, 10, 11, 12, 13, 14} & kept
        if stage == 2:
            assert not {9, 10, 11, 12, 13} & kept and next(x[1] for x in got if x[0] == 14) != texts[14]
        if stage == 3:
            assert sorted(got, key=str) == sorted(rows, key=str)
    else:
        assert {x["doc_id"] for x in out.select("doc_id").collect()} == {x[0] for x in rows}
    assert f(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    scratch, names = Scratch(spark, "test"), docs.columns
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = scratch.store(stage(spark, docs, SMALL), name.replace(" ", "-"))
        assert docs.columns == names
        assert 0 < docs.count() <= before
        before = docs.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert pieces.agg(F.countDistinct("doc_id")).first()[0] == docs.select("doc_id").distinct().count()
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0
