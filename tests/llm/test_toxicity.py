"""Restored texts against all paths of their lattices, counts against plain loops, scores against held-out labels."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
from pyspark.sql import functions as F
from saltmarsh.llm import toxicity
from saltmarsh.llm.toxicity import SLOTS, Speller

from ..conftest import SMALL

WORDS = "the quiet river runs along an old stone wall and gardens bloom under morning light while children walk home singing softly with friends".split()
INSULTS = ["idiot", "scum", "worthless", "moron", "pathetic"]
LEET = str.maketrans("oiesa", "01357"[0] + "1" + "3" + "$" + "@")


def corpus(n: int = 600) -> tuple[list[tuple], list[tuple]]:
    r, docs, labels = random.Random(4), [], []
    for i in range(n):
        words, toxic = [r.choice(WORDS) for _ in range(r.randrange(5, 80))], r.random() < 0.25
        for _ in range(r.randrange(1, 4) if toxic else 0):
            words.insert(r.randrange(len(words)), r.choice(INSULTS))
        docs.append((i, " ".join(words).capitalize() + ".", "en", "s", 0.5, "x"))
        if i % 3:
            labels.append((i, 1, int(toxic)))
    return docs, labels


DOCS = "doc_id long, text string, lang string, source string, score double, seen string"


def speller(texts: list[str]) -> Speller:
    counts = np.zeros(SLOTS, np.int64)
    for points, _, _ in toxicity.together([toxicity.plain(t) for t in texts]):
        for places in toxicity.grams(points):
            np.add.at(counts, places, 1)
    return Speller(counts.astype(np.float32))


def test_counts_of_characters(spark):
    docs, _ = corpus(50)
    texts = [t for _, t, *_ in docs] + ["", "a", "ÄÖ ü", "x\0y", "9 9"]
    want = np.zeros(SLOTS, np.int64)
    for text in texts:
        for word in "".join(c if c.isalpha() else " " for c in toxicity.plain(text)).split():
            whole = [0, 0, 0, *map(ord, word), 0]
            for i in range(3, len(whole)):
                for k in range(1, 5):
                    want[toxicity._places(whole[i - k + 1 : i + 1])[-1]] += 1
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "text string").repartition(3)
    assert (toxicity.character_counts(df) == want).all() and want.sum() > 1000


def test_decode_is_the_cheapest_path():
    s = speller([t for _, t, *_ in corpus(200)[0]])
    for seen, apart in (("1d10t", False), ("m0r0n", False), ("a b c", True), ("$cu*m", False), ("liight", False), ("sc.um", False), ("m  o r", True)):
        lattice = toxicity.channel(seen, apart)
        best = math.inf
        for path in product(*lattice):
            context, cost = "   ", 0.0
            for c, extra in path:
                cost += extra
                if c and not c == context[-1] == " ":
                    cost += s.cost(context, c)
                    context = "   " if c == " " else context[1:] + c
            best = min(best, cost + (s.cost(context, " ") if context[-1] != " " else 0))
        text, context, cost = *s.decode(lattice, "   "), 0.0
        # the decoded text's own cost can't be told without its path, so ask for it again with that text alone
        paths = []
        for path in product(*lattice):
            out, at, cost = "", "   ", 0.0
            for c, extra in path:
                cost += extra
                if c and not c == at[-1] == " ":
                    cost, at, out = cost + s.cost(at, c), "   " if c == " " else at[1:] + c, out + c
            if out == text:
                paths.append(cost + (s.cost(at, " ") if at[-1] != " " else 0))
        assert math.isclose(min(paths), best, rel_tol=1e-9)
        assert (context == "   ") == (text[-1:] in ("", " "))


def test_restored(monkeypatch):
    s = speller([t for _, t, *_ in corpus()[0]])
    for word in INSULTS:
        for seen in (word.translate(LEET), " ".join(word), ".".join(word), "-".join(word) + "!", "".join(c * 3 for c in word), word.upper().replace("O", "0")):
            assert word[:-1] in s.restore([f"The river, {seen} and the wall"])[0], seen
    clean = ["The quiet river runs.", "", "A 1 2 3 4", "call +1 (249) 555-6835!!", "the!! of%%% that***", "x\0y"]
    assert [" ".join(t.split()) for t in s.restore(clean)] == ["the quiet river runs.", "", "a 1 2 3 4", "call +1 (249) 555-6835!!", "the!! of%%% that***", "x y"]
    # texts are worked on together, and long passages in pieces
    texts = [f"{w.translate(LEET)} {i}" for i, w in enumerate(INSULTS * 30)] + ["m0r0n" * 3000]
    whole = s.restore(texts)
    monkeypatch.setattr(toxicity, "SEGMENT", 64)
    assert Speller(s.counts).restore(texts) == whole and len(whole) == len(texts)


def test_long_texts_are_whole(monkeypatch):
    text = " ".join(WORDS * 50)
    points = toxicity._points(text)
    starts, places = toxicity.features(points)
    whole = Counter(map(tuple, places.tolist()))
    monkeypatch.setattr(toxicity, "SEGMENT", 200)
    parts = Counter()
    for piece, rows, _ in toxicity.together([text]):
        assert len(piece) <= 200 and set(rows.tolist()) == {0}
        parts.update(map(tuple, toxicity.features(piece)[1].tolist()))
    assert len(starts) == len(WORDS) * 50 and parts.keys() == whole.keys() and parts == whole


def test_scores(spark):
    docs, labels = corpus()
    known = dict((i, t) for i, _, t in labels)
    hidden = [(1000 + 5 * k, f"The river, {form} along the old wall with friends.", None, None, 0.5, "x") for k, form in enumerate(x for w in INSULTS for x in (w, w.translate(LEET), " ".join(w), "".join(c * 3 for c in w)))]
    rows = [*docs, *hidden, (5000, None, "en", "s", None, None), (5001, "", "en", "s", None, None), (None, docs[0][1], None, None, None, None), docs[7], docs[7], (5002, " \n!!", None, None, 0.1, "y"), (5003, " ".join(WORDS * 40_000), None, None, 0.1, "y")]
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    table = spark.createDataFrame([*labels, (1, 1, None), (None, 1, 1), (77777, 0, 1), labels[0]], "doc_id long, quality int, toxic int")
    got = toxicity.scores(df, table).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    by_id = {r["doc_id"]: r for r in got}
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert all(by_id[i]["predicted"] == t for i, t in known.items() if by_id[i]["held_out"])
    assert all(by_id[i]["predicted"] for i, *_ in hidden)
    assert by_id[None]["score"] == by_id[0]["score"]
    assert by_id[5000]["score"] == by_id[5001]["score"] == by_id[5002]["score"] < 0.5 and not by_id[5003]["predicted"]
    # held-out labels teach nothing
    other = table.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {(r["doc_id"], r["score"]) for r in toxicity.scores(df, other).collect()} == {(r["doc_id"], r["score"]) for r in got}
    assert toxicity.scores(df.limit(0), table).count() == 0
    assert {r["predicted"] for r in toxicity.scores(df, table.limit(0)).collect()} == {0}
    assert toxicity.training(table, 50).count() < 120


def test_accuracy_of_the_query(spark):
    from saltmarsh.llm import queries as llm

    tables = SMALL.replace("0.001", "0.1")
    got = llm.queries()["op13_toxicity"](spark, tables).where("held_out")
    both = got.join(spark.read.parquet(f"{tables}/labels.parquet"), "doc_id").collect()  # some of these labels are noise
    toxic = [r for r in both if r["toxic"]]
    assert len(both) > 500 and sum(r["predicted"] == r["toxic"] for r in both) >= 0.98 * len(both)
    assert sum(r["predicted"] for r in toxic) >= 0.9 * len(toxic)
