"""Mentions against a scan character by character, with few names and with a hundred thousand."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F
from saltmarsh.operators import mentions


def by_scan(text: str | None, tickers: dict[str, str]) -> list[str]:
    text, out, i = text or "", [], 0
    longest, is_word = max(map(len, tickers), default=0), re.compile(f"[{mentions.TOKEN}]").match
    while i < len(text):
        name = next((text[i : i + n] for n in range(longest, 0, -1) if i + n <= len(text) and text[i : i + n] in tickers), None)
        if name is None:
            i += 1
            continue
        before, behind = text[i - 1 : i], text[i + len(name) :]
        if not is_word(before) and (not is_word(behind) or behind.startswith(mentions.POSTFIXES)) and not behind.startswith(mentions.ANALYSTS):
            out.append(tickers[name])
        i += len(name)
    out += [c for c in re.findall(r"(?<!\d)\d{6}(?!\d)", text) if c in tickers.values()]
    return list(dict.fromkeys(out))


def check(spark, texts: list[str | None], universe: list[tuple[str | None, str | None]]) -> list[list[str]]:
    tickers = {n: c for c, n in sorted(((c, n) for c, n in universe if c and n), reverse=True)}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["symbols"] for r in mentions.with_mentions(df, spark.createDataFrame(universe, "code string, name string")).collect()}
    want = {i: by_scan(t, tickers) for i, t in enumerate(texts)}
    assert got == want
    return [want[i] for i in range(len(texts))]


def test_mentions_by_hand(spark):
    universe = [("1", "삼성"), ("2", "삼성전자"), ("3", "Acme"), ("4", "A.B"), ("000001", "x y"), ("000009", "S-Oil"), ("6", "Oil"), ("7", "(주)한"), ("8", "Acme"), (None, "z"), ("9", None), ("10", r"Q\E|.")]
    texts = ["삼성전자가 삼성과, Acme", "Acmes xAcme Acme1 삼성 연구원 삼성XX", "A.B 000001 1000001 000009. Acme Acme", "", None, "xS-Oil Oil", "(주)한은 a(주)한", "x\ny x yz x y", "Acme\n연구원 Acme\x01 \x02Acme", r"Q\E|. and Q\E|", "Acme 삼성전자Acme AcmeAcme"]
    found = check(spark, texts, universe)
    assert found[:4] == [["2", "1", "3"], [], ["4", "3", "000001", "000009"], []] and found[5] == ["6"]


def test_mentions_of_many_names(spark):
    r = random.Random(6)
    part = lambda: "".join(r.choice("가나다라마ABab1") for _ in range(r.randrange(1, 4)))
    names = {r.choice(["", "", "("]) + r.choice([" ", "-", "", ". "]).join(part() for _ in range(r.randrange(1, 4))) for _ in range(3000)}
    names = sorted(n for n in names if re.search(f"[{mentions.TOKEN}]", n))
    texts = [r.choice([" ", "\n", "은 ", ", ", ""]).join(r.choice([part(), r.choice(names), r.choice(mentions.POSTFIXES), r.choice(mentions.ANALYSTS)]) for _ in range(60)) for _ in range(120)]
    assert sum(map(len, check(spark, texts, [(str(100000 + i), n) for i, n in enumerate(names)]))) > 200


def test_a_hundred_thousand_names(spark):
    universe = spark.range(100_000).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("code"), F.concat(F.lit("Firm "), F.hex("id"), F.lit(" Corp")).alias("name"))
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("the Firm "), F.hex(F.col("id") * 37), F.lit(" Corp는 and Firm "), F.hex(F.col("id") * 11), F.lit(" Corps, "), F.lpad((F.col("id") * 3).cast("string"), 6, "0")).alias("text"))
    rows = mentions.with_mentions(docs, universe).collect()
    assert {r["doc_id"]: r["symbols"] for r in rows} == {i: list(dict.fromkeys([f"{i * 37:06d}", f"{i * 3:06d}"])) for i in range(2000)}


def test_names_in_texts(spark):
    texts = spark.createDataFrame([(1, "the License and Licenses"), (2, None), (3, "xLicensey a.b"), (4, "")], "id int, text string")
    names = spark.createDataFrame([("License",), ("License",), ("and L",), ("cense",), ("e",), ("s",), ("th",), (None,), ("",), ("..",), ("a.b",)], "name string")
    assert {tuple(r) for r in mentions.names_in(texts, names, 3).collect()} == {(1, "License"), (1, "and L"), (1, "cense"), (3, "License"), (3, "a.b"), (3, "cense")}
    assert mentions.names_in(texts, names.limit(0)).count() == 0


def test_only_tickers_count_as_digits_where_the_universe_says_so(spark):
    texts = spark.createDataFrame([(1, "Acme 209136 100001"), (2, "Customer#7 and 100001, 209136")], "doc_id long, text string")
    universe = spark.createDataFrame([("100001", "Acme", True), ("209136", "Customer#7", False)], "code string, name string, by_code boolean")
    got = {r["doc_id"]: r["symbols"] for r in mentions.with_mentions(texts, universe).collect()}
    assert got == {1: ["100001"], 2: ["209136", "100001"]}
    assert [r["symbols"] for r in mentions.with_mentions(texts, universe.drop("by_code")).where("doc_id = 1").collect()] == [["100001", "209136"]]
