"""Operators that SQL doesn't state, against plain loops; and rows worked out by hand."""

from __future__ import annotations

import random
from datetime import date

from pyspark.sql import functions as F
from saltmarsh.operators import audits, batching, dedup, messages, windows
from saltmarsh.sources import files, market

from .conftest import SMALL


def test_greedy_dedup_keeps_what_only_a_duplicate_shares(spark):
    rows = [(1, ["k1"], None), (2, ["k1", "k2"], []), (3, ["k2"], None), (4, None, None)]
    out = dedup.greedy(spark.createDataFrame(rows, "id long, url array<string>, content array<string>"), ["url", "content"]).collect()
    assert {r["id"]: (r["kept"], r["matched"]) for r in out} == {1: (True, None), 2: (False, 1), 3: (True, None), 4: (True, None)}


def test_greedy_dedup_is_the_loop(spark):
    r = random.Random(1)
    rows = [(i, [str(x) for x in r.sample(range(60), r.randint(0, 3))]) for i in range(120)]
    owner: dict[str, int] = {}
    kept = {}
    for i, keys in rows:
        kept[i] = not any(k in owner for k in keys)
        if kept[i]:
            owner |= dict.fromkeys(keys, i)
    out = dedup.greedy(spark.createDataFrame(rows, "id long, url array<string>"), ["url"]).collect()
    assert {x["id"]: x["kept"] for x in out} == kept


def test_batches_keep_their_limits():
    r = random.Random(2)
    tokens = [r.randint(10, 900) for _ in range(400)]
    found = batching.cut(((t, 4 * t, False) for t in tokens))
    assert found == sorted(found) and found[0] == 0 and len(found) == 400
    for b in set(found):
        inside = [t for t, x in zip(tokens, found, strict=True) if x == b]
        assert len(inside) <= batching.MOST + batching.FEWEST and sum(inside) <= batching.HARD_TOKENS + batching.FEWEST * 900
    assert batching.cut((t, 1, False) for t in tokens[:40]) == [0] * 40


def test_weights_add_up(spark):
    day = market.holdings(spark, SMALL).where("weight_pct > 0").groupBy("track", "date").agg(F.sum("weight_pct").alias("w"))
    assert day.count() > 0 and day.where("abs(w - 100) > 0.5").count() == 0


def test_means_over_gaps(spark):
    x = [None, 1.0, None, 3.0]
    rows = [("a", date(2025, 1, 1 + i), v) for i, v in enumerate(x)] + [("b", date(2025, 1, 1), 7.0)]
    series = spark.createDataFrame(rows, "symbol string, date date, x double")
    out = windows.ewm(series, "x", 3, "y").where("symbol = 'a'").orderBy("date").collect()
    assert [r["y"] and round(r["y"], 4) for r in out] == [None, 1.0, 1.0, 2.3333]
    out = windows.adaptive_ema(series, "x", 20, "y").where("symbol = 'a'").orderBy("date").collect()
    assert [r["y"] and round(r["y"], 6) for r in out] == [None, 1.0, 1.0, round(1 + 2 * 2 / 21, 6)]


def test_validators_of_texts(spark):
    body = "The margin improved again this quarter and guidance was raised by the company, which the market liked."
    cases = [
        ("blog", f"Date: 2025-01-01\nSource: http://a\n{body}", None),
        ("blog", f"Date: 2025-01-01\n{body}", "blog_missing_required_metadata"),
        ("blog", "Date: 2025-01-01\nSource: http://a\n검색 x\n# y", "blog_effective_body_empty"),
        ("telegram", "Date: x\nSource: https://t\nPostID: 4\nshort text", "telegram_effective_body_too_short"),
        ("telegram", "# Telegram Log: c\nDate: x\nMessageID: 5\nRevenue and profit rose again, the order book is full.", None),
        ("premium", f"- URL: http://p\n- PublishedAt: d\n- Status: Success\n- Reason: session expired\n## 본문\n{body}", "premium_paywall_or_blocked_reason"),
        ("premium", "- URL: http://p\n- PublishedAt: d\n- Status: OK\n## 본문\nDisclaimer: none", "premium_effective_body_empty_or_boilerplate"),
        ("premium", "- URL: http://p\n- PublishedAt: d\n- Status: error", "premium_bad_status_ERROR"),
        ("other", "  123456789 ", "text_too_short"),
        ("other", "1234567890", None),
        ("blog", None, "text_too_short"),
    ]
    df = spark.createDataFrame([(i, k, t) for i, (k, t, _) in enumerate(cases)], "i int, kind string, text string")
    got = {r["i"]: r["reason"] for r in df.select("i", messages.text_reason("text", F.col("kind")).alias("reason")).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(cases)}
    dirty = "a  \n[MEDIA] x\n\n\n\nb\n[ATTACH_TEXT]\nsecret\n[/ATTACH_TEXT]\nViews: 12\n"
    row = spark.createDataFrame([(dirty,)], "t string").select(messages.without_residue("t").alias("c"), messages.attached_text("t").alias("a")).first()
    assert row["c"] == "a\n\nb\n" and row["a"] == "secret"


def test_error_lines_are_numbered_in_large_files(spark, tmp_path):
    lines = [f'{{"i": {k}}}' if k % 9 else "{oops" for k in range(2000)]
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    (tmp_path / "b.jsonl").write_text('\n\n[1]\n{"i": 5}\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        good, bad = files.jsonl(spark, f"file://{tmp_path}", "i long")
        rows = bad.collect()
        assert good.count() == sum(k % 9 != 0 for k in range(2000)) + 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r["line_no"] for r in rows if r["path"].endswith("a.jsonl")) == [k + 1 for k in range(0, 2000, 9)]
    assert [(r["line_no"], r["reason"]) for r in rows if r["path"].endswith("b.jsonl")] == [(3, "jsonl_row_not_object")]


def test_greedy_dedup_takes_whole_texts(spark):
    from saltmarsh.plans import portfolios

    start, end = "the same first forty characters of every text ", " is licensed under the gnu general public license, version 3."
    shared = "a paragraph of more than eighty characters that several documents of this corpus have word for word in them"
    texts = [f"{start}one{end}", f"{start}two{end}", f"alpha\n\n{shared}\n\nomega", f"beta\n\n{shared}\n\npsi", f"{start}ONE{end}", None, "short", "Short!"]
    docs = spark.createDataFrame([(i, x, "en") for i, x in enumerate(texts)], "doc_id long, text string, lang string")
    keys = portfolios.keyed(docs)
    owners, want = {}, {}
    for r in sorted(keys.collect(), key=lambda r: r["id"]):
        own = [(k, v) for k in ("url", "title_date", "content") for v in r[k]]
        hit = next((kind for kind in ("url", "title_date", "content") if any(k == kind and (k, v) in owners for k, v in own)), None)
        want[r["id"]] = (hit, min(owners[x] for x in own if x[0] == hit and x in owners) if hit else None)
        if hit is None:
            owners |= dict.fromkeys(own, r["id"])
    got = {r["id"]: (None if r["kept"] else r["kind"], r["matched"]) for r in dedup.greedy(keys).collect()}
    assert got == want
    assert got[1] == (None, None) and got[3] == ("content", 2) and got[4][1] == 0 and got[7] == ("title_date", 6)


def test_a_summary_is_compared_key_by_key(spark):
    rows = spark.createDataFrame([("b.jsonl", "http://a", "x", "rss", date(2025, 1, 2)), ("b.jsonl", "http://a", " ", None, None), ("c.jsonl", " ", "x", "k", date(2024, 1, 2))], "file string, url string, source_domain string, source_kind string, day date")
    files = spark.createDataFrame([("a.jsonl", 1), ("b.jsonl", 2), ("c.jsonl", 3)], "file string, modified int")
    found = audits.live_summary(rows, files, "f")
    one = found.first()
    assert (one["total_rows"], one["unique_url_count"], one["recent_backfill_added_rows"], one["latest_file"], one["latest_file_mtime_utc"]) == (3, 1, 3, "c.jsonl", 3)
    assert [tuple(x) for x in one["row_counts_by_file"]] == [("a.jsonl", 0), ("b.jsonl", 2), ("c.jsonl", 1)] and [tuple(x) for x in one["source_domains"]] == [("x", 2)]
    assert audits.summary_issues(found, found).count() == 0
    assert [r[0] for r in audits.summary_issues(found.limit(0), found).collect()] == ["summary_missing_or_invalid"]
    empty = audits.live_summary(rows.limit(0), files.limit(0), "f")
    assert empty.first()["total_rows"] == 0 and empty.first()["latest_file"] is None
    assert {r[0] for r in audits.summary_issues(empty, found).collect()} >= {"total_rows_mismatch", "date_min_mismatch", "recent_backfill_files_mismatch"}


def test_lines_of_a_page_are_fingerprinted_once(spark):
    from saltmarsh.functions import text

    lines = [f"line {i % 40} of a page that has enough characters, {'again' if i >= 40 else 'AGAIN'}!" for i in range(90)]
    lines[7] = "short"
    df = spark.createDataFrame([("<p>" + "</p><p>".join(lines) + "</p>",), (None,), ("<script>",)], "html string")
    out = df.select(text.html_lines("html").alias("l"), text.html_text("html").alias("t"))
    got = [r["l"] for r in out.collect()]
    assert got == [[x for i, x in enumerate(lines[:40]) if i != 7] + [lines[47]], [], []]
    plan = out.select("l")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sha1(") == 1


def test_text_of_a_page_is_whole(spark):
    from saltmarsh.functions import text

    lines = [f"line {'abcdefghij'[i % 10] * (i // 10 + 1)} of a page that goes on far beyond some thousand characters" for i in range(400)]
    df = spark.createDataFrame([("<p>" + "</p><p>".join(lines) + "</p>",), (None,)], "html string")
    got = [r["t"] for r in df.select(text.html_text("html").alias("t")).collect()]
    assert got == ["\n".join(lines), ""] and len(got[0]) > 30_000


def test_bad_days_go_without_a_join_of_bars(spark):
    from saltmarsh.operators import validation
    from saltmarsh.plans import validation as plans

    day = date(2025, 1, 2)
    rows = [("a", day, None), ("a", day, "x"), ("a", date(2025, 1, 3), None), ("b", day, None), ("b", None, "x"), (None, day, "x")]
    checked = spark.createDataFrame(rows, "symbol string, date date, reason string")
    want = validation.without_bad_days(checked.drop("reason"), checked).collect()
    assert sorted(map(str, validation.on_good_days(checked).collect())) == sorted(map(str, want)) and len(want) == 4
    plan = plans.QUERIES["f7_bars_collected"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("min_by") == 1 and "LeftAnti" not in plan


def test_periods_take_one_pass_and_models_are_stored(spark, monkeypatch):
    from saltmarsh.plans import factors, portfolios

    plan = factors.QUERIES["w14_period_metrics"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lineitem") + plan.count("min_by") <= 2 and "Union" not in plan
    names, kept = [], portfolios.stored
    monkeypatch.setattr(portfolios, "stored", lambda df, name: names.append(name) or kept(df, name))
    portfolios.QUERIES["d22_all_checks"](spark, SMALL)
    assert "models" in names


def test_plain_keywords_are_found_in_one_search(spark):
    from saltmarsh.functions import text

    words = ("cb", "order", "order", "risk", "수주", "수주계약", "risk-on", "or", "x1")
    rows = [("order orders cb,cb_x cb1 수주계약 수주 risk-on risk 계약order x1 or",), ("order-order ordercb 주수주수주",), ("",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    one_by_one = F.lit(0)
    for k in words:
        one_by_one = one_by_one + text.occurrences(F.col("t"), k)
    got = df.select(text.hits(F.col("t"), words).alias("a"), one_by_one.alias("b")).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got] == [14, 6, 0, None]
    plan = df.select(text.hits(F.col("t"), ("cb", "risk", "or")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1


def test_fingerprints_text_takes_blanks_and_signs_in_one_search(spark):
    import re

    from saltmarsh.functions import text

    rows = [" A\t-- b\n\n! 가c", "http://x.y/z?q, tail HTTPS://a", "", None, "… x y  ", "a.b"]
    df = spark.createDataFrame([(r,) for r in rows], "t string").coalesce(1).select("t", text.fingerprint_text("t").alias("f"))
    for r in df.collect():
        plain = re.sub(r"https?://\S+", " ", (r["t"] or "").lower(), flags=re.A)
        assert r["f"] == re.sub(r"[ \t\n\r\f\v]+", " ", re.sub(r"[^0-9a-z가-힣\s]", " ", plain, flags=re.A)).strip(" ")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") == 2
