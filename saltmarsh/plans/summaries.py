"""Queries over aggregations, selections and qualitative signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import claims as C
from ..functions import text as X
from ..operators import aggregates as A
from ..operators import page_index
from ..operators import qualitative as Q
from ..operators import topk as K
from ..shared import shared_path
from ..sources import market as M
from .registry import Plans, table
from .texts import SCORED, scored_cards

P = Plans()
AX = ("upside", "downside", "bm", "persistence")


def clustered(spark, d):
    cards = scored_cards(spark, d).withColumn("cluster_id", F.col("source"))
    return A.clusters(cards)


def means(weight: str) -> str:
    return ", ".join(f"CASE WHEN sum({weight}) > 0 THEN sum({a} * {weight}) / sum({weight}) ELSE avg({a}) END AS {a}" for a in AX)


CLUSTERS = f"{SCORED}, c AS (SELECT date, symbol, source AS cluster_id, greatest(sum(weight), 1) AS cluster_weight, count(*) AS cards, count(DISTINCT doc_id) AS docs, {means('weight')} FROM scored GROUP BY ALL)"
SYMBOLS = f"{CLUSTERS}, y AS (SELECT date, symbol, sum(cluster_weight) AS weight, count(*) AS clusters, {means('cluster_weight')} FROM c GROUP BY ALL)"
R = ", ".join(f"round({a}::DOUBLE, 5) AS {a}" for a in AX)


def r5(df, keys, values):
    return df.select(*keys.split(), *[F.round(v, 5).alias(v) for v in values.split()])


@P.query("a1_clusters", f"WITH {CLUSTERS} SELECT date, symbol, cluster_id, cards, docs, round(cluster_weight::DOUBLE, 5) AS cluster_weight, {R} FROM c")
def a1(spark, d):
    return r5(clustered(spark, d), "date symbol cluster_id cards docs", "cluster_weight " + " ".join(AX))


@P.query("a3_symbol_scores", f"WITH {SYMBOLS} SELECT date, symbol, clusters, round(weight::DOUBLE, 5) AS weight, {R} FROM y")
def a3(spark, d):
    return r5(A.symbol_scores(clustered(spark, d)), "date symbol clusters", "weight " + " ".join(AX))


@P.query(
    "a2_j3_count_features",
    f"WITH {SCORED} SELECT date, symbol, count(DISTINCT doc_id) AS docs, count(*) AS mentions, round(least(count(DISTINCT family) / 7.0, 1)::DOUBLE, 6) AS diversity, count(DISTINCT doc_id) FILTER (family = 'dart') AS docs_dart, count(DISTINCT doc_id) FILTER (family = 'other') AS docs_other, count(DISTINCT doc_id) FILTER (o = 1) AS docs_order, count(DISTINCT doc_id) FILTER (s = 1) AS docs_lawsuit FROM scored GROUP BY ALL",
)
def a2(spark, d):
    return A.count_features(scored_cards(spark, d), ["dart", "other"], ["order", "lawsuit"]).withColumn("diversity", F.round("diversity", 6))


def macro_docs(spark, d):
    k = F.col("doc_id")
    more = F.when(k % 5 == 0, " easing stimulus").when(k % 5 == 1, " sanction recession easing").otherwise("")
    return table(spark, d, "documents").select(k, F.date_add(F.lit("2026-01-01").cast("date"), (k % 20).cast("int")).alias("date"), "source", F.col("text").alias("evidence"), C.macro_risk(F.concat("text", more))["score"].alias("score"))


@P.query(
    "a4_macro_by_day",
    """WITH t AS (SELECT doc_id, DATE '2026-01-01' + (doc_id % 20)::INTEGER AS date, source, lower(text) || CASE doc_id % 5 WHEN 0 THEN ' easing stimulus' WHEN 1 THEN ' sanction recession easing' ELSE '' END AS t FROM documents),
  n AS (SELECT *, len(list_filter(['risk-on', 'risk on', 'soft landing', 'stimulus', 'easing'], lambda k: contains(t, k))) AS o, len(list_filter(['risk-off', 'risk off', 'recession', 'conflict', 'sanction'], lambda k: contains(t, k))) AS f FROM t), s AS (SELECT *, CASE WHEN o + f > 0 THEN (o - f) / (o + f) ELSE 0 END AS score FROM n),
  g AS (SELECT date, count(*) AS docs, avg(score) AS mean, avg((score > 0)::INTEGER) AS r, avg((score < 0)::INTEGER) AS f, count(DISTINCT source) AS k FROM s GROUP BY date),
  m AS (SELECT date, string_agg(printf('%s:%.2f', source, c / n), ', ' ORDER BY c DESC, source) AS sources FROM (SELECT date, source, c, sum(c) OVER (PARTITION BY date) AS n FROM (SELECT date, source, count(*) AS c FROM s GROUP BY date, source)) GROUP BY date),
  v AS (SELECT date, string_agg(evidence, ' | ' ORDER BY first) AS evidence FROM (SELECT DATE '2026-01-01' + (doc_id % 20)::INTEGER AS date, text AS evidence, min(doc_id) AS first FROM documents GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY DATE '2026-01-01' + (doc_id % 20)::INTEGER ORDER BY min(doc_id)) <= 3) GROUP BY date)
  SELECT date, docs, round(mean, 6) AS mean, round(r, 6) AS on_ratio, round(f, 6) AS off_ratio, CASE WHEN r >= 0.6 AND mean > 0.1 THEN 'risk_on' WHEN f >= 0.6 AND mean < -0.1 THEN 'risk_off' WHEN abs(mean) < 0.15 AND abs(r - f) < 0.2 THEN 'neutral' ELSE 'mixed' END AS regime,
  round(greatest(least(50 + 35 * mean + 10 * (r - f), 100), 0), 6) AS forecast, round(greatest(least(0.35 + 0.12 * least(docs, 4) / 4.0 + 0.2 * greatest(abs(mean), abs(r - f)) + 0.08 * least(k, 3) / 3.0, 0.97), 0.2), 6) AS confidence, sources, md5(coalesce(evidence, '')) AS evidence FROM g JOIN m USING (date) LEFT JOIN v USING (date)""",
)
def a4(spark, d):
    rows = A.macro_by_day(macro_docs(spark, d))
    return rows.select("date", "docs", *[F.round(c, 6).alias(c) for c in ("mean", "on_ratio", "off_ratio")], "regime", F.round("forecast", 6).alias("forecast"), F.round("confidence", 6).alias("confidence"), "sources", F.md5(F.coalesce("evidence", F.lit(""))).alias("evidence"))


PAIRS = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS rho FROM scored" for i, a in enumerate(AX) for b in AX[i + 1 :])


@P.query("a5_axis_correlations", f"WITH {SCORED}, p AS ({PAIRS}) SELECT a, b, round(coalesce(rho, 0), 5) AS rho, abs(coalesce(rho, 0)) > 0.7 AS high FROM p")
def a5(spark, d):
    return A.correlations(scored_cards(spark, d), AX).withColumn("rho", F.round("rho", 5))


BEYOND = {a: " OR ".join(f"coalesce(abs(corr({a}, {b})), 0) > 0.7" for b in others) for a, others in {"upside": ("downside", "bm", "persistence"), "persistence": ("downside", "bm"), "bm": ("downside",)}.items()}


@P.query(
    "d8_d9_guarded_signal",
    f"""WITH {SYMBOLS}, g AS (SELECT {", ".join(f"CASE WHEN {c} THEN 0.0 ELSE 0.25 END AS w_{a}" for a, c in BEYOND.items())}, 0.25 AS w_downside FROM y)
  SELECT date, symbol, round(greatest(least((w_upside * (upside - 50) - w_downside * (downside - 50) + w_bm * (bm - 50) + w_persistence * (persistence - 50)) / 50 / (w_upside + w_downside + w_bm + w_persistence), 1), -1)::DOUBLE, 6) AS signal FROM y, g""",
)
def d8(spark, d):
    rows = A.symbol_scores(clustered(spark, d))
    pairs = [(r["a"], r["b"], r["rho"]) for r in A.correlations(rows, AX).collect()]
    return rows.select("date", "symbol", F.round(Q.signal(Q.guarded(pairs)), 6).alias("signal"))


@P.query("d10_macro_shift", f"WITH {SYMBOLS} SELECT date, symbol, round(greatest(least(upside + 10 * ((symbol % 3) - 1), 100), 0)::DOUBLE, 5) AS upside, round(greatest(least(downside - 10 * ((symbol % 3) - 1), 100), 0)::DOUBLE, 5) AS downside FROM y")
def d10(spark, d):
    rows = A.symbol_scores(clustered(spark, d)).withColumn("macro", F.col("symbol") % 3 - 1)
    return r5(Q.shifted(rows, {"upside": 10.0, "downside": -10.0}), "date symbol", "upside downside")


@P.query(
    "d11_filing_signal",
    f"WITH {SCORED}, fs AS (SELECT date, symbol, count(DISTINCT doc_id) AS n, count(DISTINCT doc_id) FILTER (o = 1) AS o, count(DISTINCT doc_id) FILTER (r = 1) AS r, count(DISTINCT doc_id) FILTER (s = 1) AS s, count(DISTINCT doc_id) FILTER (g = 1) AS g FROM scored GROUP BY ALL) SELECT date, symbol, round(greatest(least((o - r - s + 0.5 * g) / greatest(n, 1), 1), -1)::DOUBLE, 6) AS signal FROM fs",
)
def d11(spark, d):
    rows = A.count_features(scored_cards(spark, d), [], list(C.EVENTS))
    return rows.select("date", "symbol", F.round(Q.filing_signal(), 6).alias("signal"))


def sectors(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("symbol"), F.col("r_name").alias("sector"))


@P.query(
    "a8_sector_strength",
    f"""WITH {M.BARS}, r AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS k FROM bars), t AS (SELECT symbol, max(close) FILTER (k = 1) / nullif(max(close) FILTER (k = 20), 0) - 1 AS ret FROM r WHERE k <= 60 GROUP BY symbol HAVING count(*) >= 20),
  s AS (SELECT t.*, r_name AS sector FROM t LEFT JOIN supplier ON s_suppkey = symbol LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey),
  m AS (SELECT sector, row_number() OVER (ORDER BY avg(ret) DESC, sector) AS rank FROM s GROUP BY sector) SELECT symbol, sector, round(ret, 6) AS ret, rank::INTEGER AS rank, round(CASE WHEN rank <= 4 THEN 1 + greatest(ret, 0) * 8 ELSE 1 END, 6) AS weight FROM s LEFT JOIN m USING (sector)""",
)
def a8(spark, d):
    rows = A.sector_strength(M.bars(spark, d), sectors(spark, d))
    return rows.select("symbol", "sector", F.round("ret", 6).alias("ret"), "rank", F.round("weight", 6).alias("weight"))


@P.query("a9_concentration", "WITH o AS (SELECT o_orderdate::DATE AS date, o_totalprice / sum(o_totalprice) OVER (PARTITION BY o_orderdate::DATE) * 100 AS w FROM orders) SELECT date, round(max(w), 5) AS max_weight, round(sum(power(w / 100, 2)), 5) AS hhi FROM o GROUP BY date")
def a9(spark, d):
    from pyspark.sql import Window

    day = F.to_date("o_orderdate")
    w = table(spark, d, "orders").select(day.alias("date"), "o_totalprice")
    w = w.withColumn("weight_pct", F.col("o_totalprice") / F.sum("o_totalprice").over(Window.partitionBy("date")) * 100)
    return r5(A.concentration(w), "date", "max_weight hhi")


def records(spark, d):
    """Pages as records of a link index: address, title and first paragraph; some without date or summary. Several pages have one address."""
    k = F.col("page_id")
    title, summary = F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.regexp_extract("html", "<p>([^<]*)</p>", 1)
    return table(spark, d, "pages").select(F.concat(F.lit("https://"), X.host_of("url"), F.lit("/")).alias("url"), k.alias("row_no"), F.when(k % 5 != 0, F.date_add(F.lit("2025-01-01").cast("date"), (k % 90).cast("int"))).alias("published"), title.alias("title"), F.when(k % 3 != 0, summary).alias("summary"), F.concat(F.lit("s"), (k % 4).cast("string")).alias("source"))


RECORDS = """records AS (SELECT 'https://' || regexp_replace(lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)), '^(www|m)\\.', '') || '/' AS url, page_id AS row_no, CASE WHEN page_id % 5 <> 0 THEN DATE '2025-01-01' + (page_id % 90)::INTEGER END AS published, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, CASE WHEN page_id % 3 <> 0 THEN regexp_extract(html, '<p>([^<]*)</p>', 1) END AS summary, 's' || (page_id % 4) AS source FROM pages)"""


@P.query("a10_merged_urls", f"WITH {RECORDS} SELECT url, min(published) AS published, arg_max(title, (length(title), -row_no)) FILTER (title <> '') AS title, arg_max(summary, (length(summary), -row_no)) FILTER (summary <> '') AS summary, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM records GROUP BY url")
def a10(spark, d):
    return A.merged_urls(records(spark, d)).withColumn("sources", F.array_join("sources", ","))


@P.query("a11_best_url_rows", f"WITH {RECORDS} SELECT url, row_no, published, title, summary FROM records QUALIFY row_number() OVER (PARTITION BY url ORDER BY published IS NOT NULL DESC, published DESC NULLS LAST, length(coalesce(summary, '')) DESC, length(title) DESC, row_no DESC) = 1")
def a11(spark, d):
    return A.best_rows(records(spark, d)).select("url", "row_no", "published", "title", "summary")


def dates(spark, d):
    return table(spark, d, "orders").where("o_custkey % 40 <> month(o_orderdate)").select(F.concat(F.lit("s"), (F.col("o_custkey") % 40).cast("string")).alias("source"), F.to_date("o_orderdate").alias("date"))


DATES = "dates AS (SELECT 's' || (o_custkey % 40) AS source, o_orderdate::DATE AS date FROM orders WHERE o_custkey % 40 <> month(o_orderdate))"


@P.query("a12_coverage", f"WITH {DATES} SELECT source, min(date) AS earliest, max(date) AS latest, count(DISTINCT date) AS days, count(DISTINCT date_trunc('month', date)) AS months, (date_diff('month', date_trunc('month', min(date)), date_trunc('month', max(date))) + 1 - count(DISTINCT date_trunc('month', date)))::BIGINT AS missing_months FROM dates GROUP BY source")
def a12(spark, d):
    return A.coverage(dates(spark, d))


@P.query("o3_missing_months", f"WITH {DATES}, h AS (SELECT DISTINCT source, date_trunc('month', date)::DATE AS month FROM dates), w AS (SELECT source, unnest(generate_series(min(month)::TIMESTAMP, max(month)::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS month FROM h GROUP BY source) SELECT source, month FROM w ANTI JOIN h USING (source, month)")
def o3(spark, d):
    return A.missing_months(dates(spark, d))


@P.query("a13_ten_years", f"WITH {DATES} SELECT source, round((max(date) - min(date)) / 365.25, 4) AS years, CASE WHEN (max(date) - min(date)) / 365.25 >= 6.5 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM dates GROUP BY source")
def a13(spark, d):
    return A.long_enough(dates(spark, d), 6.5).withColumn("years", F.round("years", 4))


@P.query("a14_freshness", "SELECT event_type AS source, count(*) AS files, round((epoch(TIMESTAMP '2024-02-01') - epoch(max(ts))) / 3600, 4) AS age_hours, count(*) >= 100 AND (epoch(TIMESTAMP '2024-02-01') - epoch(max(ts))) / 3600 <= 48 AS ok FROM events GROUP BY event_type")
def a14(spark, d):
    files = table(spark, d, "events").select(F.col("event_type").alias("source"), "ts")
    return A.freshness(files, F.lit("2024-02-01").cast("timestamp"), 100, 48).withColumn("age_hours", F.round("age_hours", 4))


@P.query("a15_staleness", f"WITH {M.BARS}, l AS (SELECT symbol, max(date) AS last FROM bars GROUP BY symbol) SELECT last, count(*) AS symbols, ((SELECT max(last) FROM l) - last)::INTEGER AS lag, (SELECT max(last) FROM l) - last > 7 AS stale FROM l GROUP BY last")
def a15(spark, d):
    return A.staleness(M.bars(spark, d))


@P.query(
    "a16_continuity",
    f"""WITH {M.BARS}, x AS (SELECT DISTINCT symbol, date FROM bars), n AS (SELECT symbol, date - DATE '1970-01-05' AS a, lead(date) OVER (PARTITION BY symbol ORDER BY date) - DATE '1970-01-05' AS b FROM x),
  g AS (SELECT symbol, coalesce(greatest(0, (b // 7) * 5 + least(b % 7, 5) - (a // 7) * 5 - least(a % 7, 5) - 1), 0) AS gap FROM n), s AS (SELECT symbol, count(*) AS days, sum(gap)::BIGINT AS missing, max(gap)::BIGINT AS max_gap FROM g GROUP BY symbol)
  SELECT symbol, rows, days, missing, max_gap, round(missing / days, 6) AS ratio, CASE WHEN missing / days > 0.10 OR max_gap > 5 THEN 'WARN' ELSE 'OK' END AS flag FROM s JOIN (SELECT symbol, count(*) AS rows FROM bars GROUP BY symbol) USING (symbol)""",
)
def a16(spark, d):
    return A.continuity(M.bars(spark, d)).withColumn("ratio", F.round("ratio", 6))


@P.query("a17_day_gaps", f"WITH {DATES}, x AS (SELECT DISTINCT source, date FROM dates), g AS (SELECT source, date - lag(date) OVER (PARTITION BY source ORDER BY date) AS gap FROM x) SELECT source, count(*) AS days, coalesce(max(gap), 0)::INTEGER AS max_gap, coalesce(max(gap), 0) <= 14 AS ok FROM g GROUP BY source")
def a17(spark, d):
    return A.day_gaps(dates(spark, d))


@P.query(
    "a18_independent_issues",
    f"""WITH {M.RAW_BARS}, b AS (SELECT *, close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY row_no), 0) - 1 AS ret FROM raw_bars),
  f AS (SELECT symbol, (open IS NULL)::INTEGER + (high IS NULL)::INTEGER + (low IS NULL)::INTEGER + (close IS NULL)::INTEGER + (volume IS NULL)::INTEGER AS m, coalesce(abs(ret) > 0.8 AND volume > 0, false) AS o,
    coalesce((high < low)::INTEGER, 0) + coalesce((close <= 0)::INTEGER, 0) + coalesce((volume <= 0)::INTEGER, 0) + (close IS NULL)::INTEGER + coalesce((abs(ret) > 0.35)::INTEGER, 0) + coalesce((open <= 0 AND close > 0)::INTEGER, 0) AS s FROM b),
  g AS (SELECT symbol, count(*) AS rows, sum(m) / (count(*) * 5) AS missing_ratio, count(*) FILTER (o) AS outliers, count(*) FILTER (s >= 3) AS suspect FROM f GROUP BY symbol)
  SELECT symbol, rows, round(missing_ratio, 6) AS missing_ratio, outliers, suspect, concat_ws(',', CASE WHEN missing_ratio > 0.3 THEN 'missing_ratio' END, CASE WHEN outliers > 0 THEN 'outliers' END, CASE WHEN suspect > rows * 0.2 THEN 'suspect_rows' END) AS issues FROM g""",
)
def a18(spark, d):
    return A.independent_issues(M.raw_bars(spark, d)).withColumn("missing_ratio", F.round("missing_ratio", 6))


@P.query("a19_preservation", f"WITH {M.RAW_FLOWS} SELECT symbol, count(*) AS raw, count(inst) AS clean, count(*) - count(inst) AS bad, true AS ok FROM raw_flows GROUP BY symbol")
def a19(spark, d):
    raw = M.raw_flows(spark, d)
    return A.preserved(raw, raw.where("inst is not null"), raw.where("inst is null"), "symbol")


@P.query("a20_verdicts", "SELECT source, CASE WHEN count(*) FILTER (n_chars < 20) > 0 THEN 'FAIL' WHEN count(*) FILTER (n_chars > 20000) > 0 OR count(*) FILTER (n_chars < 60) > 1 THEN 'WARN' ELSE 'PASS' END AS verdict FROM documents GROUP BY source")
def a20(spark, d):
    n = F.col("n_chars")
    return table(spark, d, "documents").groupBy("source").agg(A.verdict(F.count_if(n < 20), F.count_if(n > 20000), F.count_if(n < 60) - 1).alias("verdict"))


@P.query("a21_status_pivot", "SELECT o_orderpriority AS priority, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_orderstatus = 'O') AS todo, count(*) FILTER (o_orderstatus = 'P') AS in_progress FROM orders GROUP BY 1")
def a21(spark, d):
    s = F.col("o_orderstatus")
    return table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count_if(s == "F").alias("done"), F.count_if(s == "O").alias("todo"), F.count_if(s == "P").alias("in_progress"))


@P.query("a22_o14_same_content", "WITH f AS (SELECT 'd' || lpad(doc_id::VARCHAR, 8, '0') AS path, sha1(text) AS sha1, length(text) AS size FROM documents) SELECT sha1, size::INTEGER AS size, count(*) AS copies, array_to_string(list_slice(list_sort(list(path)), 1, 10), ',') AS paths FROM f GROUP BY sha1, size HAVING count(*) > 1")
def a22(spark, d):
    files = table(spark, d, "documents").select(F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 8, "0")).alias("path"), F.sha1("text").alias("sha1"), F.length("text").alias("size"))
    return A.same_content(files)


@P.query("a23_page_grades", "SELECT l_orderkey AS doc_key, CASE WHEN count(*) FILTER (l_returnflag <> 'N') = 0 THEN 'F' WHEN count(*) FILTER (l_returnflag <> 'N') / count(*) >= 0.9 THEN 'A' WHEN count(*) FILTER (l_returnflag <> 'N') / count(*) >= 0.5 THEN 'B' ELSE 'C' END AS grade FROM lineitem GROUP BY 1")
def a23(spark, d):
    return table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("doc_key")).agg(A.page_grade(F.count("*"), F.count_if(F.col("l_returnflag") != "N")).alias("grade"))


@P.query("a24_merged_by_rank", "SELECT o_custkey AS k, arg_max(o_orderpriority, o_orderkey) FILTER (o_orderkey % 2 = 0) AS priority, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1")
def a24(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("rank"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).otherwise("").alias("priority"), F.col("o_orderstatus").alias("status"))
    return A.merged_by_rank(o, ["k"], "rank")


@P.query("a25_a31_page_diagnostics", "WITH o AS (SELECT l_orderkey AS doc_key, l_linenumber AS page_no, bool_or(l_returnflag = 'R') AS t, bool_or(l_linestatus = 'O') AS r FROM lineitem GROUP BY ALL) SELECT doc_key, count(*) AS pages, count(*) FILTER (t) AS with_text, count(*) FILTER (r) AS with_render, count(*) FILTER (NOT t AND NOT r) AS placeholders, min(page_no) = 1 AND max(page_no) = count(*) AS bounded FROM o GROUP BY doc_key")
def a25(spark, d):
    return A.page_diagnostics(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_key"), F.col("l_linenumber").alias("page_no"), (F.col("l_returnflag") == "R").alias("has_text"), (F.col("l_linestatus") == "O").alias("has_render")))


def paged(spark, d):
    """Orders as documents, their lines as pages; every fifth declares one page more than it has."""
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("doc_key"), F.col("l_linenumber").alias("page_no"), F.when(F.col("l_returnflag") == "R", 100).otherwise(0).alias("text_chars"), (F.col("l_linestatus") == "O").alias("has_render"))
    many = lines.groupBy("doc_key").agg(F.max("page_no").alias("top"))
    o = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("doc_key"), (F.col("o_custkey") % 7).cast("string").alias("channel"), F.col("o_orderpriority").alias("kind"), F.to_date("o_orderdate").alias("message_date"), (F.col("o_orderkey") % 5 == 0).cast("int").alias("more"), F.col("o_orderkey").alias("k"))
    docs = o.join(many, "doc_key", "left").withColumn("declared_pages", F.coalesce("top", F.lit(0)) + F.col("more"))
    return docs.select("doc_key", "channel", "kind", "message_date", "declared_pages", F.lit("v1").alias("signature"), "k"), lines


@P.query(
    "a31_page_index",
    """WITH l AS (SELECT l_orderkey AS k, l_linenumber AS page_no, max(CASE WHEN l_returnflag = 'R' THEN 100 ELSE 0 END) AS chars, bool_or(l_linestatus = 'O') AS render FROM lineitem GROUP BY ALL), t AS (SELECT k, max(page_no) AS top FROM l GROUP BY k),
  o AS (SELECT o_orderkey AS k, (o_custkey % 7)::VARCHAR AS channel, o_orderpriority AS kind, o_orderdate::DATE AS day, coalesce(top, 0) + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS declared FROM orders LEFT JOIN t ON k = o_orderkey),
  p AS (SELECT k, unnest(range(1, declared + 1)) AS page_no FROM o), a AS (SELECT k, count(*) AS pages, count(*) FILTER (chars > 0) AS with_text, count(*) FILTER (render) AS with_render, count(*) FILTER (coalesce(chars, 0) = 0 AND NOT coalesce(render, false)) AS placeholders FROM p LEFT JOIN l USING (k, page_no) GROUP BY k),
  g AS (SELECT o.*, coalesce(pages, 0) AS pages, coalesce(with_text, 0) AS with_text, coalesce(with_render, 0) AS with_render, coalesce(placeholders, 0) AS placeholders,
    CASE WHEN coalesce(pages, 0) = 0 OR with_text = 0 THEN 'F' WHEN with_text / pages >= 0.9 THEN 'A' WHEN with_text / pages >= 0.5 THEN 'B' ELSE 'C' END AS grade FROM o LEFT JOIN a USING (k)),
  x AS (SELECT unnest(['all', 'month', 'kind', 'grade']) AS what, unnest(['', strftime(day, '%Y-%m'), kind, grade]) AS key, * EXCLUDE (kind, grade) FROM g)
  SELECT what, key, count(*) AS documents, sum(pages)::BIGINT AS pages, sum(with_text)::BIGINT AS with_text, sum(with_render)::BIGINT AS with_render, sum(placeholders)::BIGINT AS placeholders, count(DISTINCT channel) AS channels, min(day) AS first, max(day) AS last FROM x GROUP BY what, key""",
)
def a31(spark, d):
    """Totals after a second refresh: at the first, some documents had other pages, some were missing, and one more was there."""
    docs, pages = paged(spark, d)
    index = page_index.PageIndex(spark, shared_path(spark, "page-index"))
    early = docs.where("k % 3 <> 0").withColumn("signature", F.when(F.col("k") % 4 == 0, "v0").otherwise("v1")).drop("k")
    gone = spark.createDataFrame([("gone", "9", "none", None, 3, "v1")], early.schema)
    index.refresh(early.unionByName(gone), pages.withColumn("text_chars", F.when(F.col("doc_key") % 4 == 0, 7).otherwise(F.col("text_chars"))))
    index.refresh(docs.drop("k"), pages)
    return index.totals()


@P.query("s23_page_marked_text", "SELECT conv_id AS doc_key, left(string_agg('[PAGE ' || lpad(turn::VARCHAR, 3, '0') || ']' || chr(10) || coalesce(text, ''), chr(10) ORDER BY turn), 2000) AS text FROM (SELECT DISTINCT ON (conv_id, turn) conv_id, turn, text FROM conversations ORDER BY conv_id, turn, text) GROUP BY conv_id")
def s23(spark, d):
    rows = table(spark, d, "conversations").groupBy(F.col("conv_id").alias("doc_key"), F.col("turn").alias("page_no")).agg(F.min("text").alias("text"))
    return A.page_marked(rows)


@P.query("a27_batch_profile", "WITH i AS (SELECT doc_id // 30 AS batch, lang AS kind, greatest(1, ceil(length(text) / 4))::BIGINT AS tokens, strlen(text) AS bytes FROM documents), m AS (SELECT batch, string_agg(kind || '=' || n, ',' ORDER BY kind || '=' || n) AS mix FROM (SELECT batch, kind, count(*) AS n FROM i GROUP BY ALL) GROUP BY batch) SELECT batch, count(*) AS items, sum(tokens)::BIGINT AS tokens, sum(bytes)::BIGINT AS bytes, round(avg((tokens > 600)::INTEGER), 6) AS long_ratio, any_value(mix) AS mix FROM i JOIN m USING (batch) GROUP BY batch")
def a27(spark, d):
    items = table(spark, d, "documents").select(F.floor(F.col("doc_id") / 30).alias("batch"), F.col("lang").alias("kind"), X.token_estimate("text").alias("tokens"), F.octet_length("text").alias("bytes"))
    return A.batch_profile(items).withColumn("long_ratio", F.round("long_ratio", 6))


@P.query("a29_switch_control", "WITH t AS (SELECT o_orderdate::DATE AS date, CASE WHEN o_orderkey % 2 = 0 THEN 'add' ELSE 'remove' END AS kind, o_custkey % 50 AS code FROM orders WHERE o_orderkey % 9 <> 0), a AS (SELECT date, count(*) FILTER (kind = 'add') AS adds FROM t GROUP BY date), x AS (SELECT date, count(*) AS overlap FROM (SELECT date, code FROM t WHERE kind = 'add' INTERSECT SELECT date, code FROM t WHERE kind = 'remove') GROUP BY date) SELECT strftime(date, '%Y-%m') AS month, sum(adds)::BIGINT AS replacements, sum(adds) > 1 AS over_month, count(*) FILTER (adds > 1) AS days_over, coalesce(sum(overlap), 0)::BIGINT AS overlaps FROM a LEFT JOIN x USING (date) GROUP BY 1")
def a29(spark, d):
    k = F.col("o_orderkey")
    return A.switches(table(spark, d, "orders").select(F.to_date("o_orderdate").alias("date"), F.when(k % 2 == 0, "add").otherwise("remove").alias("kind"), (F.col("o_custkey") % 50).alias("code"), (k % 9 == 0).alias("risk")))


# selections

PRIO = """items AS (SELECT page_id, host, year, (page_id % 7) * 10 + (page_id % 6) * 1.5 + CASE WHEN page_id % 4 = 0 THEN 2 ELSE 0 END + page_id % 3 - CASE WHEN page_id % 11 = 0 THEN 15 ELSE 0 END AS score FROM (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)), '^(www|m)\\.', '') AS host, 2015 + page_id % 10 AS year FROM pages))"""


def items(spark, d):
    k = F.col("page_id")
    score = K.article_priority(k % 7, k % 6, 1.5, k % 4 == 0, (k % 3).cast("double"), k % 11 == 0)
    return table(spark, d, "pages").select("page_id", X.host_of("url").alias("host"), (F.lit(2015) + k % 10).alias("year"), score.alias("score"))


@P.query("k1_k2_priority_cap", f"WITH {PRIO} SELECT page_id, host, round(score, 4)::DOUBLE AS score FROM items QUALIFY row_number() OVER (PARTITION BY host ORDER BY score DESC, page_id) <= 3")
def k1(spark, d):
    return K.capped(items(spark, d), "host", 3, [F.desc("score"), F.col("page_id")]).select("page_id", "host", F.round("score", 4).alias("score"))


@P.query("k3_year_quota", f"WITH {PRIO}, q AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY score DESC, page_id) <= 5 AS q FROM items) SELECT page_id, year, round(score, 4)::DOUBLE AS score FROM q ORDER BY q DESC, score DESC, page_id LIMIT 80")
def k3(spark, d):
    return K.quota_then_fill(items(spark, d), "year", 5, 80, "score", "page_id").select("page_id", "year", F.round("score", 4).alias("score"))


@P.query("k4_leaders", f"WITH {PRIO} SELECT page_id, round(score, 4)::DOUBLE AS score FROM items ORDER BY score DESC, page_id LIMIT 10")
def k4(spark, d):
    return K.leaders(items(spark, d), "score", "page_id").select("page_id", F.round("score", 4).alias("score"))


@P.query("k5_task_order", "SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN 'P0' WHEN 1 THEN 'P1' WHEN 2 THEN 'P2' WHEN 3 THEN 'P3' ELSE '' END AS priority FROM orders ORDER BY CASE o_orderkey % 5 WHEN 4 THEN 4 ELSE o_orderkey % 5 END, CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 1 ELSE 2 END, o_custkey, o_orderkey LIMIT 20")
def k5(spark, d):
    k = F.col("o_orderkey") % 5
    tasks = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.when(k < 4, F.concat(F.lit("P"), k.cast("string"))).otherwise("").alias("priority"), F.when(F.col("o_orderstatus") == "O", "active").when(F.col("o_orderstatus") == "P", "backlog").otherwise("done").alias("bucket"), F.col("o_custkey").alias("sort_order"))
    return K.task_order(tasks, 20).select("id", "priority")


@P.query("k6_recent", "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id LIMIT 25")
def k6(spark, d):
    return table(spark, d, "events").select("event_id", "ts").orderBy(F.desc("ts"), "event_id").limit(25)


@P.query("k7_next_order", "SELECT coalesce(max(o_custkey), 0) + 1 AS next_order FROM orders")
def k7(spark, d):
    return K.next_order(table(spark, d, "orders").select(F.col("o_custkey").alias("sort_order")))


QUERIES, ORACLES = P.queries, P.oracles
