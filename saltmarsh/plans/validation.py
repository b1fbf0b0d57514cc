"""Queries over the validators and their counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import validation as V
from ..sources import market as M
from .registry import Plans, table

P = Plans()
BAD = "reason IS NOT NULL"

STRICT = """strict AS (SELECT *, CASE WHEN rn > 1 THEN 'duplicate_date' WHEN (CASE WHEN prev = 0 THEN close <> 0 ELSE abs(close / prev - 1) > 0.35 END) THEN 'return_spike_gt_35pct'
  WHEN open <= 0 AND high <= 0 AND low <= 0 AND close > 0 AND volume = 0 THEN 'zero_candle'
  WHEN date IS NULL OR open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL OR volume < 10 OR close <= 0 THEN 'basic_invalid_or_low_liquidity' END AS reason
  FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY row_no) AS rn, lag(close) OVER (PARTITION BY symbol ORDER BY row_no) AS prev FROM raw_bars))"""


@P.query("f5_bars_strict", f"WITH {M.RAW_BARS}, {STRICT} SELECT symbol, date, row_no, reason FROM strict")
def f5(spark, d):
    return V.bars_strict(M.raw_bars(spark, d)).select("symbol", "date", "row_no", "reason")


@P.query(
    "f6_bars_refined",
    f"""WITH {M.RAW_BARS}, b AS (SELECT *, CASE WHEN date IS NULL OR open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL THEN 'missing_value' WHEN close <= 0 THEN 'nonpositive_close'
  WHEN high < low THEN 'high_below_low' WHEN high < close THEN 'high_below_close' WHEN low > close THEN 'low_above_close' WHEN open <= 0 AND high <= 0 AND low <= 0 AND volume > 0 THEN 'zero_candle' END AS bad FROM raw_bars)
  SELECT symbol, date, row_no, coalesce(bad, CASE WHEN row_number() OVER (PARTITION BY symbol, date, bad IS NULL ORDER BY row_no DESC) > 1 THEN 'duplicate_date' END) AS reason FROM b""",
)
def f6(spark, d):
    return V.bars_refined(M.raw_bars(spark, d)).select("symbol", "date", "row_no", "reason")


@P.query(
    "f7_bars_collected",
    f"""WITH {M.RAW_BARS}, last AS (SELECT symbol, 100.0 AS last_close FROM raw_bars GROUP BY symbol),
  s AS (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY row_no) AS rn, CASE WHEN row_number() OVER (PARTITION BY symbol ORDER BY row_no) = 1 THEN last_close ELSE lag(close) OVER (PARTITION BY symbol ORDER BY row_no) END AS prev FROM raw_bars JOIN last USING (symbol)),
  bad AS (SELECT DISTINCT symbol, date FROM s WHERE rn > 1 OR coalesce(CASE WHEN prev = 0 THEN close <> 0 ELSE abs(close / prev - 1) > 2.0 END, false) OR close IS NULL OR volume < 10)
  SELECT symbol, date, row_no, close FROM raw_bars ANTI JOIN bad USING (symbol, date)""",
)
def f7(spark, d):
    raw = M.raw_bars(spark, d)
    last = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("symbol")).distinct().withColumn("last_close", F.lit(100.0))
    return V.on_good_days(V.bars_strict(raw, most=2.0, last_close=last)).select("symbol", "date", "row_no", "close")


@P.query("f8_flows_strict", f"""WITH {M.RAW_FLOWS} SELECT symbol, date, row_no, CASE WHEN row_number() OVER (PARTITION BY symbol, date ORDER BY row_no) > 1 THEN 'duplicate_date' WHEN inst IS NULL OR corp IS NULL OR indiv IS NULL OR "foreign" IS NULL OR total IS NULL THEN 'missing_value' END AS reason FROM raw_flows""")
def f8(spark, d):
    return V.flows_checked(M.raw_flows(spark, d)).select("symbol", "date", "row_no", "reason")


@P.query("f9_flows_refined", f"""WITH {M.RAW_FLOWS}, b AS (SELECT *, coalesce(inst, corp, indiv, "foreign", total) IS NULL AS bad FROM raw_flows)
  SELECT symbol, date, row_no, CASE WHEN bad THEN 'missing_value' WHEN row_number() OVER (PARTITION BY symbol, date, bad ORDER BY row_no DESC) > 1 THEN 'duplicate_date' END AS reason FROM b""")
def f9(spark, d):
    return V.flows_checked(M.raw_flows(spark, d), strict=False).select("symbol", "date", "row_no", "reason")


FILINGS_CHECKED = f"""WITH {M.FILINGS}, t AS (SELECT row_no, CASE WHEN lower(trim(corp_code)) NOT IN ('', 'nan', 'none', 'null') THEN trim(corp_code) END AS corp_code, CASE WHEN lower(trim(report_nm)) NOT IN ('', 'nan', 'none', 'null') THEN trim(report_nm) END AS report_nm, rcept_no,
  try_strptime(rcept_dt, '%Y%m%d')::DATE AS rcept_dt, stock_code FROM filings)
  SELECT row_no, rcept_no, rcept_dt, CASE WHEN rcept_dt IS NULL THEN 'invalid_rcept_dt' WHEN report_nm IS NULL THEN 'missing_report_nm' WHEN rcept_no IS NULL THEN 'missing_rcept_no' WHEN corp_code IS NULL AND stock_code IS NULL THEN 'missing_corp_or_stock_code'
  WHEN row_number() OVER (PARTITION BY rcept_no ORDER BY row_no DESC) > 1 THEN 'duplicate_rcept_no' END AS reason FROM t"""


@P.query("f10_filings", FILINGS_CHECKED)
def f10(spark, d):
    return V.filings_checked(M.filings(spark, d)).select("row_no", "rcept_no", "rcept_dt", "reason")


@P.query(
    "f11_text_items",
    """WITH t AS (SELECT page_id AS row_no, CASE WHEN page_id % 9 = 0 THEN 'no date' ELSE '2025-01-02 03:04:05' END AS published_at, CASE WHEN page_id % 4 <> 0 THEN left(html, 20) END AS title, CASE WHEN page_id % 6 <> 0 THEN regexp_replace(url, '[0-9?].*', '') END AS url FROM pages)
  SELECT row_no, CASE WHEN try_cast(published_at AS TIMESTAMP) IS NULL THEN 'invalid_published_at' WHEN coalesce(title, url) IS NULL THEN 'missing_title_body_url' WHEN url IS NOT NULL AND row_number() OVER (PARTITION BY url ORDER BY row_no DESC) > 1 THEN 'duplicate_url' END AS reason FROM t""",
)
def f11(spark, d):
    k = F.col("page_id")
    items = table(spark, d, "pages").select(k.alias("row_no"), F.when(k % 9 == 0, "no date").otherwise("2025-01-02 03:04:05").alias("published_at"), F.when(k % 4 != 0, F.substring("html", 1, 20)).alias("title"), F.when(k % 6 != 0, F.regexp_replace("url", "[0-9?].*", "")).alias("url"))
    return V.items_checked(items).select("row_no", "reason")


@P.query("f19_listed", f"WITH {M.UNIVERSE} SELECT DISTINCT lpad(trim(code), 6, '0') AS code FROM universe WHERE CASE WHEN market IS NOT NULL THEN market IN ('KOSPI', 'KOSDAQ', 'KOSDAQ GLOBAL') ELSE market_id IN ('STK', 'KSQ') END")
def f19(spark, d):
    return V.listed(M.universe(spark, d))


@P.query("f20_tradable", f"WITH {M.UNIVERSE} SELECT lpad(trim(code), 6, '0') AS code, name, market, replace(close, ',', '')::DOUBLE AS close, replace(volume, ',', '')::DOUBLE AS volume FROM universe WHERE (market LIKE 'KOSPI%' OR market LIKE 'KOSDAQ%') AND replace(close, ',', '')::DOUBLE > 0")
def f20(spark, d):
    return V.tradable(M.universe(spark, d))


COUNTS = f"WITH {M.RAW_BARS}, {STRICT}, c AS (SELECT symbol, count(*) AS rows, count(*) FILTER (reason IS NULL) AS clean_rows, count(*) FILTER ({BAD}) AS bad_rows, round(count(*) FILTER (reason IS NULL) / count(*)::DOUBLE, 6) AS clean_ratio FROM strict GROUP BY symbol)"


@P.query("a6_quarantine_counters", f"{COUNTS} SELECT * FROM c")
def a6(spark, d):
    return V.counters(V.bars_strict(M.raw_bars(spark, d)), "symbol")


@P.query("a7_anomalies", f"{COUNTS} SELECT symbol, 'full_quarantine' AS anomaly FROM c WHERE rows > 0 AND clean_rows = 0 UNION ALL SELECT symbol, 'high_bad_ratio' FROM c WHERE bad_rows / rows::DOUBLE > 0.30 AND rows > 10")
def a7(spark, d):
    return V.anomalies(V.counters(V.bars_strict(M.raw_bars(spark, d)), "symbol"), "symbol")


@P.query("s20_quarantine_by_reason", f"WITH {M.RAW_BARS}, {STRICT} SELECT coalesce(reason, 'clean') AS reason, count(*) AS rows FROM strict GROUP BY 1")
def s20(spark, d):
    return V.bars_strict(M.raw_bars(spark, d)).groupBy(F.coalesce("reason", F.lit("clean")).alias("reason")).agg(F.count("*").alias("rows"))


QUERIES, ORACLES = P.queries, P.oracles
