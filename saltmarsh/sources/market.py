"""Canonical market tables: one long table each, with the symbol as a column.

The adapters read them from star-schema order lines: a supplier stands for a symbol, a ship date for a trading day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shared import dealt


def nulled(c: Column | str) -> Column:
    """NaN counts as null from here on: later comparisons and aggregates skip it."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), c)


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, date, open, high, low, close, volume: one row a symbol and day, a symbol's in one task, as all that follows goes by symbol."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    place = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    lines = items.select(F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("date"), nulled(price).alias("price"), place.alias("place"), F.col("l_quantity").alias("quantity"))
    return dealt(lines, items.count(), "symbol").groupBy("symbol", "date").agg(F.min_by("price", "place").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "place").alias("close"), F.sum("quantity").alias("volume"))


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars as a feed delivers them: with row_no (file order), missing closes, thin volume, zero candles and repeated days."""
    b = bars(spark, sf_dir).withColumn("k", F.col("symbol") * 7 + F.dayofyear("date"))
    zero = (F.col("k") % 23 == 0) & (F.col("k") % 17 != 0)
    dirty = b.select(
        "symbol",
        "date",
        F.when(zero, 0.0).otherwise(F.col("open")).alias("open"),
        F.when(zero, 0.0).otherwise(F.col("high")).alias("high"),
        F.when(zero, 0.0).otherwise(F.col("low")).alias("low"),
        F.when(F.col("k") % 17 != 0, F.col("close")).alias("close"),
        F.when(zero, 0.0).when(F.col("k") % 19 == 0, 5.0).otherwise(F.col("volume")).alias("volume"),
        F.explode(F.when(F.col("k") % 13 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"),
    )
    return dirty.withColumn("row_no", F.datediff("date", F.lit("1990-01-01").cast("date")) * 2 + F.col("again")).drop("again")


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, date, inst, corp, indiv, foreign, total: net quantities by kind of investor, a symbol's in one task."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    lines = items.select(F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("date"), "l_returnflag", "l_quantity")

    def of(flag: str) -> Column:
        return F.sum(F.when(F.col("l_returnflag") == flag, F.col("l_quantity")).otherwise(0.0))

    kinds = dealt(lines, items.count(), "symbol").groupBy("symbol", "date").agg(of("R").alias("inst"), of("N").alias("corp"), of("A").alias("foreign"))
    return kinds.select("symbol", "date", "inst", "corp", (-(F.col("inst") + F.col("foreign"))).alias("indiv"), "foreign", (F.col("inst") + F.col("corp") + F.col("foreign")).alias("total"))


def raw_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows with missing numbers and repeated days."""
    f = flows(spark, sf_dir).withColumn("k", F.col("symbol") * 11 + F.dayofyear("date"))
    f = f.withColumn("inst", F.when(F.col("k") % 7 != 0, F.col("inst")))
    for c in ("corp", "indiv", "foreign", "total"):
        f = f.withColumn(c, F.when(F.col("k") % 49 != 0, F.col(c)))
    f = f.withColumn("again", F.explode(F.when(F.col("k") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return f.withColumn("row_no", F.datediff("date", F.lit("1990-01-01").cast("date")) * 2 + F.col("again")).drop("k", "again")


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw filings, all strings: some without date, name, number or identity, some numbers repeated."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    key = F.col("o_orderkey")
    return o.select(
        key.alias("row_no"),
        F.when(key % 11 != 0, F.col("o_custkey").cast("string")).otherwise("").alias("corp_code"),
        F.when(key % 13 != 0, F.col("o_orderpriority")).otherwise(" nan ").alias("report_nm"),
        F.when(key % 17 != 0, F.floor(key / 2).cast("string")).alias("rcept_no"),
        F.when(key % 19 != 0, F.date_format("o_orderdate", "yyyyMMdd")).otherwise("2024-13-45").alias("rcept_dt"),
        F.when(key % 22 != 0, F.col("o_custkey").cast("string")).alias("stock_code"),
    )


def universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """code, name, market, market_id, close, volume as an exchange lists them: strings, numbers with commas."""
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    k = F.col("s_suppkey")
    return s.select(
        k.cast("string").alias("code"),
        F.col("s_name").alias("name"),
        F.when(k % 5 == 0, "KONEX").when(k % 5 == 1, "KOSDAQ GLOBAL").when(k % 5 == 2, "KOSDAQ").when(k % 5 == 3, "KOSPI").alias("market"),
        F.when(k % 2 == 0, "STK").otherwise("KNX").alias("market_id"),
        F.format_number(F.col("s_acctbal"), 2).alias("close"),
        F.format_number(k * 1000, 0).alias("volume"),
    )


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """track, date, code, weight_pct, change (added, removed or null): ten tracks' six largest customers' groups by month, orders' totals as weights."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    sums = o.groupBy((F.col("o_custkey") % 10).alias("track"), F.trunc(F.to_date("o_orderdate"), "month").alias("date"), F.floor(F.col("o_custkey") / 10 % 12).alias("code")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("v"))
    best = Window.partitionBy("track", "date").orderBy(F.desc("v"), "code")
    top = sums.withColumn("r", F.row_number().over(best)).where("r <= 6")
    live = top.select("track", "date", "code", F.round(F.col("v").cast("double") / F.sum("v").over(Window.partitionBy("track", "date")).cast("double") * 100, 1).alias("weight_pct"))
    days = live.select("track", "date").distinct().withColumns({"next": F.lead("date").over(Window.partitionBy("track").orderBy("date")), "before": F.lag("date").over(Window.partitionBy("track").orderBy("date"))})
    moved = live.select("track", "date", "code").join(days.where("next is not null").select("track", "date", "next"), ["track", "date"]).select("track", F.col("next").alias("date"), "code", F.lit(True).alias("had"))
    now = live.join(days.select("track", "date", "before"), ["track", "date"]).join(moved, ["track", "date", "code"], "left")
    now = now.select("track", "date", "code", "weight_pct", F.when(F.col("had").isNull() & F.col("before").isNotNull(), "added").alias("change"))
    gone = moved.join(live, ["track", "date", "code"], "left_anti").select("track", "date", "code", F.lit(0.0).alias("weight_pct"), F.lit("removed").alias("change"))
    return now.unionByName(gone)


def group_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """date, code, ret: a customers' group's mean order in a month against 150,000, in ten-thousandths."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    mean = F.avg("o_totalprice")
    return o.groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("date"), F.floor(F.col("o_custkey") / 10 % 12).alias("code")).agg(((mean / 150_000 - 1) / 100).alias("ret"))


#: The same tables in DuckDB, for the oracles.
BARS = """bars AS (SELECT l_suppkey AS symbol, l_shipdate::DATE AS date, arg_min(p, o) AS open, max(p) AS high, min(p) AS low, arg_max(p, o) AS close, sum(q) AS volume
  FROM (SELECT *, l_extendedprice / l_quantity AS p, l_orderkey * 10 + l_linenumber AS o, l_quantity AS q FROM lineitem) GROUP BY ALL)"""
RAW_BARS = BARS + """, raw_bars AS (SELECT symbol, date, CASE WHEN z THEN 0.0 ELSE open END AS open, CASE WHEN z THEN 0.0 ELSE high END AS high, CASE WHEN z THEN 0.0 ELSE low END AS low,
  CASE WHEN k % 17 <> 0 THEN close END AS close, CASE WHEN z THEN 0.0 WHEN k % 19 = 0 THEN 5.0 ELSE volume END AS volume, (date - DATE '1990-01-01') * 2 + again AS row_no
  FROM (SELECT *, k % 23 = 0 AND k % 17 <> 0 AS z, unnest(CASE WHEN k % 13 = 0 THEN [0, 1] ELSE [0] END) AS again FROM (SELECT *, symbol * 7 + dayofyear(date) AS k FROM bars)))"""
FLOWS = """flows AS (SELECT *, -(inst + "foreign") AS indiv, inst + corp + "foreign" AS total FROM (SELECT l_suppkey AS symbol, l_shipdate::DATE AS date,
  coalesce(sum(l_quantity) FILTER (l_returnflag = 'R'), 0) AS inst, coalesce(sum(l_quantity) FILTER (l_returnflag = 'N'), 0) AS corp, coalesce(sum(l_quantity) FILTER (l_returnflag = 'A'), 0) AS "foreign" FROM lineitem GROUP BY ALL))"""
RAW_FLOWS = FLOWS + """, raw_flows AS (SELECT symbol, date, CASE WHEN k % 7 <> 0 THEN inst END AS inst, CASE WHEN k % 49 <> 0 THEN corp END AS corp, CASE WHEN k % 49 <> 0 THEN indiv END AS indiv,
  CASE WHEN k % 49 <> 0 THEN "foreign" END AS "foreign", CASE WHEN k % 49 <> 0 THEN total END AS total, (date - DATE '1990-01-01') * 2 + again AS row_no
  FROM (SELECT *, unnest(CASE WHEN k % 10 = 0 THEN [0, 1] ELSE [0] END) AS again FROM (SELECT *, symbol * 11 + dayofyear(date) AS k FROM flows)))"""
FILINGS = """filings AS (SELECT o_orderkey AS row_no, CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey::VARCHAR ELSE '' END AS corp_code, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority ELSE ' nan ' END AS report_nm,
  CASE WHEN o_orderkey % 17 <> 0 THEN (o_orderkey // 2)::VARCHAR END AS rcept_no, CASE WHEN o_orderkey % 19 <> 0 THEN strftime(o_orderdate, '%Y%m%d') ELSE '2024-13-45' END AS rcept_dt,
  CASE WHEN o_orderkey % 22 <> 0 THEN o_custkey::VARCHAR END AS stock_code FROM orders)"""
UNIVERSE = """universe AS (SELECT s_suppkey::VARCHAR AS code, s_name AS name, CASE s_suppkey % 5 WHEN 0 THEN 'KONEX' WHEN 1 THEN 'KOSDAQ GLOBAL' WHEN 2 THEN 'KOSDAQ' WHEN 3 THEN 'KOSPI' END AS market,
  CASE WHEN s_suppkey % 2 = 0 THEN 'STK' ELSE 'KNX' END AS market_id, format('{:,.2f}', s_acctbal) AS close, format('{:,}', s_suppkey * 1000) AS volume FROM supplier)"""
HOLDINGS = """h_sums AS (SELECT o_custkey % 10 AS track, date_trunc('month', o_orderdate)::DATE AS date, floor(o_custkey / 10 % 12)::BIGINT AS code, sum(o_totalprice::DECIMAL(18, 2)) AS v FROM orders GROUP BY ALL),
  live AS (SELECT track, date, code, round(v::DOUBLE / (sum(v) OVER (PARTITION BY track, date))::DOUBLE * 100, 1) AS weight_pct FROM (SELECT * FROM h_sums QUALIFY row_number() OVER (PARTITION BY track, date ORDER BY v DESC, code) <= 6)),
  h_days AS (SELECT *, lead(date) OVER o AS next, lag(date) OVER o AS before FROM (SELECT DISTINCT track, date FROM live) WINDOW o AS (PARTITION BY track ORDER BY date)),
  moved AS (SELECT track, next AS date, code, weight_pct AS p FROM live JOIN h_days USING (track, date) WHERE next IS NOT NULL)"""
RETURNS = "group_returns AS (SELECT date_trunc('month', o_orderdate)::DATE AS date, floor(o_custkey / 10 % 12)::BIGINT AS code, (avg(o_totalprice) / 150000 - 1) / 100 AS ret FROM orders GROUP BY ALL)"
