"""Queries over rolling and recursive factors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import windows as W
from ..sources import market as M
from .registry import Plans

P = Plans()
OVER = "OVER (PARTITION BY symbol ORDER BY date)"


def back(n: int) -> str:
    return f"OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def roll(f: str, x: str, n: int, least: int) -> str:
    return f"CASE WHEN count({x}) {back(n)} >= {least} THEN {f}({x}) {back(n)} END"


def rounded(df, keys: str, values: str, places: int = 6):
    return df.select(*keys.split(), *[(F.round(v, places) + 0.0).alias(v) for v in values.split()])  # no negative zero


@P.query("w1_momentum", f"WITH {M.BARS} SELECT symbol, date, round(close / nullif(lag(close, 20) {OVER}, 0) - 1, 6) AS mom_20 FROM bars")
def w1(spark, d):
    return rounded(W.momentum(M.bars(spark, d)), "symbol date", "mom_20")


@P.query(
    "w9_moving_averages",
    f"""WITH {M.BARS}, r AS (SELECT *, close / nullif(lag(close) {OVER}, 0) - 1 AS ret, {roll("avg", "close", 20, 20)} AS ma20, {roll("avg", "close", 60, 60)} AS ma60 FROM bars)
  SELECT symbol, date, round(ma20, 6) AS ma20, round(ma60, 6) AS ma60, round(close / ma20 * 100, 6) AS disparity_20, round(ret, 6) AS ret, round({roll("stddev_samp", "ret", 20, 20)}, 6) AS volat_20 FROM r""",
)
def w9(spark, d):
    return rounded(W.moving_averages(M.bars(spark, d)), "symbol date", "ma20 ma60 disparity_20 ret volat_20")


@P.query(
    "w10_flow_sums",
    f"""WITH {M.BARS}, {M.RAW_FLOWS.replace("bars AS", "_b AS")}, f AS (SELECT symbol, date, inst, "foreign" FROM raw_flows QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY row_no DESC) = 1),
  j AS (SELECT b.symbol, b.date, coalesce(inst, 0) AS i, coalesce("foreign", 0) AS f FROM bars b LEFT JOIN f USING (symbol, date))
  SELECT symbol, date, round({roll("sum", "f", 20, 20)}, 6) AS net_foreign_20, round({roll("sum", "i", 20, 20)}, 6) AS net_inst_20 FROM j""",
)
def w10(spark, d):
    return rounded(W.flow_sums(M.bars(spark, d), M.raw_flows(spark, d)), "symbol date", "net_foreign_20 net_inst_20")


def ewm_sql(source: str, x: str, span: int, into: str) -> str:
    """source with an exponential mean in closed form, for series whose only gaps lead."""
    a = 2 / (span + 1)
    return f"""(SELECT * EXCLUDE (_k), CASE WHEN {x} IS NOT NULL THEN power({1 - a}, _k) * sum({x} * (CASE WHEN _k = 0 THEN 1 ELSE {a} END) * power({1 - a}, -_k)) {OVER} END AS {into} FROM (SELECT *, count({x}) {OVER} - 1 AS _k FROM {source}))"""


def plain_zero(x: str, digits: int) -> str:
    """Rounded, and no negative zero."""
    return f"CASE WHEN round({x}, {digits}) = 0 THEN 0 ELSE round({x}, {digits}) END"


RET = f"r AS (SELECT *, close / nullif(lag(close) {OVER}, 0) - 1 AS ret, lag(close) {OVER} AS prev FROM bars)"
FLOW = f"m AS (SELECT *, {roll('median', 'ret', 5, 3)} AS med FROM r)"


@P.query("w4_flow_proxy", f"WITH {M.BARS}, {RET}, {FLOW} SELECT symbol, date, round(med, 6) AS med, round(val_flow_10, 6) AS val_flow_10 FROM {ewm_sql('m', 'med', 10, 'val_flow_10')}")
def w4(spark, d):
    b = M.bars(spark, d).withColumn("ret", W.change("close")).withColumn("med", W.rolling("median", "ret", 5, 3))
    return rounded(W.ewm(b, "med", 10, "val_flow_10"), "symbol date", "med val_flow_10")


@P.query("w5_turnover_winsorised", f"WITH {M.BARS}, t AS (SELECT *, close * volume AS t FROM bars), q AS (SELECT symbol, quantile_cont(t, 0.025) AS lo, quantile_cont(t, 0.975) AS hi FROM t GROUP BY symbol) SELECT symbol, date, round(greatest(least(t, hi), lo), 6) AS val_liq_win FROM t JOIN q USING (symbol)")
def w5(spark, d):
    b = M.bars(spark, d).withColumn("t", F.col("close") * F.col("volume"))
    return rounded(W.winsorised(b, "t", 0.025, 0.975, "val_liq_win"), "symbol date", "val_liq_win", 6)


ATR = f"""a AS (SELECT *, {roll("avg", "tr", 20, 10)} AS atr FROM (SELECT *, greatest(high - low, abs(high - prev), abs(low - prev)) AS tr FROM r)),
  q AS (SELECT symbol, quantile_cont(atr, 0.01) AS lo, quantile_cont(atr, 0.99) AS hi FROM a GROUP BY symbol), w AS (SELECT a.*, CASE WHEN atr IS NOT NULL THEN greatest(least(atr, hi), lo) END AS atr_w FROM a JOIN q USING (symbol))"""


@P.query("w6_atr_risk", f"WITH {M.BARS}, {RET}, {ATR} SELECT symbol, date, round(atr, 6) AS atr, round(val_risk_10, 6) AS val_risk_10 FROM {ewm_sql('w', 'atr_w', 10, 'val_risk_10')}")
def w6(spark, d):
    b = W.true_range(M.bars(spark, d)).withColumn("atr", W.rolling("avg", "tr", 20, 10))
    return rounded(W.ewm(W.winsorised(b, "atr", 0.01, 0.99, "w"), "w", 10, "val_risk_10"), "symbol date", "atr val_risk_10")


@P.query("w7_rolling_z", f"WITH {M.BARS} SELECT symbol, date, round((close - {roll('avg', 'close', 120, 20)}) / nullif({roll('stddev_samp', 'close', 120, 20)}, 0), 6) AS z FROM bars")
def w7(spark, d):
    return rounded(M.bars(spark, d).withColumn("z", W.rolling_z("close")), "symbol date", "z")


@P.query(
    "w3_volatility_baseline",
    f"WITH {M.BARS}, {RET}, v AS (SELECT *, {roll('avg', 'abs(ret)', 20, 5)} AS vol FROM r) SELECT symbol, date, round(vol, 6) AS vol, round({roll('avg', 'vol', 120, 20)}, 6) AS baseline FROM v",
)
def w3(spark, d):
    b = M.bars(spark, d).withColumn("vol", W.rolling("avg", F.abs(W.change("close")), 20, 5))
    return rounded(b.withColumn("baseline", W.rolling("avg", "vol", 120, 20)), "symbol date", "vol baseline")


@P.query(
    "w2_adaptive_ema",
    f"""WITH {M.BARS}, {RET}, v AS (SELECT *, {roll("avg", "abs(ret)", 20, 5)} AS vol FROM r), u AS (SELECT *, coalesce(vol / nullif({roll("avg", "vol", 120, 20)}, 0), 1) AS ratio FROM v),
  s AS (SELECT symbol, date, close, 2.0 / (CASE WHEN ratio > 1.5 THEN 12.0 WHEN ratio < 0.7 THEN 32.0 ELSE 20.0 END + 1) AS a, row_number() {OVER} AS k FROM u),
  l AS (SELECT *, sum(CASE WHEN k > 1 THEN ln(1 - a) ELSE 0 END) {OVER} AS p FROM s)
  SELECT symbol, date, round(exp(p) * sum(close * (CASE WHEN k = 1 THEN 1 ELSE a END) * exp(-p)) {OVER}, 4) AS ema FROM l""",
)
def w2(spark, d):
    return rounded(W.adaptive_ema(M.bars(spark, d), "close", 20, "ema"), "symbol date", "ema", 4)


def adaptive_sql(source: str, x: str, base: int, into: str) -> str:
    """source with the adaptive mean in closed form, for series whose only gaps lead."""
    fast, slow = max(8, int(base * 0.6)), min(40, int(base * 1.6))
    steps = f"(SELECT *, {x} / nullif(lag({x}) {OVER}, 0) - 1 AS chg FROM {source})"
    steps = f"(SELECT *, {roll('avg', 'abs(chg)', 20, 5)} AS vol FROM {steps})"
    steps = f"(SELECT *, coalesce(vol / nullif({roll('avg', 'vol', 120, 20)}, 0), 1) AS ratio, count({x}) {OVER} AS _k FROM {steps})"
    steps = f"(SELECT * EXCLUDE (ratio), 2.0 / (CASE WHEN ratio > 1.5 THEN {fast}.0 WHEN ratio < 0.7 THEN {slow}.0 ELSE {base}.0 END + 1) AS _a FROM {steps})"
    steps = f"(SELECT *, sum(CASE WHEN _k > 1 THEN ln(1 - _a) ELSE 0 END) {OVER} AS _p FROM {steps})"
    return f"(SELECT * EXCLUDE (chg, vol, _a, _k, _p), CASE WHEN {x} IS NOT NULL THEN exp(_p) * sum({x} * (CASE WHEN _k = 1 THEN 1 ELSE _a END) * exp(-_p)) {OVER} END AS {into} FROM {steps})"


def z_sql(x: str) -> str:
    return f"({x} - {roll('avg', x, 120, 20)}) / nullif({roll('stddev_samp', x, 120, 20)}, 0)"


@P.query(
    "w8_value_score",
    f"""WITH {M.BARS}, {RET}, {FLOW}, {ATR.replace("FROM r)", "FROM m)")}, tq AS (SELECT symbol, quantile_cont(close * volume, 0.025) AS lo, quantile_cont(close * volume, 0.975) AS hi FROM bars GROUP BY symbol),
  t AS (SELECT w.*, greatest(least(close * volume, hi), lo) AS val_liq_win, close / nullif(lag(close, 20) {OVER}, 0) - 1 AS mom_20 FROM w JOIN tq USING (symbol)),
  f AS (SELECT * FROM {adaptive_sql(ewm_sql(ewm_sql("t", "med", 10, "val_flow_10"), "atr_w", 10, "val_risk_10"), "mom_20", 20, "val_mom_20")}),
  s AS (SELECT *, 0.35 * {z_sql("val_mom_20")} + 0.25 * {z_sql("val_flow_10")} + 0.20 * {z_sql("val_liq_win")} - 0.20 * {z_sql("val_risk_10")} AS value_score_raw FROM f)
  SELECT symbol, date, round(val_liq_win, 6) AS val_liq_win, {", ".join(f"{plain_zero(c, 4)} AS {c}" for c in ("val_mom_20", "val_flow_10", "val_risk_10", "value_score_raw", "value_score"))} FROM {adaptive_sql("s", "value_score_raw", 10, "value_score")}""",
)
def w8(spark, d):
    rows = W.value_factors(M.bars(spark, d)).withColumn("val_liq_win", F.round("val_liq_win", 6))
    return rounded(rows, "symbol date val_liq_win", "val_mom_20 val_flow_10 val_risk_10 value_score_raw value_score", 4)


#: Returns tamed to a hundredth of themselves, so that compound growth stays finite over invented prices.
CURVE = f"{RET}, c AS (SELECT symbol, date, ret / 100 AS ret, exp(sum(ln(1 + coalesce(ret / 100, 0))) {OVER}) AS equity FROM r)"


def curve(spark, d):
    b = M.bars(spark, d).withColumn("ret", W.change("close") / 100)
    return W.equity(b.select("symbol", "date", "ret"))


@P.query("w12_w13_equity_drawdown", f"WITH {M.BARS}, {CURVE} SELECT symbol, date, round(equity, 6) AS equity, round((equity - max(equity) {OVER}) / max(equity) {OVER}, 6) AS drawdown FROM c")
def w12(spark, d):
    return rounded(curve(spark, d), "symbol date", "equity drawdown")


PERIODS = {"all": ("1990-01-01", "2100-01-01"), "early": ("1992-01-01", "1994-12-31"), "late": ("1997-01-01", "1998-12-31")}


@P.query(
    "w14_period_metrics",
    f"""WITH {M.BARS}, {CURVE}, p(period, a, b) AS (VALUES {", ".join(f"('{n}', DATE '{a}', DATE '{b}')" for n, (a, b) in PERIODS.items())}),
  x AS (SELECT *, (equity - max(equity) OVER o) / max(equity) OVER o AS dd FROM c JOIN p ON date BETWEEN a AND b WINDOW o AS (PARTITION BY symbol, period ORDER BY date)),
  g AS (SELECT symbol, period, arg_max(equity, date) / arg_min(equity, date) AS growth, greatest((max(date) - min(date)) / 365.0, 0.5) AS years, min(dd) AS mdd, count(*) AS rows, sum(abs(coalesce(ret, 0))) AS moved FROM x GROUP BY ALL)
  SELECT symbol, period, round(growth - 1, 6) AS total_return, round(power(growth, 1 / years) - 1, 6) AS cagr, round(mdd, 6) AS mdd, rows, round(moved / years, 6) AS turnover FROM g""",
)
def w14(spark, d):
    return rounded(W.period_metrics(curve(spark, d), PERIODS), "symbol period rows", "total_return cagr mdd turnover")


@P.query("w15_yearly_reset", f"WITH {M.BARS}, {CURVE} SELECT symbol, date, round(equity / first_value(equity) OVER (PARTITION BY symbol, year(date) ORDER BY date), 6) AS equity_year FROM c")
def w15(spark, d):
    return rounded(W.yearly(curve(spark, d)), "symbol date", "equity_year")


@P.query("w16_year_end_returns", f"WITH {M.BARS}, {CURVE}, y AS (SELECT symbol, year(date)::INTEGER AS year, arg_max(equity, date) AS equity FROM c GROUP BY ALL) SELECT symbol, year, round(equity, 6) AS equity, round(equity / coalesce(lag(equity) OVER (PARTITION BY symbol ORDER BY year), 1) - 1, 6) AS ret FROM y")
def w16(spark, d):
    return rounded(W.year_ends(curve(spark, d)), "symbol year", "equity ret")


@P.query("w17_daily_rank", f"WITH {M.BARS}, m AS (SELECT symbol, date, round(close / nullif(lag(close, 20) {OVER}, 0) - 1, 6) AS mom_20 FROM bars) SELECT symbol, date, row_number() OVER (PARTITION BY date ORDER BY mom_20 DESC, symbol)::INTEGER AS rank FROM m WHERE mom_20 IS NOT NULL")
def w17(spark, d):
    return W.daily_rank(rounded(W.momentum(M.bars(spark, d)), "symbol date", "mom_20"), "mom_20").select("symbol", "date", "rank")


@P.query("w18_latest", f"WITH {M.BARS}, r AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS k FROM bars) SELECT symbol, round(max(close) FILTER (k = 1), 6) AS last, round(max(close) FILTER (k = 1) - max(close) FILTER (k = 2), 6) AS change_1, round(max(close) FILTER (k = 1) - max(close) FILTER (k = 5), 6) AS change_5 FROM r GROUP BY symbol")
def w18(spark, d):
    return rounded(W.latest(M.bars(spark, d)), "symbol", "last change_1 change_5")


@P.query("w19_row_spikes", f"WITH {M.BARS}, {RET} SELECT symbol, date, round(ret, 6) AS ret FROM r WHERE abs(ret) > 0.8")
def w19(spark, d):
    return rounded(M.bars(spark, d).withColumn("ret", W.change("close")).where("abs(ret) > 0.8"), "symbol date", "ret")


@P.query("w11_presence_mean", f"WITH {M.BARS} SELECT symbol, date, round(avg(volume) {back(20)}, 6) AS volume_20 FROM bars")
def w11(spark, d):
    return rounded(W.presence(M.bars(spark, d), "volume"), "symbol date", "volume_20")


QUERIES, ORACLES = P.queries, P.oracles
