"""Rolling and recursive factors of price series: windows count rows, not days, within a symbol in order of date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def by_date() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy("date")


def rows_back(n: int):
    return by_date().rowsBetween(-(n - 1), 0)


def rolling(kind: str, x: Column | str, n: int, least: int | None = None) -> Column:
    """avg, sum, stddev_samp or median over the last n rows; null with fewer than ``least`` (n) values among them."""
    x = F.col(x) if isinstance(x, str) else x
    frame = rows_back(n)
    value = F.percentile(x, 0.5) if kind == "median" else getattr(F, kind)(x)
    return F.when(F.count(x).over(frame) >= (n if least is None else least), value.over(frame))


def change(x: Column | str, n: int = 1) -> Column:
    """x / (x n rows before) - 1; null where that is zero."""
    x = F.col(x) if isinstance(x, str) else x
    return x / F.nullif(F.lag(x, n).over(by_date()), F.lit(0.0)) - 1


def momentum(bars: DataFrame, n: int = 20) -> DataFrame:
    return bars.withColumn(f"mom_{n}", change("close", n))


def moving_averages(bars: DataFrame) -> DataFrame:
    """ma20, ma60, disparity_20, ret, volat_20."""
    b = bars.withColumns({"ma20": rolling("avg", "close", 20), "ma60": rolling("avg", "close", 60), "ret": change("close")})
    return b.withColumns({"disparity_20": F.col("close") / F.col("ma20") * 100, "volat_20": rolling("stddev_samp", "ret", 20)})


def flow_sums(bars: DataFrame, flows: DataFrame) -> DataFrame:
    """bars with their flows (0 where there are none; of a repeated day the last row) and their sums over 20 rows."""
    last = Window.partitionBy("symbol", "date").orderBy(F.desc("row_no"))
    own = (flows.withColumn("rn", F.row_number().over(last)).where("rn = 1") if "row_no" in flows.columns else flows).select("symbol", "date", "inst", "foreign")
    b = bars.join(own, ["symbol", "date"], "left").fillna(0.0, ["inst", "foreign"])
    return b.withColumns({"net_foreign_20": rolling("sum", "foreign", 20), "net_inst_20": rolling("sum", "inst", 20)})


def winsorised(df: DataFrame, column: str, low: float, high: float, into: str) -> DataFrame:
    """Clipped to a symbol's exact quantiles over its whole series (linear between values); rows without symbol are left out."""
    bounds = F.percentile(column, F.array(F.lit(low), F.lit(high))).over(Window.partitionBy("symbol"))
    x = F.col(column)
    return df.where("symbol is not null").withColumn("_q", bounds).withColumn(into, F.when(x.isNotNull(), F.greatest(F.least(x, F.col("_q")[1]), F.col("_q")[0]))).drop("_q")


#: Rows of a unit: products of so many decays stay far from zero.
UNIT = 128


def _recurrent(df: DataFrame, x: str, alpha: Column, into: str, fading: bool) -> DataFrame:
    """df with the values of y = alpha * x + (1 - alpha) * y along each symbol's rows in order of date, as an associative scan.

    The first value of a symbol is itself and a missing x repeats y. With ``fading``, y's share also falls by 1 - alpha for each row that x was missing, and the two
    shares are divided by their sum. Each row is an affine map of y. Within a unit, UNIT rows of a symbol, maps are composed by running products and sums; the whole
    units before, one map each, are folded to the value that a unit starts from. All of it is windows within a symbol: rows that lie by symbol stay where
    they are, nothing is joined or stored, and nothing runs row by row.
    """
    rows = df.withColumns({"_a": alpha, "_n": F.row_number().over(by_date()), "_k": F.count(x).over(by_date().rowsBetween(Window.unboundedPreceding, 0))})
    has = F.col(x).isNotNull()
    last = F.max(F.when(has, F.col("_n"))).over(by_date().rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumns({"_u": F.floor((F.col("_n") - 1) / UNIT).cast("int"), "_gap": F.col("_n") - last})
    gap = F.pow(1 - F.col("_a"), F.col("_gap"))
    a = F.col("_a") / (gap + F.col("_a")) if fading else F.col("_a")
    later = F.col("_k") > 1
    d = F.when(has, F.when(later, gap / (gap + F.col("_a")) if fading else 1 - F.col("_a")).otherwise(0.0)).otherwise(1.0)
    c = F.when(has, F.when(later, a * F.col(x)).otherwise(F.col(x))).otherwise(0.0)
    # where nothing of the value before is left, the composition begins anew
    so_far = Window.partitionBy("symbol", "_u").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"_d": d, "_c": c}).withColumn("_z", F.sum((F.col("_d") == 0).cast("int")).over(so_far))
    anew = Window.partitionBy("symbol", "_u", "_z").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_p", F.product(F.when(F.col("_d") == 0, 1.0).otherwise(F.col("_d"))).over(anew)).withColumn("_q", F.col("_p") * F.sum(F.col("_c") / F.col("_p")).over(anew))
    rows = rows.withColumn("_p", F.when(F.col("_z") > 0, 0.0).otherwise(F.col("_p")))
    # every unit but a symbol's last is whole, so its map is that of its row UNIT
    before = Window.partitionBy("symbol").orderBy("_u").rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_maps", F.collect_list(F.when(F.col("_n") % UNIT == 0, F.struct("_p", "_q"))).over(before))
    start = F.aggregate("_maps", F.lit(0.0), lambda y, m: m["_p"] * y + m["_q"])
    return rows.withColumn(into, F.when(F.col("_k") > 0, F.col("_p") * start + F.col("_q"))).select(*df.columns, into)


def ewm(df: DataFrame, column: str, span: int, into: str) -> DataFrame:
    """Exponential mean without adjustment. A gap repeats the last value and lets its weight decay."""
    return _recurrent(df, column, F.lit(2.0 / (span + 1)), into, fading=True)


def adaptive_ema(df: DataFrame, column: str, base: int, into: str) -> DataFrame:
    """An exponential mean whose span shrinks to 0.6 (at least 8) in wild and grows to 1.6 (at most 40) of itself in calm stretches.

    Wild and calm: the mean absolute change over 20 rows against its mean over 120, beyond 1.5 and below 0.7. A gap repeats the last value.
    """
    d = df.withColumn("_vol", rolling("avg", F.abs(change(column)), 20, 5))
    d = d.withColumn("_base", rolling("avg", "_vol", 120, 20))
    ratio = F.coalesce(F.col("_vol") / F.nullif(F.col("_base"), F.lit(0.0)), F.lit(1.0))
    span = F.when(ratio > 1.5, float(max(8, int(base * 0.6)))).when(ratio < 0.7, float(min(40, int(base * 1.6)))).otherwise(float(base))
    return _recurrent(d, column, 2.0 / (span + 1.0), into, fading=False).drop("_vol", "_base")


def true_range(bars: DataFrame, into: str = "tr") -> DataFrame:
    """The greatest of high - low and the distances of high and low to the close before; missing ones are left out."""
    before = F.lag("close").over(by_date())
    return bars.withColumn(into, F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before)))


def rolling_z(x: str, n: int = 120, least: int = 20) -> Column:
    return (F.col(x) - rolling("avg", x, n, least)) / F.nullif(rolling("stddev_samp", x, n, least), F.lit(0.0))


def value_factors(bars: DataFrame) -> DataFrame:
    """val_mom_20, val_flow_10, val_liq_win, val_risk_10, value_score_raw and value_score. Bars that lie by symbol stay where they are."""
    b = bars.where("date is not null and close is not null")
    b = adaptive_ema(momentum(b), "mom_20", 20, "val_mom_20")
    b = b.withColumn("_ret", change("close")).withColumn("_med", rolling("median", "_ret", 5, 3))
    b = ewm(b, "_med", 10, "val_flow_10").withColumn("val_turnover", F.col("close") * F.coalesce("volume", F.lit(0.0)))
    b = winsorised(b, "val_turnover", 0.025, 0.975, "val_liq_win")
    b = true_range(b, "_tr").withColumn("_atr", rolling("avg", "_tr", 20, 10))
    b = ewm(winsorised(b, "_atr", 0.01, 0.99, "_atr_w"), "_atr_w", 10, "val_risk_10")
    raw = 0.35 * rolling_z("val_mom_20") + 0.25 * rolling_z("val_flow_10") + 0.20 * rolling_z("val_liq_win") - 0.20 * rolling_z("val_risk_10")
    return adaptive_ema(b.withColumn("value_score_raw", raw), "value_score_raw", 10, "value_score").drop("_ret", "_med", "_tr", "_atr", "_atr_w")


def equity(returns: DataFrame, ret: str = "ret") -> DataFrame:
    """Compound growth of 1 along a symbol's returns (missing ones count as 0), its drawdown from the peak so far."""
    grown = F.exp(F.sum(F.log1p(F.coalesce(F.col(ret), F.lit(0.0)))).over(by_date().rowsBetween(Window.unboundedPreceding, 0)))
    out = returns.withColumn("equity", grown)
    peak = F.max("equity").over(by_date().rowsBetween(Window.unboundedPreceding, 0))
    return out.withColumn("drawdown", (F.col("equity") - peak) / peak)


def yearly(curve: DataFrame) -> DataFrame:
    """equity over the first of its year, as equity_year."""
    first = F.first("equity").over(Window.partitionBy("symbol", F.year("date")).orderBy("date"))
    return curve.withColumn("equity_year", F.col("equity") / first)


def year_ends(curve: DataFrame) -> DataFrame:
    """symbol, year, last equity of the year and the return against the year before (the start for the first)."""
    last = curve.groupBy("symbol", F.year("date").alias("year")).agg(F.max_by("equity", "date").alias("equity"))
    before = F.lag("equity").over(Window.partitionBy("symbol").orderBy("year"))
    return last.withColumn("ret", F.col("equity") / F.coalesce(before, F.lit(1.0)) - 1)


def period_metrics(curve: DataFrame, periods: dict[str, tuple[str, str]]) -> DataFrame:
    """For each symbol and period: return, CAGR over at least half a year, greatest drawdown, rows and turnover."""
    # one pass over the curve: a row goes to each period that has its day
    within = [F.when(F.col("date").between(F.lit(a).cast("date"), F.lit(b).cast("date")), F.lit(n)) for n, (a, b) in periods.items()]
    rows = curve.withColumn("period", F.explode(F.array_compact(F.array(*within))))
    own = Window.partitionBy("symbol", "period").orderBy("date")
    peak = F.max("equity").over(own.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("dd", (F.col("equity") - peak) / peak)
    days = F.datediff(F.max("date"), F.min("date"))
    growth = F.max_by("equity", "date") / F.min_by("equity", "date")
    years = F.greatest(days / 365.0, F.lit(0.5))
    return rows.groupBy("symbol", "period").agg((growth - 1).alias("total_return"), (F.pow(growth, 1.0 / years) - 1).alias("cagr"), F.min("dd").alias("mdd"), F.count("*").alias("rows"), (F.sum(F.abs(F.coalesce("ret", F.lit(0.0)))) / years).alias("turnover"))


def daily_rank(scores: DataFrame, score: str) -> DataFrame:
    """Rank within a day, best first, ties to the smaller symbol; days without score rank nothing."""
    day = Window.partitionBy("date").orderBy(F.desc(score), "symbol")
    return scores.where(F.col(score).isNotNull()).withColumn("rank", F.row_number().over(day))


def latest(series: DataFrame) -> DataFrame:
    """Per symbol: last value, change against the row before and against the fifth last row (four before the last)."""
    back = Window.partitionBy("symbol").orderBy(F.desc("date"))
    rows = series.withColumn("r", F.row_number().over(back)).where("r <= 5")

    def at(r: int) -> Column:
        return F.max(F.when(F.col("r") == r, F.col("close")))

    return rows.groupBy("symbol").agg(at(1).alias("last"), (at(1) - at(2)).alias("change_1"), (at(1) - at(5)).alias("change_5"))


def presence(days: DataFrame, column: str, n: int = 20) -> DataFrame:
    """Mean over the last n days on which the symbol appears, from the first day on."""
    return days.withColumn(f"{column}_{n}", rolling("avg", column, n, 1))
