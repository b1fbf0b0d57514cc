"""Model scores and what follows from a portfolio's holdings: trades, replayed returns, adoption, consistency.

Everything is joins, windows and aggregations over all days at once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import constraints


def axis_scores(stats: DataFrame, turnover_start: float = 1.8) -> DataFrame:
    """stats with value, momentum and risk composites and their z-scores over all models (spread over n; 1 if there is none), within +-3."""
    excess = F.greatest(F.lit(0.0), F.coalesce("turnover", F.lit(0.0)) - turnover_start)
    s = stats.withColumns(
        {
            "value": 0.80 * F.col("return_2021_plus") + 0.20 * F.col("total_return"),
            "momentum": 0.70 * F.col("return_2023_2025") + 0.30 * F.col("return_2025_plus"),
            "risk": -(0.50 * F.abs("mdd_2021_plus") + 0.30 * F.abs("mdd_2023_2025") + 0.20 * F.abs("mdd_full") + 0.10 * excess),
        }
    )
    axes = ("value", "momentum", "risk")
    one = F.broadcast(s.agg(*[F.avg(a).alias(f"m_{a}") for a in axes], *[F.stddev_pop(a).alias(f"s_{a}") for a in axes]))
    joined = s.crossJoin(one)
    for a in axes:
        spread = F.when(F.col(f"s_{a}") <= 1e-12, 1.0).otherwise(F.col(f"s_{a}"))
        joined = joined.withColumn(f"z_{a}", F.greatest(F.least((F.col(a) - F.col(f"m_{a}")) / spread, F.lit(3.0)), F.lit(-3.0)))
    return joined.drop(*[f"{p}_{a}" for a in axes for p in ("m", "s")])


def winner_score(scored: DataFrame, weights: dict[str, float]) -> DataFrame:
    """scored with score: the weighted mean of the axes' z-scores."""
    total = sum(weights.values())
    out = F.lit(0.0)
    for axis, w in weights.items():
        out = out + F.col(f"z_{axis}") * w
    return scored.withColumn("score", out / total)


def winner_policy(scored: DataFrame, edge: float = 0.05, cuts: dict[str, float] | None = None) -> DataFrame:
    """The best model (ties: by name) with its edge over the second; whether it is enough and no drawdown beyond its hard cut."""
    cuts = cuts or {"mdd_2021_plus": -0.85, "mdd_full": -0.92, "mdd_2023_2025": -0.80}
    safe = F.lit(True)
    for c, cut in cuts.items():
        safe = safe & (F.col(c) > cut)
    two = scored.select("model_id", "score", safe.alias("safe")).orderBy(F.desc("score"), "model_id").limit(2)
    order = Window.orderBy(F.desc("score"), "model_id")  # over two rows
    ranked = two.withColumns({"edge": F.col("score") - F.lead("score").over(order), "rank": F.row_number().over(order)})
    return ranked.where("rank = 1").select("model_id", "score", "edge", (F.col("edge") >= edge).alias("enough"), "safe")


# Points by the first bound that a figure reaches, from above; what is left of the first figure counts twenty points a unit; penalties.
STEPS = {
    "return_2021_plus": ((10.0, 60), (7.0, 54), (5.0, 48), (3.0, 40), (2.0, 32), (1.0, 24)),
    "return_2023_2025": ((3.0, 20), (2.0, 16), (1.0, 12), (0.5, 8)),
    "return_2025_plus": ((1.5, 10), (1.0, 8), (0.5, 6)),
    "mdd_2021_plus": ((-0.35, 6), (-0.50, 4), (-0.65, 2), (-0.80, 0)),
}
#: Points where no bound is reached: a gain at least, or any figure.
GAINS, ELSE = {"return_2023_2025": 4, "return_2025_plus": 3}, {"mdd_2021_plus": -8}
POINTS_A_UNIT, DEEP, DEEP_PENALTY, TURNOVER = 20, -0.90, -6, ((3.5, -4), (3.0, -2))
#: What a challenger must gain on the second, how many of the windows it must win, and how sure it must be.
EDGE, HITS, SURE, DRAWDOWNS = 0.05, 1, 0.34, {"mdd_2021_plus": -0.85, "mdd_full": -0.92, "mdd_2023_2025": -0.80}


def soft_score(of: Callable[[str], Column] = F.col) -> Column:
    """Points of a model's returns, drawdowns and turnover."""

    def stepped(name: str) -> Column:
        x, (first, *rest) = of(name), STEPS[name]
        out = F.when(x >= first[0], first[1])
        for bound, points in rest:
            out = out.when(x >= bound, points)
        if name in GAINS:
            out = out.when(x > 0, GAINS[name])
        return out.otherwise(ELSE.get(name, F.greatest(F.lit(0.0), x * POINTS_A_UNIT) if name == "return_2021_plus" else 0)).cast("double")

    high, less = TURNOVER
    turnover = F.when(of("turnover") > high[0], high[1]).when(of("turnover") > less[0], less[1]).otherwise(0)
    return sum((stepped(n) for n in STEPS), F.lit(0.0)) + F.when(of("mdd_full") < DEEP, DEEP_PENALTY).otherwise(0) + turnover


def soft_label(score: Column) -> Column:
    return F.when(score >= 60, "ADOPT_FULL").when(score >= 45, "ADOPT_WITH_CAUTION").otherwise("HOLD")


def gates(values: dict[str, Column]) -> Column:
    """name and PASS or FAIL, as an array of structs, in order; null counts as FAIL."""
    return F.array(*[F.struct(F.lit(n).alias("gate"), F.when(F.coalesce(c, F.lit(False)), "PASS").otherwise("FAIL").alias("verdict")) for n, c in values.items()])


def winner_measures(scored: DataFrame, windows: Sequence[str], better: Sequence[str] = ("return_2023_2025", "return_2021_plus", "total_return"), gain: str = "return_2021_plus") -> DataFrame:
    """The best model against the second (itself, if it is alone): return_edge, confidence, persistence_hits, their gates and the drawdowns'.

    ``confidence`` is the share of the figures ``better`` in which it is ahead; a window counts as a hit where it is ahead by EDGE of the second's figure, which is there for
    reporting and doesn't decide who is the best.
    """
    two = scored.orderBy(F.desc("score"), "model_id").limit(2)
    order = Window.orderBy(F.desc("score"), "model_id")  # over two rows
    columns = sorted({*windows, *better, gain})
    rows = two.withColumns({"rank": F.row_number().over(order), **{f"_{c}": F.lead(c).over(order) for c in columns}}).where("rank = 1")

    def second(c: str) -> Column:
        return F.coalesce(F.col(f"_{c}"), F.col(c))

    edge = F.when(F.abs(second(gain)) > 1e-12, (F.col(gain) - second(gain)) / F.abs(second(gain))).otherwise(1.0)
    sure = sum(((F.col(c) > second(c)).cast("int") for c in better), F.lit(0)) / len(better)
    hits = sum(((F.col(c) - second(c) >= F.abs(second(c)) * EDGE).cast("int") for c in windows), F.lit(0))
    safe = F.lit(True)
    for c, cut in DRAWDOWNS.items():
        safe = safe & (F.col(c) >= cut)
    rows = rows.select("model_id", edge.alias("return_edge"), sure.alias("confidence"), hits.alias("persistence_hits"), safe.alias("extreme_risk_pass"))
    return rows.withColumns({"edge_pass": F.col("return_edge") >= EDGE, "persistence_pass": F.col("persistence_hits") >= HITS, "confidence_pass": F.col("confidence") >= SURE})


def trades(holdings: DataFrame, least: float = 0.05) -> DataFrame:
    """track, date, code, kind (new, sold, more, less), delta: weights against the portfolio's day before."""
    days = holdings.select("track", "date").distinct()
    order = Window.partitionBy("track").orderBy("date")
    days = days.withColumn("next", F.lead("date").over(order))
    now = holdings.where("weight_pct > 0").select("track", "date", "code", F.col("weight_pct").alias("w"))
    before = now.join(days.where("next is not null"), ["track", "date"]).select("track", F.col("next").alias("date"), "code", F.col("w").alias("p"))
    both = now.join(before, ["track", "date", "code"], "full").fillna(0.0, ["w", "p"]).withColumn("delta", F.round(F.col("w") - F.col("p"), 2))
    kind = F.when((F.col("p") == 0) & (F.col("w") > 0), "new").when((F.col("w") == 0) & (F.col("p") > 0), "sold").when(F.col("delta") >= least, "more").when(F.col("delta") <= -least, "less")
    return both.withColumn("kind", kind).where("kind is not null").select("track", "date", "code", "kind", "delta")


def replay(holdings: DataFrame, returns: DataFrame) -> DataFrame:
    """track, date, ret, equity: weights times returns by day, compounded."""
    daily = holdings.join(returns, ["date", "code"]).groupBy("track", "date").agg(F.sum(F.col("weight_pct") / 100 * F.coalesce("ret", F.lit(0.0))).alias("ret"))
    grown = F.exp(F.sum(F.log1p("ret")).over(Window.partitionBy("track").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)))
    return daily.withColumn("equity", grown)


def adoption(score: Column, gates: Sequence[Column]) -> Column:
    """ADOPT_FULL from 60, CAUTION from 45, else HOLD; HOLD unless all gates pass."""
    ok = F.lit(True)
    for g in gates:
        ok = ok & g
    return F.when(~ok, "HOLD").when(score >= 60, "ADOPT_FULL").when(score >= 45, "CAUTION").otherwise("HOLD")


DAY, CODE = ("track", "date"), ("track", "date", "code")
#: A group's weights added from the greatest down: in doubles, whether a sum just meets a tolerance depends on the order, and rows have none.
WEIGHTS = "aggregate(sort_array(collect_list(weight_pct), false), 0D, (s, w) -> s + w)"
#: What holds among a portfolio's weights, trades, timeline, curve, models and summary. Tolerances, caps, modes.
CHECKS: tuple[constraints.Check, ...] = (
    constraints.Groups("weights_daily_sum_approx_100", "weights", DAY, f"abs({WEIGHTS} - 100) <= 0.2"),
    constraints.Rows("weights_non_negative", "weights", "weight_pct >= -1e-9"),
    constraints.Rows("weights_have_codes", "weights", "code is not null and date is not null"),
    constraints.Groups("weights_one_row_a_code", "weights", CODE, "count_if(weight_pct > 0) <= 1"),
    constraints.Groups("weights_slots_not_exceeded", "weights", DAY, "count_if(weight_pct > 0) <= 6"),
    constraints.Groups("weights_no_code_in_excess", "weights", DAY, "max(weight_pct) <= 60"),
    constraints.Subset("timeline_dates_exist_in_weights", "timeline", "weights", DAY),
    constraints.Subset("trade_event_dates_exist_in_weights", "trades", "weights", DAY),
    constraints.Subset("timeline_added_are_bought", "timeline", "trades", CODE, "change = 'added'", "kind = 'new'"),
    constraints.Subset("timeline_removed_are_sold", "timeline", "trades", CODE, "change = 'removed'", "kind = 'sold'"),
    constraints.Subset("bought_are_in_timeline", "trades", "timeline", CODE, "kind = 'new'", "change = 'added'"),
    constraints.Subset("sold_are_in_timeline", "trades", "timeline", CODE, "kind = 'sold'", "change = 'removed'"),
    constraints.Subset("timeline_added_have_weight", "timeline", "weights", CODE, "change = 'added'", "weight_pct > 0"),
    constraints.Subset("raised_weights_rose", "trades", "deltas", CODE, "kind = 'more'", "delta >= 0.05 - 1e-9"),
    constraints.Subset("cut_weights_fell", "trades", "deltas", CODE, "kind = 'less'", "delta <= -0.05 + 1e-9"),
    constraints.Rows("trade_kinds_known", "trades", "kind in ('new', 'sold', 'more', 'less')"),
    constraints.Rows("trade_deltas_have_their_sign", "trades", "sign(delta) = if(kind in ('new', 'more'), 1, -1)"),
    constraints.Groups("trades_one_row_a_code", "trades", CODE, "count(*) = 1"),
    constraints.Subset("curve_days_held", "curve", "weights", DAY),
    constraints.Subset("held_days_in_curve", "weights", "curve", DAY, "weight_pct > 0"),
    constraints.Rows("curve_stays_positive", "curve", "equity > 0 and not isnan(equity)"),
    constraints.Groups("curve_one_row_a_day", "curve", DAY, "count(*) = 1"),
    constraints.Rows("summary_mode_known", "summary", "mode in ('SIMULATED', 'LIVE')"),
    constraints.Rows("summary_live_has_a_ledger", "summary", "not (mode = 'LIVE' and not real_ledger)"),
    constraints.Rows("summary_axis_cap_le_0_25", "summary", "axis_cap <= 0.25 + 1e-12"),
    constraints.Rows("summary_corr_threshold_eq_0_7", "summary", "abs(corr_threshold - 0.7) <= 1e-12"),
    constraints.Totals("summary_counts_weights", "summary", "max(weights)", "weights", "count_if(weight_pct > 0)"),
    constraints.Totals("summary_counts_trades", "summary", "max(trades)", "trades", "count(*)"),
    constraints.Totals("summary_states_best_equity", "summary", "max(best_equity)", "curve", "max(equity)", 1e-6),
    constraints.Totals("summary_states_last_day", "summary", "max(unix_date(last_day))", "curve", "max(unix_date(date))"),
    constraints.Subset("winner_is_the_first_model", "summary", "models", ("model_id",), "true", "rank = 1"),
    constraints.Groups("models_are_distinct", "models", ("model_id",), "count(*) = 1"),
    constraints.Rows("model_scores_are_numbers", "models", "score is not null and not isnan(score)"),
)


def weight_deltas(holdings: DataFrame) -> DataFrame:
    """track, date, code, delta of the codes that are held on a portfolio's day and on the one before."""
    days = holdings.select("track", "date").distinct().withColumn("next", F.lead("date").over(Window.partitionBy("track").orderBy("date")))
    now = holdings.where("weight_pct > 0").select("track", "date", "code", F.col("weight_pct").alias("w"))
    before = now.join(days.where("next is not null"), ["track", "date"]).select("track", F.col("next").alias("date"), "code", F.col("w").alias("p"))
    return now.join(before, ["track", "date", "code"]).select("track", "date", "code", (F.col("w") - F.col("p")).alias("delta"))


def consistency(holdings: DataFrame, traded: DataFrame, curve: DataFrame, slots: int = 6) -> DataFrame:
    """check, ok, failures: named assertions across holdings, trades and the replayed curve."""
    tables = {"weights": holdings, "live": holdings.where("weight_pct > 0"), "trades": traded, "curve": curve}
    return constraints.evaluate(
        tables,
        (
            constraints.Groups("weights_sum_to_100", "live", DAY, f"abs({WEIGHTS} - 100) <= 0.2"),
            constraints.Groups("slots_not_exceeded", "live", DAY, f"count(*) <= {slots}"),
            constraints.Rows("no_negative_weight", "weights", "coalesce(weight_pct, 0) >= 0"),
            constraints.Groups("one_row_a_code", "live", CODE, "count(*) = 1"),
            constraints.Subset("curve_days_held", "curve", "live", DAY),
            constraints.Subset("added_are_new_trades", "weights", "trades", CODE, "change = 'added' and weight_pct > 0", "kind = 'new'"),
            constraints.Subset("removed_are_sold", "weights", "trades", CODE, "change = 'removed'", "kind = 'sold'"),
        ),
    )
