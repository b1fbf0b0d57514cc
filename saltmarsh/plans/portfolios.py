"""Queries of the greedy de-duplication, the portfolios from day to day, and the batches for a scorer."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import batching, constraints, dedup, portfolio
from ..shared import stored
from ..sources import market as M
from .factors import ORACLES as ORACLES_OF_FACTORS
from .factors import w14
from .registry import Plans, table

P = Plans()
QUERIES, ORACLES = P.queries, P.oracles


def keyed(docs):
    """Each document's keys: its words, its normal form as a record in its language, and the fingerprints of its whole and its paragraphs."""
    text = F.trim(F.lower(F.coalesce("text", F.lit(""))))
    return docs.select(
        F.col("doc_id").alias("id"),
        F.array(F.md5(text)).alias("url"),
        F.array(F.concat_ws("|", X.record_fingerprint("text"), F.coalesce("lang", F.lit("")))).alias("title_date"),
        X.content_fingerprints("text").alias("content"),
    )


@P.query("d1_greedy_dedup")
def d1(spark, d):
    return dedup.greedy(keyed(table(spark, d, "documents")))


@P.query(
    "d4_first_records",
    "WITH a AS (SELECT *, row_number() OVER (PARTITION BY md5(lower(text)) ORDER BY doc_id) AS r FROM documents), b AS (SELECT *, row_number() OVER (PARTITION BY source, lang, n_chars ORDER BY doc_id) AS q FROM a WHERE r = 1) SELECT doc_id FROM b WHERE q = 1",
)
def d4(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.md5(F.lower("text")).alias("record_id"), F.concat_ws("|", "source", "lang", "n_chars").alias("fingerprint"))
    return dedup.first_records(docs, ["doc_id"]).select("doc_id")


def model_stats(spark, d):
    """Symbols as models: what their curves did over three periods."""
    m = w14(spark, d)
    of = {"total_return": ("all", "total_return"), "return_2021_plus": ("late", "total_return"), "return_2023_2025": ("early", "total_return"), "return_2025_plus": ("late", "cagr"), "mdd_full": ("all", "mdd"), "mdd_2021_plus": ("late", "mdd"), "mdd_2023_2025": ("early", "mdd"), "turnover": ("all", "turnover")}
    return m.groupBy(F.col("symbol").alias("model_id")).agg(*[F.coalesce(F.max(F.when(F.col("period") == p, F.col(c))), F.lit(0.0)).alias(n) for n, (p, c) in of.items()])


WEIGHTS = {"value": 0.5, "momentum": 0.3, "risk": 0.2}
STATS = f"""m AS ({ORACLES_OF_FACTORS["w14_period_metrics"]}), st AS (SELECT symbol AS model_id, coalesce(max(total_return) FILTER (period = 'all'), 0) AS tr, coalesce(max(total_return) FILTER (period = 'late'), 0) AS late, coalesce(max(total_return) FILTER (period = 'early'), 0) AS early, coalesce(max(cagr) FILTER (period = 'late'), 0) AS cagr,
    coalesce(max(mdd) FILTER (period = 'all'), 0) AS m0, coalesce(max(mdd) FILTER (period = 'late'), 0) AS m1, coalesce(max(mdd) FILTER (period = 'early'), 0) AS m2, coalesce(max(turnover) FILTER (period = 'all'), 0) AS turn FROM m GROUP BY symbol),
  ax AS (SELECT *, 0.8 * late + 0.2 * tr AS v, 0.7 * early + 0.3 * cagr AS o, -(0.5 * abs(m1) + 0.3 * abs(m2) + 0.2 * abs(m0) + 0.1 * greatest(0, turn - 1.8)) AS r FROM st),
  z AS (SELECT ax.*, {", ".join(f"greatest(least(({x} - avg({x}) OVER ()) / CASE WHEN stddev_pop({x}) OVER () <= 1e-12 THEN 1 ELSE stddev_pop({x}) OVER () END, 3), -3) AS z_{x}" for x in "vor")} FROM ax),
  sc AS (SELECT *, 0.5 * z_v + 0.3 * z_o + 0.2 * z_r AS score FROM z)"""


def scored_models(spark, d):
    return portfolio.winner_score(portfolio.axis_scores(model_stats(spark, d)), WEIGHTS)


@P.query("d14_winner_scores", f"WITH {STATS} SELECT model_id, round(z_v, 6) AS z_value, round(z_o, 6) AS z_momentum, round(z_r, 6) AS z_risk, round(score, 6) AS score FROM sc")
def d14(spark, d):
    return scored_models(spark, d).select("model_id", *[F.round(c, 6).alias(c) for c in ("z_value", "z_momentum", "z_risk", "score")])


@P.query("d15_winner_policy", f"WITH {STATS}, b AS (SELECT *, row_number() OVER (ORDER BY score DESC, model_id) AS k FROM sc) SELECT model_id, round(score, 6) AS score, round(score - (SELECT score FROM b WHERE k = 2), 6) AS edge, score - (SELECT score FROM b WHERE k = 2) >= 0.05 AS enough, m1 > -0.85 AND m0 > -0.92 AND m2 > -0.80 AS safe FROM b WHERE k = 1")
def d15(spark, d):
    return portfolio.winner_policy(scored_models(spark, d)).withColumns({"score": F.round("score", 6), "edge": F.round("edge", 6)})


def steps_sql(x: str, name: str, rest: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} >= {bound} THEN {points}" for bound, points in portfolio.STEPS[name]) + f" {rest} END"


SOFT = f"""{steps_sql("late", "return_2021_plus", "ELSE greatest(0, late * 20)")} + {steps_sql("early", "return_2023_2025", "WHEN early > 0 THEN 4 ELSE 0")} + {steps_sql("cagr", "return_2025_plus", "WHEN cagr > 0 THEN 3 ELSE 0")} + {steps_sql("m1", "mdd_2021_plus", "ELSE -8")}
  + CASE WHEN m0 < -0.9 THEN -6 ELSE 0 END + CASE WHEN turn > 3.5 THEN -4 WHEN turn > 3 THEN -2 ELSE 0 END"""


@P.query(
    "d21_soft_scores",
    f"""WITH {STATS}, s AS (SELECT *, {SOFT} AS soft FROM st) SELECT model_id, round(soft, 6) AS soft, CASE WHEN soft >= 60 THEN 'ADOPT_FULL' WHEN soft >= 45 THEN 'ADOPT_WITH_CAUTION' ELSE 'HOLD' END AS label,
  CASE WHEN m1 >= -0.85 AND m0 >= -0.92 AND m2 >= -0.8 THEN 'PASS' ELSE 'FAIL' END AS extreme_risk, CASE WHEN tr > 0 THEN 'PASS' ELSE 'FAIL' END AS gain FROM s""",
)
def d21_soft(spark, d):
    cuts = F.lit(True)
    for c, cut in portfolio.DRAWDOWNS.items():
        cuts = cuts & (F.col(c) >= cut)
    rows = model_stats(spark, d).withColumns({"soft": portfolio.soft_score(), "g": portfolio.gates({"extreme_risk": cuts, "gain": F.col("total_return") > 0})})
    return rows.select("model_id", F.round("soft", 6).alias("soft"), portfolio.soft_label(F.col("soft")).alias("label"), *[F.get("g", F.lit(i))["verdict"].alias(n) for i, n in enumerate(("extreme_risk", "gain"))])


@P.query(
    "d15_winner_measures",
    f"""WITH {STATS}, k AS (SELECT *, row_number() OVER (ORDER BY score DESC, model_id) AS k FROM sc), b AS (SELECT a.*, s.late AS l2, s.early AS e2, s.tr AS t2, s.cagr AS c2 FROM k a JOIN k s ON a.k = 1 AND s.k = 2),
  r AS (SELECT *, CASE WHEN abs(l2) > 1e-12 THEN (late - l2) / abs(l2) ELSE 1 END AS edge, ((early > e2)::INTEGER + (late > l2)::INTEGER + (tr > t2)::INTEGER) / 3.0 AS sure, (early - e2 >= abs(e2) * 0.05)::INTEGER + (late - l2 >= abs(l2) * 0.05)::INTEGER + (cagr - c2 >= abs(c2) * 0.05)::INTEGER AS hits FROM b)
  SELECT model_id, round(edge, 6) AS return_edge, round(sure, 6) AS confidence, hits AS persistence_hits, m1 >= -0.85 AND m0 >= -0.92 AND m2 >= -0.8 AS extreme_risk_pass, edge >= 0.05 AS edge_pass, hits >= 1 AS persistence_pass, sure >= 0.34 AS confidence_pass FROM r""",
)
def d15_measures(spark, d):
    rows = portfolio.winner_measures(scored_models(spark, d), ("return_2023_2025", "return_2021_plus", "return_2025_plus"))
    return rows.withColumns({c: F.round(c, 6) for c in ("return_edge", "confidence")})


TRADES = f"""{M.HOLDINGS}, tr AS (SELECT * FROM (SELECT *, CASE WHEN p = 0 AND w > 0 THEN 'new' WHEN w = 0 AND p > 0 THEN 'sold' WHEN delta >= 0.05 THEN 'more' WHEN delta <= -0.05 THEN 'less' END AS kind
    FROM (SELECT *, round(w - p, 2) AS delta FROM (SELECT coalesce(l.track, b.track) AS track, coalesce(l.date, b.date) AS date, coalesce(l.code, b.code) AS code, coalesce(l.weight_pct, 0) AS w, coalesce(b.p, 0) AS p FROM live l FULL JOIN moved b ON l.track = b.track AND l.date = b.date AND l.code = b.code))) WHERE kind IS NOT NULL)"""


@P.query("d17_trades", f"WITH {TRADES} SELECT track, date, code, kind, delta FROM tr")
def d17(spark, d):
    return portfolio.trades(M.holdings(spark, d))


@P.query("d18_replay", f"WITH {M.HOLDINGS}, {M.RETURNS}, r AS (SELECT track, date, sum(weight_pct / 100 * coalesce(ret, 0)) AS ret FROM live JOIN group_returns USING (date, code) GROUP BY ALL) SELECT track, date, round(exp(sum(ln(1 + ret)) OVER (PARTITION BY track ORDER BY date)), 6) AS equity FROM r")
def d18(spark, d):
    return portfolio.replay(M.holdings(spark, d), M.group_returns(spark, d)).select("track", "date", F.round("equity", 6).alias("equity"))


@P.query("d21_adoption", "SELECT s_suppkey, CASE WHEN NOT (s_acctbal > 0 AND s_nationkey <> 3) THEN 'HOLD' WHEN s_acctbal / 100 >= 60 THEN 'ADOPT_FULL' WHEN s_acctbal / 100 >= 45 THEN 'CAUTION' ELSE 'HOLD' END AS verdict FROM supplier")
def d21(spark, d):
    gates = [F.col("s_acctbal") > 0, F.col("s_nationkey") != 3]
    return table(spark, d, "supplier").select("s_suppkey", portfolio.adoption(F.col("s_acctbal") / 100, gates).alias("verdict"))


@P.query(
    "d22_consistency",
    f"""WITH {M.HOLDINGS}, g AS (SELECT track, date, sum(weight_pct) AS w, count(*) AS n FROM live GROUP BY ALL) SELECT 'weights_sum_to_100' AS "check", count(*) FILTER (abs(w - 100) > 0.2) = 0 AS ok, count(*) FILTER (abs(w - 100) > 0.2) AS failures FROM g
  UNION ALL SELECT 'slots_not_exceeded', count(*) FILTER (n > 5) = 0, count(*) FILTER (n > 5) FROM g UNION ALL SELECT unnest(['no_negative_weight', 'one_row_a_code', 'curve_days_held', 'added_are_new_trades', 'removed_are_sold']), true, 0""",
)
def d22(spark, d):
    held = M.holdings(spark, d)
    curve = portfolio.replay(held.where("weight_pct > 0"), M.group_returns(spark, d))
    return portfolio.consistency(held, portfolio.trades(held), curve, slots=5)


#: What fails here: days whose rounded weights miss 100, the first days' purchases, which are no changes, a summary that counts a trade too many, large weights.
FAILING = {
    "weights_daily_sum_approx_100": "SELECT count(*) FROM (SELECT sum(weight_pct) AS w FROM live GROUP BY track, date) WHERE abs(w - 100) > 0.2",
    "bought_are_in_timeline": "SELECT count(*) FROM tr WHERE kind = 'new' AND date = (SELECT min(date) FROM live l WHERE l.track = tr.track)",
    "summary_counts_trades": "SELECT 1",
    "weights_no_code_in_excess": "SELECT count(*) FROM (SELECT max(weight_pct) AS m FROM live GROUP BY track, date) WHERE m > 60",
}


@P.query("d22_all_checks", f"WITH {TRADES}, f AS (" + " UNION ALL ".join(f"SELECT '{c.name}' AS \"check\", ({FAILING.get(c.name, 'SELECT 0')})::BIGINT AS failures" for c in portfolio.CHECKS) + ') SELECT "check", failures = 0 AS ok, failures FROM f')
def d22_all(spark, d):
    held = stored(M.holdings(spark, d), "holdings")
    traded, curve = stored(portfolio.trades(held), "trades"), stored(portfolio.replay(held.where("weight_pct > 0"), M.group_returns(spark, d)), "curve")
    # a row a model; stored, as several checks read it and it takes all bars
    models = stored(scored_models(spark, d).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "model_id"))), "models")
    one = curve.agg(F.max("equity").alias("best_equity"), F.max("date").alias("last_day")).crossJoin(held.agg(F.count_if(F.col("weight_pct") > 0).alias("weights"))).crossJoin(traded.agg((F.count("*") + 1).alias("trades")))
    summary = one.crossJoin(models.where("rank = 1").select("model_id")).withColumns({"mode": F.lit("SIMULATED"), "real_ledger": F.lit(False), "axis_cap": F.lit(0.25), "corr_threshold": F.lit(0.7)})
    timeline = held.where("change is not null").select("track", "date", "code", "change")
    tables = {"weights": held, "trades": traded, "timeline": timeline, "deltas": portfolio.weight_deltas(held), "curve": curve, "models": models, "summary": summary}
    return constraints.evaluate(tables, portfolio.CHECKS)


@P.query(
    "d23_batches",
    """WITH RECURSIVE i AS (SELECT doc_id // 500 AS package, doc_id AS item_id, ceil(length(coalesce(text, '')) / 4)::BIGINT AS t, strlen(coalesce(text, '')) AS b, contains(lower(coalesce(text, '')), 'http')::INTEGER AS c, row_number() OVER (PARTITION BY doc_id // 500 ORDER BY doc_id) AS pos, count(*) OVER (PARTITION BY doc_id // 500) AS size FROM documents),
  g AS (SELECT package, item_id, pos, size, 0 AS batch, 1 AS n, t AS st, b AS sb, (t >= 320)::INTEGER AS sl, c AS sc FROM i WHERE pos = 1
    UNION ALL SELECT package, item_id, pos, size, CASE WHEN cut THEN batch + 1 ELSE batch END, CASE WHEN cut THEN 1 ELSE n + 1 END, CASE WHEN cut THEN t ELSE st + t END, CASE WHEN cut THEN b ELSE sb + b END, CASE WHEN cut THEN l ELSE sl + l END, CASE WHEN cut THEN c ELSE sc + c END
    FROM (SELECT i.package, i.item_id, i.pos, i.size, i.t, i.b, i.c, (i.t >= 320)::INTEGER AS l, g.batch, g.n, g.st, g.sb, g.sl, g.sc,
      g.n + 1 > 40 OR g.st + i.t > 16000 OR g.sb + i.b > 90000 OR (g.n + 1 > 30 AND (g.st + i.t >= 12000 OR g.sb + i.b >= 65000 OR (g.sl + (i.t >= 320)::INTEGER) / (g.n + 1) > 0.35 OR (g.sc + i.c) / (g.n + 1) > 0.35)) AS cut FROM g JOIN i ON i.package = g.package AND i.pos = g.pos + 1)),
  k AS (SELECT package, batch, count(*) AS m, max(batch) OVER (PARTITION BY package) AS top FROM g GROUP BY package, batch), e AS (SELECT package, max(m) FILTER (batch = top) AS last, max(m) FILTER (batch = top - 1) AS before, max(top) AS top FROM k GROUP BY package)
  SELECT package, item_id, CASE WHEN size <= 40 THEN 0 WHEN top > 0 AND pos > size - last - greatest(0, least(20 - last, before - 20)) THEN top ELSE batch END::BIGINT AS batch FROM g JOIN e USING (package)""",
)
def d23(spark, d):
    """Packages of 500 consecutive identifiers, so each is a bounded group."""
    text = F.coalesce("text", F.lit(""))
    items = table(spark, d, "documents").select(F.floor(F.col("doc_id") / 500).alias("package"), F.col("doc_id").alias("item_id"), F.ceil(F.length(text) / 4).alias("tokens"), F.octet_length(text).cast("long").alias("bytes"), F.contains(F.lower(text), F.lit("http")).alias("chatter"))
    return batching.batches(items)
