"""Queries over joins, pairings and the ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import ledger as L
from ..operators import mentions
from ..sources import market as M
from .registry import Plans, table

P = Plans()


def features(spark, d):
    o = table(spark, d, "orders")
    return o.select((F.col("o_custkey") % 100 + 1).alias("symbol"), F.to_date("o_orderdate").alias("date"), F.col("o_orderkey").alias("row_no"), ((F.col("o_orderkey") % 400 - 200) / 100).alias("qualitative_signal"))


FEATURES = "features AS (SELECT o_custkey % 100 + 1 AS symbol, o_orderdate::DATE AS date, o_orderkey AS row_no, greatest(least((o_orderkey % 400 - 200) / 100, 1), -1) AS s FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey % 100 + 1, o_orderdate::DATE ORDER BY o_orderkey DESC) = 1)"


@P.query("j1_signal_with_default", f"WITH {M.BARS}, {FEATURES} SELECT b.symbol, b.date, round(coalesce(s, 0), 6) AS qualitative_signal, (s IS NULL)::INTEGER AS missing FROM bars b LEFT JOIN features USING (symbol, date)")
def j1(spark, d):
    return J.with_signal(M.bars(spark, d), features(spark, d)).select("symbol", "date", F.round("qualitative_signal", 6).alias("qualitative_signal"), "missing")


@P.query("j2_flows_left", f'WITH {M.BARS}, {M.FLOWS} SELECT b.symbol, b.date, coalesce(inst, 0) AS inst, coalesce("foreign", 0) AS "foreign" FROM bars b LEFT JOIN flows USING (symbol, date)')
def j2(spark, d):
    return M.bars(spark, d).join(M.flows(spark, d).select("symbol", "date", "inst", "foreign"), ["symbol", "date"], "left").fillna(0.0, ["inst", "foreign"]).select("symbol", "date", "inst", "foreign")


MACRO = "macro AS (SELECT event_type AS series, ts::DATE AS date, avg(value) AS value FROM events GROUP BY ALL)"


def macro(spark, d):
    return table(spark, d, "events").groupBy(F.col("event_type").alias("series"), F.to_date("ts").alias("date")).agg(F.avg("value").alias("value"))


@P.query("j4_macro_by_day", f"WITH {M.BARS}, {MACRO}, m AS (SELECT date + INTERVAL (-9500) DAY AS date, value FROM macro WHERE series = (SELECT min(series) FROM macro)) SELECT b.symbol, b.date, round(coalesce(value, 0), 6) AS macro FROM bars b LEFT JOIN m USING (date)")
def j4(spark, d):
    rows = macro(spark, d)
    first = rows.agg(F.min("series").alias("series"))
    own = rows.join(F.broadcast(first), "series").select(F.date_add("date", -9500).alias("date"), "value")
    return M.bars(spark, d).join(own, "date", "left").select("symbol", "date", F.round(F.coalesce("value", F.lit(0.0)), 6).alias("macro"))


@P.query("j5_j6_spread", f"WITH {MACRO}, n AS (SELECT DISTINCT series, dense_rank() OVER (ORDER BY series) AS k FROM macro) SELECT a.date, round(a.value - b.value, 6) AS spread FROM macro a JOIN macro b USING (date) WHERE a.series = (SELECT series FROM n WHERE k = 1) AND b.series = (SELECT series FROM n WHERE k = 2)")
def j5(spark, d):
    rows = macro(spark, d)
    a, b = (r["series"] for r in rows.select("series").distinct().orderBy("series").limit(2).collect())
    return J.spread(rows, a, b).select("date", F.round("spread", 6).alias("spread"))


@P.query("j7_j8_sectors", "SELECT s_suppkey AS symbol, r_name AS sector FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)")
def j7(spark, d):
    sectors = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("sector"))
    listed = table(spark, d, "supplier").join(table(spark, d, "lineitem"), F.col("s_suppkey") == F.col("l_suppkey"), "left_semi")
    return listed.join(sectors, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("symbol"), "sector")


@P.query("j9_anti", "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def j9(spark, d):
    return table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels"), "doc_id", "left_anti")


def ledgers(spark, d):
    k = F.col("o_orderkey")
    e = table(spark, d, "orders").select(
        k.alias("row_no"),
        F.when(k % 7 != 0, k.cast("string")).alias("execution_id"),
        F.when(k % 35 != 0, F.floor(k / 3).cast("string")).alias("order_id"),
        F.col("o_orderdate").alias("ts"),
        (F.col("o_custkey") % 100 + 1).alias("symbol"),
        F.when(k % 2 == 0, "BUY").otherwise("SELL").alias("side"),
        (k % 50 + 1).cast("double").alias("qty"),
        (F.col("o_totalprice") / 1000).alias("price"),
        ((k % 10) / 100).alias("fee"),
        ((k % 4) / 100).alias("tax"),
    )
    a = e.where("row_no % 29 <> 0").withColumns({"qty": F.when(F.col("row_no") % 31 == 0, F.col("qty") + 1).otherwise(F.col("qty")), "side": F.when(F.col("row_no") % 37 == 0, "SELL").otherwise(F.col("side")), "execution_id": F.when(F.col("row_no") % 11 != 0, F.col("execution_id"))})
    return e, a


LEDGERS = """e AS (SELECT o_orderkey AS row_no, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey::VARCHAR END AS execution_id, CASE WHEN o_orderkey % 35 <> 0 THEN (o_orderkey // 3)::VARCHAR END AS order_id, o_orderdate AS ts, o_custkey % 100 + 1 AS symbol,
  CASE WHEN o_orderkey % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS side, (o_orderkey % 50 + 1)::DOUBLE AS qty, o_totalprice / 1000 AS price, (o_orderkey % 10) / 100 AS fee, (o_orderkey % 4) / 100 AS tax FROM orders),
  a AS (SELECT row_no, CASE WHEN row_no % 11 <> 0 THEN execution_id END AS execution_id, order_id, ts, symbol, CASE WHEN row_no % 37 = 0 THEN 'SELL' ELSE side END AS side, qty + (row_no % 31 = 0)::INTEGER AS qty, price, fee, tax FROM e WHERE row_no % 29 <> 0)"""


def phase_sql(i: int, keys: str, e: str, a: str) -> str:
    n = f"row_number() OVER (PARTITION BY {keys} ORDER BY ts, row_no) AS n"
    given = " AND ".join(f"{k} IS NOT NULL" for k in keys.split(", "))
    return f"p{i} AS (SELECT {i} AS phase, x.row_no AS e_row, y.row_no AS a_row FROM (SELECT *, {n} FROM {e} WHERE {given}) x JOIN (SELECT *, {n} FROM {a} WHERE {given}) y USING ({keys}, n))"


PAIRS = f"""{LEDGERS}, {phase_sql(1, "execution_id", "e", "a")}, e2 AS (SELECT * FROM e WHERE row_no NOT IN (SELECT e_row FROM p1)), a2 AS (SELECT * FROM a WHERE row_no NOT IN (SELECT a_row FROM p1)), {phase_sql(2, "order_id", "e2", "a2")},
  e3 AS (SELECT *, ts::DATE AS day FROM e2 WHERE row_no NOT IN (SELECT e_row FROM p2)), a3 AS (SELECT *, ts::DATE AS day FROM a2 WHERE row_no NOT IN (SELECT a_row FROM p2)), {phase_sql(3, "day, symbol, side", "e3", "a3")},
  pairs AS (SELECT * FROM p1 UNION ALL SELECT * FROM p2 UNION ALL SELECT * FROM p3)"""


@P.query("j10_phased_pairs", f"WITH {PAIRS} SELECT phase::INTEGER AS phase, e_row, a_row FROM pairs")
def j10(spark, d):
    e, a = ledgers(spark, d)
    return J.paired(e, a, [["execution_id"], ["order_id"], [F.to_date("ts"), "symbol", "side"]])


MISMATCHES = f"""WITH {PAIRS}, j AS (SELECT e_row AS row, e.qty AS q1, a.qty AS q2, e.side AS s1, a.side AS s2, e.symbol AS y1, a.symbol AS y2, e.price AS m1, a.price AS m2, e.fee AS f1, a.fee AS f2, e.tax AS t1, a.tax AS t2 FROM pairs JOIN e ON e.row_no = e_row JOIN a ON a.row_no = a_row),
  m AS (SELECT row, 'qty_mismatch' AS type FROM j WHERE abs(q1 - q2) > 1e-9 UNION ALL SELECT row, 'price_mismatch' FROM j WHERE abs(m1 - m2) > 1e-6 UNION ALL SELECT row, 'fee_mismatch' FROM j WHERE abs(f1 - f2) > 1e-6 UNION ALL SELECT row, 'tax_mismatch' FROM j WHERE abs(t1 - t2) > 1e-6
  UNION ALL SELECT row, 'side_mismatch' FROM j WHERE s1 <> s2 UNION ALL SELECT row, 'symbol_mismatch' FROM j WHERE y1 <> y2
  UNION ALL SELECT row_no, 'missing_in_ledger' FROM e WHERE row_no NOT IN (SELECT e_row FROM pairs) UNION ALL SELECT row_no, 'unexpected_in_ledger' FROM a WHERE row_no NOT IN (SELECT a_row FROM pairs))"""


@P.query("d20_reconciliation", f"{MISMATCHES} SELECT row, type FROM m")
def d20(spark, d):
    return L.reconcile(*ledgers(spark, d))


@P.query("a30_mismatch_counts", f"{MISMATCHES} SELECT type, count(*) AS n, count(*) <= 100 AS ok FROM m GROUP BY type")
def a30(spark, d):
    return L.mismatch_counts(L.reconcile(*ledgers(spark, d)), 100)


@P.query(
    "d19_fifo",
    f"""WITH {LEDGERS}, c AS (SELECT *, sum(CASE WHEN side = 'BUY' THEN qty ELSE -qty END) OVER o AS net FROM e WINDOW o AS (PARTITION BY symbol ORDER BY ts, row_no)),
  h AS (SELECT *, net - least(0, min(net) OVER (PARTITION BY symbol ORDER BY ts, row_no)) AS held FROM c), f AS (SELECT *, CASE WHEN side = 'BUY' THEN qty ELSE least(qty, coalesce(lag(held) OVER (PARTITION BY symbol ORDER BY ts, row_no), 0)) END AS eff FROM h),
  b AS (SELECT symbol, sum(eff) OVER (PARTITION BY symbol ORDER BY ts, row_no) AS hi, eff, (qty * price + fee + tax) / qty AS cost FROM f WHERE side = 'BUY'), s AS (SELECT symbol, sum(eff) AS sold FROM f WHERE side = 'SELL' GROUP BY symbol),
  k AS (SELECT symbol, sum(greatest(0, least(hi, coalesce(sold, 0)) - (hi - eff)) * cost) AS cost, sum((eff - greatest(0, least(hi, coalesce(sold, 0)) - (hi - eff))) * cost) AS open_cost FROM b LEFT JOIN s USING (symbol) GROUP BY symbol),
  l AS (SELECT symbol, coalesce(sum(qty * price - fee - tax) FILTER (side = 'SELL'), 0) AS proceeds, sum(qty - eff) AS uncovered, arg_max(held, (ts, row_no)) AS open_qty, arg_max(price, (ts, row_no)) AS last_price FROM f GROUP BY symbol)
  SELECT symbol, round(proceeds - cost, 6) AS realised, round(uncovered, 6) AS uncovered, round(open_qty, 6) AS open_qty, round(open_cost, 6) AS open_cost, last_price FROM l JOIN k USING (symbol)""",
)
def d19(spark, d):
    return L.fifo(ledgers(spark, d)[0]).select("symbol", *[F.round(c, 6).alias(c) for c in ("realised", "uncovered", "open_qty", "open_cost")], "last_price")


@P.query("j11_words_known", "WITH n AS (SELECT lower(n_name) AS name, n_nationkey AS entry FROM nation UNION ALL SELECT 'the', 100 UNION ALL SELECT 'the', 99 UNION ALL SELECT 'de', 101), w AS (SELECT DISTINCT doc_id AS id, unnest(regexp_split_to_array(lower(text), '[^0-9A-Za-z_]+')) AS name FROM documents) SELECT id, name, min(entry)::INTEGER AS entry FROM w JOIN n USING (name) GROUP BY ALL")
def j11(spark, d):
    names = table(spark, d, "nation").select(F.lower("n_name").alias("name"), F.col("n_nationkey").alias("entry")).union(spark.createDataFrame([("the", 100), ("the", 99), ("de", 101)], "name string, entry int"))
    return J.words_known(table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.lower("text").alias("text")), names)


@P.query("j12_names_in_text", "SELECT id, name FROM (SELECT doc_id AS id, name, row_number() OVER (PARTITION BY doc_id ORDER BY name) AS r FROM documents JOIN (SELECT unnest(['License', 'idiot', 'Version', 'the the', 'que de', 'and the', 'Released', 'for an', 'der und']) AS name) ON contains(text, name)) WHERE r <= 5")
def j12(spark, d):
    names = spark.createDataFrame([(n,) for n in ("License", "idiot", "Version", "the the", "que de", "and the", "Released", "for an", "der und")], "name string")
    return mentions.names_in(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text"), names)


@P.query("j13_compared_ids", "WITH got AS (SELECT doc_id + CASE WHEN doc_id % 50 = 0 THEN 1 ELSE 0 END AS doc_id FROM labels) SELECT DISTINCT doc_id, 'missing' AS status FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM got) UNION ALL SELECT DISTINCT doc_id, 'unexpected' FROM got WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'duplicate' FROM got GROUP BY doc_id HAVING count(*) > 1")
def j13(spark, d):
    labels = table(spark, d, "labels").select("doc_id")
    return J.compared_ids(labels, labels.select((F.col("doc_id") + F.when(F.col("doc_id") % 50 == 0, 1).otherwise(0)).alias("doc_id")), "doc_id")


@P.query("j14_weight_match", "WITH a AS (SELECT o_orderdate::DATE AS date, o_custkey AS code, sum(o_totalprice) AS w FROM orders GROUP BY ALL), b AS (SELECT date, code, w + CASE WHEN code % 41 = 0 THEN 1 ELSE 0 END AS w FROM a WHERE code % 43 <> 0) SELECT date, code, round(a.w, 4) AS a, round(b.w, 4) AS b FROM a FULL JOIN b USING (date, code) WHERE coalesce(abs(a.w - b.w) > 1e-6, true)")
def j14(spark, d):
    a = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("date"), F.col("o_custkey").alias("code")).agg(F.sum("o_totalprice").alias("weight"))
    b = a.where("code % 43 <> 0").withColumn("weight", F.col("weight") + F.when(F.col("code") % 41 == 0, 1.0).otherwise(0.0))
    return J.unequal_weights(a, b).select("date", "code", F.round("a", 4).alias("a"), F.round("b", 4).alias("b"))


@P.query("j15_page_mismatches", "SELECT o_orderkey AS doc_key, (o_orderkey % 7 + 1)::INTEGER AS stated, coalesce(n, 0) AS found FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE coalesce(n, 0) <> o_orderkey % 7 + 1")
def j15(spark, d):
    documents = table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_key"), (F.col("o_orderkey") % 7 + 1).cast("int").alias("stated"))
    return J.page_mismatches(documents, table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_key")))


@P.query("j16_conflicts", "WITH t AS (SELECT DISTINCT o_orderkey AS id, l_partkey AS r FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'P') SELECT DISTINCT x.id AS a, y.id AS b FROM t x JOIN t y ON x.r = y.r AND x.id < y.id")
def j16(spark, d):
    """Pending orders as active tasks, their parts as resources."""
    parts = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_set("l_partkey").alias("resources"))
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "P").alias("active"))
    return J.conflicts(orders.join(parts, "id"))


@P.query("j17_prerequisites", "WITH t AS (SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 'DONE' ELSE 'TODO' END AS status, CASE WHEN o_orderkey % 3 = 0 THEN [] ELSE [o_orderkey - 1, o_orderkey // 2] END AS refs FROM orders), r AS (SELECT id, unnest(refs) AS ref FROM t), s AS (SELECT r.id, bool_and(coalesce(t.status = 'DONE', false)) AS ready FROM r LEFT JOIN t ON t.id = ref GROUP BY r.id) SELECT id, coalesce(ready, true) AS ready FROM t LEFT JOIN s USING (id)")
def j17(spark, d):
    k = F.col("o_orderkey")
    tasks = table(spark, d, "orders").select(k.alias("id"), F.when(F.col("o_orderstatus") == "F", "DONE").otherwise("TODO").alias("status"), F.when(k % 3 == 0, F.array().cast("array<long>")).otherwise(F.array(k - 1, F.floor(k / 2))).alias("refs"))
    return J.ready(tasks)


@P.query(
    "j18_artifact_resolution",
    """WITH b AS (SELECT doc_id AS block_id, 'm' || doc_id AS marker, 'f' || doc_id AS flat_key, 'l' || doc_id AS legacy_key, doc_id % 10 AS message_id FROM documents),
  s AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'm' WHEN doc_id % 3 = 1 AND doc_id % 2 = 0 THEN 'f' WHEN doc_id % 5 = 0 THEN 'l' END AS way, (doc_id + (doc_id % 7 = 0)::INTEGER) % 10 AS owner FROM documents)
  SELECT block_id, CASE WHEN way IS NOT NULL THEN 'p' || doc_id END AS path, CASE way WHEN 'm' THEN 'strong' WHEN 'f' THEN 'medium' WHEN 'l' THEN 'weak' ELSE 'none' END AS confidence,
  CASE WHEN way IS NULL THEN 'unresolved' WHEN owner <> message_id THEN 'lineage_mismatch' ELSE 'ok' END AS status, coalesce(way IS NOT NULL AND owner <> message_id OR way = 'l', false) AS diagnostics_only FROM b JOIN s ON doc_id = block_id""",
)
def j18(spark, d):
    k = F.col("doc_id")
    docs = table(spark, d, "documents").select("doc_id", k.cast("string").alias("s"))
    blocks = docs.select(k.alias("block_id"), F.concat(F.lit("m"), "s").alias("marker"), F.concat(F.lit("f"), "s").alias("flat_key"), F.concat(F.lit("l"), "s").alias("legacy_key"), (k % 10).alias("message_id"))

    def side(name, rule):
        return docs.where(rule).select(F.concat(F.lit(name), "s").alias("key"), F.concat(F.lit("p"), "s").alias("path"), ((k + (k % 7 == 0).cast("int")) % 10).alias("owner"))

    return J.resolved(blocks, side("m", k % 3 == 0), side("f", (k % 3 == 1) & (k % 2 == 0)), side("l", (k % 5 == 0) & (k % 3 != 0) & ~((k % 3 == 1) & (k % 2 == 0))))


BLOCKS = "string_split(replace(coalesce(text, ''), '. ', '---'), '---')"


@P.query("j19_block_promotion", f"WITH m AS (SELECT doc_id AS id, {BLOCKS} AS bs FROM documents) SELECT id, md5(array_to_string(list_transform(bs, lambda b, i: b || CASE WHEN (id + i - 1) % 3 = 0 THEN '+' || length(b) ELSE '' END), '---')) AS text, len(list_filter(bs, lambda b, i: (id + i - 1) % 3 = 0)) AS promoted FROM m")
def j19(spark, d):
    """Documents' sentences as blocks; for every third one a text is found."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.replace(F.coalesce("text", F.lit("")), F.lit(". "), F.lit("---")).alias("text"))
    blocks = docs.select("id", F.posexplode(F.split("text", "---")).alias("block", "part"))
    found = blocks.where((F.col("id") + F.col("block")) % 3 == 0).select("id", "block", F.concat(F.lit("+"), F.length("part").cast("string")).alias("text"))
    return J.promoted(docs, found).withColumn("text", F.md5("text"))


@P.query("j20_sidecars", "SELECT page_id, CASE WHEN page_id % 3 = 0 AND (page_id % 4 = 0 OR page_id % 2 <> 0) THEN left(sha1(url), 8) END AS sidecar FROM pages")
def j20(spark, d):
    """Pages with the hash of their content (a quarter unknown), and sidecars of a third, of which those of even pages were made for an older content."""
    k, p = F.col("page_id"), table(spark, d, "pages")
    content = F.coalesce("html", F.lit(""))
    path = F.concat_ws("#", "url", k.cast("string"))  # pages are copies of one url, files aren't
    items = p.select("page_id", path.alias("path"), F.when(k % 4 != 0, F.sha1(content)).alias("sha1"))
    side = p.where("page_id % 3 = 0").select(path.alias("path"), F.sha1(F.when(k % 2 == 0, F.concat(content, F.lit("older"))).otherwise(content)).alias("sha1"), F.substring(F.sha1("url"), 1, 8).alias("sidecar"))
    return J.sidecars(items, side).select("page_id", "sidecar")


QUERIES, ORACLES = P.queries, P.oracles
