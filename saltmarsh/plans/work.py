"""Queries over repairs, coverage, work items and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import audits, ops, search
from ..shared import shared_path
from .registry import Plans, table

P = Plans()
NOW = "1999-01-01"


def now():
    return F.lit(NOW).cast("timestamp")


def tasks(spark, d):
    """Orders as work items."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    status = F.when(F.col("o_orderstatus") == "F", "DONE").when(k % 3 == 0, "TODO").when(k % 3 == 1, "IN_PROGRESS").otherwise("BLOCKED")
    return o.select(
        k.alias("id"),
        status.alias("status"),
        F.when(k % 5 == 0, "main").when(k % 5 == 1, "sub-1").when(k % 5 == 2, "").alias("assignee"),
        F.when(k % 4 != 0, F.concat(F.lit("Proof of "), "o_orderpriority")).otherwise("").alias("proof"),
        F.when(k % 6 == 0, "waiting for data").when(k % 6 == 1, "after review").otherwise("").alias("reason"),
        F.when(k % 7 == 0, "phase: two\nassignee: ann").otherwise("").alias("note"),
        F.col("o_orderdate").cast("timestamp").alias("updated"),
        (F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 30 DAYS")).alias("due"),
        F.when(k % 11 == 0, F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 60 DAYS")).alias("until"),
    )


TASKS = """tasks AS (SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'DONE' WHEN o_orderkey % 3 = 0 THEN 'TODO' WHEN o_orderkey % 3 = 1 THEN 'IN_PROGRESS' ELSE 'BLOCKED' END AS status,
  CASE o_orderkey % 5 WHEN 0 THEN 'main' WHEN 1 THEN 'sub-1' WHEN 2 THEN '' END AS assignee, CASE WHEN o_orderkey % 4 <> 0 THEN 'Proof of ' || o_orderpriority ELSE '' END AS proof,
  CASE o_orderkey % 6 WHEN 0 THEN 'waiting for data' WHEN 1 THEN 'after review' ELSE '' END AS reason, CASE WHEN o_orderkey % 7 = 0 THEN 'ann' ELSE '' END AS noted,
  o_orderdate AS updated, o_orderdate + INTERVAL 30 DAY AS due, CASE WHEN o_orderkey % 11 = 0 THEN o_orderdate + INTERVAL 60 DAY END AS until FROM orders)"""


@P.query("o1_repaired_dates", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN DATE '2025-03-07' WHEN 1 THEN DATE '2024-11-05' ELSE ts::DATE END AS repaired, CASE event_id % 4 WHEN 0 THEN 'published' WHEN 1 THEN 'title_pattern' ELSE 'file_time' END AS date_source, event_id % 4 <> 0 AS changed FROM events")
def o1(spark, d):
    k = F.col("event_id") % 4
    items = table(spark, d, "events").select("event_id", F.when(k == 0, "2025-03-07T10:00:00").when(k == 2, "no date").alias("published"), F.when(k == 1, "of 2024/11/5, a note").otherwise("a note").alias("title"), F.col("ts").cast("timestamp").alias("at"))
    return ops.repaired_dates(items, ["published"], ["title"], "at").select("event_id", "repaired", "date_source", "changed")


@P.query("o2_year_for", "SELECT o_orderkey, make_date((year(stamp) - (month(o_orderdate) > month(stamp) + 1)::INTEGER)::BIGINT, month(o_orderdate), least(day(o_orderdate), 28)) AS day FROM (SELECT *, o_orderdate + INTERVAL 75 DAY AS stamp FROM orders)")
def o2(spark, d):
    day = F.col("o_orderdate").cast("timestamp")
    return table(spark, d, "orders").select("o_orderkey", ops.year_for(F.month(day), F.least(F.dayofmonth(day), F.lit(28)), day + F.expr("INTERVAL 75 DAYS")).alias("day"))


@P.query("o4_to_repair", "SELECT lpad(s_suppkey::VARCHAR, 6, '0') AS code FROM supplier WHERE NOT (s_suppkey % 3 <> 0 AND s_suppkey % 40 >= 20 AND s_suppkey % 5 <> 0)")
def o4(spark, d):
    k = F.col("s_suppkey")
    s = table(spark, d, "supplier").select(k, F.lpad(k.cast("string"), 6, "0").alias("code"))
    return ops.to_repair(s, s.where(k % 3 != 0).select("code", (k % 40).alias("size"), (k % 5 != 0).alias("readable")))


def articles(spark, d):
    return table(spark, d, "pages").select((F.col("page_id") % 10).alias("file"), X.canonical_url("url").alias("url"), F.date_add(F.lit("2025-01-01").cast("date"), (F.col("page_id") % 30).cast("int")).alias("date"), X.host_of("url").alias("host"))


HOST = "regexp_replace(lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)), '^(www|m)\\.', '')"


@P.query("o5_article_summary", f"SELECT page_id % 10 AS file, count(*) AS rows, min(DATE '2025-01-01' + (page_id % 30)::INTEGER) AS first, max(DATE '2025-01-01' + (page_id % 30)::INTEGER) AS last, count(DISTINCT {HOST}) AS hosts FROM pages GROUP BY 1")
def o5(spark, d):
    return ops.article_summary(articles(spark, d)).drop("urls")


@P.query("o5_summary_mismatches", "SELECT DISTINCT page_id % 10 AS file, CASE WHEN page_id % 10 % 3 = 0 AND page_id % 10 % 2 = 0 THEN 'rows,last' WHEN page_id % 10 % 3 = 0 THEN 'rows' ELSE 'last' END AS wrong FROM pages WHERE page_id % 10 % 3 = 0 OR page_id % 10 % 2 = 0")
def o5b(spark, d):
    found = ops.article_summary(articles(spark, d)).select("file", "rows", "first", "last")
    stated = found.select("file", (F.col("rows") + (F.col("file") % 3 == 0).cast("int")).alias("rows"), "first", F.when(F.col("file") % 2 != 0, F.col("last")).alias("last"))
    return ops.summary_mismatches(stated, found, "file")


def live(spark, d):
    """Pages as articles in ten files, and an eleventh without any."""
    k = F.col("page_id")
    name = F.format_string("selected_articles_%02d.jsonl", k % 10)
    rows = table(spark, d, "pages").select(name.alias("file"), F.when(k % 9 == 0, " ").otherwise(F.col("url")).alias("url"), F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("d"), (k % 3).cast("string"))).alias("source_domain"), F.when(k % 2 == 0, "rss").otherwise("sitemap").alias("source_kind"), F.when(k % 5 != 0, F.date_add(F.lit("2025-01-01").cast("date"), (k % 30).cast("int"))).alias("day"))
    files = spark.range(11).select(F.format_string("selected_articles_%02d.jsonl", "id").alias("file"), F.timestamp_seconds(F.col("id") * 1000).alias("modified"))
    return audits.live_summary(rows, files, "news/selected")


LIVE = """a AS (SELECT printf('selected_articles_%02d.jsonl', page_id % 10) AS file, CASE WHEN page_id % 9 = 0 THEN NULL ELSE nullif(trim(url), '') END AS url, CASE WHEN page_id % 4 = 0 THEN NULL ELSE 'd' || page_id % 3 END AS dom, CASE WHEN page_id % 2 = 0 THEN 'rss' ELSE 'sitemap' END AS kind, CASE WHEN page_id % 5 <> 0 THEN DATE '2025-01-01' + (page_id % 30)::INTEGER END AS day FROM pages),
  f AS (SELECT file, count(page_id) AS n FROM (SELECT printf('selected_articles_%02d.jsonl', unnest(range(11))) AS file) LEFT JOIN (SELECT printf('selected_articles_%02d.jsonl', page_id % 10) AS file, page_id FROM pages) USING (file) GROUP BY file)"""


@P.query(
    "o5_live_summary",
    f"""WITH {LIVE} SELECT count(*) AS total_rows, count(DISTINCT url) AS unique_url_count, min(day) AS date_min, max(day) AS date_max, (SELECT string_agg(file || '=' || n, ',' ORDER BY file) FROM f) AS row_counts_by_file, (SELECT max(file) FROM f) AS latest_file, TIMESTAMP '1970-01-01 02:46:40' AS latest_file_mtime_utc,
  (SELECT string_agg(dom || '=' || c, ',' ORDER BY dom) FROM (SELECT dom, count(*) AS c FROM a WHERE dom IS NOT NULL GROUP BY dom)) AS source_domains, (SELECT string_agg(kind || '=' || c, ',' ORDER BY kind) FROM (SELECT kind, count(*) AS c FROM a GROUP BY kind)) AS source_kinds,
  (SELECT sum(n)::BIGINT FROM f WHERE file >= 'selected_articles_09.jsonl') AS recent_backfill_added_rows, 11 AS source_files FROM a""",
)
def o5c(spark, d):
    def flat(c: str) -> F.Column:
        return F.array_join(F.transform(c, lambda x: F.concat(x["name"], F.lit("="), x["n"].cast("string"))), ",").alias(c)

    keys = ("total_rows", "unique_url_count", "date_min", "date_max", "latest_file", "latest_file_mtime_utc", "recent_backfill_added_rows", "source_files")
    return live(spark, d).select(*keys, *map(flat, ("row_counts_by_file", "source_domains", "source_kinds")))


@P.query("o5_live_issues", "SELECT unnest(['summary_mode_mismatch', 'total_rows_mismatch', 'latest_file_mtime_utc_mismatch', 'source_kinds_mismatch']) AS issue, count(*) > 0 AS told FROM pages")
def o5d(spark, d):
    """A stated summary with four wrong keys."""
    found = live(spark, d)
    wrong = {"summary_mode": F.lit("other"), "total_rows": F.col("total_rows") + 1, "latest_file_mtime_utc": F.lit(None).cast("timestamp"), "source_kinds": F.slice("source_kinds", 1, 1)}
    return audits.summary_issues(found.withColumns(wrong), found).withColumn("told", F.lit(True))


@P.query("o6_scopes", "SELECT source, count(*) AS registered, count(*) FILTER (doc_id % 3 = 0) AS missing, count(*) FILTER (doc_id % 3 = 0 AND doc_id % 6 <> 0 AND doc_id % 4 <> 1) AS unresolved, count(*) FILTER (doc_id % 3 = 0 AND doc_id % 6 <> 0 AND doc_id % 4 <> 1) = 0 AS satisfied FROM documents WHERE source IS NOT NULL GROUP BY source")
def o6(spark, d):
    k = F.col("doc_id")
    registry = table(spark, d, "documents").where("source is not null").select("source", k.alias("url"))
    u = F.col("url")
    return ops.scopes(registry, registry.where(u % 3 != 0), registry.where((u % 6 == 0) | (u % 4 == 1)))


@P.query("o7_date_sources", "WITH g AS (SELECT event_type AS source, min(ts::DATE) FILTER (event_type <> 'click') AS first, max(ts::DATE) FILTER (event_type <> 'click') AS last, count(*) FILTER (event_id % 2 = 0 AND event_type <> 'view') AS published FROM events GROUP BY 1) SELECT *, CASE WHEN first IS NULL OR published = 0 THEN 'BLOCKED' WHEN (last - first) / 365.25 >= 0.05 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM g")
def o7(spark, d):
    kind = F.col("event_type")
    rows = table(spark, d, "events").select(kind.alias("source"), F.when(kind != "click", F.to_date("ts")).alias("date"), F.when((F.col("event_id") % 2 == 0) & (kind != "view"), "published").otherwise("file_time").alias("date_source"))
    return ops.date_sources(rows, 0.05)


@P.query("o8_leaves", "SELECT source || '/' || lang AS folder, count(*) AS files, round(epoch(TIMESTAMP '1999-01-01' - max(TIMESTAMP '1998-01-01' + to_minutes(doc_id))) / 3600.0, 6) AS age_hours FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL GROUP BY 1")
def o8(spark, d):
    docs = table(spark, d, "documents").where("source is not null and lang is not null")
    at = F.timestamp_micros(F.unix_micros(F.lit("1998-01-01").cast("timestamp")) + F.col("doc_id") * 60_000_000)
    files = docs.select(F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))).alias("path"), at.alias("ts"))
    return ops.leaves(files, now()).withColumn("age_hours", F.round("age_hours", 6))


@P.query("o9_evidence_search", f"WITH {TASKS} SELECT id FROM tasks WHERE contains(lower(proof || ' ' || reason), 'urgent') AND contains(lower(proof || ' ' || reason), 'review') ORDER BY updated DESC, id LIMIT 20")
def o9(spark, d):
    """By the stored index of what tasks prove, a segment a month."""
    rows, folder = tasks(spark, d).select("id", "updated", F.concat_ws(" ", "proof", "reason").alias("text")), shared_path(spark, "evidence")
    search.build(rows, folder)
    return search.search(rows, folder, ["Urgent", "review"], 20).rows.select("id")


@P.query("o10_lanes", f"WITH {TASKS} SELECT id, CASE WHEN assignee = 'main' THEN 'main' WHEN assignee LIKE 'sub%' THEN 'subagent' ELSE 'remaining' END AS lane FROM tasks WHERE status <> 'DONE'")
def o10(spark, d):
    return ops.lane(tasks(spark, d)).select("id", "lane")


@P.query("o11_blocked_without_reason", f"WITH {TASKS} SELECT id FROM tasks WHERE status = 'BLOCKED' AND proof <> '' AND reason = '' ORDER BY updated DESC, id LIMIT 10")
def o11(spark, d):
    return ops.blocked_without_reason(tasks(spark, d)).select("id")


@P.query("o12_by_assignee", f"WITH {TASKS} SELECT coalesce(nullif(assignee, ''), nullif(noted, ''), 'nobody') AS who, count(*) FILTER (status = 'IN_PROGRESS') AS active, count(*) FILTER (status IN ('TODO', 'BLOCKED')) AS waiting FROM tasks GROUP BY 1")
def o12(spark, d):
    return ops.by_assignee(tasks(spark, d))


@P.query("o13_latest_reports", "WITH r AS (SELECT event_type AS stage, event_id AS path, event_id % 10 AS size, (event_id % 3 = 0)::INTEGER AS errors, (event_id % 2 = 0)::INTEGER AS warnings, ts FROM events), b AS (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY ts DESC, path DESC) AS k FROM r WHERE size > 0) SELECT stage, path, CASE WHEN errors > 0 THEN 'fail' WHEN warnings > 0 THEN 'warn' ELSE 'ok' END AS state FROM b WHERE k = 1")
def o13(spark, d):
    k = F.col("event_id")
    return ops.latest_reports(table(spark, d, "events").select(F.col("event_type").alias("stage"), k.alias("path"), (k % 10).alias("size"), (k % 3 == 0).cast("int").alias("errors"), (k % 2 == 0).cast("int").alias("warnings"), "ts"))


@P.query("d24_requeued", f"WITH {TASKS} SELECT id, 'BLOCKED' AS old, 'TODO' AS new FROM tasks WHERE status = 'BLOCKED' AND (coalesce(until <= TIMESTAMP '1997-06-01', false) OR (id % 2 = 0 AND reason <> ''))")
def d24(spark, d):
    t = tasks(spark, d)
    return ops.requeued(t, F.lit("1997-06-01").cast("timestamp"), t.where(F.col("id") % 2 == 0).select("id", F.lit(True).alias("ready")))


@P.query("d26_watch", f"WITH {TASKS} SELECT id, unnest(list_filter([CASE WHEN status = 'IN_PROGRESS' AND updated < TIMESTAMP '1998-01-01' - INTERVAL 30 MINUTE THEN 'stale' END, CASE WHEN status <> 'DONE' AND due < TIMESTAMP '1998-01-01' THEN 'overdue' END, CASE WHEN status = 'DONE' AND proof = '' THEN 'missing_evidence' END], lambda x: x IS NOT NULL)) AS issue FROM tasks")
def d26(spark, d):
    return ops.watch(tasks(spark, d), F.lit("1998-01-01").cast("timestamp"))


@P.query("d27_deliverables", "SELECT p_partkey AS doc_key, p_size > 5 AS has_pages, p_partkey % 3 <> 0 AS numbered, p_size % 4 > 0 AS has_text, (p_size % 5 = 0 AND p_size = 0) OR p_partkey % 2 = 0 AS rendered, p_size % 7 = 0 AS no_placeholder, p_size > 5 AND p_partkey % 3 <> 0 AND p_size % 4 > 0 AND p_partkey % 2 = 0 AND p_size % 7 = 0 AS ok FROM part")
def d27(spark, d):
    k, n = F.col("p_partkey"), F.col("p_size")
    pages = F.greatest(n - 5, F.lit(0))
    docs = table(spark, d, "part").select(k.alias("doc_key"), pages.alias("pages"), (k % 3 != 0).alias("bounded"), (n % 4).alias("with_text"), F.when(k % 2 == 0, pages).otherwise(pages + 1).alias("with_render"), (n % 7).alias("placeholders"))
    return ops.deliverables(docs)


def raw_files(spark, d, keep, edited):
    """Files of a raw tree at one time: some missing, some edited."""
    k = F.col("doc_id")
    return table(spark, d, "documents").where(keep(k)).select(F.concat_ws("/", F.coalesce("source", F.lit("none")), k.cast("string")).alias("path"), (F.coalesce("n_chars", F.lit(0)) + edited(k).cast("int")).alias("size"), (k % 1000 + edited(k).cast("int")).alias("mtime"), F.sha1(F.concat(F.col("doc_id").cast("string"), edited(k).cast("string"))).alias("sha1"))


def files_old(spark, d):
    return raw_files(spark, d, lambda k: k % 10 != 0, lambda k: k < 0)


def files_new(spark, d):
    return raw_files(spark, d, lambda k: k % 11 != 0, lambda k: k % 5 == 0)


@P.query("o15_manifest_diff", "SELECT coalesce(source, 'none') || '/' || doc_id AS path, CASE WHEN doc_id % 10 = 0 THEN 'insert' WHEN doc_id % 11 = 0 THEN 'deactivate' WHEN doc_id % 5 = 0 THEN 'update' ELSE 'unchanged' END AS action FROM documents WHERE doc_id % 10 <> 0 OR doc_id % 11 <> 0")
def o15(spark, d):
    return ops.manifest_diff(files_old(spark, d), files_new(spark, d))


@P.query("s16_kept_snapshots", "SELECT o_orderkey AS sync_id, CASE WHEN o_orderkey % 3 <> 0 THEN row_number() OVER (PARTITION BY o_orderkey % 3 <> 0 ORDER BY o_orderdate DESC, o_orderkey) <= 2 ELSE o_orderdate > TIMESTAMP '1998-01-01' - INTERVAL 12 HOUR END AS keep FROM orders")
def s16(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("sync_id"), (F.col("o_orderkey") % 3 != 0).alias("complete"), F.col("o_orderdate").cast("timestamp").alias("created"))
    return ops.kept_snapshots(o, F.lit("1998-01-01").cast("timestamp"))


@P.query("f27_folder_issues", "SELECT p_partkey AS folder, CASE WHEN p_partkey % 5 = 0 THEN 'missing_input_folder' ELSE 'zero_clean_' || CASE WHEN p_partkey % 2 = 0 THEN 'required' ELSE 'optional' END || '_folder' END AS issue, CASE WHEN p_partkey % 2 = 0 THEN 'fail' ELSE 'warn' END AS severity FROM part WHERE p_partkey % 5 = 0 OR (p_size > 10 AND p_partkey % 3 = 0)")
def f27(spark, d):
    k = F.col("p_partkey")
    return audits.folder_issues(table(spark, d, "part").select(k.alias("folder"), (k % 2 == 0).alias("required"), (k % 5 != 0).alias("present"), F.greatest(F.col("p_size") - 10, F.lit(0)).alias("files"), (k % 3).alias("clean")))


def handed(spark, d):
    k = F.col("p_partkey")
    status = table(spark, d, "part").select(
        k.alias("run"),
        F.when(k % 7 != 0, "PASS").alias("checkpoint"),
        F.when(k % 11 != 0, "PASS").otherwise("FAIL").alias("coverage"),
        F.when(k % 5 == 0, "UNRECOVERABLE").when(k % 5 == 1, "DEGRADED").otherwise("COMPLETE").alias("completeness"),
        (k % 4).alias("collected"),
        F.when(k % 3 == 0, 1).otherwise(0).alias("placeholder"),
        F.lit(0).alias("recoverable"),
        F.when(k % 13 == 0, 1).otherwise(0).alias("unrecoverable"),
        (k % 17 == 0).cast("int").alias("lineage_mismatch"),
        (k % 19 == 0).cast("int").alias("parse_failed"),
        (k % 23 == 0).cast("int").alias("hard_issues"),
    )
    return audits.readiness(audits.handoff(status), ["lineage_mismatch", "parse_failed"], ["lineage_mismatch"])


@P.query(
    "a26_readiness",
    """WITH s AS (SELECT p_partkey AS run, p_partkey AS k, CASE WHEN p_partkey % 4 > 0 AND p_partkey % 3 = 0 THEN round_even(1.0 / (p_partkey % 4), 6) ELSE 0.0 END::DOUBLE AS placeholder_ratio, CASE WHEN p_partkey % 4 > 0 AND p_partkey % 13 = 0 THEN round_even(1.0 / (p_partkey % 4), 6) ELSE 0.0 END::DOUBLE AS severe FROM part),
  h AS (SELECT *, CASE WHEN k % 7 = 0 OR k % 11 = 0 THEN 'BLOCKED' WHEN k % 5 = 0 OR severe > 0 THEN 'NEED_RECOVERY_FIRST' WHEN k % 5 = 1 OR placeholder_ratio > 0 THEN 'READY_WITH_WARNINGS' ELSE 'READY' END AS handoff_status FROM s)
  SELECT run, placeholder_ratio, handoff_status, CASE WHEN handoff_status <> 'READY' AND (k % 17 = 0 OR k % 19 = 0) THEN 'unresolved_mixed_origin' WHEN handoff_status <> 'READY' THEN 'inherited_from_stage1' ELSE 'introduced_in_stage2' END AS origin,
    CASE WHEN k % 23 = 0 OR handoff_status = 'BLOCKED' THEN 'BLOCKED' WHEN handoff_status = 'NEED_RECOVERY_FIRST' THEN 'DEGRADED' WHEN handoff_status = 'READY_WITH_WARNINGS' OR k % 17 = 0 THEN 'READY_WITH_WARNINGS' ELSE 'READY' END AS ready_status FROM h""",
)
def a26(spark, d):
    return handed(spark, d).select("run", "placeholder_ratio", "handoff_status", "origin", "ready_status")


@P.query(
    "a28_response_integrity",
    """WITH e AS (SELECT l_orderkey AS package, l_linenumber AS item_id FROM lineitem), i AS (SELECT l_orderkey AS package, CASE WHEN l_orderkey % 7 = 0 AND l_linenumber = 2 THEN 1 WHEN l_orderkey % 11 = 0 AND l_linenumber = 1 THEN 99 ELSE l_linenumber END AS item_id,
    l_orderkey % 13 = 0 AND l_linenumber = 3 AS bad, l_returnflag AS item_type, l_linestatus AS source_family FROM lineitem WHERE NOT (l_orderkey % 5 = 0 AND l_linenumber = 4)),
  n AS (SELECT coalesce(w.package, h.package) AS package, count(*) FILTER (h.n IS NULL) AS missing, count(*) FILTER (w.item_id IS NULL) AS unexpected, count(*) FILTER (h.n > 1) AS repeated, count(w.item_id) AS expected, coalesce(sum(h.n), 0) AS returned
    FROM (SELECT DISTINCT * FROM e) w FULL JOIN (SELECT package, item_id, count(*) AS n FROM i GROUP BY ALL) h ON w.package = h.package AND w.item_id = h.item_id GROUP BY 1),
  c AS (SELECT package, count(*) FILTER (bad) AS conflicts FROM i GROUP BY 1),
  f AS (SELECT package, 'item_type' AS facet, item_type AS value, count(*) AS n FROM i GROUP BY ALL UNION ALL SELECT package, 'source_family', source_family, count(*) FROM i GROUP BY ALL),
  s AS (SELECT l_orderkey AS package, 'item_type' AS facet, l_returnflag AS value, count(*) AS n FROM lineitem GROUP BY ALL UNION ALL SELECT l_orderkey, 'source_family', l_linestatus, count(*) FROM lineitem GROUP BY ALL),
  x AS (SELECT coalesce(f.package, s.package) AS package, count(*) FILTER (f.n IS DISTINCT FROM s.n) AS differing FROM f FULL JOIN s ON f.package = s.package AND f.facet = s.facet AND f.value = s.value GROUP BY 1),
  t AS (SELECT l_orderkey AS package, count(*) AS total FROM lineitem GROUP BY 1),
  r AS (SELECT n.package, missing, unexpected, repeated, coalesce(conflicts, 0) AS conflicts, coalesce(differing, 0) AS differing, total = expected AND total = returned AND expected = returned AS counts_match FROM n LEFT JOIN c USING (package) LEFT JOIN x USING (package) LEFT JOIN t USING (package))
  SELECT *, counts_match AND missing + unexpected + repeated + conflicts + differing = 0 AS success FROM r""",
)
def a28(spark, d):
    """Order lines as items of a package, some sent back missing, renamed or twice."""
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("package"), F.col("l_linenumber").alias("item_id"), F.col("l_returnflag").alias("item_type"), F.col("l_linestatus").alias("source_family"))
    k, n = F.col("package"), F.col("item_id")
    sent = F.when((k % 7 == 0) & (n == 2), 1).when((k % 11 == 0) & (n == 1), 99).otherwise(n)
    items = rows.where(~((k % 5 == 0) & (n == 4))).withColumns({"status": F.when((k % 13 == 0) & (n == 3), "skipped").otherwise("done"), "decision": F.lit("kept")}).withColumn("item_id", sent)
    none = F.lit(None).cast("string")
    totals = rows.groupBy("package").agg(F.count("*").alias("expected_count"), F.count("*").alias("returned_count")).withColumns({"facet": none, "value": none, "count": F.lit(None).cast("long")})
    facets = rows.select("package", F.explode(F.array(*[F.struct(F.lit(f).alias("facet"), F.col(f).alias("value")) for f in ("item_type", "source_family")])).alias("p")).groupBy("package", "p.facet", "p.value").agg(F.count("*").alias("count"))
    stated = totals.unionByName(facets, allowMissingColumns=True)
    return audits.response_integrity(rows, items, stated)


@P.query("c38_notes_and_sides", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'BUY' WHEN 1 THEN 'SELL' WHEN 2 THEN 'SELL' ELSE 'HOLD' END AS side, CASE WHEN o_orderkey % 2 = 0 THEN 'two' ELSE '' END AS phase, CASE WHEN o_orderkey % 3 = 0 THEN 'a,b' ELSE 'repo:global' END AS keys FROM orders")
def c38(spark, d):
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(k, X.side(F.when(k % 4 == 0, " b ").when(k % 4 == 1, "sell").when(k % 4 == 2, "매도").otherwise("hold")).alias("side"), X.note_value(F.when(k % 2 == 0, "x: 1\nphase: two \nphase: three").otherwise("xphase: no"), "phase").alias("phase"), X.resource_keys(F.when(k % 3 == 0, "b, a,,b").alias("r")).alias("keys"))


@P.query(
    "c42_inferred_lanes",
    """WITH t AS (SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN 'debug the join' WHEN 1 THEN 'Backfill months' WHEN 2 THEN 'tidy' WHEN 3 THEN 'refactor and sync' ELSE 'tidy' END AS title, CASE o_orderkey % 10 WHEN 4 THEN 'subagent' WHEN 9 THEN '' ELSE '' END AS lane FROM orders)
  SELECT id, CASE WHEN title LIKE '%debug%' OR title LIKE '%refactor%' THEN 'hard' ELSE 'normal' END AS difficulty, CASE WHEN lower(title) LIKE '%backfill%' OR title LIKE '%sync%' THEN 'long' ELSE 'short' END AS duration,
  CASE WHEN lane <> '' THEN lane WHEN title LIKE '%debug%' OR title LIKE '%refactor%' THEN 'main' WHEN lower(title) LIKE '%backfill%' OR title LIKE '%sync%' THEN 'subagent' ELSE 'auto' END AS lane FROM t""",
)
def c42(spark, d):
    k = F.col("o_orderkey")
    title = F.when(k % 5 == 0, "debug the join").when(k % 5 == 1, "Backfill months").when(k % 5 == 3, "refactor and sync").otherwise("tidy")
    t = table(spark, d, "orders").select(k.alias("id"), title.alias("title"), F.lit("").alias("scope"), F.when(k % 10 == 4, "execution_lane: Subagent").otherwise("other: x").alias("note"))
    return ops.inferred(t).select("id", "difficulty", "duration", "lane")


QUERIES, ORACLES = P.queries, P.oracles
