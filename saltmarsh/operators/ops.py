"""Repairs, coverage and the state of work items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import any_date, any_of, note_value


def repaired_dates(items: DataFrame, fields: Sequence[str], texts: Sequence[str], fallback: str) -> DataFrame:
    """items with repaired, date_source and changed: the first field that parses, then a date in a text, then the file's time."""
    found = F.lit(None).cast("date")
    source = F.lit(None).cast("string")
    for name, c in reversed([*[(f, any_date(f)) for f in fields], *[(f"{t}_pattern", any_date(F.regexp_extract(t, r"(\d{4}[-./]\d{1,2}[-./]\d{1,2})", 1))) for t in texts], ("file_time", F.to_date(fallback))]):
        source = F.when(c.isNotNull(), name).otherwise(source)
        found = F.coalesce(c, found)
    return items.withColumns({"repaired": found, "date_source": source, "changed": ~found.eqNullSafe(any_date(fields[0]))})


def year_for(month: Column, day: Column, at: Column) -> Column:
    """A date without year: the file's, or the year before where the month lies more than one ahead of the file's."""
    year = F.year(at) - (month > F.month(at) + 1).cast("int")
    return F.try_make_timestamp(year, month, day, F.lit(0), F.lit(0), F.lit(0)).cast("date")


def to_repair(universe: DataFrame, files: DataFrame, least: int = 20) -> DataFrame:
    """Valid codes without a file or with one too small or unreadable."""
    good = files.where((F.col("size") >= least) & F.col("readable")).select("code").distinct()
    return universe.where(F.col("code").rlike(r"^\d{6}$")).select("code").distinct().join(good, "code", "left_anti")


def article_summary(rows: DataFrame) -> DataFrame:
    """Per file: rows, distinct URLs, first and last date, domains."""
    return rows.groupBy("file").agg(F.count("*").alias("rows"), F.count_distinct("url").alias("urls"), F.min("date").alias("first"), F.max("date").alias("last"), F.count_distinct("host").alias("hosts"))


def summary_mismatches(stated: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """key and names of the columns in which a stated summary differs from a recomputed one."""
    columns = [c for c in stated.columns if c != key]
    j = stated.select(key, F.struct(*columns).alias("s")).join(found.select(key, F.struct(*columns).alias("f")), key, "full")
    wrong = F.array_compact(F.array(*[F.when(~F.col(f"s.{c}").eqNullSafe(F.col(f"f.{c}")), c) for c in columns]))
    return j.select(key, F.array_join(wrong, ",").alias("wrong")).where("wrong <> ''")


def scopes(registry: DataFrame, observed: DataFrame, terminal: DataFrame) -> DataFrame:
    """Per source: registered, missing in raw, unresolved (missing and not classified for good), satisfied."""
    missing = registry.join(observed, ["source", "url"], "left_anti")
    open_ = missing.join(terminal, ["source", "url"], "left_anti")

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("source").agg(F.count("*").alias(name))

    rows = counted(registry, "registered").join(counted(missing, "missing"), "source", "left").join(counted(open_, "unresolved"), "source", "left").fillna(0)
    return rows.withColumn("satisfied", (F.col("registered") > 0) & (F.col("unresolved") == 0))


def date_sources(rows: DataFrame, years: float = 10) -> DataFrame:
    """Per source: first and last date, published ones, verdict BLOCKED (no date, or none published), PASS, FAIL."""
    g = rows.groupBy("source").agg(F.min("date").alias("first"), F.max("date").alias("last"), F.count_if(F.col("date_source") == "published").alias("published"))
    span = F.datediff("last", "first") / 365.25
    return g.withColumn("verdict", F.when(F.col("first").isNull() | (F.col("published") == 0), "BLOCKED").when(span >= years, "PASS").otherwise("FAIL"))


def leaves(files: DataFrame, now: Column) -> DataFrame:
    """Per folder: files and age of the newest in hours."""
    folder = F.regexp_replace("path", "/[^/]*$", "")
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.max("ts").cast("timestamp"))) / 3.6e9
    return files.groupBy(folder.alias("folder")).agg(F.count("*").alias("files"), age.alias("age_hours"))


def lane(tasks: DataFrame) -> DataFrame:
    """Open tasks by lane: main, subagent or remaining."""
    a = F.lower(F.coalesce("assignee", F.lit("")))
    return tasks.where("status <> 'DONE'").withColumn("lane", F.when(a == "main", "main").when(a.startswith("sub"), "subagent").otherwise("remaining"))


def blocked_without_reason(tasks: DataFrame, n: int = 10) -> DataFrame:
    rows = tasks.where("status = 'BLOCKED' and coalesce(proof, '') <> '' and coalesce(reason, '') = ''")
    return rows.orderBy(F.desc("updated"), "id").limit(n)


def by_assignee(tasks: DataFrame) -> DataFrame:
    """Per assignee (also from a note ``assignee: x``): active and waiting tasks."""
    who = F.coalesce(F.nullif("assignee", F.lit("")), F.nullif(F.regexp_extract(F.coalesce("note", F.lit("")), r"(?i)assignee:\s*(\w+)", 1), F.lit("")), F.lit("nobody"))
    return tasks.groupBy(who.alias("who")).agg(F.count_if(F.col("status") == "IN_PROGRESS").alias("active"), F.count_if(F.col("status").isin("TODO", "BLOCKED")).alias("waiting"))


def latest_reports(reports: DataFrame) -> DataFrame:
    """Per stage the newest report that isn't empty, with a text of its state."""
    r = reports.where("size > 0").groupBy("stage").agg(F.max_by(F.struct("path", "errors", "warnings"), F.struct("ts", "path")).alias("r"))
    return r.select("stage", "r.path", F.when(F.col("r.errors") > 0, "fail").when(F.col("r.warnings") > 0, "warn").otherwise("ok").alias("state"))


def requeued(tasks: DataFrame, now: Column, ready: DataFrame) -> DataFrame:
    """id, old, new of blocked tasks to take up again: their wait is over or all that they refer to is done. A diff, no update."""
    j = tasks.where("status = 'BLOCKED'").join(ready, "id", "left")
    due = F.coalesce(F.col("until") <= now, F.lit(False)) | (F.coalesce("ready", F.lit(False)) & any_of(F.lower(F.coalesce("reason", F.lit(""))), ("waiting for", "after ", "prerequisite")))
    return j.where(due).select("id", F.lit("BLOCKED").alias("old"), F.lit("TODO").alias("new"))


def watch(tasks: DataFrame, now: Column, stale_minutes: int = 30) -> DataFrame:
    """id, issue: work that is stale, overdue or done without evidence."""
    old = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("updated").cast("timestamp")) > stale_minutes * 60_000_000
    rules = F.array_compact(F.array(F.when((F.col("status") == "IN_PROGRESS") & old, "stale"), F.when((F.col("status") != "DONE") & (F.col("due") < now), "overdue"), F.when((F.col("status") == "DONE") & (F.coalesce("proof", F.lit("")) == ""), "missing_evidence")))
    return tasks.select("id", F.explode(rules).alias("issue"))


def deliverables(docs: DataFrame) -> DataFrame:
    """Five checks of a paged document and whether all hold."""
    checks = {"has_pages": F.col("pages") > 0, "numbered": F.col("bounded"), "has_text": F.col("with_text") > 0, "rendered": F.col("with_render") == F.col("pages"), "no_placeholder": F.col("placeholders") == 0}
    out = docs.select("doc_key", *[c.alias(n) for n, c in checks.items()])
    ok = F.lit(True)
    for n in checks:
        ok = ok & F.col(n)
    return out.withColumn("ok", ok)


def manifest_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """path, action: insert, update (other size or time, and other hash), unchanged, deactivate."""
    o, n = (df.select("path", F.struct("size", "mtime", "sha1").alias(x)) for df, x in ((old, "o"), (new, "n")))
    same = ((F.col("o.size") == F.col("n.size")) & (F.col("o.mtime") == F.col("n.mtime"))) | (F.col("o.sha1") == F.col("n.sha1"))
    action = F.when(F.col("o").isNull(), "insert").when(F.col("n").isNull(), "deactivate").when(same, "unchanged").otherwise("update")
    return o.join(n, "path", "full").select("path", action.alias("action"))


def kept_snapshots(snapshots: DataFrame, now: Column, keep: int = 2, hours: int = 12) -> DataFrame:
    """sync_id, keep: the newest complete ones, and incomplete ones that may still be written."""
    rank = F.row_number().over(Window.partitionBy("complete").orderBy(F.desc("created"), "sync_id"))
    young = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("created").cast("timestamp")) < hours * 3_600_000_000
    return snapshots.withColumn("r", rank).select("sync_id", F.when(F.col("complete"), F.col("r") <= keep).otherwise(young).alias("keep"))


# Words of hard and of long work.
HARD = ("hard", "complex", "debug", "root cause", "contract", "architecture", "refactor", "migration", "정렬", "정합")
LENGTHY = ("collect", "sync", "refresh", "scan", "backfill", "monitor", "crawl", "wait", "coverage", "import", "index", "batch", "수집", "동기화", "대기")


def inferred(tasks: DataFrame) -> DataFrame:
    """tasks with difficulty, duration and lane: what their note states, else by the words of title, scope and note."""
    text = F.lower(F.concat_ws(" ", "title", "scope", "note"))

    def stated(key: str, values: Sequence[str], otherwise: Column) -> Column:
        said = F.lower(note_value("note", key))
        return F.when(said.isin(*values), said).otherwise(otherwise)

    t = tasks.withColumns({"difficulty": stated("difficulty", ("easy", "normal", "hard"), F.when(any_of(text, HARD), "hard").otherwise("normal")), "duration": stated("duration", ("short", "long"), F.when(any_of(text, LENGTHY), "long").otherwise("short"))})
    return t.withColumn("lane", stated("execution_lane", ("main", "subagent", "auto"), F.when(F.col("difficulty") == "hard", "main").when(F.col("duration") == "long", "subagent").otherwise("auto")))
