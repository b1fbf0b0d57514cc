"""Verdicts over a run's counts: completeness of folders, readiness for the next stage, integrity of a scorer's response."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import safe_ratio


def folder_issues(folders: DataFrame) -> DataFrame:
    """folder, issue, severity of folders (folder, required, present, files, clean): missing ones, and ones with files but nothing clean."""
    kind = F.when(F.col("required"), "required").otherwise("optional")
    issue = F.when(~F.col("present"), "missing_input_folder").when((F.col("files") > 0) & (F.col("clean") == 0), F.concat(F.lit("zero_clean_"), kind, F.lit("_folder")))
    return folders.select("folder", issue.alias("issue"), F.when(F.col("required"), "fail").otherwise("warn").alias("severity")).where("issue is not null")


def handoff(status: DataFrame) -> DataFrame:
    """status with three ratios and handoff_status: BLOCKED, NEED_RECOVERY_FIRST, READY_WITH_WARNINGS, READY.

    status: checkpoint, coverage (PASS, FAIL or null), completeness, collected, placeholder, recoverable, unrecoverable.
    """
    ratios = {f"{c}_ratio": safe_ratio(c, "collected") for c in ("placeholder", "recoverable", "unrecoverable")}
    s = status.withColumns(ratios)

    def is_(c: str, *names: str) -> Column:
        return F.coalesce(F.col(c).isin(*names), F.lit(False))

    verdict = (
        F.when(~is_("checkpoint", "PASS") | ~is_("coverage", "PASS"), "BLOCKED")
        .when(is_("completeness", "UNRECOVERABLE") | (F.col("unrecoverable_ratio") > 0), "NEED_RECOVERY_FIRST")
        .when(is_("completeness", "DEGRADED", "PARTIAL_RECOVERY") | (F.col("placeholder_ratio") > 0) | (F.col("recoverable_ratio") > 0), "READY_WITH_WARNINGS")
        .otherwise("READY")
    )
    return s.withColumn("handoff_status", verdict)


def readiness(handed: DataFrame, introduced: Sequence[str], warnings: Sequence[str], hard: str = "hard_issues") -> DataFrame:
    """handed with origin (of degradation) and ready_status; the named columns are counts: of what this stage introduced, and of what warns."""

    def any_in(columns: Sequence[str]) -> Column:
        return sum((F.coalesce(c, F.lit(0)) for c in columns), F.lit(0)) > 0

    mine, warned = any_in(introduced), any_in(warnings)
    theirs = F.col("handoff_status") != "READY"
    origin = F.when(theirs & mine, "unresolved_mixed_origin").when(theirs, "inherited_from_stage1").otherwise("introduced_in_stage2")
    ready = (
        F.when((F.col(hard) > 0) | (F.col("handoff_status") == "BLOCKED"), "BLOCKED")
        .when(F.col("handoff_status") == "NEED_RECOVERY_FIRST", "DEGRADED")
        .when((F.col("handoff_status") == "READY_WITH_WARNINGS") | warned, "READY_WITH_WARNINGS")
        .otherwise("READY")
    )
    return handed.withColumns({"origin": origin, "ready_status": ready})


def response_integrity(expected: DataFrame, items: DataFrame, stated: DataFrame, facets: Sequence[str] = ("item_type", "source_family")) -> DataFrame:
    """One row a package: numbers of missing, unexpected and repeated items, of conflicts, of facets counted differently, and success.

    expected: package, item_id. items (the response): package, item_id, status, decision, and the facets. stated: package, expected_count,
    returned_count, and counts by facet as rows: package, facet, value, count (facet null: the two counts).
    """
    want = expected.select("package", "item_id").distinct()
    have = items.groupBy("package", "item_id").agg(F.count("*").alias("n"))
    both = want.withColumn("w", F.lit(1)).join(have, ["package", "item_id"], "full")
    ids = both.groupBy("package").agg(F.count_if(F.col("n").isNull()).alias("missing"), F.count_if(F.col("w").isNull()).alias("unexpected"), F.count_if(F.col("n") > 1).alias("repeated"), F.sum("w").alias("expected"), F.sum("n").alias("returned"))
    conflict = (F.col("status") == "skipped") != (F.col("decision") == "skipped")
    conflicts = items.groupBy("package").agg(F.count_if(conflict).alias("conflicts"))
    pairs = items.select("package", F.explode(F.array(*[F.struct(F.lit(f).alias("facet"), F.col(f).alias("value")) for f in facets])).alias("p")).select("package", "p.facet", "p.value").where("value <> ''")
    counted = pairs.groupBy("package", "facet", "value").agg(F.count("*").alias("n"))
    said = stated.where("facet is not null").select("package", "facet", "value", "count")
    differing = counted.join(said, ["package", "facet", "value"], "full").groupBy("package").agg(F.count_if(~F.col("n").eqNullSafe(F.col("count"))).alias("differing"))
    totals = stated.where("facet is null").select("package", "expected_count", "returned_count")
    out = ids.join(conflicts, "package", "left").join(differing, "package", "left").join(totals, "package", "left").fillna(0, ["conflicts", "differing", "expected", "returned"])
    match = (F.col("expected_count") == F.col("expected")) & (F.col("returned_count") == F.col("returned")) & (F.col("expected") == F.col("returned"))
    ok = F.coalesce(match, F.lit(False)) & (F.col("missing") + F.col("unexpected") + F.col("repeated") + F.col("conflicts") + F.col("differing") == 0)
    return out.select("package", "missing", "unexpected", "repeated", "conflicts", "differing", F.coalesce(match, F.lit(False)).alias("counts_match"), ok.alias("success"))


# What a summary of a folder says of itself, and the keys that are compared, in order.
SUMMARY_MODE, NOTE = "directory_jsonl_summary", "Canonical selected_articles corpus is the live selected_articles_*.jsonl set in this directory. This file is a directory summary only."
SUMMARY_KEYS = (
    "summary_mode", "source_dir", "source_files", "source_files_list", "merged_count", "total_rows", "unique_url_count", "date_min", "date_max", "output_file", "latest_file",
    "latest_file_mtime_utc", "recent_backfill_files", "recent_backfill_added_rows", "row_counts_by_file", "source_domains", "source_kinds", "contract_note",
)


def live_summary(rows: DataFrame, files: DataFrame, folder: str) -> DataFrame:
    """One row of SUMMARY_KEYS: what articles (file, url, source_domain, source_kind, day) in a folder's files (file, modified) come to.

    Counts by file, domain and kind are arrays of name and n, by name; files without rows count 0 there. Blank values count nowhere but in the rows.
    """

    def text(c: str) -> Column:
        return F.nullif(F.trim(F.col(c)), F.lit(""))

    def counted(df: DataFrame, name: str, n: Column, into: str) -> DataFrame:
        return df.agg(F.array_sort(F.collect_list(F.struct(F.col(name).alias("name"), n.cast("long").alias("n")))).alias(into))

    by_file = files.join(rows.groupBy("file").agg(F.count("*").alias("rows")), "file", "left").fillna(0, ["rows"])
    listed = counted(by_file, "file", F.col("rows"), "row_counts_by_file")
    kinds = {into: counted(rows.select(text(c).alias("name")).where("name is not null").groupBy("name").agg(F.count("*").alias("c")), "name", F.col("c"), into) for c, into in (("source_domain", "source_domains"), ("source_kind", "source_kinds"))}
    totals = rows.agg(F.count("*").alias("total_rows"), F.count_distinct(text("url")).alias("unique_url_count"), F.min("day").alias("date_min"), F.max("day").alias("date_max"))
    one = totals.crossJoin(listed).crossJoin(kinds["source_domains"]).crossJoin(kinds["source_kinds"])  # a row each
    one = one.crossJoin(files.agg(F.max_by("modified", "file").alias("latest_file_mtime_utc")))
    names = F.transform("row_counts_by_file", lambda x: x["name"])
    recent = F.slice("row_counts_by_file", F.greatest(F.size("row_counts_by_file") - 1, F.lit(1)), F.lit(2))
    made = {
        "summary_mode": F.lit(SUMMARY_MODE),
        "source_dir": F.lit(folder),
        "source_files": F.size("row_counts_by_file"),
        "source_files_list": names,
        "merged_count": F.col("total_rows"),
        "output_file": F.lit(""),
        "latest_file": F.try_element_at(names, F.lit(-1)),
        "recent_backfill_files": F.transform(recent, lambda x: x["name"]),
        "recent_backfill_added_rows": F.reduce(recent, F.lit(0).cast("long"), lambda a, x: a + x["n"]),
        "contract_note": F.lit(NOTE),
    }
    return one.withColumns(made).select(*SUMMARY_KEYS)


def summary_issues(stated: DataFrame, found: DataFrame) -> DataFrame:
    """issue: ``<key>_mismatch`` for each key of SUMMARY_KEYS in which a stated summary (a row, or none) differs from a found one, in order; a stated one that isn't there is one issue."""
    both = found.select(F.struct(*SUMMARY_KEYS).alias("f")).join(stated.limit(1).select(F.struct(*SUMMARY_KEYS).alias("s")), F.lit(True), "left")  # a row each
    wrong = F.array_compact(F.array(*[F.when(~F.col(f"s.{k}").eqNullSafe(F.col(f"f.{k}")), f"{k}_mismatch") for k in SUMMARY_KEYS]))
    return both.select(F.explode(F.when(F.col("s").isNull(), F.array(F.lit("summary_missing_or_invalid"))).otherwise(wrong)).alias("issue"))
