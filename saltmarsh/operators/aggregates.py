"""Aggregations: clusters of claims, counts, coverage, continuity, concentration, merges of records."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

AXES = ("upside", "downside", "bm", "persistence")


def weighted(value: str, weight: str = "weight") -> Column:
    """The weighted mean; the plain one where weights add up to nothing."""
    return F.when(F.sum(weight) > 0, F.sum(F.col(value) * F.col(weight)) / F.nullif(F.sum(weight), F.lit(0.0))).otherwise(F.avg(value))


def clusters(cards: DataFrame) -> DataFrame:
    """Per date, symbol and cluster: weight (at least 1), cards, documents and weighted means of the axes."""
    means = [weighted(a).alias(a) for a in AXES]
    return cards.groupBy("date", "symbol", "cluster_id").agg(F.greatest(F.sum("weight"), F.lit(1.0)).alias("cluster_weight"), F.count("*").alias("cards"), F.count_distinct("doc_id").alias("docs"), *means)


def symbol_scores(clustered: DataFrame) -> DataFrame:
    means = [weighted(a, "cluster_weight").alias(a) for a in AXES]
    return clustered.groupBy("date", "symbol").agg(F.sum("cluster_weight").alias("weight"), F.count("*").alias("clusters"), *means)


def count_features(cards: DataFrame, families: Sequence[str], events: Sequence[str]) -> DataFrame:
    """Documents overall, by family and by event; mentions; diversity = families / 7, at most 1."""
    per = [F.count_distinct(F.when(F.col("family") == f, F.col("doc_id"))).alias(f"docs_{f}") for f in families]
    flags = [F.count_distinct(F.when(F.col(f"event_{e}") == 1, F.col("doc_id"))).alias(f"docs_{e}") for e in events]
    return cards.groupBy("date", "symbol").agg(F.count_distinct("doc_id").alias("docs"), F.count("*").alias("mentions"), F.least(F.count_distinct("family") / 7.0, F.lit(1.0)).alias("diversity"), *per, *flags)


def macro_by_day(docs: DataFrame, evidence: int = 3) -> DataFrame:
    """Per day of macro texts (date, doc_id, score, source, evidence): means, shares, regime, forecast, confidence.

    Regime: risk_on (off) from a share of 0.6 and a mean beyond +-0.1; neutral near balance; mixed. ``sources``: each with its share,
    most frequent first; ``evidence``: the first distinct texts by document.
    """
    day = docs.groupBy("date").agg(F.count_distinct("doc_id").alias("docs"), F.avg("score").alias("mean"), F.avg((F.col("score") > 0).cast("int")).alias("on_ratio"), F.avg((F.col("score") < 0).cast("int")).alias("off_ratio"), F.count_distinct("source").alias("kinds"), F.count("*").alias("rows"))
    counts = docs.groupBy("date", "source").agg(F.count("*").alias("n"))
    mix = counts.join(day.select("date", "rows"), "date").groupBy("date").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "source", F.format_string("%s:%.2f", "source", F.col("n") / F.col("rows")).alias("t")))).alias("m"))
    texts = docs.groupBy("date", "evidence").agg(F.min("doc_id").alias("first"))
    rank = F.row_number().over(Window.partitionBy("date").orderBy("first"))
    notes = texts.withColumn("r", rank).where(F.col("r") <= evidence).groupBy("date").agg(F.array_sort(F.collect_list(F.struct("r", "evidence"))).alias("e"))
    mean, on, off = F.col("mean"), F.col("on_ratio"), F.col("off_ratio")
    balance = F.abs(on - off)
    regime = F.when((on >= 0.60) & (mean > 0.10), "risk_on").when((off >= 0.60) & (mean < -0.10), "risk_off").when((F.abs(mean) < 0.15) & (balance < 0.20), "neutral").otherwise("mixed")
    forecast = F.greatest(F.least(50.0 + 35.0 * mean + 10.0 * (on - off), F.lit(100.0)), F.lit(0.0))
    trust = 0.35 + 0.12 * F.least("docs", F.lit(4)) / 4.0 + 0.20 * F.greatest(F.abs(mean), balance) + 0.08 * F.least(F.greatest("kinds", F.lit(1)), F.lit(3)) / 3.0
    rows = day.join(mix, "date").join(notes, "date", "left")
    return rows.select("date", "docs", "mean", "on_ratio", "off_ratio", regime.alias("regime"), forecast.alias("forecast"), F.greatest(F.least(trust, F.lit(0.97)), F.lit(0.20)).alias("confidence"), F.array_join(F.transform("m", lambda x: x["t"]), ", ").alias("sources"), F.array_join(F.transform("e", lambda x: x["evidence"]), " | ").alias("evidence"))


def correlations(df: DataFrame, columns: Sequence[str], most: float = 0.7, least_rows: int = 3) -> DataFrame:
    """a, b, rho of all pairs of columns, one row a pair; null (too few rows, no variance) counts as 0; ``high`` beyond ``most``."""
    pairs = list(combinations(columns, 2))
    flat = [F.var_pop(c).alias(f"v_{c}") for c in columns]
    one = df.agg(F.count("*").alias("n"), *flat, *[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.when((F.col("n") >= least_rows) & (F.col(f"v_{a}") > 1e-15) & (F.col(f"v_{b}") > 1e-15), F.col(f"{a}|{b}")).alias("rho")) for a, b in pairs]
    rows = one.select(F.explode(F.array(*cells)).alias("x")).select("x.a", "x.b", F.coalesce(F.nanvl("x.rho", F.lit(0.0)), F.lit(0.0)).alias("rho"))
    return rows.withColumn("high", F.abs("rho") > most)


def sector_strength(bars: DataFrame, sectors: DataFrame, top: int = 4) -> DataFrame:
    """symbol, sector, ret (last close over the 20th last, of the last 60 rows, at least 20), rank of its sector, weight."""
    back = Window.partitionBy("symbol").orderBy(F.desc("date"))
    last = bars.withColumn("r", F.row_number().over(back)).where("r <= 60")
    rets = last.groupBy("symbol").agg(F.count("*").alias("n"), (F.max(F.when(F.col("r") == 1, F.col("close"))) / F.nullif(F.max(F.when(F.col("r") == 20, F.col("close"))), F.lit(0.0)) - 1).alias("ret")).where("n >= 20").drop("n")
    own = rets.join(sectors, "symbol", "left")
    means = own.where("sector is not null").groupBy("sector").agg(F.avg("ret").alias("strength"))
    ranked = means.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("strength"), "sector")))
    weight = F.when(F.col("rank") <= top, 1 + F.greatest(F.col("ret"), F.lit(0.0)) * 8).otherwise(1.0)
    return own.join(F.broadcast(ranked.select("sector", "rank")), "sector", "left").select("symbol", "sector", "ret", "rank", weight.alias("weight"))


def concentration(weights: DataFrame) -> DataFrame:
    """Per date the greatest weight and the sum of squared shares (weights in percent)."""
    return weights.groupBy("date").agg(F.max("weight_pct").alias("max_weight"), F.sum(F.pow(F.col("weight_pct") / 100, F.lit(2.0))).alias("hhi"))


def merged_urls(records: DataFrame) -> DataFrame:
    """One record a URL: earliest date, longest title and summary (the first of several), all provenances."""

    def longest(c: str) -> Column:
        return F.max_by(c, F.when(F.coalesce(c, F.lit("")) != "", F.struct(F.length(c), -F.col("row_no"))))

    return records.groupBy("url").agg(F.min("published").alias("published"), longest("title").alias("title"), longest("summary").alias("summary"), F.array_sort(F.collect_set("source")).alias("sources"))


def best_rows(records: DataFrame) -> DataFrame:
    """The row of each URL with a date, the latest, the longest summary and title; the later row on ties."""
    rank = F.struct(F.col("published").isNotNull(), F.col("published"), F.length(F.coalesce("summary", F.lit(""))), F.length(F.coalesce("title", F.lit(""))), F.col("row_no"))
    return records.groupBy("url").agg(F.max_by(F.struct("row_no", "published", "title", "summary"), rank).alias("r")).select("url", "r.*")


def coverage(dates: DataFrame) -> DataFrame:
    """Per source: earliest, latest, distinct days, months, and the number of months missing between."""
    rows = dates.where("date is not null").groupBy("source").agg(F.min("date").alias("earliest"), F.max("date").alias("latest"), F.count_distinct("date").alias("days"), F.count_distinct(F.trunc("date", "month")).alias("months"))
    span = F.months_between(F.trunc("latest", "month"), F.trunc("earliest", "month")).cast("int") + 1
    return rows.withColumn("missing_months", span - F.col("months"))


def missing_months(dates: DataFrame) -> DataFrame:
    """source, month without a date between its first and last."""
    have = dates.where("date is not null").select("source", F.trunc("date", "month").alias("month")).distinct()
    want = have.groupBy("source").agg(F.min("month").alias("a"), F.max("month").alias("b")).select("source", F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month"))
    return want.join(have, ["source", "month"], "left_anti")


def long_enough(dates: DataFrame, years: int = 10) -> DataFrame:
    """Per source: span in years and PASS, FAIL or (without dates) BLOCKED."""
    rows = dates.groupBy("source").agg((F.datediff(F.max("date"), F.min("date")) / 365.25).alias("years"))
    return rows.withColumn("verdict", F.when(F.col("years").isNull(), "BLOCKED").when(F.col("years") >= years, "PASS").otherwise("FAIL"))


def freshness(files: DataFrame, now: Column, min_count: int, max_age_hours: float) -> DataFrame:
    """Per source: files, age of the newest in hours, and whether both limits hold. ``now`` is an argument."""
    rows = files.groupBy("source").agg(F.count("*").alias("files"), F.max("ts").alias("newest"))
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("newest").cast("timestamp"))) / 3.6e9
    return rows.select("source", "files", age.alias("age_hours"), ((F.col("files") >= min_count) & (age <= max_age_hours)).alias("ok"))


def staleness(bars: DataFrame, most: int = 7) -> DataFrame:
    """Per last day of symbols: how many end there, its lag behind the latest of all, and whether that is stale."""
    last = bars.groupBy("symbol").agg(F.max("date").alias("last"))
    newest = F.broadcast(last.agg(F.max("last").alias("newest")))
    return last.crossJoin(newest).groupBy("last").agg(F.count("*").alias("symbols"), F.first(F.datediff("newest", "last")).alias("lag")).withColumn("stale", F.col("lag") > most)


def business_days(a: Column, b: Column) -> Column:
    """Weekdays from a (included) to b (excluded)."""

    def since(d: Column) -> Column:
        n = F.datediff(d, F.lit("1970-01-05").cast("date"))  # a Monday
        return F.floor(n / 7) * 5 + F.least(F.pmod(n, F.lit(7)), F.lit(5))

    return since(b) - since(a)


def continuity(bars: DataFrame) -> DataFrame:
    """Per symbol: rows, days, missing business days between them, the longest gap, the ratio to days, WARN beyond 0.10 or 5."""
    days = bars.where("date is not null").select("symbol", "date").distinct()
    gap = F.greatest(F.lit(0), business_days(F.col("date"), F.lead("date").over(Window.partitionBy("symbol").orderBy("date"))) - 1)
    gaps = days.withColumn("gap", F.coalesce(gap, F.lit(0))).groupBy("symbol").agg(F.count("*").alias("days"), F.sum("gap").alias("missing"), F.max("gap").alias("max_gap"))
    rows = bars.groupBy("symbol").agg(F.count("*").alias("rows")).join(gaps, "symbol", "left").fillna(0, ["days", "missing", "max_gap"])
    ratio = F.col("missing") / F.greatest("days", F.lit(1))
    return rows.withColumn("ratio", ratio).withColumn("flag", F.when((F.col("days") == 0) | (ratio > 0.10) | (F.col("max_gap") > 5), "WARN").otherwise("OK"))


def day_gaps(dates: DataFrame, most: int = 14) -> DataFrame:
    """Per source: distinct days and the longest distance between neighbours, over the limit or not."""
    days = dates.where("date is not null").select("source", "date").distinct()
    gap = F.datediff("date", F.lag("date").over(Window.partitionBy("source").orderBy("date")))
    return days.withColumn("gap", gap).groupBy("source").agg(F.count("*").alias("days"), F.coalesce(F.max("gap"), F.lit(0)).alias("max_gap")).withColumn("ok", F.col("max_gap") <= most)


def independent_issues(bars: DataFrame) -> DataFrame:
    """Per symbol, by rules of its own: rows, missing ratio, outliers (|return| > 0.8 on traded rows), suspect rows, issues."""
    before = F.lag("close").over(Window.partitionBy("symbol").orderBy("row_no"))
    ret = F.col("close") / F.nullif(before, F.lit(0.0)) - 1
    missing = F.lit(0)
    for c in ("open", "high", "low", "close", "volume"):
        missing = missing + F.col(c).isNull().cast("int")
    flags = (F.col("high") < F.col("low")).cast("int"), (F.col("close") <= 0).cast("int"), (F.col("volume") <= 0).cast("int"), F.col("close").isNull().cast("int"), (F.abs(ret) > 0.35).cast("int"), ((F.col("open") <= 0) & (F.col("close") > 0)).cast("int")
    sums = F.lit(0)
    for f in flags:
        sums = sums + F.coalesce(f, F.lit(0))
    rows = bars.withColumns({"_m": missing, "_o": F.coalesce((F.abs(ret) > 0.8) & (F.col("volume") > 0), F.lit(False)), "_f": sums})
    out = rows.groupBy("symbol").agg(F.count("*").alias("rows"), (F.sum("_m") / (F.count("*") * 5)).alias("missing_ratio"), F.count_if("_o").alias("outliers"), F.count_if(F.col("_f") >= 3).alias("suspect"))
    issues = F.array_compact(F.array(F.when(F.col("missing_ratio") > 0.30, "missing_ratio"), F.when(F.col("outliers") > 0, "outliers"), F.when(F.col("suspect") > F.col("rows") * 0.20, "suspect_rows")))
    return out.withColumn("issues", F.array_join(issues, ","))


def preserved(raw: DataFrame, clean: DataFrame, bad: DataFrame, key: str) -> DataFrame:
    """Per key: rows before, clean and bad after, and whether none went missing."""
    r, c, b = (df.groupBy(key).agg(F.count("*").alias(n)) for df, n in ((raw, "raw"), (clean, "clean"), (bad, "bad")))
    rows = r.join(c, key, "left").join(b, key, "left").fillna(0, ["clean", "bad"])
    return rows.withColumn("ok", F.col("clean") + F.col("bad") >= F.col("raw"))


def verdict(errors: Column, warnings: Column, issues: Column) -> Column:
    return F.when(errors > 0, "FAIL").when((warnings > 0) | (issues > 0), "WARN").otherwise("PASS")


def same_content(files: DataFrame, most: int = 10) -> DataFrame:
    """Contents (sha1, size) stored more than once, with the first paths; the paths are ranked before they are gathered."""
    r = F.row_number().over(Window.partitionBy("sha1", "size").orderBy("path"))
    n = F.count("*").over(Window.partitionBy("sha1", "size"))
    rows = files.withColumns({"r": r, "n": n}).where((F.col("n") > 1) & (F.col("r") <= most))
    return rows.groupBy("sha1", "size").agg(F.max("n").alias("copies"), F.array_join(F.array_sort(F.collect_list("path")), ",").alias("paths"))


def page_grade(pages: Column, with_text: Column) -> Column:
    """A, B, C or F by the share of pages with text."""
    share = with_text / F.nullif(pages, F.lit(0))
    return F.when(pages.isNull() | (pages == 0) | (with_text == 0), "F").when(share >= 0.9, "A").when(share >= 0.5, "B").otherwise("C")


def merged_by_rank(rows: DataFrame, keys: Sequence[str], rank: str) -> DataFrame:
    """Per key and column the non-empty value of the highest rank."""
    values = [c for c in rows.columns if c not in (*keys, rank)]
    return rows.groupBy(*keys).agg(*[F.max_by(c, F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.col(rank))).alias(c) for c in values])


def page_diagnostics(pages: DataFrame) -> DataFrame:
    """Per document over distinct page numbers: pages, with text, with image, placeholders, and whether 1..n are all there."""
    one = pages.groupBy("doc_key", "page_no").agg(F.max("has_text").alias("t"), F.max("has_render").alias("r"))
    return one.groupBy("doc_key").agg(F.count("*").alias("pages"), F.count_if("t").alias("with_text"), F.count_if("r").alias("with_render"), F.count_if(~F.col("t") & ~F.col("r")).alias("placeholders"), ((F.min("page_no") == 1) & (F.max("page_no") == F.count("*"))).alias("bounded"))


def page_marked(pages: DataFrame, most: int = 2000) -> DataFrame:
    """Per document its pages' texts in order, each behind ``[PAGE 001]``, clipped."""
    marked = F.concat(F.lit("[PAGE "), F.lpad(F.col("page_no").cast("string"), 3, "0"), F.lit("]\n"), F.coalesce("text", F.lit("")))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_no", marked.alias("t")))), lambda x: x["t"]), "\n")
    return pages.groupBy("doc_key").agg(F.substring(whole, 1, most).alias("text"))


def batch_profile(items: DataFrame) -> DataFrame:
    """Per batch: items, tokens, bytes, kinds with counts, and the share of long or chatty items."""
    kinds = items.groupBy("batch", "kind").agg(F.count("*").alias("n"))
    mix = kinds.groupBy("batch").agg(F.array_join(F.array_sort(F.collect_list(F.concat("kind", F.lit("="), F.col("n").cast("string")))), ",").alias("mix"))
    rows = items.groupBy("batch").agg(F.count("*").alias("items"), F.sum("tokens").alias("tokens"), F.sum("bytes").alias("bytes"), F.avg(((F.col("tokens") > 600) | (F.col("kind") == "chat")).cast("int")).alias("long_ratio"))
    return rows.join(mix, "batch")


def switches(trades: DataFrame, row_cap: int = 1, month_cap: int = 1) -> DataFrame:
    """Per month: replacements, over its cap or not, days over the row cap, and codes added and removed on one day. Risk rows don't count."""
    t = trades.where("not risk")
    days = t.groupBy("date").agg(F.count_if(F.col("kind") == "add").alias("adds"), F.size(F.array_intersect(F.collect_set(F.when(F.col("kind") == "add", F.col("code"))), F.collect_set(F.when(F.col("kind") == "remove", F.col("code"))))).alias("overlap"))
    return days.groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(F.sum("adds").alias("replacements"), (F.sum("adds") > month_cap).alias("over_month"), F.count_if(F.col("adds") > row_cap).alias("days_over"), F.sum("overlap").cast("long").alias("overlaps"))
