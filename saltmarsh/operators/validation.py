"""Row validators: each adds a ``reason`` column, null for clean rows. Order-dependent rules follow ``row_no``, the order of the file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OHLC = ("open", "high", "low", "close")
#: What a source writes for nothing.
NULL_WORDS = ("", "nan", "none", "null")


def normalised_names(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Strip column names, drop index columns (``Unnamed...``, ``index``), apply aliases (matched without case). First wins."""
    keep: dict[str, str] = {}
    for name in df.columns:
        short = name.strip()
        if not short.startswith("Unnamed") and short.lower() != "index":
            keep.setdefault(aliases.get(short.lower(), short), name)
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in keep.items()])


def without_null_words(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Trimmed strings, null where they only say so."""
    return df.withColumns({c: F.when(~F.lower(F.trim(c)).isin(*NULL_WORDS), F.trim(c)) for c in columns})


def first_present(df: DataFrame, candidates: Sequence[str]) -> Column | None:
    """The first of some columns that exists."""
    return next((F.col(c) for c in candidates if c in df.columns), None)


def coalesced(df: DataFrame, candidates: Sequence[str]) -> Column:
    """The first value among those of some columns that exist."""
    return F.coalesce(*[F.col(c) for c in candidates if c in df.columns], F.lit(None))


def to_number(c: Column | str) -> Column:
    """A double; null where the text is none. Commas between digits are dropped."""
    return F.regexp_replace(F.trim(c), ",", "").try_cast("double")


def to_day(c: Column | str, pattern: str = "yyyyMMdd") -> Column:
    return F.to_date(F.try_to_timestamp(c, F.lit(pattern)))


def _reasons(rules: Sequence[tuple[str, Column]]) -> Column:
    """The first rule that holds."""
    out = F.lit(None).cast("string")
    for name, rule in reversed(rules):
        out = F.when(rule, F.lit(name)).otherwise(out)
    return out


def spike(close: Column, before: Column, most: float) -> Column:
    """Whether a close is further than ``most`` from the one before, as |close / before - 1|; after a zero close any other is."""
    return F.coalesce(F.when(before == 0, close != 0).otherwise(F.abs(close / F.nullif(before, F.lit(0.0)) - 1) > most), F.lit(False))


def bars_strict(bars: DataFrame, min_volume: float = 10, most: float = 0.35, last_close: DataFrame | None = None) -> DataFrame:
    """Reasons: duplicate_date (all but a day's first row), return_spike_gt_35pct, zero_candle, basic_invalid_or_low_liquidity.

    When several hold, that is also their precedence. The close before is that of the row before in the file, clean or not, and,
    for a symbol's first row, ``last_close`` (symbol, last_close) if given. Missing days count as one and the same day.
    """
    file = Window.partitionBy("symbol").orderBy("row_no")
    before = F.lag("close").over(file)
    if last_close is not None:
        bars = bars.join(last_close, "symbol", "left")
        before = F.when(F.row_number().over(file) == 1, F.col("last_close")).otherwise(before)
    close, volume = F.col("close"), F.col("volume")
    basic = F.col("date").isNull() | volume.isNull() | (volume < min_volume) | (close <= 0)
    for c in OHLC:
        basic = basic | F.col(c).isNull()
    zero = (F.col("open") <= 0) & (F.col("high") <= 0) & (F.col("low") <= 0) & (close > 0) & (volume == 0)
    again = F.row_number().over(Window.partitionBy("symbol", "date").orderBy("row_no")) > 1
    rules = [("duplicate_date", again), ("return_spike_gt_35pct", spike(close, before, most)), ("zero_candle", zero), ("basic_invalid_or_low_liquidity", basic)]
    out = bars.withColumn("reason", _reasons(rules))
    return out.drop("last_close") if last_close is not None else out


def bars_refined(bars: DataFrame) -> DataFrame:
    """Bad rows first, then all but the last row of a day among the others; no rule on returns."""
    o, h, l, c, v = (F.col(x) for x in (*OHLC, "volume"))
    rules = [("missing_value", F.col("date").isNull() | o.isNull() | h.isNull() | l.isNull() | c.isNull() | v.isNull()), ("nonpositive_close", c <= 0), ("high_below_low", h < l), ("high_below_close", h < c), ("low_above_close", l > c), ("zero_candle", (o <= 0) & (h <= 0) & (l <= 0) & (v > 0))]
    checked = bars.withColumn("bad", _reasons(rules))
    day = Window.partitionBy("symbol", "date", F.col("bad").isNull()).orderBy(F.desc("row_no"))
    return checked.withColumn("reason", F.coalesce("bad", F.when(F.row_number().over(day) > 1, "duplicate_date"))).drop("bad")


def without_bad_days(bars: DataFrame, checked: DataFrame) -> DataFrame:
    """Bars of days on which a symbol has no bad row."""
    return bars.join(checked.where("reason is not null").select("symbol", "date").distinct(), ["symbol", "date"], "left_anti")


def on_good_days(checked: DataFrame) -> DataFrame:
    """Checked bars of days on which a symbol has no bad row, as ``without_bad_days`` of the bars themselves; rows that lie by symbol stay there. What has no day or symbol stays too."""
    bad = F.bool_or(F.col("reason").isNotNull()).over(Window.partitionBy("symbol", "date"))
    return checked.withColumn("_bad", bad).where(~F.col("_bad") | F.col("date").isNull() | F.col("symbol").isNull()).drop("_bad", "reason")


def flows_checked(flows: DataFrame, numbers: Sequence[str] = ("inst", "corp", "indiv", "foreign", "total"), strict: bool = True) -> DataFrame:
    """Strict: any missing number is bad and a day's first row counts, over all rows; else: all missing, and the last good row counts."""
    if strict:
        again = F.row_number().over(Window.partitionBy("symbol", "date").orderBy("row_no")) > 1
        missing = F.col("date").isNull()
        for c in numbers:
            missing = missing | F.col(c).isNull()
        return flows.withColumn("reason", _reasons([("duplicate_date", again), ("missing_value", missing)]))
    missing = F.col("date").isNull() | F.coalesce(*numbers).isNull()
    checked = flows.withColumn("bad", F.when(missing, "missing_value"))
    day = Window.partitionBy("symbol", "date", F.col("bad").isNull()).orderBy(F.desc("row_no"))
    return checked.withColumn("reason", F.coalesce("bad", F.when(F.row_number().over(day) > 1, "duplicate_date"))).drop("bad")


def filings_checked(filings: DataFrame) -> DataFrame:
    """First reason wins: date, name, number, identity, then all but the last row of a number. ``rcept_dt`` becomes a date."""
    f = without_null_words(filings, ["corp_code", "report_nm", "rcept_no", "rcept_dt", "stock_code"])
    last = F.row_number().over(Window.partitionBy("rcept_no").orderBy(F.desc("row_no"))) == 1
    day = to_day("rcept_dt")
    rules = [("invalid_rcept_dt", day.isNull()), ("missing_report_nm", F.col("report_nm").isNull()), ("missing_rcept_no", F.col("rcept_no").isNull()), ("missing_corp_or_stock_code", F.col("corp_code").isNull() & F.col("stock_code").isNull()), ("duplicate_rcept_no", F.col("rcept_no").isNotNull() & ~last)]
    return f.withColumn("reason", _reasons(rules)).withColumn("rcept_dt", day)


def items_checked(items: DataFrame) -> DataFrame:
    """Any table of texts: a date that doesn't parse, nothing in title, body and url, repeated identifiers or (date, title)."""
    rules = []
    date = next((c for c in ("published_at", "published", "datetime", "timestamp", "date") if c in items.columns), None)
    if date:
        rules.append((f"invalid_{date}", F.col(date).try_cast("timestamp").isNull()))
    groups = (("title", "headline", "subject"), ("body", "content", "text", "summary", "description"), ("url", "link", "href"))
    texts = [c for c in (first_present(items, g) for g in groups) if c is not None]
    if texts:
        rules.append(("missing_title_body_url", F.coalesce(*[c.cast("string") for c in texts]).isNull()))
    key = next((c for c in ("id", "post_id", "message_id", "url", "link") if c in items.columns), None)
    title = first_present(items, groups[0])
    if key:
        last = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("row_no"))) == 1
        rules.append((f"duplicate_{key}", F.col(key).isNotNull() & ~last))
    elif date and title is not None:
        rules.append(("duplicate_date_title", F.row_number().over(Window.partitionBy(F.col(date), title).orderBy(F.desc("row_no"))) > 1))
    return items.withColumn("reason", _reasons(rules))


def listed(universe: DataFrame, markets: Sequence[str] = ("KOSPI", "KOSDAQ", "KOSDAQ GLOBAL"), ids: Sequence[str] = ("STK", "KSQ")) -> DataFrame:
    """Distinct six-digit codes on some markets; where no market is given, by market identifier."""
    on = F.when(F.col("market").isNotNull(), F.col("market").isin(*markets)).otherwise(F.col("market_id").isin(*ids))
    return universe.where(on).select(F.lpad(F.trim("code"), 6, "0").alias("code")).distinct()


def tradable(universe: DataFrame) -> DataFrame:
    """Codes of six digits on a KOSPI or KOSDAQ market with a positive close and volume; a code's first row by name."""
    code, close, volume = F.lpad(F.trim("code"), 6, "0"), to_number("close"), to_number("volume")
    ok = code.rlike(r"^\d{6}$") & (F.col("market").startswith("KOSPI") | F.col("market").startswith("KOSDAQ")) & (close > 0) & (volume > 0)
    rows = universe.where(ok).select(code.alias("code"), "name", "market", close.alias("close"), volume.alias("volume"))
    return rows.withColumn("rn", F.row_number().over(Window.partitionBy("code").orderBy("name"))).where("rn = 1").drop("rn")


def counters(checked: DataFrame, group: str | Column) -> DataFrame:
    """Rows, clean and bad rows, and the clean ratio of each group (6 places, 0 where there is nothing)."""
    clean = F.count_if(F.col("reason").isNull())
    return checked.groupBy(group).agg(F.count("*").alias("rows"), clean.alias("clean_rows"), F.count_if(F.col("reason").isNotNull()).alias("bad_rows"), F.coalesce(F.round(F.try_divide(clean, F.count("*")), 6), F.lit(0.0)).alias("clean_ratio"))


def anomalies(counts: DataFrame, group: str, most: float = 0.30, more_than: int = 10) -> DataFrame:
    """One row a group and rule: full_quarantine, high_bad_ratio (with more than so many rows), empty_input."""
    bad = F.col("bad_rows") / F.nullif(F.col("rows"), F.lit(0))
    rules = F.array_compact(F.array(F.when((F.col("rows") > 0) & (F.col("clean_rows") == 0), "full_quarantine"), F.when((bad > most) & (F.col("rows") > more_than), "high_bad_ratio"), F.when(F.col("rows") == 0, "empty_input")))
    return counts.select(group, F.explode(rules).alias("anomaly"))
