"""Records for analysis from seven kinds of sources, and what is read from macro series and portfolio snapshots.

A record has record_id, published_at, symbols, text, source, source_family and content_fingerprint, whatever it was made from; the
sources' records are one union.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.claims import RISK_OFF, RISK_ON
from ..operators import messages

# Least lengths of texts, series of the macro summary, placeholders.
MESSAGE_LEAST, ARTICLE_LEAST = 20, 30
ON_SERIES, OFF_SERIES = ("SPY", "QQQ", "SOX"), ("VIX", "DXY", "TNX", "IRX")
NO_SYMBOL, MACRO = "__NOSYMBOL__", "__MACRO__"
ORDER = ("dart", "rss", "macro", "text_telegram", "text_blog", "text_premium", "market_selected_articles")
COLUMNS = ("record_id", "published_at", "symbols", "text", "source", "source_family", "content_fingerprint")


def _record(rows: DataFrame, record_id: Column, published: Column, symbols: Column, text: Column, source: Column, family: Column | str) -> DataFrame:
    family = F.lit(family) if isinstance(family, str) else family
    return rows.select(record_id.alias("record_id"), published.alias("published_at"), symbols.alias("symbols"), text.alias("text"), source.alias("source"), family.alias("source_family"), X.record_fingerprint(text).alias("content_fingerprint"))


def _joined(sign: str, *parts: str) -> Column:
    """Trimmed parts that aren't empty, with a sign between."""
    return F.trim(F.array_join(F.filter(F.array(*[F.trim(F.coalesce(p, F.lit(""))) for p in parts]), lambda x: x != ""), sign))


def _short_id(*parts: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws(":", *parts)), 1, 20)


def from_filings(rows: DataFrame, now: Column) -> DataFrame:
    """Filings (rcept_no, rcept_dt yyyyMMdd, corp_name, report_nm, stock_code, row_no) of listed companies with a text."""
    code, text = X.six_digits("stock_code"), _joined(" ", "corp_name", "report_nm")
    day = F.when(F.trim("rcept_dt").rlike(r"^\d{8}$"), F.regexp_replace(F.trim("rcept_dt"), r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3T15:30:00+09:00"))
    number = F.coalesce(F.nullif(F.trim("rcept_no"), F.lit("")), F.concat(F.lit("dart-row-"), F.col("row_no").cast("string")))
    good = rows.where((F.coalesce(code, F.lit("")) != "") & (code != "000000") & (text != ""))
    return _record(good, F.concat(F.lit("dart:"), number), F.coalesce(day, now), F.array(code), text, F.lit("dart"), "dart")


def is_macro(text: Column) -> Column:
    """Whether a text has a word of risk taken or shunned."""
    return X.any_of(F.lower(F.coalesce(text, F.lit(""))), (*RISK_ON, *RISK_OFF))


def with_keyword(items: DataFrame, keywords: Sequence[str], columns: Sequence[str] = ("title", "summary")) -> DataFrame:
    """Items with a keyword in one of the columns; all without keywords."""
    text = F.lower(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in columns]))
    return items.where(X.any_of(text, keywords)) if keywords else items


def since(items: DataFrame, published: str, now: Column, days: int) -> DataFrame:
    """Items published within so many days before ``now``; all for no days. An unreadable time is out."""
    return items.where(F.col(published).try_cast("timestamp") >= now.cast("timestamp") - F.make_dt_interval(F.lit(days))) if days > 0 else items


def first_messages(logs: DataFrame, most: int) -> DataFrame:
    """path, place, date_text, body of each log's first messages; a log without dated parts is one message without date."""
    parts = F.split("text", r"\n---\s*\nDate:\s*", -1)
    several = F.size(parts) > 1
    found = F.when(several, F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(1)))).otherwise(F.array("text"))
    rows = logs.select("path", several.alias("dated"), F.posexplode(F.slice(found, 1, max(1, most))).alias("place", "m"))
    head = F.substring_index("m", "\n", 1)
    return rows.select("path", "place", F.when(F.col("dated"), F.trim(head)).otherwise("").alias("date_text"), F.trim(F.when(F.col("dated"), F.substring("m", F.length(head) + 2, F.lit(1 << 30))).otherwise(F.col("m")), F.lit(" \n\t\r")).alias("body"))


def from_feed(items: DataFrame, now: Column) -> DataFrame:
    """Feed entries (feed, place, stem, title, summary, published, published_date, symbols): with a symbol, or about macro news."""
    text = _joined("\n", "title", "summary")
    rows = items.withColumns({"text": text, "real": F.size("symbols") > 0}).where("text <> ''").where(F.col("real") | is_macro(F.col("text")))
    when = F.coalesce(F.nullif(F.trim("published"), F.lit("")), F.concat(F.nullif(F.trim("published_date"), F.lit("")), F.lit("T09:00:00+09:00")), now)
    kind = F.when(F.col("real"), "rss").otherwise("rss_macro")
    number = F.concat_ws(":", F.lit("rss"), "stem", "feed", F.col("place").cast("string"))
    return _record(rows, number, when, F.when(F.col("real"), F.col("symbols")).otherwise(F.array(F.lit(MACRO))), F.col("text"), F.concat(kind, F.lit(":"), F.col("feed")), F.when(F.col("real"), "news_rss").otherwise("news_rss_macro"))


def macro_summary(latest: DataFrame) -> DataFrame:
    """risk_on, risk_off, word, text and day of the newest values (symbol, date, change_1d) of macro series, in order of symbol.

    Rising shares speak for risk taken, rising fear, dollar and yields against it. One row, none for no series; the text lists twelve.
    """
    up, down = F.col("change_1d") > 0, F.col("change_1d") < 0
    on = F.count_if((F.col("symbol").isin(*ON_SERIES) & up) | (F.col("symbol").isin(*OFF_SERIES) & down))
    off = F.count_if((F.col("symbol").isin(*ON_SERIES) & down) | (F.col("symbol").isin(*OFF_SERIES) & up))
    ranked = latest.withColumn("change_1d", F.coalesce("change_1d", F.lit(0.0))).orderBy("symbol")
    listed = ranked.limit(12).agg(F.array_sort(F.collect_list(F.concat("symbol", F.lit(":"), F.format_string("%+.4f", "change_1d")))).alias("parts"))
    counts = ranked.agg(on.alias("risk_on"), off.alias("risk_off"), F.max("date").alias("day"), F.count("*").alias("series")).where("series > 0")
    word = F.when(F.col("risk_on") > F.col("risk_off"), "risk-on").when(F.col("risk_on") < F.col("risk_off"), "risk-off").otherwise("neutral")
    text = F.concat(F.lit("macro summary "), F.col("word"), F.lit(", risk_on="), F.col("risk_on").cast("string"), F.lit(", risk_off="), F.col("risk_off").cast("string"), F.lit(", signals="), F.array_join("parts", ", "))
    return counts.crossJoin(F.broadcast(listed)).withColumn("word", word).select("risk_on", "risk_off", "word", text.alias("text"), "day")


def from_macro(latest: DataFrame) -> DataFrame:
    rows = macro_summary(latest).withColumn("at", F.concat(F.col("day").cast("string"), F.lit("T15:30:00+09:00")))
    return _record(rows, F.concat(F.lit("macro:"), _short_id(F.lit("macro_summary"), F.col("at"), F.col("text"))), F.col("at"), F.array(F.lit(MACRO)), F.col("text"), F.lit("rss_macro:market_macro"), "news_rss_macro")


def from_texts(rows: DataFrame, kind: str, least: int, with_nosymbol: bool) -> DataFrame:
    """Records of texts (stem, published_at, symbols, text) of a kind: text_telegram, text_blog, text_premium, market_selected_articles.

    A text without symbols is left out, or marked so. Undated and short texts are left out.
    """
    t = F.trim(F.regexp_replace("text", "\n{3,}", "\n\n"), F.lit(" \n\t\r"))
    rows = rows.withColumns({"text": t, "real": F.size("symbols") > 0}).where((F.length("text") >= least) & F.col("published_at").isNotNull())
    if not with_nosymbol:
        rows = rows.where("real")
    family = F.when(F.col("real"), kind).otherwise(f"{kind}_nosymbol")
    number = F.concat(F.lit(f"{kind}:"), _short_id(F.col("stem"), F.col("published_at"), F.substring("text", 1, 160), family))
    return _record(rows, number, F.col("published_at"), F.when(F.col("real"), F.col("symbols")).otherwise(F.array(F.lit(NO_SYMBOL))), F.col("text"), F.concat(F.lit(kind.replace("text_", "text/")), F.lit(":"), F.col("stem")), family)


def united(parts: dict[str, DataFrame]) -> DataFrame:
    """The records of all sources, the first of those with one record_id, then of those with one fingerprint, in order of the sources."""
    rows = reduce(DataFrame.unionByName, [df.select(*COLUMNS).withColumn("_o", F.lit(ORDER.index(n))) for n, df in parts.items()])
    for key in ("record_id", "content_fingerprint"):
        first = F.row_number().over(Window.partitionBy(key).orderBy("_o", "record_id", "text"))
        rows = rows.withColumn("_r", first).where("_r = 1").drop("_r")
    return rows.drop("_o")


def regime(latest: DataFrame) -> DataFrame:
    """vix, sox and dxy as labels, and regime and confidence, of the newest values (symbol, close, change_5d). Missing series are calm ones at 20 or 0."""
    def of(symbol: str, column: str, otherwise: float) -> Column:
        return F.coalesce(F.max(F.when(F.col("symbol") == symbol, F.col(column))), F.lit(otherwise))

    one = latest.agg(of("VIX", "close", 20.0).alias("v"), of("SOX", "change_5d", 0.0).alias("s"), of("DXY", "change_5d", 0.0).alias("d"))
    labels = one.select(
        F.when(F.col("v") > 30, "high_fear").when(F.col("v") > 20, "elevated").otherwise("calm").alias("vix"),
        F.when(F.col("s") > 0.05, "bullish").when(F.col("s") < -0.05, "bearish").otherwise("neutral").alias("sox"),
        F.when(F.col("d") > 0.02, "strong_dollar").when(F.col("d") < -0.02, "weak_dollar").otherwise("stable").alias("dxy"),
    )

    def counted(*names: str) -> Column:
        return sum((F.col(c).isin(*names).cast("int") for c in ("vix", "sox", "dxy")), F.lit(0))

    fear, greed = counted("high_fear", "bearish", "strong_dollar"), counted("calm", "bullish", "weak_dollar")
    return labels.select("*", F.when(fear >= 2, "risk_off").when(greed >= 2, "risk_on").otherwise("mixed").alias("regime"), F.when(fear >= 2, fear / 3).when(greed >= 2, greed / 3).otherwise(0.5).alias("confidence"))


def snapshot_rows(snapshots: DataFrame, text: str = "snapshot") -> DataFrame:
    """snapshots with place, name and weight: one row for each part ``name 41.4%, 20d`` between semicolons; other parts are left out."""
    pattern = r"^(.*?)\s([0-9.]+)%(?:,\s*\d+d)?$"
    rows = snapshots.select("*", F.posexplode(F.split(F.coalesce(text, F.lit("")), ";")).alias("place", "part")).withColumn("part", F.trim("part")).where(F.col("part").rlike(pattern))
    return rows.withColumns({"name": F.trim(F.regexp_extract("part", pattern, 1)), "weight": F.regexp_extract("part", pattern, 2).try_cast("double")}).drop("part", text)


def weight_changes(snapshots: DataFrame, keys: Sequence[str] = (), order: str = "date") -> DataFrame:
    """keys, order, name, kind (new, more, less, out), points: each snapshot against the one before; changes below 0.05 points don't count."""
    keys = list(keys)
    rows = snapshot_rows(snapshots).groupBy(*keys, order, "name").agg(F.max_by("weight", "place").alias("weight"))
    steps = rows.select(*keys, order).distinct().withColumn("next", F.lead(order).over(Window.partitionBy(*keys).orderBy(order)))
    before = rows.join(steps, [*keys, order]).where("next is not null").select(*keys, F.col("next").alias(order), "name", F.col("weight").alias("old"))
    first = steps.groupBy(*keys).agg(F.min(order).alias("first")) if keys else steps.agg(F.min(order).alias("first"))
    both = rows.join(before, [*keys, order, "name"], "full")
    both = both.join(first, keys) if keys else both.crossJoin(F.broadcast(first))
    diff = F.col("weight") - F.col("old")
    kind = F.when(F.col("old").isNull(), "new").when(F.col("weight").isNull(), "out").when(diff >= 0.05, "more").when(diff <= -0.05, "less")
    points = F.coalesce(F.abs(diff), F.col("weight"), F.col("old"))
    return both.where(F.col(order) > F.col("first")).select(*keys, order, "name", kind.alias("kind"), points.alias("points")).where("kind is not null")


def messages_of(files: DataFrame, kind: str) -> DataFrame:
    """stem, published_at, text of single texts (path, text) whose headers name a date; the text is what follows the header lines."""
    clean = messages.without_residue("text")
    skipped = messages.BLOG_SKIPPED if kind == "text_blog" else messages.MESSAGE_SKIPPED
    return files.select(F.regexp_extract("path", r"([^/]*?)(\.[^./]*)?$", 1).alias("stem"), messages.date_of("text").cast("string").alias("published_at"), messages.effective_lines(clean, skipped).alias("text"))
