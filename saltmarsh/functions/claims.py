"""Claim cards of texts: events, tags, scores on four axes, confidence and weight.

The word lists are parameters with defaults; the formulas are written over columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as X

# Word lists, by meaning.
UPSIDE = ("성장", "개선", "확대", "수주", "계약", "흑자", "상향", "반등", "증가", "회복", "신제품", "점유율", "가이던스", "성공", "강세", "growth", "improve", "expand", "order", "beat", "upgrade", "strong", "recovery", "guidance", "share gain", "launch")
DOWNSIDE = ("감소", "부진", "하락", "적자", "둔화", "악화", "소송", "분쟁", "유상증자", "리스크", "규제", "지연", "차질", "정정", "우려", "decline", "weak", "drop", "loss", "lawsuit", "dispute", "dilution", "downgrade", "risk", "regulation", "delay", "concern")
LASTING = ("지속", "장기", "반복", "연속", "누적", "중장기", "pipeline", "recurring", "long-term", "backlog", "구조적", "계속")
PASSING = ("일회성", "단기", "일시", "변동성", "불확실", "temporary", "one-off", "volatile", "uncertain", "반짝", "소멸")
EVENTS = {
    "order": ("수주", "공급계약", "단일판매", "계약체결", "수주계약", "판매계약"),
    "rights_issue": ("유상증자", "증자", "전환사채", "cb", "bw", "신주발행", "희석"),
    "lawsuit": ("소송", "피소", "판결", "항소", "가처분", "분쟁"),
    "guidance": ("가이던스", "실적전망", "전망치", "컨센서스", "잠정실적", "실적발표"),
}
RISK_ON = ("완화", "인하", "랠리", "상승", "회복", "risk-on", "risk on", "soft landing", "stimulus", "easing")
RISK_OFF = ("긴축", "인상", "침체", "전쟁", "관세", "하락", "위기", "리스크오프", "risk-off", "risk off", "recession", "conflict", "sanction")
# Each family's reliability, base fit, target length and number of chunks.
FAMILIES = {
    "dart": (1.00, 0.92, 220, 1),
    "news_rss": (0.94, 0.76, 420, 2),
    "news_rss_macro": (0.94, 0.66, 420, 2),
    "market_selected_articles": (0.91, 0.80, 650, 4),
    "text_telegram": (0.68, 0.62, 700, 4),
    "text_blog": (0.72, 0.68, 750, 5),
    "text_premium": (0.84, 0.82, 750, 5),
    "text_image_map": (0.58, 0.58, 550, 3),
    "text_images_ocr": (0.55, 0.56, 500, 3),
    "other": (0.55, 0.55, 650, 4),
}
EVENT_FAMILIES = ("dart", "news_rss", "news_rss_macro", "market_selected_articles", "text_premium", "text_blog", "text_telegram")
STOPWORDS = ("the", "and", "for", "with", "from", "that", "this", "into", "after", "before", "about", "market", "stock", "company", "기업", "시장", "투자", "기사", "뉴스", "증권", "대한", "관련", "에서", "으로", "하는")
AXES = ("upside", "downside", "bm", "persistence")


def of_family(family: Column, at: int) -> Column:
    out = F.lit(FAMILIES["other"][at])
    for name, values in FAMILIES.items():
        out = F.when(family == name, values[at]).otherwise(out)
    return out


def family_of(source: Column | str) -> Column:
    """A known family (without ``_nosymbol``), else by the source's beginning, else other."""
    s = F.regexp_replace(F.lower(F.trim(source)), "_nosymbol$", "")
    out = F.lit("other")
    for name in sorted(FAMILIES, key=len):
        out = F.when(s.startswith(name), name).otherwise(out)
    return out


def chunked(records: DataFrame) -> DataFrame:
    """records (with family, text) with chunk_id and chunk_text, one row a chunk."""
    cut = X.chunks("text", of_family(F.col("family"), 2), of_family(F.col("family"), 3), F.col("family") == "dart")
    return records.select("*", F.posexplode(cut).alias("chunk_id", "chunk_text"))


def with_events(cards: DataFrame, text: str = "chunk_text", events: dict = EVENTS) -> DataFrame:
    low, known = F.lower(F.coalesce(F.col(text), F.lit(""))), F.col("family").isin(*EVENT_FAMILIES)
    return cards.withColumns({f"event_{name}": (known & X.any_of(low, words)).cast("int") for name, words in events.items()})


def macro_risk(text: Column | str) -> Column:
    """score in +-1 and the numbers of distinct risk-on and risk-off terms."""
    low = F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))
    on, off = X.distinct_of(low, RISK_ON), X.distinct_of(low, RISK_OFF)
    return F.struct(F.when(on + off > 0, (on - off) / (on + off)).otherwise(0.0).alias("score"), on.alias("on"), off.alias("off"), (on + off > 0).alias("signal"))


def evidence(text: Column | str, keywords=(*UPSIDE, *DOWNSIDE, *LASTING, *PASSING), most: int = 260) -> Column:
    """The first sentence with a strong word, else the first, at most 260 characters."""
    c = F.col(text) if isinstance(text, str) else text
    parts = F.flatten(F.transform(F.split(F.coalesce(c, F.lit("")), r"\n+"), X.sentences))
    strong = F.filter(parts, lambda s: X.any_of(F.lower(s), keywords))
    return F.substring(F.coalesce(F.get(strong, F.lit(0)), F.get(parts, F.lit(0)), c), 1, most)


def scored(cards: DataFrame, text: str = "chunk_text", upside=UPSIDE, downside=DOWNSIDE, lasting=LASTING, passing=PASSING) -> DataFrame:
    """cards with upside, downside, bm, persistence (0 to 100), dominant_axis, confidence and weight."""
    # a column of its own: an expression within functions over arrays would be computed for each of them
    cards = cards.withColumn("_tokens", X.tokens(text))
    toks = F.col("_tokens")

    def met(words) -> Column:
        return F.size(F.filter(toks, lambda t: t.isin(*words)))

    c = cards.withColumns({"_n": F.size(toks), "_up": met(upside), "_down": met(downside), "_last": met(lasting), "_pass": met(passing), "_number": F.coalesce(F.col(text).rlike(r"\d"), F.lit(False)).cast("int")})
    up, down, last, passed, number = (F.col(x) for x in ("_up", "_down", "_last", "_pass", "_number"))
    order, rights, suit, guide = (F.col(f"event_{x}") for x in ("order", "rights_issue", "lawsuit", "guidance"))
    one = F.lit(1)
    polarity = (up - down) / F.greatest(up + down, one)
    balance = (last - passed) / F.greatest(last + passed, one)
    density = F.least(F.col("_n"), F.lit(120)) / 120.0
    family = F.col("family")
    events = order + rights + suit + guide
    extra = F.when(family == "dart", 7.0).when(family == "market_selected_articles", 2.0).otherwise(0.0)
    axes = {
        "upside": 50.0 + 22.0 * polarity + 8.0 * F.least(up, F.lit(6)) / 6.0 + 8.0 * order + 4.0 * guide,
        "downside": 50.0 - 20.0 * polarity + 10.0 * F.least(down, F.lit(6)) / 6.0 + 12.0 * rights + 10.0 * suit,
        "bm": 100.0 * of_family(family, 1) + 4.0 * order - 5.0 * rights - 6.0 * suit + 3.0 * number + extra,
        "persistence": 38.0 + 18.0 * balance + 18.0 * density + 4.0 * order + 3.0 * guide - 4.0 * rights - 5.0 * suit + 2.0 * number,
    }
    c = c.withColumns({k: X.clipped(v, 0.0, 100.0) for k, v in axes.items()})
    strength = [F.abs(F.col(a) - 50.0) for a in AXES]
    top = F.greatest(*strength)
    dominant = F.lit(AXES[-1])
    for name, s in list(zip(AXES, strength, strict=True))[::-1]:
        dominant = F.when(s == top, name).otherwise(dominant)
    confidence = X.clipped(0.32 + 0.08 * F.least(up + down + last + passed, F.lit(5)) + 0.10 * events + 0.06 * number, 0.15, 0.98)
    weight = X.clipped(of_family(family, 0) * (0.85 + 0.18 * F.least(events, F.lit(2)) + 0.16 * density + 0.08 * number), 0.20, 2.00)
    return c.withColumns({"dominant_axis": dominant, "confidence": confidence, "weight": weight}).drop("_tokens", "_n", "_up", "_down", "_last", "_pass", "_number")


def cluster_key(cards: DataFrame, text: str = "chunk_text") -> DataFrame:
    """cards with cluster_key (events' names, else the first three telling tokens) and cluster_id (of date, symbol and key)."""
    events = F.array_sort(F.array_compact(F.array(*[F.when(F.col(f"event_{n}") == 1, n) for n in EVENTS])))
    telling = F.slice(F.array_distinct(F.filter(X.tokens(text), lambda t: (F.length(t) >= 2) & ~t.rlike(r"^\d+$") & ~t.isin(*STOPWORDS))), 1, 3)
    key = F.when(F.size(events) > 0, F.array_join(events, "+")).otherwise(F.array_join(telling, "+"))
    c = cards.withColumn("cluster_key", key)
    return c.withColumn("cluster_id", F.substring(F.sha1(F.concat_ws(":", F.col("date").cast("string"), F.col("symbol").cast("string"), "cluster_key")), 1, 16))
