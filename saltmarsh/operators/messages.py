"""Validators of texts with header lines (blogs, message logs, premium articles) and of article rows; what their headers say.

All are columns over whole texts: a reason, null for good ones, and the cleaned text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as X

# Least lengths, and lines that are no content.
BLOG_LEAST, MESSAGE_LEAST, PREMIUM_LEAST, ARTICLE_LEAST, SHORT_LEAST, TEXT_LEAST = 80, 60, 100, 80, 45, 10
BLOG_MARKERS = ("본문 바로가기", "카테고리 이동", "검색", "my메뉴 열기", "메뉴 바로가기", "이 블로그")
PREMIUM_MARKERS = ("disclaimer", "본 포스팅에 수록된 내용은", "매수/매도 추천", "투자 결과에 대한 법적 책임소재", "별도의 투자 상담", "구독자 여러분 스스로 공부")
BLOG_SKIPPED = (r"^#\s+", r"^(Date|PublishedDate|Source|LinkEnriched|CanonicalURLs)\s*:", r"^---$")
MESSAGE_SKIPPED = (r"^#\s+", r"^(Date|Source|LinkEnriched|CanonicalURLs)\s*:", r"^---$", r"^Post(ID|Date|DateTime)?\s*:", r"^MessageID\s*:\s*\d+", r"^Forwarded from\s*:")
ATTACHED = r"(?is)\[ATTACH_TEXT\]\s*(.*?)\s*\[/ATTACH_TEXT\]"
RESIDUE = (
    r"^\[/?MEDIA\].*$",
    r"^\[ATTACH_[A-Z0-9_]+\].*$",
    r"^\[ENTITY_URL\].*$",
    r"^\[MIME\].*$",
    r"^\[FILE_SIZE\].*$",
    r"^\[FILE_NAME\].*$",
    r"^\[NO_TEXT_OR_MEDIA_METADATA\].*$",
    r"^Forwarded from\s*:.*$",
    r"^Views\s*:\s*\d+.*$",
    r"^Forwards\s*:\s*\d+.*$",
    r"^GroupedID\s*:\s*\d+.*$",
)
FINANCE = r"(?i)(실적|매출|이익|가이던스|밸류|PER|PBR|수주|계약|리스크|주가|상승|하락|증가|감소|투자|업황|현금흐름|capex|margin|guidance|earnings|revenue|profit|order|risk)"
PAYWALLED = ("paywall", "subscription", "session", "blocked")
LINE_ENDS = r"\R|[\x1c-\x1e]"


def _text(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def _once(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often and in whatever branches f names it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def _lines(c: Column | str) -> Column:
    return F.split(_text(c), LINE_ENDS)


def _one_of(line: Column, patterns: Sequence[str]) -> Column:
    return line.rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns))


def effective_lines(c: Column | str, skipped: Sequence[str] = (), markers: Sequence[str] = ()) -> Column:
    """The lines that are content: not blank, no attachment mark, none of the patterns, without a marker in them."""
    mine = (r"^\[/?ATTACH_TEXT\]$", r"^\[ATTACH_TEXT_STATUS\]", *skipped)
    lines = F.filter(F.transform(_lines(c), lambda x: F.trim(x)), lambda s: (s != "") & ~_one_of(s, mine) & ~X.any_of(F.lower(s), markers))
    return F.array_join(lines, "\n")


def effective(c: Column | str, skipped: Sequence[str] = (), markers: Sequence[str] = ()) -> Column:
    """Content without URLs and markup."""
    return X.without_markup(effective_lines(c, skipped, markers))


def meaningful_short(c: Column) -> Column:
    """At least 45 characters with letters, the end of a sentence or a line, and a word of finance."""
    t = F.trim(c)
    return (F.length(t) >= SHORT_LEAST) & t.rlike("[A-Za-z가-힣]") & t.rlike("[.!?]|\n") & t.rlike(FINANCE)


def _bad_body(body: Column, least: int, empty: str, short: str) -> Column:
    """Null where the body is long enough or meaningful."""
    return _once(body, lambda b: F.when((F.length(b) < least) & ~meaningful_short(b), F.when(F.trim(b) == "", empty).otherwise(short)))


def blog_reason(c: Column | str) -> Column:
    t = _text(c)
    told = t.rlike(r"(?mi)^(Date|PublishedDate)\s*:\s*.+$") & t.rlike(r"(?mi)^Source\s*:\s*https?://\S+")
    return F.when(~told, "blog_missing_required_metadata").otherwise(_bad_body(effective(t, BLOG_SKIPPED, BLOG_MARKERS), BLOG_LEAST, "blog_effective_body_empty", "blog_effective_body_too_short"))


def message_reason(c: Column | str) -> Column:
    """Messages one a file (with source and post header) or from a log (with log header and message number)."""
    t = _text(c)
    single = t.rlike(r"(?mi)^Source\s*:\s*https?://\S+") & t.rlike(r"(?mi)^Post(ID|Date|DateTime)?\s*:")
    logged = t.rlike(r"(?mi)^#\s*Telegram\s+Log\s*:") & t.rlike(r"(?mi)^MessageID\s*:\s*\d+")
    told = t.rlike(r"(?mi)^Date\s*:\s*.+$") & (single | logged)
    return F.when(~told, "telegram_missing_required_metadata").otherwise(_bad_body(effective(t, MESSAGE_SKIPPED), MESSAGE_LEAST, "telegram_effective_body_empty", "telegram_effective_body_too_short"))


def premium_reason(c: Column | str) -> Column:
    t = _text(c)
    status = F.upper(F.trim(F.regexp_extract(t, r"(?mi)^-\s*Status\s*:\s*(.+)$", 1)))
    why = F.lower(F.trim(F.regexp_extract(t, r"(?mi)^-\s*Reason\s*:\s*(.+)$", 1)))
    told = t.rlike(r"(?mi)^-\s*URL\s*:\s*https?://\S+") & t.rlike(r"(?mi)^-\s*PublishedAt\s*:\s*.+$") & t.rlike(r"(?mi)^-\s*Status\s*:\s*.+$")
    body = effective(F.coalesce(F.get(F.split(t, r"(?mi)^##\s*본문\s*$", 2), F.lit(1)), F.lit("")), (), PREMIUM_MARKERS)
    bad = _bad_body(body, PREMIUM_LEAST, "premium_effective_body_empty_or_boilerplate", "premium_effective_body_too_short")
    return F.when(~told, "premium_missing_required_metadata").when(~status.isin("SUCCESS", "OK"), F.concat(F.lit("premium_bad_status_"), status)).when(X.any_of(why, PAYWALLED), "premium_paywall_or_blocked_reason").otherwise(bad)


def article_reason(url: Column | str, title: Column | str, date: Column, summary: Column | str, body: Column | str) -> Column:
    """Of article rows: URL, title and date that read as such, and enough text in summary and body together."""
    parts = F.array_join(F.filter(F.array(F.trim(_text(summary)), F.trim(_text(body))), lambda x: x != ""), "\n")
    t = X.without_markup(parts)
    return (
        F.when(X.canonical_url(url) == "", "selected_articles_missing_url")
        .when(F.trim(_text(title)) == "", "selected_articles_missing_title")
        .when(date.isNull(), "selected_articles_missing_published_date")
        .when((F.length(t) < ARTICLE_LEAST) & ~meaningful_short(t), "selected_articles_effective_body_too_short")
    )


def attached_text(c: Column | str) -> Column:
    """What stands in attachment blocks, one below the other."""
    found = F.transform(F.regexp_extract_all(_text(c), F.lit(ATTACHED), 1), lambda x: F.trim(x))
    return F.array_join(F.filter(found, lambda x: x != ""), "\n")


def without_residue(c: Column | str) -> Column:
    """A text without attachment blocks and the lines that describe attachments; at most one empty line in a row, one line end at the end."""
    lines = F.split(F.regexp_replace(_text(c), ATTACHED, "\n"), LINE_ENDS)
    kept = F.transform(F.filter(lines, lambda s: ~_one_of(F.trim(s), RESIDUE)), lambda x: F.rtrim(x))
    out = F.regexp_replace(F.regexp_replace(F.array_join(kept, "\n"), "\n{3,}", "\n\n"), r"^\s+|\s+$", "")
    return _once(out, lambda x: F.when(x != "", F.concat(x, F.lit("\n"))).otherwise(""))


def text_reason(c: Column | str, kind: Column) -> Column:
    """The reason for a raw text of kind blog, telegram, premium or another (which has no rules but the least length)."""
    by_kind = _once(without_residue(c), lambda t: F.when(kind == "blog", blog_reason(t)).when(kind == "telegram", message_reason(t)).when(kind == "premium", premium_reason(t)))
    return F.when(F.length(F.regexp_replace(_text(c), r"^\s+|\s+$", "")) < TEXT_LEAST, "text_too_short").otherwise(by_kind)


def _first(c: Column, patterns: Sequence[str]) -> Column:
    return F.coalesce(*[F.nullif(F.trim(F.regexp_extract(c, p, 1)), F.lit("")) for p in patterns])


def title_of(c: Column | str) -> Column:
    """The title line, else the first heading; null without."""
    return _first(_text(c), (r"(?mi)^Title\s*:\s*(.+)$", r"(?mi)^#\s+(.+?)\s*$"))


def date_of(c: Column | str) -> Column:
    """The date in a header line, else in a list line, that parses."""
    t = _text(c)
    return F.coalesce(*[X.any_date(F.regexp_extract(t, p, 1)) for p in (r"(?mi)^(?:Date|PublishedDate|PostDate|PostDateTime)\s*:\s*(.+)$", r"(?mi)^-\s*(?:PublishedAt|Date)\s*:\s*(.+)$")])


def urls_of(c: Column | str) -> Column:
    """Distinct canonical URLs of the header lines, in order."""
    t = _text(c)
    found = F.concat(*[F.regexp_extract_all(t, F.lit(p), 1) for p in (r"(?mi)^(?:Source|URL|CanonicalURL)\s*:\s*(https?://\S+)\s*$", r"(?mi)^-\s*(?:URL|CanonicalURL)\s*:\s*(https?://\S+)\s*$")])
    return F.array_distinct(F.filter(F.transform(found, lambda u: X.canonical_url(u)), lambda u: u != ""))
