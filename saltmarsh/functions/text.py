"""Text expressions: URLs, HTML, fingerprints, tokens, sentences, chunks. All are columns; none runs Python."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Query parameters that track, by equal name or prefix.
TRACKING = ("utm_", "fbclid", "gclid", "igshid", "ref", "mc_cid", "mc_eid", "spm")
#: What a fingerprint keeps besides blanks.
KEPT = "0-9a-z가-힣"
#: Characters other than those, and other than those and the blank, as ranges: Java takes six times as long for a negated class that goes beyond Latin.
OTHER = r"\x00-\x2F\x3A-\x60\x7B-\x{ABFF}\x{D7A4}-\x{10FFFF}"
OTHER_BUT_BLANKS = OTHER.replace(r"\x00-\x2F", r"\x00-\x1F\x21-\x2F")
WORD = r"[0-9A-Za-z가-힣_\-]+"
#: Named references; numeric ones follow from their numbers.
NAMED = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&"))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def one_space(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(c), r"\s+", " "))


def _quoted(c: Column) -> Column:
    """Percent-encoding as in forms, with ~ plain and * encoded."""
    return F.replace(F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def canonical_url(url: Column | str, tracking: Sequence[str] = TRACKING, force_https: bool = True, keep_blank: bool = False) -> Column:
    """One spelling of a web address, '' for others.

    Lower-case host without default port, user or fragment; single slashes and none at the end of the path; parameters
    without tracking ones (and blank ones, unless kept), decoded, sorted and encoded again.
    """
    raw = F.regexp_replace(F.trim(F.coalesce(_col(url), F.lit(""))), r"""^["'()\[\]{}<>]+|["'()\[\]{}<>]+$""", "")
    pattern = r"(?i)^(https?)://(?:[^/?#@]*@)?([^/?#:]*)(?::(\d*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
    part = [F.regexp_extract(raw, pattern, i) for i in range(6)]
    scheme, host, port, query = F.lower(part[1]), F.lower(part[2]), part[3], part[5]
    default = (port == "") | ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443"))
    path = F.regexp_replace(F.concat(F.lit("/"), part[4]), "/+", "/")
    path = F.when(path != "/", F.regexp_replace(path, "/+$", "")).otherwise(path)

    def decoded(x: Column) -> Column:
        return F.coalesce(F.try_url_decode(x), x)

    pairs = F.transform(F.filter(F.split(query, "&"), lambda p: p != ""), lambda p: F.struct(decoded(F.substring_index(p, "=", 1)).alias("k"), F.when(F.instr(p, "=") > 0, decoded(F.regexp_replace(p, "^[^=]*=", ""))).otherwise(F.lit("")).alias("v")))

    def kept(p: Column) -> Column:
        name = F.lower(F.trim(p["k"]))
        ok = name != ""
        for t in tracking:
            ok = ok & ~name.startswith(t)
        return ok if keep_blank else ok & (p["v"] != "")

    names = F.array_join(F.transform(F.array_sort(F.filter(pairs, kept)), lambda p: F.concat(_quoted(p["k"]), F.lit("="), _quoted(p["v"]))), "&")
    out = F.concat(F.lit("https") if force_https else scheme, F.lit("://"), host, F.when(default, F.lit("")).otherwise(F.concat(F.lit(":"), port)), path, F.when(names != "", F.concat(F.lit("?"), names)).otherwise(F.lit("")))
    return F.when(host != "", out).otherwise(F.lit(""))


def index_url(url: Column | str, tracking: Sequence[str] = TRACKING) -> Column:
    """Another spelling, of link indexes: scheme, user, port, slashes within the path and blank values stay; '' for other addresses."""
    raw = F.trim(F.coalesce(_col(url), F.lit("")))
    part = [F.regexp_extract(raw, r"(?i)^(https?)://([^/?#]+)([^?#]*)(?:\?([^#]*))?", i) for i in range(5)]
    path = F.when(part[3].isin("", "/"), "/").otherwise(F.regexp_replace(part[3], "/+$", ""))

    def decoded(x: Column) -> Column:
        return F.coalesce(F.try_url_decode(x), x)

    def kept(p: Column) -> Column:
        return ~F.lower(p["k"]).isin(*tracking) & ~F.lower(p["k"]).startswith("utm_")

    pairs = F.transform(F.filter(F.split(part[4], "&"), lambda p: p != ""), lambda p: F.struct(decoded(F.substring_index(p, "=", 1)).alias("k"), F.when(F.instr(p, "=") > 0, decoded(F.regexp_replace(p, "^[^=]*=", ""))).otherwise(F.lit("")).alias("v")))
    names = F.array_join(F.transform(F.array_sort(F.filter(pairs, kept)), lambda p: F.concat(_quoted(p["k"]), F.lit("="), _quoted(p["v"]))), "&")
    out = F.concat(F.lower(part[1]), F.lit("://"), F.lower(part[2]), path, F.when(names != "", F.concat(F.lit("?"), names)).otherwise(F.lit("")))
    return F.when(part[2] != "", out).otherwise(F.lit(""))


def excluded(url: Column | str, domains: Sequence[str], patterns: Sequence[str]) -> Column:
    """Below one of the domains, or like one of the patterns: a part of the address, or a glob with * and ? over the whole of it."""
    low = F.lower(F.trim(F.coalesce(_col(url), F.lit(""))))
    out = in_domain(host_of(url), domains)
    for p in patterns:
        glob = "".join({"*": ".*", "?": "."}.get(c, c if c.isalnum() else "\\" + c) for c in p)
        out = out | F.contains(low, F.lit(p)) | low.rlike(f"(?s)^{glob}$")
    return out


def percent(c: Column | str) -> Column:
    """A share as percent with two places; 0 for none."""
    return F.format_string("%.2f%%", F.coalesce(_col(c).cast("double"), F.lit(0.0)) * 100)


def side(c: Column | str) -> Column:
    """BUY or SELL from their synonyms; others in capitals."""
    x = F.upper(F.trim(F.coalesce(_col(c), F.lit(""))))
    return F.when(x.isin("BUY", "B", "매수"), "BUY").when(x.isin("SELL", "S", "매도"), "SELL").otherwise(x)


def note_value(note: Column | str, key: str) -> Column:
    """The value of a note's first line ``key: value``, '' without."""
    return F.trim(F.regexp_extract(F.trim(F.coalesce(_col(note), F.lit(""))), rf"(?m)^{key}:([^\r\n]*)", 1))


def resource_keys(c: Column | str) -> Column:
    """Distinct sorted keys of a comma-separated list, ``repo:global`` for none."""
    parts = F.array_sort(F.array_distinct(F.filter(F.transform(F.split(F.coalesce(_col(c), F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")))
    return F.when(F.size(parts) > 0, F.array_join(parts, ",")).otherwise("repo:global")


def real_symbols(c: Column | str) -> Column:
    """symbols and placeholders (``__X__``) of a list, in capitals, distinct, in order."""
    names = F.array_distinct(F.filter(F.transform(F.coalesce(_col(c), F.array().cast("array<string>")), lambda x: F.upper(F.trim(F.coalesce(x, F.lit(""))))), lambda x: x != ""))

    def placeholder(x: Column) -> Column:
        return x.startswith("__") & x.endswith("__")

    return F.struct(F.filter(names, lambda x: ~placeholder(x)).alias("symbols"), F.filter(names, placeholder).alias("placeholders"))


def host_of(url: Column | str) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(_col(url), r"(?i)^https?://(?:[^/?#@]*@)?([^/?#:]+)", 1)), r"^(www|m)\.", "")


def in_domain(host: Column, domains: Sequence[str]) -> Column:
    out = F.lit(False)
    for d in domains:
        out = out | (host == d) | host.endswith("." + d)
    return out


def allowed_link(url: Column | str, blocked: Sequence[str], allowed: Sequence[str] | None = None) -> Column:
    """Not below a blocked domain, and below an allowed one; without a list of those any host with a dot."""
    host = host_of(url)
    return (host != "") & ~in_domain(host, blocked) & (F.instr(host, ".") > 0 if allowed is None else in_domain(host, allowed))


def fingerprint_text(c: Column | str) -> Column:
    """Lower case, URLs out, other signs to blanks, single blanks."""
    x = F.regexp_replace(F.lower(F.coalesce(_col(c), F.lit(""))), r"https?://\S+", " ")
    # other signs and blanks in one search, as both become one blank
    return F.trim(F.regexp_replace(x, rf"[{OTHER}]+", " "))


def fingerprint(c: Column | str) -> Column:
    return F.sha1(fingerprint_text(c))


def record_text(c: Column | str) -> Column:
    """Another normal form, of records: single blanks first, then other signs, URLs' too, deleted."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(_col(c), F.lit(""))), r"\s+", " "), rf"[{OTHER_BUT_BLANKS}]+", ""))


def record_fingerprint(c: Column | str) -> Column:
    return F.sha1(record_text(c))


def paragraphs(c: Column | str) -> Column:
    """Parts between empty lines; lines, if there is one part only."""
    parts = F.filter(F.split(_col(c), r"\n\s*\n+"), lambda p: F.trim(p) != "")
    return F.when(F.size(parts) > 1, parts).otherwise(F.filter(F.split(_col(c), r"\n+"), lambda p: F.trim(p) != ""))


def content_fingerprints(c: Column | str, least: int = 80) -> Column:
    """Distinct fingerprints of the whole and of its paragraphs, of those with enough normalised characters.

    Parts are normalised once and bound to a name: as white space separates them, the whole is its normalised parts with blanks between.
    """
    normal = F.filter(F.transform(paragraphs(F.coalesce(_col(c), F.lit(""))), fingerprint_text), lambda p: p != "")
    kept = F.flatten(F.transform(F.array(normal), lambda n: F.filter(F.concat(F.array(F.array_join(n, " ")), n), lambda p: F.length(p) >= least)))
    return F.array_distinct(F.transform(kept, F.sha1))


def content_fingerprint_rows(docs: DataFrame, key: str, text: str, least: int = 80) -> DataFrame:
    """key, fingerprint: the same as rows, distinct within a row of docs.

    Parts are normalised once: as white space separates them, the whole is its normalised parts with blanks between.
    """
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), r"\n\s*\n+"), lambda p: F.trim(p) != "").alias("_p")
    lines = F.filter(F.split(F.get("_p", F.lit(0)), r"\n+"), lambda p: F.trim(p) != "")
    rows = docs.select(key, parts).select(key, F.when(F.size("_p") > 1, F.col("_p")).otherwise(lines).alias("_p"))
    normal = rows.select(key, F.filter(F.transform("_p", fingerprint_text), lambda p: p != "").alias("_n"))
    kept = F.filter(F.concat(F.array(F.array_join("_n", " ")), F.col("_n")), lambda p: F.length(p) >= least)
    return normal.select(key, F.explode(F.array_distinct(F.transform(kept, F.sha1))).alias("fingerprint"))


def urls_in(c: Column | str) -> Column:
    """Distinct URLs of a text without punctuation behind them."""
    return F.array_distinct(F.transform(F.regexp_extract_all(_col(c), F.lit(r"https?://[^\s<>\"']+"), 0), lambda u: F.regexp_replace(u, r"[.,;:!?)\]}]+$", "")))


def without_markup(c: Column | str) -> Column:
    """URLs and the signs of light markup out, single blanks."""
    return one_space(F.regexp_replace(F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"https?://\S+", " "), r"[`*_>#\[\]()|]+", " "))


def unescaped(c: Column) -> Column:
    for name, sign in NAMED:
        c = F.replace(c, F.lit(name), F.lit(sign))
    return c


def html_lines(c: Column | str, least: int = 25) -> Column:
    """Lines of a page's text: long enough ones, the first of those with one fingerprint."""
    x = F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"(?is)<(script|style|noscript|iframe|svg).*?>.*?</\1>", " ")
    x = F.regexp_replace(x, r"(?i)<br\s*/?>", "\n")
    x = F.regexp_replace(x, r"(?i)</(p|div|section|article|li|h1|h2|h3|h4|h5|h6)>", "\n")
    x = unescaped(F.regexp_replace(x, r"(?s)<[^>]+>", " "))
    # each step's array is bound to a name once: a lambda that names an expression would work it out again for each line
    lines = F.filter(F.transform(F.split(x, r"[\n\r]"), one_space), lambda s: F.length(s) >= least)
    marked = F.array_sort(F.transform(lines, lambda s, i: F.struct(fingerprint(s).alias("f"), i.alias("i"), s.alias("s"))))
    first = F.flatten(F.transform(F.array(marked), lambda ms: F.filter(ms, lambda m, i: (i == 0) | (F.get(ms, i - 1)["f"] != m["f"]))))
    return F.transform(F.array_sort(F.transform(first, lambda m: F.struct(m["i"].alias("i"), m["s"].alias("s")))), lambda m: m["s"])


def html_text(c: Column | str) -> Column:
    """A page's whole text: its lines, however many."""
    return F.trim(F.array_join(html_lines(c), "\n"))


def tokens(c: Column | str) -> Column:
    return F.transform(F.filter(F.split(F.coalesce(_col(c), F.lit("")), f"[^{WORD[1:-2]}]+"), lambda w: w != ""), F.lower)


def sentences(c: Column | str) -> Column:
    x = one_space(F.coalesce(_col(c), F.lit("")))
    return F.filter(F.transform(F.split(x, r"(?<=[.!?。！？])\s+"), lambda x: F.trim(x)), lambda s: s != "")


def chunks(c: Column | str, target: Column | int, most: Column | int, first_only: Column | None = None) -> Column:
    """Blocks (paragraphs; sentences where there is one) packed in order up to ``target`` characters, cut at 120 more, at most ``most``.

    A block counts one more than its length. ``first_only``: just the text's first ``target`` characters.
    """
    target = F.lit(target) if isinstance(target, int) else target
    most = F.lit(most) if isinstance(most, int) else most
    text = F.trim(F.coalesce(_col(c), F.lit("")))
    blocks = F.filter(F.transform(F.split(text, r"\n\s*\n+"), one_space), lambda b: b != "")
    blocks = F.when(F.size(blocks) > 1, blocks).otherwise(sentences(text))
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("buf"), F.lit(0).alias("n"))

    def add(acc: Column, b: Column) -> Column:
        full = (acc["buf"] != "") & (acc["n"] + F.length(b) + 1 > target)
        return F.struct(F.when(full, F.concat(acc["done"], F.array(acc["buf"]))).otherwise(acc["done"]).alias("done"), F.when(full | (acc["buf"] == ""), b).otherwise(F.concat(acc["buf"], F.lit("\n"), b)).alias("buf"), F.when(full, F.length(b)).otherwise(acc["n"] + F.length(b) + 1).alias("n"))

    packed = F.aggregate(blocks, start, add, lambda s: F.when(s["buf"] != "", F.concat(s["done"], F.array(s["buf"]))).otherwise(s["done"]))
    out = F.slice(F.transform(packed, lambda x: F.substring(x, F.lit(1), target + 120)), F.lit(1), most)
    whole = F.when(text == "", F.array().cast("array<string>")).otherwise(F.array(F.substring(text, F.lit(1), target)))
    return out if first_only is None else F.when(first_only, whole).otherwise(out)


def _plain(keyword: str) -> bool:
    return keyword.isascii() and keyword.isalnum()


def occurrences(text: Column, keyword: str) -> Column:
    """How often a keyword stands in a lower-cased text; ASCII letters and digits count between word boundaries only."""
    if _plain(keyword):
        return F.regexp_count(text, F.lit(rf"(?<![a-z0-9]){keyword}(?![a-z0-9])"))
    # most texts lack most keywords: they aren't copied
    n = ((F.length(text) - F.length(F.replace(text, F.lit(keyword), F.lit("")))) / len(keyword)).cast("int")
    return F.when(F.contains(text, F.lit(keyword)), n).when(text.isNotNull(), 0)


def hits(text: Column, keywords: Sequence[str]) -> Column:
    """How often any of the keywords stands in a lower-cased text. Plain ones never overlap, as each is all that stands between two boundaries, so one search finds all of them."""
    low = [k.lower() for k in keywords]
    plain, out = [k for k in low if _plain(k)], F.lit(0)
    for k in sorted(set(plain)):
        if plain.count(k) > 1:  # a keyword that is given twice counts twice
            out = out + occurrences(text, k) * (plain.count(k) - 1)
    if plain:
        out = out + F.regexp_count(text, F.lit(rf"(?<![a-z0-9])(?:{'|'.join(sorted(set(plain)))})(?![a-z0-9])"))
    for k in low:
        if not _plain(k):
            out = out + occurrences(text, k)
    return out


def any_of(text: Column, keywords: Sequence[str]) -> Column:
    out = F.lit(False)
    for k in keywords:
        out = out | F.contains(text, F.lit(k.lower()))
    return out


def distinct_of(text: Column, keywords: Sequence[str]) -> Column:
    """How many of the keywords occur."""
    out = F.lit(0)
    for k in sorted(set(keywords)):
        out = out + F.contains(text, F.lit(k.lower())).cast("int")
    return out


def ranked_tags(text: Column, table: dict[str, Sequence[str]]) -> Column:
    """Names with hits, most first, then by name."""
    scored = F.array(*[F.struct((-hits(text, words)).alias("n"), F.lit(tag).alias("tag")) for tag, words in table.items()])
    return F.transform(F.array_sort(F.filter(scored, lambda s: s["n"] < 0)), lambda s: s["tag"])


def distinct_in_order(c: Column | str) -> Column:
    return F.array_distinct(F.filter(_col(c), lambda x: x.isNotNull() & (F.trim(x) != "")))


def token_estimate(c: Column | str) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.length(_col(c)) / 4).cast("int"))


def bucket(c: Column | str, n: int = 128) -> Column:
    """A stable bucket of an identifier."""
    return F.pmod(F.conv(F.substring(F.md5(_col(c).cast("string")), 1, 8), 16, 10).cast("long"), F.lit(n))


def safe_ratio(a: Column | str, b: Column | str) -> Column:
    """a / b to 6 places, half to even; 0 unless b is positive."""
    return F.coalesce(F.when(_col(b) > 0, F.bround(_col(a) / _col(b), 6)), F.lit(0.0))


def clipped(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(c, F.lit(high)), F.lit(low))


def six_digits(c: Column | str) -> Column:
    """Code without ``.0``, filled to six digits where it is a number of at most six."""
    x = F.upper(F.regexp_replace(F.trim(_col(c).cast("string")), r"\.0$", ""))
    return F.when(x.rlike(r"^\d{1,6}$"), F.lpad(x, 6, "0")).otherwise(x)


def any_date(c: Column | str) -> Column:
    """A date from an ISO day or time, a mail header, or a year-month-day somewhere in the text."""
    x = F.trim(_col(c))
    mail = F.regexp_extract(x, r"(\d{1,2} [A-Z][a-z]{2} \d{4})", 1)
    inside = F.regexp_replace(F.regexp_extract(x, r"(\d{4}[-./]\d{1,2}[-./]\d{1,2})", 1), r"[./]", "-")
    return F.coalesce(F.to_date(x.try_cast("timestamp")), F.to_date(F.try_to_timestamp(mail, F.lit("d MMM yyyy"))), F.to_date(F.try_to_timestamp(inside, F.lit("yyyy-M-d"))))


def recency(age_seconds: Column) -> Column:
    """5 down to 0 for ages up to 2, 7, 30, 90 and 365 whole days."""
    days = F.floor(age_seconds / 86400)
    out = F.lit(0)
    for most, score in ((365, 1), (90, 2), (30, 3), (7, 4), (2, 5)):
        out = F.when(days <= most, score).otherwise(out)
    return out
