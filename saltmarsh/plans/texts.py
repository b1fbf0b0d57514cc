"""Queries over text functions, tags and claim scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import claims as C
from ..functions import tags as G
from ..functions import text as X
from .registry import Plans, table

P = Plans()
NORMAL = "trim(regexp_replace(regexp_replace(regexp_replace(lower({0}), 'https?://\\S+', ' ', 'g'), '[^0-9a-z가-힣\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
RECORD = "trim(regexp_replace(regexp_replace(lower({0}), '\\s+', ' ', 'g'), '[^0-9a-z가-힣 ]+', '', 'g'))"


def docs(spark, d):
    return table(spark, d, "documents").select("doc_id", "text", "lang", "source")


@P.query(
    "c1_canonical_url",
    """WITH p AS (SELECT page_id, regexp_extract(url, '^(https?)://([^/?#]+)([^?#]*)\\??([^#]*)', ['s', 'h', 'p', 'q']) AS u FROM pages)
  SELECT page_id, 'https://' || lower(u.h) || CASE WHEN u.p IN ('', '/') THEN '/' ELSE regexp_replace(regexp_replace(u.p, '/+', '/', 'g'), '/+$', '') END ||
  CASE WHEN len(k) > 0 THEN '?' || array_to_string(list_sort(k), '&') ELSE '' END AS url FROM (SELECT *, list_filter(string_split(u.q, '&'), lambda x: x <> '' AND NOT starts_with(x, 'ref') AND NOT starts_with(x, 'utm_') AND x NOT LIKE '%=') AS k FROM p)""",
)
def c1(spark, d):
    return table(spark, d, "pages").select("page_id", X.canonical_url("url").alias("url"))


@P.query("c34_hosts", "SELECT page_id, regexp_replace(lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)), '^(www|m)\\.', '') AS host, NOT (regexp_replace(lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)), '^(www|m)\\.', '') LIKE '%.example.net') AS allowed FROM pages")
def c34(spark, d):
    return table(spark, d, "pages").select("page_id", X.host_of("url").alias("host"), X.allowed_link("url", ["example.net"]).alias("allowed"))


@P.query("c8_c9_fingerprints", f"SELECT doc_id, sha1({NORMAL.format('text')}) AS fingerprint, sha1({RECORD.format('text')}) AS record_fingerprint FROM documents")
def c8(spark, d):
    return docs(spark, d).select("doc_id", X.fingerprint("text").alias("fingerprint"), X.record_fingerprint("text").alias("record_fingerprint"))


@P.query(
    "c10_content_fingerprints",
    f"""WITH p AS (SELECT doc_id, list_concat([text], CASE WHEN len(list_filter(regexp_split_to_array(text, '\\n\\s*\\n+'), lambda x: trim(x) <> '')) > 1 THEN list_filter(regexp_split_to_array(text, '\\n\\s*\\n+'), lambda x: trim(x) <> '') ELSE list_filter(regexp_split_to_array(text, '\\n+'), lambda x: trim(x) <> '') END) AS ps FROM documents),
  u AS (SELECT doc_id, unnest(ps) AS x FROM p) SELECT doc_id, count(DISTINCT n) AS parts, min(sha1(n)) AS least FROM (SELECT doc_id, {NORMAL.format('x')} AS n FROM u) WHERE length(n) >= 80 GROUP BY doc_id""",
)
def c10(spark, d):
    rows = X.content_fingerprint_rows(docs(spark, d), "doc_id", "text")
    return rows.groupBy("doc_id").agg(F.count("*").alias("parts"), F.min("fingerprint").alias("least"))


PAGE = "coalesce(html, '')"
for _tag in ("script", "style", "noscript", "iframe", "svg"):
    PAGE = f"regexp_replace({PAGE}, '(?is)<{_tag}.*?>.*?</{_tag}>', ' ', 'g')"
PAGE = f"regexp_replace(regexp_replace({PAGE}, '(?i)<br\\s*/?>', chr(10), 'g'), '(?i)</(p|div|section|article|li|h1|h2|h3|h4|h5|h6)>', chr(10), 'g')"
PAGE = f"regexp_replace({PAGE}, '(?s)<[^>]+>', ' ', 'g')"
for _name, _sign in X.NAMED:
    PAGE = f"replace({PAGE}, '{_name}', '{_sign.replace(chr(39), chr(39) * 2)}')"


@P.query(
    "c4_html_text",
    f"""WITH p AS (SELECT page_id, regexp_split_to_array({PAGE}, '[\\n\\r]') AS ls FROM pages), l AS (SELECT page_id, generate_subscripts(ls, 1) AS i, trim(regexp_replace(unnest(ls), '\\s+', ' ', 'g')) AS s FROM p),
  k AS (SELECT page_id, i, s, row_number() OVER (PARTITION BY page_id, {NORMAL.format("s")} ORDER BY i) AS r FROM l WHERE length(s) >= 25), t AS (SELECT page_id, trim(string_agg(s, chr(10) ORDER BY i)) AS text FROM k WHERE r = 1 GROUP BY page_id) SELECT page_id, coalesce(text, '') AS text FROM pages LEFT JOIN t USING (page_id)""",
)
def c4(spark, d):
    return table(spark, d, "pages").select("page_id", X.html_text("html").alias("text"))


@P.query("c6_urls_in_text", "SELECT page_id, unnest(list_distinct(list_transform(regexp_extract_all('see ' || url || ', or (' || url || ').', 'https?://[^\\s<>\"'']+'), lambda u: regexp_replace(u, '[.,;:!?)\\]}]+$', '')))) AS url FROM pages")
def c6(spark, d):
    text = F.concat(F.lit("see "), "url", F.lit(", or ("), "url", F.lit(")."))
    return table(spark, d, "pages").select("page_id", F.explode(X.urls_in(text)).alias("url"))


@P.query("c12_tokens", "SELECT doc_id, len(regexp_extract_all(text, '[0-9A-Za-z가-힣_\\-]+'))::INTEGER AS n, len(list_distinct(list_transform(regexp_extract_all(text, '[0-9A-Za-z가-힣_\\-]+'), lambda x: lower(x))))::INTEGER AS kinds FROM documents")
def c12(spark, d):
    return docs(spark, d).select("doc_id", F.size(X.tokens("text")).alias("n"), F.size(F.array_distinct(X.tokens("text"))).alias("kinds"))


@P.query("c13_sentences", "SELECT doc_id, len(list_filter(regexp_split_to_array(regexp_replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), '([.!?。！？]) ', '\\1' || chr(1), 'g'), chr(1)), lambda s: trim(s) <> ''))::INTEGER AS sentences FROM documents")
def c13(spark, d):
    return docs(spark, d).select("doc_id", F.size(X.sentences("text")).alias("sentences"))


SENTENCES = "list_filter(list_transform(string_split(regexp_replace(trim(regexp_replace({0}, '\\s+', ' ', 'g')), '([.!?。！？]) ', '\\1' || chr(1), 'g'), chr(1)), lambda s: trim(s)), lambda s: s <> '')"


@P.query(
    "c14_chunks",
    f"""WITH b AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(trim(text), '\\n\\s*\\n+'), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> '') AS ps, {SENTENCES.format("text")} AS ss FROM documents WHERE trim(text) <> ''),
  c AS (SELECT doc_id, CASE WHEN len(ps) > 1 THEN ps ELSE ss END AS bs FROM b),
  k AS (SELECT doc_id, string_split(list_reduce(bs, lambda acc, x: CASE WHEN length(string_split(acc, chr(1))[-1]) + (NOT contains(acc, chr(1)))::INTEGER + length(x) + 1 > 750 THEN acc || chr(1) || x ELSE acc || chr(10) || x END), chr(1)) AS cs FROM c WHERE len(bs) > 0)
  SELECT doc_id, (i - 1)::INTEGER AS chunk_id, left(chunk, 870) AS chunk_text FROM (SELECT doc_id, generate_subscripts(cs, 1) AS i, unnest(cs) AS chunk FROM k) WHERE i <= 5""",
)
def c14(spark, d):
    return C.chunked(docs(spark, d).withColumn("family", F.lit("text_blog"))).select("doc_id", "chunk_id", "chunk_text")


@P.query("c16_macro_risk", "WITH t AS (SELECT doc_id, lower(text) || CASE doc_id % 5 WHEN 0 THEN ' easing stimulus' WHEN 1 THEN ' sanction recession easing' ELSE '' END AS t FROM documents), n AS (SELECT doc_id, len(list_filter(['risk-on', 'risk on', 'soft landing', 'stimulus', 'easing'], lambda k: contains(t, k))) AS o, len(list_filter(['risk-off', 'risk off', 'recession', 'conflict', 'sanction'], lambda k: contains(t, k))) AS f FROM t) SELECT doc_id, round(CASE WHEN o + f > 0 THEN (o - f) / (o + f) ELSE 0 END, 6) AS score, o::INTEGER AS risk_on, f::INTEGER AS risk_off FROM n")
def c16(spark, d):
    more = F.when(F.col("doc_id") % 5 == 0, " easing stimulus").when(F.col("doc_id") % 5 == 1, " sanction recession easing").otherwise("")
    rows = docs(spark, d).select("doc_id", C.macro_risk(F.concat("text", more)).alias("m"))
    return rows.select("doc_id", F.round("m.score", 6).alias("score"), F.col("m.on").alias("risk_on"), F.col("m.off").alias("risk_off"))


#: Words of the invented prose that stand for meanings, so that scores vary.
UP, DOWN, LAST, PASS = ("the", "of", "que", "der"), ("and", "de", "la", "die"), ("on", "en"), ("re", "to", "el")


def cards(spark, d):
    """Claim cards: a document is a claim on one symbol and day."""
    k = F.col("doc_id")
    base = docs(spark, d).select("doc_id", "text", "source", F.date_add(F.lit("2026-01-01").cast("date"), (k % 20).cast("int")).alias("date"), (k % 30).alias("symbol"), F.when(k % 4 == 0, "dart").when(k % 4 == 1, "news_rss").when(k % 4 == 2, "text_blog").otherwise("other").alias("family"))
    return C.with_events(base, "text", {"order": ("license",), "rights_issue": ("idiot", "moron"), "lawsuit": ("worthless",), "guidance": ("@",)})


def scored_cards(spark, d):
    return C.scored(cards(spark, d), "text", UP, DOWN, LAST, PASS)


SCORED = """toks AS (SELECT doc_id, text, list_transform(regexp_extract_all(text, '[0-9A-Za-z가-힣_\\-]+'), lambda x: lower(x)) AS w, DATE '2026-01-01' + (doc_id % 20)::INTEGER AS date, doc_id % 30 AS symbol,
    CASE doc_id % 4 WHEN 0 THEN 'dart' WHEN 1 THEN 'news_rss' WHEN 2 THEN 'text_blog' ELSE 'other' END AS family, source FROM documents),
  met AS (SELECT doc_id, date, symbol, family, source, len(w) AS n, len(list_filter(w, lambda t: t IN ('the', 'of', 'que', 'der'))) AS up, len(list_filter(w, lambda t: t IN ('and', 'de', 'la', 'die'))) AS dn, len(list_filter(w, lambda t: t IN ('on', 'en'))) AS la, len(list_filter(w, lambda t: t IN ('re', 'to', 'el'))) AS pa,
    regexp_matches(text, '[0-9]')::INTEGER AS nu, (family <> 'other' AND contains(lower(text), 'license'))::INTEGER AS o, (family <> 'other' AND (contains(lower(text), 'idiot') OR contains(lower(text), 'moron')))::INTEGER AS r, (family <> 'other' AND contains(lower(text), 'worthless'))::INTEGER AS s, (family <> 'other' AND contains(text, '@'))::INTEGER AS g,
    CASE family WHEN 'dart' THEN 0.92 WHEN 'news_rss' THEN 0.76 WHEN 'text_blog' THEN 0.68 ELSE 0.55 END AS bm0, CASE family WHEN 'dart' THEN 1.0 WHEN 'news_rss' THEN 0.94 WHEN 'text_blog' THEN 0.72 ELSE 0.55 END AS rel FROM toks),
  f AS (SELECT *, (up - dn) / greatest(up + dn, 1) AS pol, (la - pa) / greatest(la + pa, 1) AS bal, least(n, 120) / 120.0 AS den FROM met),
  scored AS (SELECT doc_id, date, symbol, family, source, o, r, s, g, greatest(least(50 + 22 * pol + 8 * least(up, 6) / 6.0 + 8 * o + 4 * g, 100), 0) AS upside, greatest(least(50 - 20 * pol + 10 * least(dn, 6) / 6.0 + 12 * r + 10 * s, 100), 0) AS downside,
    greatest(least(100 * bm0 + 4 * o - 5 * r - 6 * s + 3 * nu + CASE WHEN family = 'dart' THEN 7 ELSE 0 END, 100), 0) AS bm, greatest(least(38 + 18 * bal + 18 * den + 4 * o + 3 * g - 4 * r - 5 * s + 2 * nu, 100), 0) AS persistence,
    greatest(least(0.32 + 0.08 * least(up + dn + la + pa, 5) + 0.10 * (o + r + s + g) + 0.06 * nu, 0.98), 0.15) AS confidence, greatest(least(rel * (0.85 + 0.18 * least(o + r + s + g, 2) + 0.16 * den + 0.08 * nu), 2.0), 0.2) AS weight FROM f)"""


@P.query("c17_claim_scores", f"WITH {SCORED} SELECT doc_id, {', '.join(f'round({c}::DOUBLE, 6) AS {c}' for c in ('upside', 'downside', 'bm', 'persistence', 'confidence', 'weight'))} FROM scored")
def c17(spark, d):
    return scored_cards(spark, d).select("doc_id", *[F.round(c, 6).alias(c) for c in ("upside", "downside", "bm", "persistence", "confidence", "weight")])


@P.query("c15_event_flags", f"WITH {SCORED} SELECT doc_id, o AS event_order, r AS event_rights_issue, s AS event_lawsuit, g AS event_guidance FROM scored")
def c15(spark, d):
    return cards(spark, d).select("doc_id", "event_order", "event_rights_issue", "event_lawsuit", "event_guidance")


NAMED_EVENTS = "array_to_string(list_filter([CASE WHEN g = 1 THEN 'guidance' END, CASE WHEN s = 1 THEN 'lawsuit' END, CASE WHEN o = 1 THEN 'order' END, CASE WHEN r = 1 THEN 'rights_issue' END], lambda x: x IS NOT NULL), '+')"


@P.query(
    "c18_cluster_ids",
    f"""WITH {SCORED}, u AS (SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS x FROM toks), telling_words AS (SELECT doc_id, x, min(i) AS i FROM u WHERE length(x) >= 2 AND NOT regexp_matches(x, '^\\d+$') AND x NOT IN ({", ".join(f"'{x}'" for x in C.STOPWORDS)}) GROUP BY ALL),
  t AS (SELECT doc_id, string_agg(x, '+' ORDER BY i) AS telling FROM (SELECT * FROM telling_words QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY i) <= 3) GROUP BY doc_id), k AS (SELECT doc_id, date, symbol, coalesce(nullif({NAMED_EVENTS}, ''), telling, '') AS cluster_key FROM scored LEFT JOIN t USING (doc_id))
  SELECT doc_id, cluster_key, left(sha1(date || ':' || symbol || ':' || cluster_key), 16) AS cluster_id FROM k""",
)
def c18(spark, d):
    return C.cluster_key(cards(spark, d), "text").select("doc_id", "cluster_key", "cluster_id")


@P.query(
    "c19_evidence",
    f"""WITH s AS (SELECT doc_id, text, flatten(list_transform(regexp_split_to_array(coalesce(text, ''), '\\n+'), lambda l: {SENTENCES.format("l")})) AS parts FROM documents)
  SELECT doc_id, left(coalesce(list_filter(parts, lambda x: contains(lower(x), 'license') OR contains(lower(x), 'idiot'))[1], parts[1], text), 260) AS evidence FROM s""",
)
def c19(spark, d):
    return docs(spark, d).select("doc_id", C.evidence("text", ("license", "idiot")).alias("evidence"))


TABLE = {"law": ("license", "licensed"), "abuse": ("idiot", "moron", "worthless", "clown"), "articles": ("the", "der", "die", "el", "la")}


@P.query("c22_ranked_tags", "WITH h AS (SELECT doc_id, 'law' AS tag, len(regexp_extract_all(lower(text), '\\b(?:license|licensed)\\b')) AS n FROM documents UNION ALL SELECT doc_id, 'abuse', len(regexp_extract_all(lower(text), '\\b(?:idiot|moron|worthless|clown)\\b')) FROM documents) SELECT doc_id, string_agg(tag, ',' ORDER BY n DESC, tag) AS tags FROM h WHERE n > 0 GROUP BY doc_id")
def c22(spark, d):
    rows = docs(spark, d).select("doc_id", X.ranked_tags(F.lower("text"), {k: TABLE[k] for k in ("law", "abuse")}).alias("t"))
    return rows.where("size(t) > 0").select("doc_id", F.array_join("t", ",").alias("tags"))


@P.query("c21_industry_tags", "WITH h AS (SELECT doc_id, len(regexp_extract_all(lower(text), '\\b(?:license|licensed)\\b')) AS n, len(regexp_extract_all(lower(text), '\\blicensed\\b')) AS s FROM documents) SELECT doc_id, 'law' AS tags FROM h WHERE n >= 2 OR s > 0")
def c21(spark, d):
    rows = docs(spark, d).select("doc_id", G.industries(F.lower("text"), {"law": TABLE["law"]}, {"law": 2}, {"law": ("licensed",)}).alias("t"))
    return rows.where("size(t) > 0").select("doc_id", F.array_join("t", ",").alias("tags"))


@P.query("c23_c24_direction_horizon", "WITH h AS (SELECT doc_id, len(regexp_extract_all(lower(text), '\\blicense\\b')) AS p, len(regexp_extract_all(lower(text), '\\b(?:idiot|moron)\\b')) AS n, lower(text) AS t FROM documents) SELECT doc_id, CASE WHEN p > 0 AND n > 0 THEN 'mixed' WHEN p > 0 THEN 'positive' WHEN n > 0 THEN 'negative' ELSE 'neutral' END AS direction, CASE WHEN contains(t, 'released') THEN 'long_term' WHEN contains(t, 'version') THEN 'medium_term' WHEN contains(t, 'clown') THEN 'short_term' ELSE 'unknown' END AS horizon FROM h")
def c23(spark, d):
    low = F.lower("text")
    none = F.array().cast("array<string>")
    return docs(spark, d).select("doc_id", G.direction(low, none, ("license",), ("idiot", "moron")).alias("direction"), G.horizon(low, None, ("released",), ("version",), ("clown",)).alias("horizon"))


def hits_sql(words, text="t") -> str:
    """How often keywords stand in a lower-cased text: whole words of ASCII letters and digits, others anywhere."""
    plain = [w.lower() for w in words if w.isascii() and w.isalnum()]
    other = [w.lower() for w in words if not (w.isascii() and w.isalnum())]
    parts = [f"len(regexp_extract_all({text}, '\\b{w}\\b'))" for w in plain]
    parts += [f"(length({text}) - length(replace({text}, '{w}', ''))) // {len(w)}" for w in other]
    return f"({' + '.join(parts)})"


def any_sql(words, text="t") -> str:
    return "(" + " OR ".join(f"contains({text}, '{w.lower()}')" for w in words) + ")"


@P.query(
    "c25_c26_classification",
    f"""WITH t AS (SELECT doc_id, lower(text) AS t FROM documents), h AS (SELECT *, {hits_sql(TABLE["law"])} AS law, {hits_sql(TABLE["abuse"])} AS abuse, {hits_sql(TABLE["articles"])} AS words, {hits_sql(G.POSITIVE)} AS up, {hits_sql(G.NEGATIVE)} AS down, {", ".join(f'{hits_sql(w)} AS "{n}"' for n, w in G.EVENT_TAGS.items())} FROM t),
  e AS (SELECT doc_id, string_agg(tag, ',' ORDER BY n DESC, tag) AS tags FROM (UNPIVOT (SELECT doc_id, {", ".join(f'"{n}"::BIGINT AS "{n}"' for n in G.EVENT_TAGS)} FROM h) ON {", ".join(chr(34) + n + chr(34) for n in G.EVENT_TAGS)} INTO NAME tag VALUE n) WHERE n > 0 GROUP BY doc_id),
  s AS (SELECT *, up + (guidance > 0)::INTEGER + ("order" > 0)::INTEGER AS u, down + (rights_issue > 0)::INTEGER + (lawsuit > 0)::INTEGER AS d FROM h)
  SELECT doc_id, concat_ws(',', CASE WHEN law > 0 THEN 'macro' END, CASE WHEN abuse > 0 THEN 'industry' END) AS target_levels, CASE WHEN law > 0 THEN 'law' ELSE '' END AS macro_tags, CASE WHEN abuse > 0 THEN 'abuse' ELSE '' END AS industry_tags, coalesce(tags, '') AS event_tags, CASE WHEN words > 0 THEN 'words' ELSE '' END AS region_tags,
  CASE WHEN u > 0 AND d > 0 THEN 'mixed' WHEN u > 0 THEN 'positive' WHEN d > 0 THEN 'negative' ELSE 'neutral' END AS impact_direction, CASE WHEN {any_sql(G.LONG)} THEN 'long_term' WHEN {any_sql(G.MEDIUM)} THEN 'medium_term' WHEN {any_sql(G.SHORT)} THEN 'short_term' ELSE 'unknown' END AS horizon FROM s LEFT JOIN e USING (doc_id)""",
)
def c25(spark, d):
    s = G.classified(F.lower("text"), F.array().cast("array<string>"), {"law": TABLE["law"]}, {"abuse": TABLE["abuse"]}, {"words": TABLE["articles"]})
    return docs(spark, d).select("doc_id", s.alias("c")).select("doc_id", *[(F.array_join(f"c.{n}", ",") if n.endswith(("tags", "levels")) else F.col(f"c.{n}")).alias(n) for n in ("target_levels", "macro_tags", "industry_tags", "event_tags", "region_tags", "impact_direction", "horizon")])


@P.query("c36_c37_buckets_tokens", "SELECT doc_id, (('0x' || left(md5(doc_id::VARCHAR), 8))::BIGINT % 128)::BIGINT AS bucket, greatest(1, ceil(length(text) / 4))::INTEGER AS tokens FROM documents")
def c36(spark, d):
    return docs(spark, d).select("doc_id", X.bucket("doc_id").alias("bucket"), X.token_estimate("text").alias("tokens"))


@P.query("c30_dates", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 4 THEN o_orderdate::DATE END AS date FROM orders")
def c30(spark, d):
    """Orders' dates as an ISO time, a mail header's date, in the middle of a text, with one-digit months and days; and none."""
    k, day = F.col("o_orderkey") % 5, F.to_date("o_orderdate")
    raw = (
        F.when(k == 0, F.date_format(day, "yyyy-MM-dd'T01:02:03'"))
        .when(k == 1, F.concat(F.date_format(day, "EEE, d MMM yyyy"), F.lit(" 10:00:00 +0000")))
        .when(k == 2, F.concat(F.lit("on "), F.date_format(day, "yyyy.M.d"), F.lit(" of "), "o_orderpriority"))
        .when(k == 3, F.date_format(day, "yyyy/MM/dd"))
        .otherwise(F.col("o_orderpriority"))
    )
    return table(spark, d, "orders").select("o_orderkey", X.any_date(raw).alias("date"))


@P.query("c29_codes", "SELECT s_suppkey, lpad(s_suppkey::VARCHAR, 6, '0') AS code FROM supplier")
def c29(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", X.six_digits(F.concat(F.col("s_suppkey").cast("string"), F.lit(".0"))).alias("code"))


@P.query("c33_recency", "SELECT event_id, CASE WHEN d <= 2 THEN 5 WHEN d <= 7 THEN 4 WHEN d <= 30 THEN 3 WHEN d <= 90 THEN 2 WHEN d <= 365 THEN 1 ELSE 0 END AS score FROM (SELECT event_id, floor((epoch((SELECT max(ts) FROM events)) - epoch(ts)) / 86400) AS d FROM events)")
def c33(spark, d):
    e = table(spark, d, "events")
    now = F.broadcast(e.agg(F.max("ts").alias("now")))
    return e.crossJoin(now).select("event_id", X.recency((F.unix_micros(F.col("now").cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))) / 1e6).alias("score"))


QUERIES, ORACLES = P.queries, P.oracles
