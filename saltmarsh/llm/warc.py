"""Derivatives of WARC responses: linked metadata records and plain-text conversion records.

Expressions over one response's columns: no shuffle. Response records come from WARC files, cut into records
by Spark's text source and their stated lengths, or are made of fetched pages; either way a response's HTTP message is parsed for its status, headers and
payload. A derived record has an identifier made from its type and the response's identifier, so a repeated run gives the same ones; it
names the response in WARC-Refers-To and repeats its target, date and payload digest. Digests are labelled, ``sha256:`` and hexadecimal.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import BATCH_BYTES, bounded_batches

#: Named character references that become characters; numeric ones do by their numbers.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))
DROPPED = ("script", "style", "noscript", "svg", "nav")
#: Elements that end a line.
BREAKS = "br|/p|/h[1-6]|/li|/div|/tr|/title|/article|/section|/ul|/ol|/table|/blockquote|/pre"
CRLF = "\r\n"


def _numbered(text: Column) -> Column:
    """Numeric character references (decimal and hexadecimal) as characters; what is no character stays."""
    parts = F.split(text, "&#(?=(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});)")

    def character(part: Column) -> Column:
        name = F.substring_index(part, ";", 1)
        number = F.when(F.lower(F.substring(name, 1, 1)) == "x", F.conv(F.substring(name, 2, 6), 16, 10)).otherwise(name).cast("long")
        valid = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
        sign = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        return F.when(valid, F.concat(sign, F.substring(part, F.length(name) + 2, F.length(part)))).otherwise(F.concat(F.lit("&#"), part))

    return F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(character(p))), "")


def _unescaped(text: Column) -> Column:
    text = F.when(F.contains(text, F.lit("&#")), _numbered(text)).otherwise(text)
    for name, sign in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(sign))
    return text


def _bare(html: Column) -> Column:
    """A page without comments, elements that hold no text, and tags: a line for each block."""
    text = F.regexp_replace(html, "(?s)<!--.*?-->", "")
    text = F.regexp_replace(text, rf"(?si)<({'|'.join(DROPPED)})[ >].*?</\1>", " ")
    text = F.regexp_replace(text, "[\r\n\t ]+", " ")
    text = F.regexp_replace(text, f"(?i)<({BREAKS})[ /]*>", "\n")
    return F.regexp_replace(text, "<[^>]*>", "")


def _tidy(text: Column) -> Column:
    text = F.regexp_replace(text, " *\n[ \n]*", "\n")
    return F.regexp_replace(text, "^[ \n]+|[ \n]+$", "")


def plain_text(html: Column) -> Column:
    """Text of a page: without comments and elements that hold none, a line for each block, blanks collapsed, no empty lines."""
    return _tidy(_unescaped(_bare(html)))


def _title(html: Column) -> Column:
    return F.regexp_extract(html, "(?si)<title[^>]*>(.*?)</title>", 1)


def title(html: Column) -> Column:
    return F.trim(_unescaped(_title(html)))


def record_id(*parts: Column | str) -> Column:
    """A urn:uuid from a digest of the parts."""
    h = F.md5(F.concat_ws("\n", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12)), F.lit(">"))


def digest(text: Column | str) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(F.encode(text, "UTF-8"), 256))


#: What the made messages answer, by the page's number, and a header that every other one has.
STATUSES = ("200 OK", "404 Not Found", "301 Moved Permanently", "200 OK", "200 OK", "503 Service Unavailable", "200 OK")


def messages(pages: DataFrame) -> DataFrame:
    """Fetched pages (page_id, url, html) as response records: source_id, record_id, target_uri, warc_date, message (the HTTP response whole).

    Date, status and headers follow from the page's number, as the pages have none; a null number counts as 0.
    """
    url, html, number = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit("")), F.coalesce(F.col("page_id").cast("long"), F.lit(0))
    status = F.element_at(F.array(*[F.lit(x) for x in STATUSES]), (F.pmod(number, F.lit(len(STATUSES))) + 1).cast("int"))
    server = F.when(F.pmod(number, F.lit(2)) == 0, f"Server: marsh{CRLF}").otherwise("")
    head = F.concat(F.lit("HTTP/1.1 "), status, F.lit(CRLF), server, F.lit(f"Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length(html).cast("string"), F.lit(CRLF * 2))
    second = F.timestamp_seconds(F.lit(DAY) + F.pmod(number, F.lit(YEAR)))
    date = F.concat(F.replace(F.substring(second.cast("string"), 1, 19), F.lit(" "), F.lit("T")), F.lit("Z"))
    return pages.select(F.col("page_id").alias("source_id"), record_id(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), url).alias("record_id"), url.alias("target_uri"), date.alias("warc_date"), F.concat(head, html).alias("message"))


#: 2026-01-01, and the seconds of a year.
DAY, YEAR = 1767225600, 31_536_000
#: A header of this library's own: the number that a record's source has in its table.
SOURCE = "WARC-X-Source-Id"


def write_warc(records: DataFrame, path: str, version: str = "1.1", compression: str = "gzip") -> None:
    """Response records (source_id, record_id, target_uri, warc_date, message) as WARC files; a line break in a header becomes a blank.

    Archives are gzipped; another of Hadoop's codecs does for files that only Spark reads.
    """

    def header(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{CRLF}{name}: "), F.regexp_replace(F.coalesce((F.col(value) if isinstance(value, str) else value).cast("string"), F.lit("")), "[\r\n]+", " "))

    body = F.coalesce(F.col("message").cast("binary"), F.lit(b""))
    head = F.concat(F.lit(f"WARC/{version}"), header("WARC-Type", F.lit("response")), header("WARC-Record-ID", "record_id"), header("WARC-Target-URI", "target_uri"), header("WARC-Date", "warc_date"), header(SOURCE, "source_id"), header("Content-Type", F.lit("application/http; msgtype=response")), header("Content-Length", F.octet_length(body)), F.lit(CRLF * 2))
    # bytes as they are: a string's bytes aren't looked at on the way into the file
    records.select(F.concat(head.cast("binary"), body).cast("string").alias("value")).write.option("lineSep", CRLF * 2).option("compression", compression).text(path)


WARC = "path string, warc_type string, source_id string, record_id string, target_uri string, warc_date string, message binary, charset string, decoded string, problem string"
_VERSION, _HEADER = re.compile(rb"[0-9]\r?\n"), re.compile(rb"(?m)^([^:\r\n]+):[ \t]*([^\r\n]*)")
#: What may stand between a record's block and the next record.
_GAP = b"\r\n"


#: Charsets whose bytes Spark makes text of; a task decodes others as it reads them.
UTF8, LATIN = ("utf-8", "utf8", "us-ascii", "ascii"), ("iso-8859-1", "latin1", "latin-1")
_STATED, _DECLARED = re.compile(rb"(?mi)^content-type:[^\r\n]*charset=[\"']?([^\s;\"']+)"), re.compile(rb"(?i)<(?:meta[^>]+charset|\?xml[^>]+encoding)=[\"']?([A-Za-z0-9_:.-]+)")


def _charset(message: bytes) -> tuple[str, str | None]:
    """The payload's charset: that of its content type, else one that its first 1,024 bytes declare, else UTF-8; and the payload decoded, if Spark doesn't.

    An unknown charset counts as UTF-8, and bytes that don't fit become the sign for that.
    """
    end = message.find(b"\r\n\r\n") if message.startswith(b"HTTP/") else -1
    start = 0 if end < 0 else end + 4
    found = end > 0 and _STATED.search(message, 0, end) or _DECLARED.search(message, start, start + 1024)
    name = found[1].decode("ascii", "replace").lower() if found else "utf-8"
    if name in UTF8 or name in LATIN:
        return name, None
    try:
        return name, message[start:].decode(name, "replace")
    except LookupError:
        return "utf-8", None


def _read(path: str, pieces: Iterator[bytes]) -> Iterator[dict]:
    """The records of one file or split, cut at ``WARC/1.``: a piece that a block is short of belongs to it."""

    def given(held: bytes) -> tuple[dict, int]:
        """A record, and how many bytes its block is short of."""
        row = dict.fromkeys(WARC.replace(" string", "").replace(" binary", "").split(", "))
        head, _, rest = held.partition(b"\r\n\r\n")
        fields = {k.decode("utf-8", "replace").lower(): v.decode("utf-8", "replace").strip() for k, v in _HEADER.findall(head)}
        row |= {"path": path, "warc_type": fields.get("warc-type"), "record_id": fields.get("warc-record-id"), "target_uri": fields.get("warc-target-uri"), "warc_date": fields.get("warc-date"), "source_id": fields.get(SOURCE.lower(), fields.get("warc-target-uri"))}
        if not _VERSION.match(held):
            return row | {"problem": "no version line"}, 0
        if len(head) == len(held):
            return row | {"problem": "headers don't end"}, 1
        if not fields.get("content-length", "").isdigit():
            return row | {"message": rest, "problem": "no content length"}, 0
        length = int(fields["content-length"])
        row["message"] = rest[:length]
        if rest[length:].strip(_GAP) and length <= len(rest):
            row["problem"] = "bytes behind the block"
        return (row | {"problem": "cut short"} if length > len(rest) else row), max(0, length - len(rest))

    held, row, short = None, None, 0
    for piece in pieces:
        if short:  # the version line stands in a block
            held = held + b"WARC/1." + piece
        elif piece.strip(_GAP):
            if row is not None:
                yield row
            held = piece
        else:
            continue
        # headers are read again only while the record isn't whole
        row, short = given(held)
    if row is not None:
        yield row


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Response records of WARC/1.x files, gzipped or not: path, source_id, record_id, target_uri, warc_date, message (bytes), charset, decoded, problem.

    Nothing is dropped in silence: a record that can't be read as one, whatever its type, comes with its problem, others with null; whole records of
    other types aren't responses and are left out. Spark's text source cuts files at ``WARC/1.`` and undoes compression; where that stands within a block, the length stated
    in the record's header joins the pieces again, also at the cost of the records behind one that is really cut short, which then has them in it. Only
    where an uncompressed file is split within such a block is it cut, and named so. A task holds one record.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[tuple[str, bytes]]:
            for batch in stream:
                for name, split, value in zip(batch.column("path").to_pylist(), batch.column("split").to_pylist(), batch.column("value").to_pylist(), strict=True):
                    yield f"{split}:{name}", value

        names = WARC.replace(" string", "").replace(" binary", "").split(", ")
        rows, size = [], 0
        for key, group in groupby(pieces(), lambda x: x[0]):
            for row in _read(key.partition(":")[2], (value for _, value in group)):
                if row["problem"] is None and (row["warc_type"] or "").lower() != "response":
                    continue
                row["charset"], row["decoded"] = _charset(row["message"] or b"")
                rows.append(row)
                size += len(row["message"] or b"")
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_pydict({n: [r[n] for r in rows] for n in names}, schema=form)
                    rows, size = [], 0
        yield pa.RecordBatch.from_pydict({n: [r[n] for r in rows] for n in names}, schema=form)

    form = pa.schema([(n, pa.binary() if kind == "binary" else pa.string()) for n, kind in (x.split(" ") for x in WARC.split(", "))])
    bounded_batches(spark)
    raw = spark.read.option("lineSep", "WARC/1.").text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("value"))
    return raw.mapInArrow(run, WARC).select("path", "source_id", "record_id", "target_uri", "warc_date", "message", "charset", "decoded", "problem")


def parsed(records: DataFrame) -> DataFrame:
    """Response records with http_status (null where the status line is none), http_headers, payload (text) and payload_digest (of its bytes) instead of message.

    The headers end at the first empty line; a message, text or bytes, without one is a payload without headers. Text is UTF-8, or of the ``charset`` and ``decoded`` that
    ``read_warc`` found.
    """
    message = F.coalesce(F.col("message").cast("binary"), F.lit(b""))
    own = [c for c in ("charset", "decoded") if c in records.columns]
    rest = [c for c in records.columns if c != "message" and c not in own]
    # all in bytes: positions of characters would be counted anew in every long text
    rows = records.select(*rest, *own, message.alias("message"), F.substring_index(message.cast("string"), CRLF * 2, 1).alias("head"))
    headed = (F.substring("message", 1, 5) == F.lit(b"HTTP/")) & (F.octet_length("head") < F.octet_length("message"))
    payload = F.when(headed, F.expr("substring(message, octet_length(head) + 5)")).otherwise(F.col("message"))
    rows = rows.select(*rest, *own, F.when(headed, F.concat("head", F.lit(CRLF))).otherwise("").alias("http_headers"), payload.alias("bytes"))
    text = F.make_valid_utf8(F.col("bytes").cast("string"))
    if len(own) == 2:
        text = F.when(F.col("decoded").isNotNull(), F.col("decoded")).when(F.col("charset").isin(*LATIN), F.decode("bytes", "ISO-8859-1")).otherwise(text)
    status = F.regexp_extract("http_headers", r"^HTTP/[0-9.]+ ([0-9]{3})", 1).try_cast("int")
    return rows.select(*rest, status.alias("http_status"), "http_headers", text.alias("payload"), F.concat(F.lit("sha256:"), F.sha2("bytes", 256)).alias("payload_digest"))


def responses(pages: DataFrame) -> DataFrame:
    """Parsed response records of fetched pages."""
    return parsed(messages(pages))


def derive(records: DataFrame) -> DataFrame:
    """A metadata and a conversion record for each response.

    source_id, warc_type, record_id, refers_to, target_uri, warc_date, http_status, source_headers, payload_digest (the response's), content_type,
    block, block_digest, content_length. A null or empty payload gives an empty conversion block and metadata with an
    empty title; repeated responses give repeated records; an empty table gives none; other columns are ignored.
    """
    html = F.coalesce("payload", F.lit(""))
    own = ("source_id", "record_id", "target_uri", "warc_date", "http_status", "http_headers", "payload_digest")
    # step by step: what a later step reads more than once is a column by then
    steps = {"_bare": _bare(html), "_name": _title(html), "_lang": F.regexp_extract(html, '(?si)<html[^>]* lang="([^"]*)"', 1), "_links": F.regexp_count(html, F.lit('(?i)<a [^>]*href="')), "_scripts": F.regexp_count(html, F.lit("(?i)<script[ >]"))}
    rows = records.select(*own, *[c.alias(n) for n, c in steps.items()])
    rest = (*own, "_lang", "_links", "_scripts")
    rows = rows.select(*rest, _unescaped(F.col("_bare")).alias("_loose"), F.trim(_unescaped(F.col("_name"))).alias("_title"))
    rows = rows.select(*rest, "_title", _tidy(F.col("_loose")).alias("_text"))
    rows = rows.select(*rest, "_title", "_text", digest("_text").alias("_digest"))
    fields = (("title", "_title"), ("languages", "_lang"), ("outlinks", "_links"), ("scripts", "_scripts"), ("text-digest", "_digest"))
    meta = F.concat(*[F.concat(F.lit(f"{name}: "), (F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(CRLF)) for name, c in fields])

    def record(kind: str, content: str, block: Column, of: Column) -> Column:
        return F.struct(F.lit(kind).alias("warc_type"), F.lit(content).alias("content_type"), block.alias("block"), of.alias("block_digest"))

    rows = rows.select("*", meta.alias("_meta"))
    both = rows.select("*", F.inline(F.array(record("metadata", "application/warc-fields", F.col("_meta"), digest("_meta")), record("conversion", "text/plain; charset=utf-8", F.col("_text"), F.col("_digest")))))
    return both.select(
        "source_id",
        "warc_type",
        record_id("warc_type", "record_id").alias("record_id"),
        F.col("record_id").alias("refers_to"),
        "target_uri",
        "warc_date",
        "http_status",
        F.col("http_headers").alias("source_headers"),
        "payload_digest",
        "content_type",
        "block",
        "block_digest",
        F.octet_length("block").cast("long").alias("content_length"),
    )


def serialised(records: DataFrame) -> DataFrame:
    """derive()'s rows with ``record``: the whole WARC/1.1 record in bytes, its headers, block and closing blank lines."""

    def header(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{name}: "), (F.col(value) if isinstance(value, str) else value).cast("string"), F.lit(CRLF))

    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        header("WARC-Type", "warc_type"),
        header("WARC-Record-ID", "record_id"),
        header("WARC-Refers-To", "refers_to"),
        header("WARC-Target-URI", "target_uri"),
        header("WARC-Date", "warc_date"),
        header("WARC-Payload-Digest", "payload_digest"),
        header("WARC-Block-Digest", "block_digest"),
        header("Content-Type", "content_type"),
        header("Content-Length", "content_length"),
        F.lit(CRLF),
    )
    return records.withColumn("record", F.encode(F.concat(head, "block", F.lit(CRLF * 2)), "UTF-8"))


def derive_sql() -> str:
    """The query's result in DuckDB."""

    def unescaped(x: str) -> str:
        x = f"array_to_string(list_transform(regexp_split_to_array({x}, '&#'), lambda p, i: CASE WHEN i > 1 AND regexp_matches(p, '^(x|X)?[0-9a-fA-F]+;') THEN chr(CASE WHEN p[1] IN ('x', 'X') THEN ('0x' || regexp_extract(p, '^.([0-9a-fA-F]+);', 1))::INTEGER ELSE regexp_extract(p, '^([0-9]+);', 1)::INTEGER END) || regexp_replace(p, '^[^;]*;', '') WHEN i > 1 THEN '&#' || p ELSE p END), '')"
        for name, sign in ENTITIES:
            x = f"replace({x}, '{name}', '{sign.replace(chr(39), chr(39) * 2)}')"
        return x

    text = "regexp_replace(h, '(?s)<!--.*?-->', '', 'g')"
    for tag in DROPPED:
        text = f"regexp_replace({text}, '(?si)<{tag}[ >].*?</{tag}>', ' ', 'g')"
    text = f"regexp_replace({text}, '[\\r\\n\\t ]+', ' ', 'g')"
    text = f"regexp_replace({text}, '(?i)<({BREAKS})[ /]*>', chr(10), 'g')"
    text = unescaped(f"regexp_replace({text}, '<[^>]*>', '', 'g')")
    text = f"regexp_replace(regexp_replace({text}, ' *\\n[ \\n]*', chr(10), 'g'), '^[ \\n]+|[ \\n]+$', '', 'g')"

    def uuid(x: str) -> str:
        return f"'<urn:uuid:' || regexp_replace(md5({x}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5') || '>'"

    crlf = "chr(13) || chr(10)"
    status = f"({list(STATUSES)})[coalesce(source_id, 0) % {len(STATUSES)} + 1]"
    headers = " || ".join(f"'{name}: ' || {value} || {crlf}" for name, value in (("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"), ("WARC-Target-URI", "target_uri"), ("WARC-Date", "warc_date"), ("WARC-Payload-Digest", "payload_digest"), ("WARC-Block-Digest", "block_digest"), ("Content-Type", "content_type"), ("Content-Length", "content_length")))
    return f"""
WITH p AS (SELECT page_id AS source_id, coalesce(url, '') AS u, coalesce(html, '') AS h FROM pages),
r AS (SELECT *, {uuid("'response' || chr(10) || coalesce(source_id::VARCHAR, '') || chr(10) || u")} AS refers_to, {text} AS t,
             trim({unescaped("regexp_extract(h, '(?si)<title[^>]*>(.*?)</title>', 1)")}) AS title, regexp_extract(h, '(?si)<html[^>]* lang="([^"]*)"', 1) AS lang,
             len(regexp_extract_all(h, '(?i)<a [^>]*href="')) AS links, len(regexp_extract_all(h, '(?i)<script[ >]')) AS scripts FROM p),
b AS (SELECT r.*, 'metadata' AS warc_type, 'application/warc-fields' AS content_type,
             'title: ' || title || {crlf} || 'languages: ' || lang || {crlf} || 'outlinks: ' || links || {crlf} || 'scripts: ' || scripts || {crlf} || 'text-digest: sha256:' || sha256(t) || {crlf} AS block FROM r
      UNION ALL SELECT r.*, 'conversion', 'text/plain; charset=utf-8', t FROM r),
o AS (SELECT source_id, warc_type, {uuid("warc_type || chr(10) || refers_to")} AS record_id, refers_to, u AS target_uri, strftime(make_timestamp(({DAY} + coalesce(source_id, 0) % {YEAR}) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS warc_date, substr({status}, 1, 3)::INTEGER AS http_status,
       'HTTP/1.1 ' || {status} || {crlf} || CASE WHEN coalesce(source_id, 0) % 2 = 0 THEN 'Server: marsh' || {crlf} ELSE '' END || 'Content-Type: text/html; charset=utf-8' || {crlf} || 'Content-Length: ' || strlen(h) || {crlf} AS source_headers,
       'sha256:' || sha256(h) AS payload_digest, content_type, block, 'sha256:' || sha256(block) AS block_digest, strlen(block)::BIGINT AS content_length
FROM b)
SELECT *, md5('WARC/1.1' || {crlf} || {headers} || {crlf} || block || {crlf} || {crlf}) AS record_md5 FROM o"""
