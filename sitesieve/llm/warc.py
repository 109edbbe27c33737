"""WARC derivative builder: responses become linked metadata and plain-text conversion records.

Responses come from WARC files (`read`) or from a table of pages (`responses`, which has no headers or dates of its own
and is given one date and the headers of a plain answer). For each response there are two derived records, as WARC/1.1
names them. The conversion holds the page's plain text; the metadata holds application/warc-fields that describe the
response (title, language, counts of links, digests) and repeat its HTTP status line and headers, each after `http-`.
Both keep WARC-Refers-To (the response's record id), WARC-Target-URI, WARC-Date and WARC-Refers-To-Target-URI, and each
has digests of its own block and of the response's payload. Record ids are name-based: the same response always gives
the same ids, so a retried task writes the same records.

Plain text: comments, scripts, styles and heads go; block tags and breaks end lines; other tags go; all named and
numeric references of HTML5 are decoded once, a no-break space to a space; spaces collapse within lines, and empty
lines go. Titles are decoded in the same way, before their white space collapses.

Defined cases: a null or empty html gives empty text and digests of the empty block; a null url gives the empty URI; a
null page_id counts as the text "null" in ids; rows that repeat page_id and url give the same records each; an empty
table gives no rows; very long pages are converted whole, a row each; other columns are ignored. In files, records other
than responses are passed over, and so is a record cut off at the end of its file; payloads are unchunked, unzipped and
decoded by the charset they name (UTF-8 else, with U+FFFD for what is no character).
"""

from __future__ import annotations

import contextlib
import gzip
import hashlib
import html as markup
import io
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from html.entities import html5
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sitesieve.llm import shared

DATE = "2024-01-01T00:00:00Z"
# The patterns of the plain-text conversion, in the order they apply.
GONE = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<head\b[^>]*>.*?</head\s*>"
BREAKS = r"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|nav|header|footer|pre|blockquote)\b[^>]*>"
TAGS = r"(?s)<[a-zA-Z/!?][^>]*>"
LINK = r"(?i)<a\s[^>]*\bhref\s*="
TITLE = r"(?is)<title[^>]*>(.*?)</title"
LANG = r"(?i)<html[^>]*\slang=\"([a-zA-Z-]+)\""


def urn(*parts: Column) -> Column:
    """A name-based urn:uuid of the parts."""
    h = F.sha2(F.concat_ws("\n", *parts), 256)
    cut = [h.substr(a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block.cast("binary"), 256))


REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]{1,31};?)")


def _decoded(m: re.Match) -> str:
    return markup.unescape(m[0]).replace("\xa0", " ")


@F.arrow_udf(StringType())
def unescaped(texts: pa.Array) -> pa.Array:
    """Texts with their references decoded once, as html.unescape does, and a no-break space as a space."""
    return pa.array([x if x is None or "&" not in x else REFERENCE.sub(_decoded, x) for x in texts.to_pylist()], pa.string())


def plain_text(html: Column) -> Column:
    x = F.regexp_replace(html, GONE, " ")
    x = F.regexp_replace(F.regexp_replace(x, r"\s+", " "), BREAKS, "\n")
    x = F.regexp_replace(x, TAGS, "")
    x = unescaped(x)
    return F.trim(F.regexp_replace(F.regexp_replace(x, r" *\n[ \n]*", "\n"), r"^\n+|\n+$", ""))


RESPONSES = "page_id bigint, response_id string, uri string, date string, http_headers string, payload string, payload_digest string"


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """The response records of a table of pages: see RESPONSES."""
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    name = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    headers = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(html).cast("string"))
    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), urn(F.lit("response"), name, url).alias("response_id"), url.alias("uri"), F.lit(date).alias("date"), headers.alias("http_headers"), html.alias("payload"), digest(html).alias("payload_digest"))


def records(stream: io.BufferedReader) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of a WARC stream."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            continue  # the empty lines between records
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields.get("content-length", 0))
        block = stream.read(size)
        if len(block) < size:
            return
        yield fields, block


def _unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        size = int(body[at:end].split(b";")[0] or b"0", 16)
        if not size:
            break
        out.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size
    return b"".join(out)


def _payload(head: str, body: bytes) -> bytes:
    of = lambda name: (re.search(rf"(?im)^{name}:\s*(.*?)\s*$", head) or ["", ""])[1].lower()
    with contextlib.suppress(ValueError, OSError, EOFError, zlib.error):  # a server's false header: the bytes as they are
        if "chunked" in of("transfer-encoding"):
            body = _unchunked(body)
        if of("content-encoding") in ("gzip", "x-gzip"):
            body = gzip.decompress(body)
        elif of("content-encoding") == "deflate":
            body = zlib.decompress(body)
    return body


def _parsed(content: bytes) -> Iterator[tuple]:
    stream = io.BytesIO(content)
    if content[:2] == b"\x1f\x8b":
        stream = gzip.GzipFile(fileobj=stream)
    with contextlib.suppress(EOFError):  # a file cut off
        for fields, block in records(io.BufferedReader(stream)):
            if fields.get("warc-type") != "response":
                continue
            head, _, body = block.partition(b"\r\n\r\n")
            head = head.decode("utf-8", "replace")
            body = _payload(head, body)
            charset = re.search(r"(?im)^content-type:.*charset=[\"']?([\w.:-]+)", head)
            try:
                text = body.decode(charset[1] if charset else "utf-8", "replace")
            except LookupError:
                text = body.decode("utf-8", "replace")
            yield None, fields.get("warc-record-id", ""), fields.get("warc-target-uri", "").strip("<>"), fields.get("warc-date", ""), head, text, "sha256:" + hashlib.sha256(body).hexdigest()


def read(spark: SparkSession, path: str, rows: int = 64) -> DataFrame:
    """The response records of WARC files, gzipped (as a whole or by record) or not: see RESPONSES. A file is one row of
    Spark's reader, so it must fit in a task's memory; files of a crawl are some hundred megabytes."""
    names = [x.split()[0] for x in RESPONSES.split(", ")]
    types = [pa.int64(), *[pa.string()] * 6]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                held = []
                for row in _parsed(batch.column("content")[i].as_py()):
                    held.append(row)
                    if len(held) == rows:
                        yield _batch(held)
                        held = []
                if held:
                    yield _batch(held)

    def _batch(held):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RESPONSES)


def derived(given: DataFrame) -> DataFrame:
    """Two rows a response: page_id, warc_type, record_id, refers_to, target_uri, date, content_type, content_length,
    block_digest, payload_digest (of the response), source_headers, block."""
    title = F.trim(F.regexp_replace(unescaped(F.regexp_extract("payload", TITLE, 1)), r"\s+", " "))
    r = given.withColumns({"text": plain_text(F.col("payload")), "title": title, "lang": F.regexp_extract("payload", LANG, 1), "links": F.regexp_count("payload", F.lit(LINK))})
    fields = F.concat(
        F.lit("title: "), F.col("title"), F.lit("\r\nlanguage: "), F.col("lang"), F.lit("\r\nlinks: "), F.col("links").cast("string"),
        F.lit("\r\npayloadDigest: "), F.col("payload_digest"), F.lit("\r\ntextDigest: "), digest(F.col("text")),
        F.lit("\r\nhttp-status: "), F.replace("http_headers", F.lit("\r\n"), F.lit("\r\nhttp-")), F.lit("\r\n"),
    )
    kinds = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), F.lit("application/warc-fields").alias("content_type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("text").alias("block")),
    )
    rows = r.select("page_id", "response_id", "uri", "date", "http_headers", "payload_digest", F.explode(kinds).alias("x"))
    return rows.select(
        "page_id",
        F.col("x.warc_type").alias("warc_type"),
        urn(F.col("x.warc_type"), F.col("response_id")).alias("record_id"),
        F.col("response_id").alias("refers_to"),
        F.col("uri").alias("target_uri"),
        "date",
        F.col("x.content_type").alias("content_type"),
        F.octet_length("x.block").cast("bigint").alias("content_length"),
        digest(F.col("x.block")).alias("block_digest"),
        "payload_digest",
        F.col("http_headers").alias("source_headers"),
        F.col("x.block").alias("block"),
    )


def serialized(records: DataFrame) -> DataFrame:
    """Derived records with `record`, their bytes in a WARC file."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("warc_type")), line("WARC-Record-ID", F.col("record_id")), line("WARC-Date", F.col("date")),
        line("WARC-Target-URI", F.col("target_uri")), line("WARC-Refers-To", F.col("refers_to")), line("WARC-Refers-To-Target-URI", F.col("target_uri")),
        line("WARC-Refers-To-Date", F.col("date")), line("WARC-Block-Digest", F.col("block_digest")), line("X-Refers-To-Payload-Digest", F.col("payload_digest")),
        line("Content-Type", F.col("content_type")), line("Content-Length", F.col("content_length").cast("string")), F.lit("\r\n"),
    )
    return records.withColumn("record", F.concat(head, F.col("block"), F.lit("\r\n\r\n")).cast("binary"))


def write(records: DataFrame, path: str) -> DataFrame:
    """WARC files of the records, each record a gzip member of its own, one file a partition: file, records, bytes.

    path must be a folder that executors have mounted. A file is written under another name and then renamed to one that
    its partition alone gives, so a task that runs again puts the same file in its place."""
    named = urlparse(path)
    if named.scheme not in ("", "file"):
        raise ValueError("WARC files are written by executors: give a folder that they have mounted")
    os.makedirs(named.path, exist_ok=True)

    def run(batches):
        from pyspark import TaskContext

        name = f"{named.path.rstrip('/')}/part-{TaskContext.get().partitionId():06d}.warc.gz"
        temporary, n = f"{name}.{uuid.uuid4().hex}", 0
        with open(temporary, "wb") as f:
            for batch in batches:
                for record in batch.column("record"):
                    f.write(gzip.compress(record.as_py(), mtime=0))
                    n += 1
            size = f.tell()
        os.replace(temporary, name)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n]), pa.array([size])], names=["file", "records", "bytes"])

    written = serialized(records).select("record").mapInArrow(run, "file string, records bigint, bytes bigint")
    return records.sparkSession.createDataFrame(written.collect(), written.schema)  # a row per file


def op8_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(responses(shared.table(spark, sf_dir, "pages")))


def _decoded_sql(x: str) -> str:
    """SQL of unescaped(x); m is a map of the names that HTML5 has."""
    numeric = """case when n = 0 or n between 55296 and 57343 or n > 1114111 then chr(65533)
      when n = 13 then chr(13) when n between 128 and 159 then coalesce(c[n], '')
      when n between 1 and 8 or n = 11 or n between 14 and 31 or n = 127 or n between 64976 and 65007 or n % 65536 >= 65534 then '' else chr(cast(n as integer)) end"""
    digits = "rtrim(substr(z[2], 3), ';')"
    n = f"case when lower(substr(z[2], 3, 1)) = 'x' then coalesce(try_cast('0x' || substr({digits}, 2) as bigint), 9999999) else coalesce(try_cast({digits} as bigint), 9999999) end"
    number = f"list_transform([{n}], lambda n: {numeric})[1]"
    shorter = "list_filter(list_transform(range(length(z[2]) - 1, 2, -1), lambda i: m[substr(z[2], 2, i - 1)] || substr(z[2], i + 1)), lambda v: v is not null)[1]"
    one = f"case when z[2] = '' then '' when z[2] like '&#%' then {number} else coalesce(m[substr(z[2], 2)], {shorter}, z[2]) end"
    p = f"'{REFERENCE.pattern}'"
    return f"array_to_string(list_transform(list_zip(regexp_split_to_array({x}, {p}), list_append(regexp_extract_all({x}, {p}), '')), lambda z: z[1] || replace({one}, chr(160), ' ')), '')"


def _sql() -> str:
    q = lambda x: "'" + x.replace("'", "''") + "'"
    sub = lambda x, p, to: f"regexp_replace({x}, {q(p)}, {to}, 'g')"
    text = sub("html", GONE, "' '")
    text = sub(sub(text, r"\s+", "' '"), BREAKS, "chr(10)")
    text = sub(text, TAGS, "''")
    clean = f"trim({sub(sub('decoded', r' *\n[ \n]*', 'chr(10)'), r'^\n+|\n+$', q(''))}, ' ')"
    uuid = lambda x: f"(select '<urn:uuid:' || substr(h,1,8) || '-' || substr(h,9,4) || '-' || substr(h,13,4) || '-' || substr(h,17,4) || '-' || substr(h,21,12) || '>' from (select sha256({x}) as h))"
    crlf = "chr(13) || chr(10)"
    names = ",".join(f"({q(k)},{q(v)})" for k, v in html5.items())
    latin = ",".join(f"({n},{q(markup.unescape(f'&#{n};'))})" for n in range(128, 160) if markup.unescape(f"&#{n};"))
    return f"""
with names as (select map(list(k), list(v)) as m from (values {names}) as t(k, v)),
latin as (select map(list(cast(k as bigint)), list(v)) as c from (values {latin}) as t(k, v)),
p as (select page_id, coalesce(url, '') as uri, coalesce(html, '') as html from pages),
cleaned as (select page_id, uri, html, {text} as bare, regexp_extract(html, {q(TITLE)}, 1) as head from p),
d as (select page_id, uri, html, {_decoded_sql("bare")} as decoded, {_decoded_sql("head")} as title_text from cleaned, names, latin),
r as (select page_id, uri, html, {uuid("'response' || chr(10) || coalesce(cast(page_id as varchar), 'null') || chr(10) || uri")} as response_id,
  'HTTP/1.1 200 OK' || {crlf} || 'Content-Type: text/html; charset=utf-8' || {crlf} || 'Content-Length: ' || cast(octet_length(encode(html)) as varchar) as source_headers,
  'sha256:' || sha256(html) as payload_digest, {clean} as text,
  trim({sub("title_text", r"\s+", "' '")}, ' ') as title, regexp_extract(html, {q(LANG)}, 1) as lang,
  len(regexp_extract_all(html, {q(LINK)})) as links from d),
x as (select *, 'metadata' as warc_type, 'application/warc-fields' as content_type,
  'title: ' || title || {crlf} || 'language: ' || lang || {crlf} || 'links: ' || cast(links as varchar) || {crlf} || 'payloadDigest: ' || payload_digest || {crlf} || 'textDigest: sha256:' || sha256(text) || {crlf}
  || 'http-status: ' || replace(source_headers, {crlf}, {crlf} || 'http-') || {crlf} as block from r
  union all select *, 'conversion', 'text/plain; charset=utf-8', text from r)
select page_id, warc_type, {uuid("warc_type || chr(10) || response_id")} as record_id, response_id as refers_to, uri as target_uri, '{DATE}' as date, content_type,
  cast(octet_length(encode(block)) as bigint) as content_length, 'sha256:' || sha256(block) as block_digest, payload_digest, source_headers, block from x"""


ORACLE_SQL = _sql()
