"""Which responses are HTML, and their text.  Narrow; the same on streams."""

from __future__ import annotations

import codecs
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webgrove.functions.udf import task_udf
from webgrove.functions.urls import path
from webgrove.schema import require

# Content types by kind of response.
MIME_KINDS = {
    "html": "text/html application/xhtml+xml application/vnd.wap.xhtml+xml",
    "xml": "application/xml text/xml application/atom+xml application/rdf+xml application/rss+xml",
    "json": "application/json application/x-json application/json-amazonui-streaming",
    "text": "application/javascript application/x-javascript",     # and every other text/*
}

# File name extensions by kind; others say nothing about the kind.
EXTENSION_KINDS = {
    "html": "html htm shtml xhtml xht",
    "xml": "xml xsl xsd rdf rss atom wsdl xpdl",
    "json": "json",
    "text": "asc txt text css csv tsv js mjs ics md markdown rtx etx sgml sgm vcf c h py pl bat ksh n3 srt",
}

# Parser names an override may carry; there is one parser here.
BACKENDS = ("lexbor", "html5ever")

# A value of Spark holds fewer bytes than this; bodies that inflate beyond it stay packed.
_MOST_BYTES = (1 << 31) - (1 << 20)
# Inflated bytes handed back to Spark per Arrow batch; a single larger body is a batch of its own.
_BATCH_BYTES = 16 << 20

# The codecs of the charsets that the web knows.
WEB_CODECS = frozenset(
    "utf-8 utf-16 utf-16-le utf-16-be cp866 cp874 cp932 cp949 gb18030 big5hkscs euc_jp iso2022_jp koi8-r koi8-u mac-roman mac-cyrillic"
    " cp1250 cp1251 cp1252 cp1253 cp1254 cp1255 cp1256 cp1257 cp1258 iso8859-2 iso8859-3 iso8859-4 iso8859-5 iso8859-6 iso8859-7"
    " iso8859-8 iso8859-10 iso8859-13 iso8859-14 iso8859-15 iso8859-16".split())

# Declared charsets that stand for a wider one.
_CODECS = {
    "ascii": "cp1252", "us-ascii": "cp1252", "iso-8859-1": "cp1252", "latin-1": "cp1252", "latin1": "cp1252",
    "iso-8859-9": "cp1254", "iso-8859-11": "cp874", "tis-620": "cp874", "gb2312": "gb18030", "gbk": "gb18030", "shift_jis": "cp932", "euc-kr": "cp949", "big5": "big5hkscs",
}


def header(name: str) -> Column:
    """The last value of a header, its name compared without case; null if absent."""
    entries = F.filter(F.map_entries("headers"), lambda e: F.lower(e["key"]) == name)
    return F.try_element_at(F.get(entries, F.lit(0))["value"], F.lit(-1))


def _one_of(value: Column, table: dict[str, str]) -> Column:
    kind = F.lit(None).cast("string")
    for name, members in table.items():
        kind = F.when(value.isin(*members.split()), name).otherwise(kind)
    return kind


def mime_kind(mime: Column) -> Column:
    return F.coalesce(_one_of(mime, MIME_KINDS), F.when(mime.startswith("text/"), "text"))


def name_kind(name: Column) -> Column:
    """Kind by the extension of a file name or URL path."""
    return _one_of(F.lower(F.regexp_extract(name, r"[^/]\.([^./]*)$", 1)), EXTENSION_KINDS)


def body_kind(body: Column) -> Column:
    """A marker anywhere in the body tells; without one, control characters say binary."""
    text = F.lower(F.decode(body, "ISO-8859-1"))
    return (
        F.when(body.isNull(), F.lit(None))
        .when(text.contains("<html>"), "html")
        .when(text.contains("<?xml"), "xml")
        .when(text.contains("<!doctype html>"), "html")
        .when(text.rlike(r"[\x01-\x08\x0b\x0c\x0e-\x1f]"), F.lit(None))
        .otherwise("text")
    )


def response_kind() -> Column:
    """``html``, ``xml``, ``json``, ``text`` or null: the first of content type,
    content disposition, URL extension and body that tells."""
    plain = F.coalesce(F.length(header("content-encoding")), F.lit(0)) == 0
    mime = F.lower(F.trim(F.split(header("content-type"), ";")[0]))
    attached = F.regexp_extract(header("content-disposition"), r"^[^;]*;[^=;]*=([^=;]*)", 1)
    return F.coalesce(
        F.when(plain, mime_kind(mime)),
        name_kind(F.btrim(attached, F.lit("\"' "))),
        name_kind(path(F.col("url"))),
        body_kind(F.col("body")),
    )


def classify_html(responses: DataFrame, *, default: bool | str | None = True) -> DataFrame:
    """Add ``kind`` and ``is_html`` (HTML *and* switched on for the row).

    ``default`` switches rows without an override.  Where ``has_override`` is
    true the row's ``backend_override`` decides, also when it is null or "false"
    (both off).  A ``kind`` column already present (an earlier decision) is kept
    where it says html.
    """
    require(responses, url=T.StringType, headers=T.MapType, body=T.BinaryType)
    if isinstance(default, str) and default not in BACKENDS:
        raise ValueError(f"unknown parser {default!r}; known: {BACKENDS}")
    enabled = F.lit(bool(default))
    if "has_override" in responses.columns:
        override = F.lower("backend_override")
        chosen = (
            F.when(override.isNull() | override.isin("", "false"), False)
            .when(override.isin(*BACKENDS, "true"), True)
            .otherwise(F.raise_error(F.concat(F.lit("unknown parser: "), F.col("backend_override"))).cast("boolean"))
        )
        enabled = F.when(F.coalesce("has_override", F.lit(False)), chosen).otherwise(enabled)
    kind = response_kind()
    if "kind" in responses.columns:
        kind = F.when(F.col("kind") == "html", "html").otherwise(kind)
    return responses.withColumn("kind", kind).withColumn(
        "is_html", enabled & F.coalesce(F.col("kind") == "html", F.lit(False)))


def split_html(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """HTML rows, and all the others unchanged."""
    return classified.where("is_html"), classified.where(~F.col("is_html"))


def html_only(classified: DataFrame, observation: Observation | str | None = None) -> DataFrame:
    """HTML rows; the number of rows left out is reported as ``skipped``."""
    if observation is not None:
        skipped = F.count_if(~F.col("is_html")).alias("skipped")
        classified = classified.observe(observation, skipped)
    return classified.where("is_html")


def _member(data: bytes, wbits: int, room: int) -> tuple[bytes, bytes]:
    """One compressed member, whole, and what follows it; else ``zlib.error``."""
    stream = zlib.decompressobj(wbits)
    plain = stream.decompress(data, room)
    if not stream.eof:
        raise zlib.error("cut short, or too large for a value")
    return plain, stream.unused_data


def _inflate(body: bytes) -> bytes:
    out, rest, room = [], body, _MOST_BYTES
    while rest:
        try:
            plain, rest = _member(rest, 47, room)       # gzip or zlib header
        except zlib.error:
            if not out:
                return _member(rest, -15, room)[0]
            if rest[:2] == b"\x1f\x8b":
                raise                                   # a further member that is not whole
            break                                       # padding after the last member
        out.append(plain)
        room -= len(plain)
        if not room:
            raise zlib.error("too large for a value")
    return b"".join(out)


def _inflated(body: bytes | None) -> bytes | None:
    try:
        return None if body is None else _inflate(body)
    except zlib.error:
        return None


def _with_plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add ``_plain``, the inflated ``_packed``; batches end by inflated bytes."""
    for batch in batches:
        start, size, plain = 0, 0, []
        for row, body in enumerate(batch.column("_packed")):
            plain.append(_inflated(body.as_py()))
            size += len(plain[-1] or b"")
            if size >= _BATCH_BYTES or row + 1 == batch.num_rows:
                part = batch.slice(start, row + 1 - start)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(plain, pa.binary())], names=[*part.schema.names, "_plain"])
                start, size, plain = row + 1, 0, []


def decompress(responses: DataFrame) -> DataFrame:
    """Undo gzip or deflate named by ``Content-Encoding`` and remove that header.

    Goes before ``classify_html``, which takes no content type from a body that
    is still compressed.  Other rows, and bodies that do not inflate to their
    end, stay as they are.
    """
    require(responses, headers=T.MapType, body=T.BinaryType)
    packed = F.lower(F.trim(header("content-encoding"))).isin("gzip", "x-gzip", "deflate")
    work = responses.withColumns({"_packed": F.when(packed, F.col("body")), "body": F.when(packed, F.lit(None)).otherwise(F.col("body"))})
    work = work.mapInArrow(_with_plain, T.StructType([*work.schema.fields, T.StructField("_plain", T.BinaryType())]))
    done = F.col("_plain").isNotNull()
    return work.withColumns({
        "body": F.coalesce("_plain", "_packed", "body"),
        "headers": F.when(done, F.map_filter("headers", lambda k, _: F.lower(k) != "content-encoding")).otherwise(F.col("headers")),
    }).select(*responses.columns)


@task_udf(T.StringType())
def _decode(bodies: pa.Array, charsets: pa.Array) -> pa.Array:
    out = []
    for body, charset in zip(bodies.to_pylist(), charsets.to_pylist(), strict=True):
        out.append(None if body is None else _decode_one(body, charset))
    return pa.array(out, pa.string())


def _decode_one(body: bytes, charset: str | None) -> str:
    for mark, name in ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be")):
        if body.startswith(mark):
            return body[len(mark):].decode(name, "replace")
    charset = (charset or "").strip().lower()
    try:
        codec = codecs.lookup(_CODECS.get(charset, charset)).name
        if codec in WEB_CODECS:
            return body.decode(codec, "replace").encode("utf-8", "replace").decode()
    except (LookupError, UnicodeError):
        pass
    try:
        return body.decode("utf-8")
    except UnicodeDecodeError:
        return body.decode("cp1252", "replace")


def declared_charset() -> Column:
    """The charset named by the content type, else by a meta tag, else ""."""
    in_header = F.lower(F.regexp_extract(header("content-type"), r"(?i)charset\s*=\s*[\"']?([\w.:-]+)", 1))
    in_body = F.lower(F.regexp_extract(
        F.decode("body", "ISO-8859-1"), r"(?i)<meta[^>]*?charset\s*=\s*[\"']?([\w.:-]+)", 1))
    return F.when(F.length(in_header) > 0, in_header).otherwise(in_body)


def with_text(responses: DataFrame, name: str = "html") -> DataFrame:
    """Add the body as text: byte order mark, then declared charset, then UTF-8,
    then Windows-1252.  The bytes of valid UTF-8 never leave the JVM."""
    body, text = F.col("body"), F.col("body").cast("string")
    marked = F.substring(body, 1, 3).isin(F.unhex(F.lit("EFBBBF"))) | F.substring(body, 1, 2).isin(
        F.unhex(F.lit("FFFE")), F.unhex(F.lit("FEFF")))
    work = responses.withColumn("_charset", declared_charset())
    work = work.withColumn("_direct", F.col("_charset").isin("", "utf-8", "utf8") & F.is_valid_utf8(text) & ~marked)
    other = ~F.col("_direct")
    decoded = _decode(F.when(other, body), F.when(other, F.col("_charset")))
    return work.withColumn(name, F.when(F.col("_direct"), text).otherwise(decoded)).drop("_charset", "_direct")


def to_pages(classified: DataFrame, *, carry: Iterable[str] = ()) -> DataFrame:
    """HTML rows as ``page_id, url, html``; the URL is the id where there is none."""
    html = with_text(classified.where("is_html"))
    page_id = F.col("page_id") if "page_id" in classified.columns else F.col("url")
    return html.select(page_id.alias("page_id"), "url", "html", *carry)
