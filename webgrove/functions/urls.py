"""URL work: resolve, percent-encode, canonicalise (Arrow UDFs over arrays), and
the host, path and scheme tests (plain Columns)."""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import parse_qsl, quote, unquote, urlencode, urljoin, urlsplit, urlunsplit

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webgrove.functions.process import ListFunction, checked
from webgrove.functions.udf import task_udf
from webgrove.schema import PIECES_TYPE

# Characters left as they are in each part of a URL.
_PART_SAFE = ":/?@!$&'()*+,;=-._~%"
_QUERY_SAFE = _PART_SAFE.replace("'", "")       # http, https, ftp, file, ws, wss
_USER_SAFE = "!$&'()*+,-._~"
_SPECIAL_SCHEMES = frozenset("http https ftp file ws wss".split())

# Already resolved and encoded: nothing below would change such a URL.
_CLEAN_ROOT = re.compile(r"/(?![/])[A-Za-z0-9:@!$&'()*+,=\-_~%/]*(?:\.[A-Za-z0-9\-_~%]+)?")
# A path alone, no dot segments or parameters: only encoding is left to do.
_PLAIN_ROOT = re.compile(r"/(?!/)(?:[^\x00-\x20?#;/]|/(?!\.))*")
_CLEAN_ORIGIN = re.compile(r"https?://[a-z0-9\-.]+(?::[1-9][0-9]{0,3})?(?=/|\?|#|\Z)")
_STRIP = "".join(map(chr, range(33)))


# Whole URLs that encoding and joining leave as they are, and what their parts may hold.
_HOST = r"(https?://[a-z0-9\-.]+(?::[1-9][0-9]{0,3})?)"
_SETTLED = re.compile(_HOST[1:-1] + r"(?:/[A-Za-z0-9:/@!$&()*+,=\-._~%]*)?(?:\?[A-Za-z0-9:/?@!$&()*+,;=\-._~%]+)?(?:#[A-Za-z0-9:/?@!$&()*+,;=\-._~%]+)?")
# Escapes that stay: of characters a path must not hold, of its two marks, and of bytes above ASCII; in queries, of
# all ASCII but letters, digits, "_.-~" and the blank.
_PATH_ESCAPE = r"%(?:[01][0-9A-F]|2[023F]|3[CEF]|5[B-E]|60|7[BCDF]|[89A-F][0-9A-F])"
_QUERY_ESCAPE = r"%(?:[01][0-9A-F]|2[1-9A-CF]|3[A-F]|40|5[B-E]|60|7[BCDF])"
_CANONICAL = re.compile(
    _HOST + rf"((?:/(?:[A-Za-z0-9:/@!$&'()*+,;=\-._~]|{_PATH_ESCAPE})*)?)"
    rf"(?:\?((?:[A-Za-z0-9_.\-~+=&!$'()*,/:;?@]|{_QUERY_ESCAPE})*))?(?:#([A-Za-z0-9:/?@!$&'()*+,;=\-._~%]*))?")
# Characters that the percent-encoding of a query's parts does not keep, and those that the one of paths does.
_QUERY_RAW = "!$'()*,/:;?@"
_KEPT = ":/?@!$&'()+,;=~"


#: Longer URLs go to Python: the JVM's patterns recurse once per character of a repeated choice.
_SHORT = 1000


def _whole(pattern: re.Pattern[str]) -> str:
    return f"^(?:{pattern.pattern})\\z"


def _fits(url: Column, pattern: re.Pattern[str]) -> Column:
    return (F.length(url) <= _SHORT) & url.rlike(_whole(pattern))


def clean_origin(url: Column) -> Column:
    """Scheme and host of a URL that needs no rewriting; null for others."""
    found = F.regexp_extract(url, f"^({_CLEAN_ORIGIN.pattern.replace('(?=', '(?:(?=').replace('Z)', 'z))')})", 1)
    return F.when(F.length(found) > 0, found)


def encoded_path(value: Column) -> Column:
    """Percent-encoded as ``safe_url`` does it for a path: the form encoding, less what a path may hold."""
    out = F.replace(F.url_encode(value), F.lit("+"), F.lit("%20"))
    for char in _KEPT:
        out = F.replace(out, F.lit(f"%{ord(char):02X}"), F.lit(char))
    return F.replace(out, F.lit("%25"), F.lit("%"))     # last: an escape's own sign comes back whole


def settled(value: Column, origin: Column) -> Column:
    """The URL that a value resolves to, where that takes no more than plain functions; null for others.

    Those are whole URLs that hold nothing to encode, and rooted paths behind ``origin``.
    """
    return (F.when(origin.isNotNull() & value.rlike(_whole(_CLEAN_ROOT)), F.concat(origin, value))
            .when(origin.isNotNull() & ~value.startswith("/.") & _fits(value, _PLAIN_ROOT), F.concat(origin, encoded_path(value)))
            .when(_fits(value, _SETTLED), value))


def is_plain(url: Column) -> Column:
    """``canonical_plain`` holds for this URL."""
    return F.coalesce(_fits(url, _CANONICAL), F.lit(False))


def canonical_plain(url: Column) -> Column:
    """``canonical_url`` of an ASCII URL with usual escapes, as ``struct<key,url>``.

    Pairs are sorted by what they say, decoded, and written in one way.
    """

    def part(i: int) -> Column:
        return F.coalesce(F.regexp_extract(url, _whole(_CANONICAL), i), F.lit(""))

    def encoded(text: Column) -> Column:
        for char in _QUERY_RAW:
            text = F.replace(text, F.lit(char), F.lit(f"%{ord(char):02X}"))
        return F.replace(text, F.lit("="), F.lit("%3D"))

    def pair(piece: Column) -> Column:
        name = F.substring_index(piece, "=", 1)
        value = F.substring(piece, F.length(name) + 2, F.length(piece))
        return F.struct(F.url_decode(name).alias("name"), F.url_decode(value).alias("value"), F.concat(encoded(name), F.lit("="), encoded(value)).alias("text"))

    pieces = F.filter(F.split(part(3), "&"), lambda p: p != "")
    query = F.array_join(F.transform(F.array_sort(F.transform(pieces, pair)), lambda p: p["text"]), "&")
    path = F.when(part(2) == "", "/").otherwise(part(2))
    plain = F.concat(part(1), path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    return F.struct(F.concat(plain, F.when(part(4) == "", "").otherwise(F.concat(F.lit("#"), part(4)))).alias("key"), plain.alias("url"))

_CANONICAL_TYPE = T.ArrayType(
    T.StructType([T.StructField("key", T.StringType()), T.StructField("url", T.StringType())])
)


def safe_url(url: str) -> str:
    """Percent-encode what a URL may not hold; ValueError when it is no URL."""
    parts = urlsplit(url.strip(_STRIP))
    netloc = ""
    if parts.username is not None or parts.password is not None:
        netloc = quote(unquote(parts.username or ""), _USER_SAFE)
        if parts.password is not None:
            netloc += ":" + quote(unquote(parts.password), _USER_SAFE)
        netloc += "@"
    host = parts.hostname or ""
    if ":" in host:
        netloc += f"[{host}]"
    elif host.isascii():
        netloc += host
    else:
        try:
            netloc += host.encode("idna").decode("ascii")
        except UnicodeError:
            netloc += quote(host, "")
    if parts.port is not None:
        netloc += f":{parts.port}"
    query_safe = _QUERY_SAFE if parts.scheme in _SPECIAL_SCHEMES else _PART_SAFE
    return urlunsplit((
        parts.scheme,
        netloc,
        quote(parts.path, _PART_SAFE),
        quote(parts.query, query_safe),
        quote(parts.fragment, _PART_SAFE),
    ))


def canonical_url(url: str, *, keep_fragment: bool = False) -> str:
    """Sorted query, one form of percent-encoding, lower-case host, no fragment."""
    parts = urlsplit(safe_url(url))
    pairs = sorted(parse_qsl(parts.query, keep_blank_values=True, errors="surrogateescape"))
    # An encoded slash or question mark would change meaning if decoded.
    path = re.sub(r"%(2[fF]|3[fF])", lambda m: "%25" + m.group(1).upper(), parts.path)
    path = quote(unquote(path, errors="surrogateescape"), _PART_SAFE, errors="surrogateescape")
    user, at, host = parts.netloc.rpartition("@")
    return urlunsplit((
        parts.scheme,
        user + at + host.lower().rstrip(":"),
        path or "/",
        urlencode(pairs, errors="surrogateescape"),
        parts.fragment if keep_fragment else "",
    ))


def _join(base: str, value: str) -> str | None:
    try:
        return urljoin(base, value)
    except ValueError:
        return None


def _finish(page_url: str, value: str) -> str | None:
    try:
        return urljoin(page_url, safe_url(value))
    except ValueError:
        return None


def _per_page(pages: list[pa.Array], values: pa.Array, one: Callable) -> pa.Array:
    """Apply ``one(*page values, value)`` to every value of every page's list."""
    out: list[str | None] = []
    offsets = [0]
    for *page, items in zip(*(p.to_pylist() for p in pages), values.to_pylist(), strict=True):
        if items:
            out += [None if item is None else one(*page, item) for item in items]
        offsets.append(len(out))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(out, pa.string()))


@task_udf(PIECES_TYPE)
def join_urls(base: pa.Array, values: pa.Array) -> pa.Array:
    """Values resolved on the base URL; null where that fails."""
    return _per_page([base], values, lambda b, v: _join(b or "", v))


@task_udf(PIECES_TYPE)
def finish_urls(page_url: pa.Array, values: pa.Array) -> pa.Array:
    """Values percent-encoded, then resolved on the page URL; null where that fails."""
    return _per_page([page_url], values, lambda u, v: _finish(u or "", v))


def process_urls(apply: ListFunction) -> Callable[[str, str, Column], Column]:
    """``join_urls``, a user's function and ``finish_urls`` in one pass over the pages of a batch.

    The function sees the URLs of all pages as one list, without those that do not resolve.
    """

    @task_udf(PIECES_TYPE)
    def run(base: pa.Array, page_url: pa.Array, values: pa.Array) -> pa.Array:
        joined: list[str | None] = []
        owners: list[str] = []
        offsets = [0]
        for b, u, items in zip(base.to_pylist(), page_url.to_pylist(), values.to_pylist(), strict=True):
            joined += [None if item is None else _join(b or "", item) for item in items or ()]
            owners += [u or ""] * (len(joined) - len(owners))
            offsets.append(len(joined))
        at = [i for i, url in enumerate(joined) if url is not None]
        given = [joined[i] for i in at]
        for i, url in zip(at, checked(given, apply(given)) if given else (), strict=True):
            joined[i] = None if url is None else _finish(owners[i], url)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(joined, pa.string()))

    return run


@task_udf(PIECES_TYPE)
def resolve_urls(base: pa.Array, page_url: pa.Array, values: pa.Array) -> pa.Array:
    """``join_urls`` and ``finish_urls`` in one pass, for when nothing comes between."""
    origins: dict[str, str | None] = {}

    def one(b: str | None, u: str | None, value: str) -> str | None:
        b = b or ""
        if value[:1] == "/":
            if b not in origins:
                found = _CLEAN_ORIGIN.match(b)
                origins[b] = found.group() if found else None
            if origins[b]:
                if _CLEAN_ROOT.fullmatch(value):
                    return origins[b] + value
                if value[1:2] != "." and _PLAIN_ROOT.fullmatch(value):
                    return origins[b] + quote(value, _PART_SAFE)
        joined = _join(b, value)
        return None if joined is None else _finish(u or "", joined)

    return _per_page([base, page_url], values, one)


@task_udf(_CANONICAL_TYPE)
def canonical_urls(values: pa.Array) -> pa.Array:
    """Per URL: the comparison key (fragment kept) and the canonical URL."""
    flat = values.flatten()
    keys = [None if u is None else canonical_url(u, keep_fragment=True) for u in flat.to_pylist()]
    pairs = pa.StructArray.from_arrays(
        [
            pa.array(keys, pa.string()),
            pa.array([None if k is None else k.partition("#")[0] for k in keys], pa.string()),
        ],
        names=["key", "url"],
    )
    offsets = values.offsets
    if len(offsets) and offsets[0].as_py():
        offsets = pc.subtract(offsets, offsets[0])
    return pa.ListArray.from_arrays(offsets, pairs)


def scheme(url: Column) -> Column:
    return F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1)


def netloc(url: Column) -> Column:
    """Host with port and user part, lower case; "" when the URL has none."""
    return F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def host(url: Column) -> Column:
    """Host name alone, lower case."""
    return F.regexp_extract(netloc(url), r"^(?:[^@]*@)?(\[[^\]]*\]|[^:]*)", 1)


def path(url: Column) -> Column:
    """Path without the parameters of its last segment."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?((?:[^?#;]|;(?=[^?#]*/))*)", 1)


def host_suffixes(name: Column) -> Column:
    """``a.b.c`` -> ``[a.b.c, b.c, c]``, the domains a host belongs to."""
    labels = F.split(name, r"\.")
    return F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
