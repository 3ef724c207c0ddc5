"""Which responses are HTML, and their text."""

import gzip
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from webgrove import classify_html, css, decompress, html_only, links_from_pages, parse_pages, split_html, to_pages
from webgrove.operators.routing import _with_plain
from webgrove.schema import RESPONSES_SCHEMA
from webgrove.sources.tables import read_response_files

HTML = b"<html><title>Orchard</title><p>apples, pears</p></html>"
XML = b'<?xml version="1.0" encoding="utf-8"?><harvest year="3"><crate href="/apples">full</crate><link href="/pears"/></harvest>'


@pytest.fixture
def frame(spark):
    def make(*rows):
        full = [(u, h, b, o is not ..., None if o is ... else o) for u, h, b, o in rows]
        return spark.createDataFrame(full, RESPONSES_SCHEMA)

    return make


def row(body, headers=None, url="http://example.com", override=...):
    return url, {k: v if isinstance(v, list) else [v] for k, v in (headers or {}).items()}, body, override


@pytest.mark.parametrize(("kind", "item"), [
    ("html", row(HTML, {"Content-Type": "text/html"})),
    ("html", row(b"x", {"CONTENT-TYPE": "Text/HTML; charset=x"})),
    ("html", row(b"x", {"Content-Type": "application/xhtml+xml"})),
    ("html", row(b"x", {"Content-Type": ["text/plain", "text/html"]})),
    ("xml", row(HTML, {"Content-Type": "application/xml"})),
    ("xml", row(HTML, {"Content-Type": "text/xml"})),
    ("json", row(b"{}", {"Content-Type": "application/json"})),
    ("text", row(HTML, {"Content-Type": "text/plain"})),
    ("text", row(HTML, {"Content-Type": "application/javascript"})),
    ("html", row(b"x", {"Content-Disposition": 'attachment; filename="page.HTML"'})),
    ("xml", row(HTML, {"Content-Type": "application/unknown", "Content-Disposition": "attachment; filename=d.xml"})),
    ("html", row(b"x", url="http://example.com/a/page.html?q=x.json#f")),
    ("text", row(HTML, url="http://example.com/notes.txt")),
    ("html", row(HTML, url="http://example.com/file.pdf")),
    ("html", row(HTML)), ("html", row(b"<!DOCTYPE html><p>x")), ("xml", row(b"<?xml ?><root/>")),
    ("text", row(b"plain text")), ("text", row(b'{"key": "value"}')), ("text", row(b"")),
    ("html", row(b"\x01\x02<html>")), (None, row(b"\x01\x02html")), (None, row(None)),
    (None, row(gzip.compress(HTML), {"Content-Type": "text/html", "Content-Encoding": "gzip"})),
    ("html", row(b"x" * 5000 + HTML)),
])
def test_kind(frame, kind, item):
    got = classify_html(frame(item)).first()
    assert (got.kind, got.is_html) == (kind, kind == "html")


@pytest.mark.parametrize(("default", "override", "expected"), [
    (True, ..., True), ("lexbor", ..., True), (None, ..., False), (False, ..., False),
    (True, None, False), (True, "false", False), (True, "", False), (None, "html5ever", True), (False, "lexbor", True), (None, None, False),
])
def test_switch_and_override(frame, default, override, expected):
    assert classify_html(frame(row(HTML, override=override)), default=default).first().is_html is expected


def test_unknown_parsers_are_refused(frame):
    with pytest.raises(ValueError, match="unknown parser"):
        classify_html(frame(row(HTML)), default="lxml")
    with pytest.raises(Exception, match="unknown parser"):
        classify_html(frame(row(HTML, override="lxml"))).collect()


def test_earlier_decision_is_kept(frame):
    df = frame(row(b"plain text"), row(HTML)).withColumn("kind", F.lit("html"))
    assert [r.is_html for r in classify_html(df).collect()] == [True, True]


def test_branches_together_are_the_input(frame):
    df = frame(row(HTML), row(XML), row(b"plain"), row(None))
    html, rest = split_html(classify_html(df))
    assert (html.count(), rest.count()) == (1, 3)
    assert sorted(map(str, html.unionAll(rest).select("body").collect())) == sorted(map(str, df.select("body").collect()))


def test_xml_gives_no_links_and_is_counted(frame):
    df = frame(row(XML, {"Content-Type": "application/xml"}), row(XML, {"Content-Type": "text/xml"}), row(b"<html><a href=/x>t"))
    seen = Observation("routing")
    links = links_from_pages(to_pages(html_only(classify_html(df), seen)))
    assert [r.url for r in links.collect()] == ["http://example.com/x"]
    assert seen.get == {"skipped": 2}


def test_compressed_page_end_to_end(frame):
    html = b"""<html><body><h1>Main Page</h1><a href="/page1">1</a><a href="/page2">2</a>
    <a href="https://example.com/external">E</a></body></html>"""
    head = {"Content-Type": "text/html", "Content-Encoding": "gzip"}
    pages = to_pages(classify_html(decompress(frame(row(gzip.compress(html), head)))))
    assert [r.url for r in links_from_pages(pages).orderBy("pos").collect()] == [
        "http://example.com/page1", "http://example.com/page2", "https://example.com/external"]
    assert parse_pages(pages).select(css("h1::text").get()).first()[0] == "Main Page"


def test_decompress_variants(frame):
    raw = zlib.compressobj(wbits=-15)
    raw_deflate = raw.compress(HTML) + raw.flush()
    bodies = [
        row(gzip.compress(HTML[:9]) + gzip.compress(HTML[9:]), {"content-encoding": "x-gzip"}, "u0"),
        row(zlib.compress(HTML), {"Content-Encoding": "deflate"}, "u1"), row(raw_deflate, {"Content-Encoding": "deflate"}, "u2"),
        row(b"not gzip", {"Content-Encoding": "gzip"}, "u3"), row(HTML, {"Content-Encoding": "br"}, "u4"),
        row(HTML, {"X": "y"}, "u5"), row(None, {"Content-Encoding": "gzip"}, "u6"),
    ]
    got = {r.url: (bytes(r.body) if r.body is not None else None, sorted(r.headers)) for r in decompress(frame(*bodies)).collect()}
    assert [got[f"u{i}"][0] for i in range(7)] == [HTML, HTML, HTML, b"not gzip", HTML, HTML, None]
    assert [got[f"u{i}"][1] for i in range(6)] == [[], [], [], ["Content-Encoding"], ["Content-Encoding"], ["X"]]


@pytest.mark.parametrize(("text", "body", "content_type"), [
    ("<html>é", "<html>é".encode(), "text/html"),
    ("<html>é", "<html>é".encode(), "text/html; charset=utf-8"),
    ("<html>é€", "<html>é€".encode("cp1252"), "text/html; charset=ISO-8859-1"),
    ("<html>é", "<html>é".encode("latin-1"), "text/html"),
    ("<html>ж", "<html>ж".encode("koi8-r"), "text/html; charset=koi8-r"),
    ("<html>é", b"\xef\xbb\xbf" + "<html>é".encode(), "text/html; charset=latin-1"),
    ("<html>é", b"\xff\xfe" + "<html>é".encode("utf-16-le"), "text/html"),
    ("<html>é", "<html>é".encode(), "text/html; charset=no-such"),
    ('<meta charset="cp1251">ж', '<meta charset="cp1251">ж'.encode("cp1251"), "text/html"),
])
def test_text_of_a_body(frame, text, body, content_type):
    assert to_pages(classify_html(frame(row(body, {"Content-Type": content_type})))).first().html == text


def test_stored_files_as_responses(spark, tmp_path):
    (tmp_path / "a.html").write_bytes(b"<p>x")
    (tmp_path / "b.json").write_bytes(b"{}")
    got = classify_html(read_response_files(spark, str(tmp_path)))
    assert {r.url.rsplit("/", 1)[1]: r.kind for r in got.collect()} == {"a.html": "html", "b.json": "json"}
    assert read_response_files(spark, str(tmp_path), glob="*.html").count() == 1


def test_a_marker_anywhere_tells(frame):
    late = b"<!--" + b"x" * 20_000 + b"--><html><a href=/y>t"
    odd = b"\x01\x02" + b"z" * 6000 + b"<HTML><p>"
    got = [r.kind for r in classify_html(frame(row(late, {}), row(odd, {}), row(b"\x01\x02zz", {}))).collect()]
    assert got == ["html", "html", None]


def test_a_long_meta_tag_declares_its_charset(frame):
    text = f'<html><meta data-x="{"y" * 300}" charset=iso-8859-2>\u0141'
    pages = to_pages(classify_html(frame(row(text.encode("iso-8859-2"), {"Content-Type": "text/html"}))))
    assert pages.first().html == text


@pytest.mark.parametrize("charset", ["unicode_escape", "utf-7", "rot13", "idna", "raw_unicode_escape", "undefined", "base64"])
def test_odd_charsets_end_no_job(frame, charset):
    body = b"<html>\\ud800 caf\xe9"
    assert to_pages(classify_html(frame(row(body, {"Content-Type": f"text/html; charset={charset}"})))).first().html == "<html>\\ud800 café"


def test_bodies_cut_short_stay_packed(frame):
    whole = gzip.compress(HTML * 500)
    head = {"Content-Encoding": "gzip"}
    cut = [whole[:len(whole) // 2], gzip.compress(HTML) + whole[:40], zlib.compress(HTML)[:-3]]
    got = decompress(frame(*(row(b, head, f"u{i}") for i, b in enumerate(cut)), row(whole + b"\0\0", head, "u3"))).collect()
    assert [bytes(r.body) for r in got] == [*cut, HTML * 500]
    assert [sorted(r.headers) for r in got] == [["Content-Encoding"]] * 3 + [[]]


def test_large_bodies_come_back_in_small_batches():
    packed = pa.record_batch({"x": pa.array(range(6)), "_packed": pa.array([gzip.compress(b"y" * (6 << 20))] * 6)})
    sizes = [b.num_rows for b in _with_plain(iter([packed]))]
    assert sizes == [3, 3]
