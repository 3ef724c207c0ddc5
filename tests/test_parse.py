"""Parsing pages to rows."""

import random

import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.fixtures import SITE
from webgrove import css, nodes, parse_pages
from webgrove.functions.page_tree import INT_FIELDS, PageColumns


def tree(source, **options):
    columns = PageColumns(**options)
    columns.add(source)
    rows = [dict(zip(INT_FIELDS, r, strict=True)) | {"tag": t} for r, t in zip(columns.numbers, columns.tags, strict=True)]
    return columns, rows


def serialised(source):
    return "".join(tree(source)[0].markup)


WRAP = "<html><head></head><body>{}</body></html>"


@pytest.mark.parametrize(("source", "body"), [
    ("", ""),
    ("<p>a<p>b", "<p>a</p><p>b</p>"),
    ("<p>a<div>b</div>c", "<p>a</p><div>b</div>c"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "<ul><li>a</li><li>b<ul><li>c</li></ul></li><li>d</li></ul>"),
    ("<dl><dt>a<dd>b<dt>c</dl>", "<dl><dt>a</dt><dd>b</dd><dt>c</dt></dl>"),
    ("<table><tr><td>1<td>2<tr><th>3</table>x", "<table><tbody><tr><td>1</td><td>2</td></tr><tr><th>3</th></tr></tbody></table>x"),
    ("<table><col><tr><td>1</table>", "<table><colgroup><col></colgroup><tbody><tr><td>1</td></tr></tbody></table>"),
    ("<td>x</td>", "x"),
    ("<select><option>1<option>2</select>", "<select><option>1</option><option>2</option></select>"),
    ("a < b & c &amp; &ampx", "a &lt; b &amp; c &amp; &amp;x"),
    ("<a href=/x/>1<a href='/y' HREF=z disabled>2</a>", '<a href="/x/">1</a><a href="/y" disabled="">2</a>'),
    ("<h1>a<h2>b</h1>c", "<h1>a</h1><h2>b</h2>c"),
    ("<svg><path d=1/><g/></svg>t", '<svg><path d="1/"></path><g></g></svg>t'),
    ("x</br>y</p>z", "x<br>y<p></p>z"),
    ("x</span></div>y", "xy"),
    ("x<a href='unclosed>zzz", "x"),
    ("x<!-- c -->y<!-->z<!d>w</>v", "x<!-- c -->y<!---->z<!--d-->wv"),
    ("<p><b>X.<br><p>Y</p><div>z</div>", "<p><b>X.<br></b></p><p><b>Y</b></p><div><b>z</b></div>"),
    ("<p><b>x</b><p>y", "<p><b>x</b></p><p>y</p>"),
    ("<pre>\n x</pre>", "<pre> x</pre>"),
    ("<textarea><b>&lt;</textarea>", "<textarea>&lt;b&gt;&lt;</textarea>"),
    ("<button>a<button>b", "<button>a</button><button>b</button>"),
    ("<form><form><input></form>", "<form><input></form>"),
    ("a\x00b\r\nc", "ab\nc"),
])
def test_tree_building(source, body):
    assert serialised(source) == WRAP.format(body)


def test_head_and_body_are_told_apart():
    assert serialised("<title>a</title><meta charset=x><p>b</p>") == (
        '<html><head><title>a</title><meta charset="x"></head><body><p>b</p></body></html>')
    assert serialised('<html lang=en><body class=c>x<body id=i class=d>') == (
        '<html lang="en"><head></head><body class="c" id="i">x</body></html>')
    assert serialised("<script>var t='</p><b>';</script >x") == (
        "<html><head><script>var t='</p><b>';</script></head><body>x</body></html>")


def test_elements_after_the_head_still_belong_to_it():
    assert serialised("<head><title>a</title></head><link href=x><p>b") == (
        '<html><head><title>a</title><link href="x"></head><body><p>b</p></body></html>')


def test_attribute_entities_without_semicolon():
    columns, rows = tree('<a href="?a=1&copy=2&lt;&notit;&amp">z</a>')
    assert dict(zip(columns.attr_names, columns.attr_values, strict=True)) == {"href": "?a=1&copy=2<&notit;&"}


def test_valueless_and_empty_attributes_differ():
    columns, _ = tree("<input disabled value='' DISABLED=x>")
    assert dict(zip(columns.attr_names, columns.attr_values, strict=True)) == {"disabled": None, "value": ""}


def check_numbers(columns, rows):
    total_text, total_markup = len(columns.texts), len(columns.markup)
    for row in rows:
        assert row["pre"] <= row["last"] < len(rows)
        assert 0 <= row["t0"] <= row["t1"] <= total_text
        assert 0 <= row["h0"] < row["h1"] <= total_markup
        if row["parent"] >= 0:
            parent = rows[row["parent"]]
            assert parent["pre"] < row["pre"] <= row["last"] <= parent["last"]
            assert row["depth"] == parent["depth"] + 1
            assert parent["t0"] <= row["t0"] and row["t1"] <= parent["t1"]
            assert parent["h0"] < row["h0"] and row["h1"] < parent["h1"]
            children = [r for r in rows if r["parent"] == parent["pre"]]
            assert row["nsib"] == len(children)
            assert [r["sib"] for r in children] == list(range(1, len(children) + 1))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([
    "<p>", "</p>", "<div>", "</div>", "<b>", "</b>", "<a href=x>", "</a>", "<table>", "<tr>", "<td>", "</table>", "<li>", "<ul>",
    "</ul>", "<br>", "<!-- c -->", "text ", " ", "<script>", "</script>", "<svg>", "</svg>", "<x/>", "<title>", "</title>",
    "&amp;", "<", "</", "<h1>", "</h2>", "<select>", "<option>", "<body>", "</body>", "<head>", "<template>", "</template>",
]), max_size=25))
def test_numbers_hold_for_any_markup(pieces):
    columns, rows = tree("".join(pieces))
    check_numbers(columns, rows)
    assert [r["tag"] for r in rows[:1]] == ["html"]


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="<>/='\"!-a b&;#x\n", max_size=60))
def test_any_text_is_read_to_the_end(source):
    check_numbers(*tree(source))


def test_reading_back_the_serialised_page_changes_nothing():
    rng = random.Random(7)
    for _ in range(50):
        source = "".join(rng.choice(["<p>a", "<div>", "</div>", "<ul><li>x", "</ul>", "<b>", "</b>", "<h2>t</h2>", "&lt;"]) for _ in range(12))
        once = serialised(source)
        assert serialised(once) == once


def test_only_tags_keeps_numbers():
    _, every = tree(SITE)
    _, some = tree(SITE, markup=False, only_tags=frozenset({"a"}))
    assert [r["pre"] for r in some] == [r["pre"] for r in every if r["tag"] == "a"]


def test_parse_pages_rows(spark):
    pages = spark.createDataFrame(
        [(1, "http://example.com", SITE), (2, "http://example.com/2", None), (3, None, "<base href='/b/'>x"),
         (4, "http://e.com/a/b", "<base href=' ../c/ '>x"), (5, "http://e.com/a", "<base><base href='http://[bad'>")],
        "page_id long, url string, html string")
    docs = parse_pages(pages)
    assert docs.columns == ["page_id", "url", "base_url", "texts", "markup", "nodes"]
    got = {r.page_id: (r.base_url, r.n) for r in docs.select("page_id", "base_url", F.size("nodes").alias("n")).collect()}
    assert got == {1: ("http://example.com", 19), 2: ("http://example.com/2", 0), 3: (None, 4),
                   4: ("http://e.com/c/", 4), 5: ("http://e.com/a", 5)}
    assert "markup" not in parse_pages(pages, keep=("text",)).columns
    assert docs.select(css("*").count()).where("page_id = 2").first()[0] == 0
    tags = [r.tag for r in nodes(docs).where("page_id = 1").orderBy("pre").collect()]
    assert tags[:6] == ["html", "head", "meta", "title", "link", "link"]


def test_carried_columns_and_contract(spark):
    pages = spark.createDataFrame([(1, "u", "<p>x", 7)], "page_id long, url string, html string, day int")
    assert parse_pages(pages, carry=("day",)).select("day").first()[0] == 7
    with pytest.raises(ValueError, match="html"):
        parse_pages(pages.drop("html"))
    with pytest.raises(TypeError, match="html"):
        parse_pages(pages.withColumn("html", F.lit(1)))
    with pytest.raises(ValueError, match="keep"):
        parse_pages(pages, keep=("xml",))


def test_result_does_not_depend_on_partitioning(spark):
    pages = spark.range(60).select(
        F.col("id").alias("page_id"), F.lit("http://e.com").alias("url"),
        F.concat(F.lit("<ul>"), F.repeat(F.lit("<li><a href=/x>t</a>"), F.col("id").cast("int"))).alias("html"))
    runs = []
    for parts in (1, 7):
        docs = parse_pages(pages.repartition(parts))
        runs.append(sorted(docs.select("page_id", css("li a").count()).collect()))
    assert runs[0] == runs[1]
    assert [r[1] for r in runs[0]] == list(range(60))


def test_large_pages_are_split_over_output_batches(spark):
    pages = spark.range(6).select(
        F.col("id").alias("page_id"), F.lit("http://e.com").alias("url"),
        F.repeat(F.lit("<p class=x>some text here</p>"), 100_000).alias("html"))
    got = parse_pages(pages.coalesce(1)).select("page_id", F.size("nodes"), css("p:last-child::text").get()).collect()
    assert sorted(got) == [(i, 100_003, "some text here") for i in range(6)]


@pytest.mark.parametrize("n", [40, 200])
def test_all_unclosed_formatting_is_reopened(n):
    source = "<p>" + "".join(f"<b id={i}>" for i in range(n)) + "x<p>y"
    assert [r["tag"] for r in tree(source)[1]].count("b") == 2 * n
    alike = "<p>" + "<b>" * n + "x<p>y"
    assert [r["tag"] for r in tree(alike)[1]].count("b") == n + 3


def test_many_unclosed_elements_stay_cheap():
    many = "".join(f"<i id={i}>" for i in range(20_000)) + "".join("</b><a href=x>y</a>" for _ in range(3000))
    start = time.perf_counter()
    assert len(tree(many)[1]) == 23_003
    assert time.perf_counter() - start < 10


def test_invalid_bytes_end_no_job(spark):
    pages = spark.createDataFrame([(1, "http://e.com/", "x")], "page_id long, url string, html string").withColumn(
        "html", F.concat(F.lit("<p>a".encode()), F.unhex(F.lit("FF")), F.lit("b<a href=/c>d".encode())).cast("string"))
    docs = parse_pages(pages)
    assert docs.select(css("p::text").get()).first()[0] == "a\ufffdbd"
