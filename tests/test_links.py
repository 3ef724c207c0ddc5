"""Link extraction."""

import re
from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.fixtures import LINKS
from webgrove import extract_links, iter_links, links_from_pages, parse_pages, restrict_domains
from webgrove.functions.urls import safe_url
from webgrove.operators.links import LinkOptions, candidates, in_domains


@pytest.fixture
def links(spark):
    def run(html, url="http://example.com", **options):
        pages = spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")
        rows = extract_links(parse_pages(pages, keep=("text",)), **options).orderBy("pos").collect()
        pruned = links_from_pages(pages, **options).orderBy("pos").collect()
        assert rows == pruned
        assert [r.pos for r in rows] == list(range(len(rows)))
        return [r.url for r in rows]

    return run


ALL = ["http://example.com/trees", "http://example.com/press", "http://example.com/visit", "http://example.com/cider",
       "http://maps.example.org/road", "http://example.com/plan", "http://example.com/legal"]


def test_all_links_in_document_order(links):
    assert links(LINKS) == ALL


def test_allow_and_deny(links):
    assert links(LINKS, allow=r"/cider") == [ALL[3]]
    assert links(LINKS, deny=r"/plan") == ALL[:5] + ALL[6:]
    assert links(LINKS, allow=[r"/cider", r"/pr(?P<rest>ess)"]) == [ALL[1], ALL[3]]
    assert links(LINKS, allow=r"example\.com", deny=(r"/trees", r"/vis")) == [ALL[1], ALL[3], ALL[5], ALL[6]]


def test_compiled_patterns(links):
    assert links(LINKS, allow=re.compile("/CIDER", re.I)) == [ALL[3]]
    assert links(LINKS, allow=[re.compile("/c.{,3}er"), "/legal"]) == [ALL[3], ALL[6]]
    assert links(LINKS, deny=re.compile("""example . com   # this site""", re.X)) == [ALL[4]]


def test_domains(links):
    hosts = ("orchard.org/press", "shop.Orchard.org/juice", "oldorchard.org/map", "mill.net/flour", "orchard.org:8443/till")
    html = "<ol>" + "".join(f'<li><a href="https://{h}">{i}</a></li>' for i, h in enumerate(hosts)) + "</ol>"
    own = ["https://orchard.org/press", "https://shop.orchard.org/juice"]
    assert links(html, allow_domains="Orchard.org") == own
    assert links(html, allow_domains=["mill.net", "orchard.org"]) == [*own, "https://mill.net/flour"]
    assert links(html, deny_domains=["mill.net", "orchard.org"]) == ["https://oldorchard.org/map", "https://orchard.org:8443/till"]
    many = [*(f"farm{i}.org" for i in range(20)), "orchard.org"]
    assert links(html, allow_domains=many) == own


def test_tags_and_attributes(links):
    html = '<img src="/pear.png"><a href="/pears">P</a><button data-open="/basket">B</button><link rel=icon href="/pip.ico"><a data-open="/crate">C</a>'
    assert links(html, tags=["link"], deny_extensions=()) == ["http://example.com/pip.ico"]
    assert links(html, attrs="data-open") == ["http://example.com/crate"]
    assert links(html, tags=("button", "img", "a"), attrs=("src", "data-open", "href"), deny_extensions=()) == [
        "http://example.com/pear.png", "http://example.com/pears", "http://example.com/basket", "http://example.com/crate"]
    assert links(html, tags="area") == []


def test_unique(spark, links):
    html = '<a href="/quince">jam</a><a href="/medlar">jelly</a><a href="/quince">paste</a><a href="/medlar">cheese</a><a href="/quince">tart</a>'
    assert links(html) == ["http://example.com/quince", "http://example.com/medlar"]
    assert len(links(html, unique=False)) == 5
    pages = spark.createDataFrame([(1, "http://e.com", html)], "page_id long, url string, html string")
    assert [r.text for r in links_from_pages(pages).orderBy("pos").collect()] == ["jam", "jelly"]


def test_strip(links):
    assert links('<a href="\t\n /plum ">x</a>') == ["http://example.com/plum"]
    # without it, blanks inside the joined URL are encoded and only outer ones go
    assert links('<a href="\t\n /pl um ">x</a>', strip=False) == ["http://example.com/pl%20um"]


def test_extensions(links):
    html = "".join(f'<a href="{u}">x</a>' for u in (
        "/page.html", "/image.JPG", "/doc.pdf?x=1", "/a.tar.gz", "/b.gz", "/c.pdf;v=1", "/pdf", "/x.pdf/y", "/.pdf"))
    assert links(html, deny_extensions=["jpg", "pdf"]) == [
        "http://example.com" + p for p in ("/page.html", "/a.tar.gz", "/b.gz", "/pdf", "/x.pdf/y")]
    assert links(html) == ["http://example.com" + p for p in ("/page.html", "/b.gz", "/pdf", "/x.pdf/y")]
    assert len(links(html, deny_extensions=())) == 9
    assert LinkOptions(deny_extensions="pdf").deny_extensions == ("pdf",)


def test_nothing_to_find(links):
    assert links("<!doctype html><title>bare</title>") == []
    assert links("<section><p>the trees are asleep</p></section>") == []
    assert links(None) == []


def test_process_value(links):
    html = '<a href="/cider?season=autumn">C</a><a href="/closed">x</a>'
    assert links(html, process_value=lambda u: F.when(~u.endswith("/closed"), F.substring_index(u, "?", 1))) == ["http://example.com/cider"]
    # what the function returns may be relative again
    assert links(html, process_value=lambda u: F.lit("sub/é"), url="http://example.com/a/") == ["http://example.com/a/sub/%C3%A9"]


PROCESSED = '<a href="/cider?season=autumn">C</a><a href="http://[bad">b</a><a href="/closed">x</a><a href="/cider#top">T</a><a href="">self</a>'


def _open_only(u):
    return None if u.endswith("/closed") else u.split("?")[0]


@F.udf(T.StringType())
def _plain_udf(u):
    return _open_only(u)


@F.pandas_udf(T.StringType())
def _series_udf(u: pd.Series) -> pd.Series:
    return u.map(_open_only)


@F.pandas_udf(T.StringType())
def _series_parts_udf(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for u in parts:
        yield u.map(_open_only)


@F.arrow_udf(T.StringType())
def _array_udf(u: pa.Array) -> pa.Array:
    return pa.array([_open_only(x) for x in u.to_pylist()], pa.string())


@F.arrow_udf(T.StringType())
def _array_parts_udf(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for u in parts:
        yield pa.array([_open_only(x) for x in u.to_pylist()], pa.string())


@pytest.mark.parametrize("function", [_open_only, lambda u: _open_only(u), _plain_udf, _series_udf, _series_parts_udf, _array_udf, _array_parts_udf])
def test_process_value_in_python(links, function):
    assert links(PROCESSED, process_value=function) == ["http://example.com/cider", "http://example.com/cider#top", "http://example.com"]
    assert links(None, process_value=function) == []


def test_process_value_relative_again_and_dropped(links):
    def same(u: str) -> str:
        return u + "/x"             # would work on a Column too: the annotation decides

    assert links('<a href="/a">1</a>', process_value=same) == ["http://example.com/a/x"]
    assert links('<a href="/a">1</a>', process_value=lambda u: ["../up é"][len(u) - len(u)], url="http://example.com/b/c") == ["http://example.com/up%20%C3%A9"]
    assert links('<a href="/a">1</a>', process_value=lambda u: None) == []
    assert links('<a href="/a">1</a>', process_value=lambda u: u) == ["http://example.com/a"]


def test_process_value_is_one_pass_per_batch(spark):
    """Pages without links, null pages, and the number of calls a batch makes."""
    calls = spark.sparkContext.accumulator(0)

    @F.pandas_udf(T.StringType())
    def counted(u: pd.Series) -> pd.Series:
        calls.add(1)
        return u + "?seen"

    rows = [(i, f"http://e{i}.com/", None if i % 5 == 0 else "none" if i % 5 == 1 else "<a href=/x>t</a>" * (i % 4)) for i in range(100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    found = links_from_pages(pages, process_value=counted, unique=False)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan
    got = sorted((r.page_id, r.pos, r.url) for r in found.collect())
    assert got == [(i, k, f"http://e{i}.com/x?seen") for i in range(100) if i % 5 > 1 for k in range(i % 4)]
    assert calls.value == 1


def test_process_value_is_checked(spark, links):
    with pytest.raises(TypeError, match="strings"):
        links("<a href=/x>t", process_value=F.udf(lambda u: 1, T.IntegerType()))
    with pytest.raises(Exception, match="must return strings"):
        links("<a href=/x>t", process_value=lambda u: len(u.split("/")))
    with pytest.raises(Exception, match="returned 0 values for 1"):
        links("<a href=/x>t", process_value=F.pandas_udf(lambda u: u.head(0), T.StringType(), F.PandasUDFType.SCALAR))

    @F.pandas_udf(T.StringType())
    def least(u: pd.Series) -> str:
        return u.min()

    with pytest.raises(TypeError, match="scalar"):
        links("<a href=/x>t", process_value=least)


def test_base_and_odd_targets(links):
    html = ('<base href="/sub/"><a href="x">1</a><a href>none</a><a href="">self</a><a href="http://[bad">b</a>'
            '<a href="mailto:x@y">m</a><a href="javascript:void(0)">j</a><a href="//o.com">o</a><a href="ftp://f.com/x">f</a>')
    assert links(html) == ["http://example.com/sub/x", "http://example.com/sub/", "http://o.com", "ftp://f.com/x"]
    assert links('<a href="">self</a>', url="http://example.com/p?q") == ["http://example.com/p?q"]


def test_canonicalize(links):
    html = ('<a href="/p?b=2&a=1#one">1</a><a href="/p?a=1&b=2">2</a><a href="/p?a=1&b=2#one">3</a>'
            '<a href="/%7Eu">4</a><a href="/~u">5</a>')
    assert links(html, canonicalize=True) == ["http://example.com/p?a=1&b=2", "http://example.com/~u"]
    assert links(html, canonicalize=True, unique=False) == [
        "http://example.com/p?a=1&b=2"] * 3 + ["http://example.com/~u"] * 2
    # patterns see the URL as written, the first of equal keys
    assert links(html, canonicalize=True, allow="b=2&a=1") == ["http://example.com/p?a=1&b=2"]
    assert len(links(html)) == 5


def test_link_rows(spark):
    html = ('<a href="/1" rel="nofollow">a <b>b</b>\n</a><a href="/2" rel="noopener,nofollow">x</a><a href="/3" rel=nofollows>'
            '<img alt=y></a><a href="/4" data-link="/5">m</a>')
    docs = parse_pages(spark.createDataFrame([(1, "http://e.com", html)], "page_id long, url string, html string"))
    rows = extract_links(docs).orderBy("pos").collect()
    assert [(r.text, r.nofollow) for r in rows] == [("a b\n", True), ("x", True), ("", False), ("m", False)]
    raw = iter_links(docs, attrs=("data-link", "href")).orderBy("pos").collect()
    assert [(r.attr, r.value) for r in raw][-2:] == [("href", "/4"), ("data-link", "/5")]
    only = docs.select(F.size(candidates(lambda t: t == "a", lambda a: a.startswith("data")))).first()[0]
    assert only == 1


def test_many_equal_links_on_one_page(spark):
    pages = spark.range(3).select(
        F.col("id").alias("page_id"), F.lit("http://e.com/").alias("url"),
        F.concat_ws("", F.transform(F.sequence(F.lit(0), F.lit(19999)), lambda i: F.concat(
            F.lit('<a href="/'), (i % 5000).cast("string"), F.lit('">'), i.cast("string"), F.lit("</a>")))).alias("html"))
    rows = links_from_pages(pages).groupBy("page_id").agg(F.count("*").alias("n"), F.max("pos").alias("last"), F.max(F.col("text").cast("int")).alias("t")).collect()
    assert [(r.n, r.last, r.t) for r in rows] == [(5000, 4999, 4999)] * 3


def test_domain_table_with_a_hot_host(spark):
    links = spark.range(3000).select(
        F.col("id").alias("page_id"), F.lit(0).alias("pos"),
        F.when(F.col("id") % 3 == 0, "http://hot.example.com/x").otherwise(F.concat(F.lit("http://h"), F.col("id") % 7, F.lit(".net/"))).alias("url"))
    domains = spark.createDataFrame([("Example.com",), ("h1.net",), ("h1.net",)], "domain string")
    kept, dropped = restrict_domains(links, domains), restrict_domains(links, domains, keep=False)
    want = links.where(in_domains(F.regexp_extract("url", "//([^/]+)", 1), ("example.com", "h1.net"))).count()
    assert (kept.count(), dropped.count()) == (want, 3000 - want)


def test_domain_table_parses_once(spark):
    html = "".join(f'<a href="http://{h}/x">t</a>' for h in ("a.hot.com", "hot.com", "cold.com"))
    pages = spark.createDataFrame([(i, "http://e.com", html) for i in range(40)], "page_id long, url string, html string")
    domains = spark.createDataFrame([("HOT.com",)], "domain string")
    kept = restrict_domains(links_from_pages(pages), domains)
    assert kept._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert kept.count() == 80 and kept.columns == ["page_id", "pos", "url", "text", "nofollow"]


def test_domain_table_of_odd_domains(spark):
    """Nested, repeated, null, empty and one-label domains; a link listed twice over stays one row."""
    hosts = ("a.b.c.org", "b.c.org", "c.org", "org", "x.org", "localhost", "net", "a.localhost", "[::1]")
    links = spark.createDataFrame([(i, 0, f"http://{h}/") for i, h in enumerate(hosts)] * 2, "page_id long, pos int, url string")
    domains = spark.createDataFrame([("c.org",), ("b.C.org",), ("c.org",), (None,), ("",), ("localhost",), ("z.y.x.w",)], "domain string")
    want = [0, 0, 1, 1, 2, 2, 5, 5, 7, 7]
    assert sorted(r.page_id for r in restrict_domains(links, domains).collect()) == want
    assert sorted({r.page_id for r in restrict_domains(links, domains, keep=False).collect()}) == [3, 4, 6, 8]
    none = domains.limit(0)
    assert restrict_domains(links, none).count() == 0 and restrict_domains(links, none, keep=False).count() == 18


def test_only_hard_urls_go_to_python(links):
    html = "".join(f'<a href="{u}">x</a>' for u in ("/plain", "/a/./b", "/a/../c", "//o.com/d", "/e f", "/g?h=i", "/j/", "/k.l", "/m..n", "/é", "/%41", "/o;p"))
    for base in ("http://example.com/x/y", "HTTP://EXAMPLE.com/x", "http://u:p@example.com/", "http://example.com:8080", "https://a-b.example.com?q"):
        want = []
        for value in re.findall('href="([^"]*)"', html):
            want.append(urljoin(base, safe_url(urljoin(base, value))))
        assert links(html, url=base, unique=False) == want, base


def test_bad_pattern_fails_early():
    with pytest.raises(Exception, match="unterminated|missing"):
        LinkOptions(allow="(")


def test_a_filter_on_links_does_not_repeat_the_url_pass(spark):
    pages = spark.createDataFrame([(1, "http://e.com", "<a href=/x>t")], "page_id long, url string, html string")
    found = links_from_pages(pages).where("url like '%x'")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan
    assert found.count() == 1
