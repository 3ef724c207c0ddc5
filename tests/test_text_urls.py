"""String and URL functions."""

import random
import re
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from webgrove import has_nofollow, strip_blanks
from webgrove.functions import urls
from webgrove.functions.text import captures, decode_entities


def values(spark, column, items, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r.o for r in df.select("i", column.alias("o")).orderBy("i").collect()]


def test_entities(spark):
    got = values(spark, decode_entities(F.col("v"), scalar=True), [
        "a &copy; &#169; &#xA9; &lt;b&gt; &amp;amp; &AMP; R&D &nope; &eacute", None, "plain"])
    assert got == ["a © © © &lt;b> &amp;amp; &AMP; R&D  é", None, "plain"]
    assert values(spark, decode_entities(F.col("v")), [["&#65;", None, "x"], [], None], "array<string>") == [["A", None, "x"], [], []]


def test_strip_and_nofollow(spark):
    assert values(spark, strip_blanks(F.col("v")), ["\t\n\f\r a b \r", "\xa0x"]) == ["a b", "\xa0x"]
    assert values(spark, has_nofollow(F.col("v")), ["nofollow", "noopener,nofollow", "a nofollow\tb", "nofollows", "", None]) == [
        True, True, True, False, False, False]


@pytest.mark.parametrize("pattern", [
    r"\w+", r"(\d)(\D)?", r"(?P<one_name>[a-zé]+)\s(?P<b2>\w+)", r"(?P<q>['\"]).*?(?P=q)", r"[^]x]+", r"[[\]&&]+", r"(?i)É\w", r"x.y", r"\w+\Z",
    r"^\w+$", r"\bü\w*", r"(?m)^\w", r"(?P<extract>\w)\w+", r"[\w.-]+@[\w-]+",
])
def test_patterns_mean_what_they_mean_in_python(spark, pattern):
    texts = ["für den é2 ٣", "x\ry x\ny", "a 'q' \"r\" [&]x]", "é", "last\n", "a.b-c@d-e É7", ""]

    def python(text):
        found = re.compile(pattern)
        if "extract" in found.groupindex:
            first = found.search(text)
            return [first.group("extract")] if first else []
        return [g for m in found.findall(text) for g in (m if isinstance(m, tuple) else (m,))]

    assert values(spark, captures(F.col("v"), pattern), texts) == [python(t) for t in texts]


def test_captures_of_null(spark):
    assert values(spark, captures(F.col("v"), r"(a)(b)?"), ["abxa", None]) == [["a", "b", "a", ""], []]


@pytest.mark.parametrize(("url", "safe"), [
    ("http://e.com/a b", "http://e.com/a%20b"),
    ("http://E.com/für?q=ü#ü", "http://e.com/f%C3%BCr?q=%C3%BC#%C3%BC"),
    ("http://e.com/%41%zz", "http://e.com/%41%zz"),
    ("http://e.com/a|b[c]?q='x'", "http://e.com/a%7Cb%5Bc%5D?q=%27x%27"),
    ("http://bücher.example/x", "http://xn--bcher-kva.example/x"),
    ("http://u:p w@e.com:80/", "http://u:p%20w@e.com:80/"),
    ("\x01 http://e.com/\n", "http://e.com/"),
])
def test_safe_url(url, safe):
    assert urls.safe_url(url) == safe


def test_safe_url_rejects():
    for bad in ("http://[bad", "http://e.com:port/", "http://e.com:99999/"):
        with pytest.raises(ValueError):
            urls.safe_url(bad)


@pytest.mark.parametrize(("url", "canonical"), [
    ("http://E.com/do?c=3&b=5&b=2&a=50#x", "http://e.com/do?a=50&b=2&b=5&c=3"),
    ("http://e.com", "http://e.com/"),
    ("http://e.com/%7Ea%2fb%20c", "http://e.com/~a%2Fb%20c"),
    ("http://e.com/?b&a=1+2", "http://e.com/?a=1+2&b="),
    ("http://e.com/?q=%ff", "http://e.com/?q=%FF"),
    ("http://e.com:/x", "http://e.com/x"),
])
def test_canonical_url(url, canonical):
    assert urls.canonical_url(url) == canonical
    assert urls.canonical_url(canonical) == canonical


def test_resolving_in_one_pass_or_two_is_the_same(spark):
    bases = ["http://e.com", "http://e.com/a/b?x#f", "https://E.com:8080/x/", "http://u@e.com/", "http://e.com:99999/", "ftp://e.com/d/", "", None]
    items = ["", "/", "/a", "/a.b", "/a/../b", "/./x", "//o.com/x", "b", "../c", "?q", "#f", "/für", "/a;p", "/a b", "mailto:x",
             "http://[bad", "HTTP://X.com/Y", "/a//b", "/.hidden", "/x..y", "/a?b=1#c", "/a/.", "/%zz", "/é/.b", "/é.b", "/[x]|\\\\", "/\x7f", "/a\xa0", "/é//b", "/.é", "/..é", "javascript:x(1)", None]
    df = spark.createDataFrame([(b, b, items) for b in bases], "base string, url string, v array<string>")
    one = df.select(urls.resolve_urls("base", "url", "v").alias("o"))
    two = df.select("url", urls.join_urls("base", "v").alias("j")).select(urls.finish_urls("url", "j").alias("o"))
    assert [r.o for r in one.collect()] == [r.o for r in two.collect()]


def test_url_parts(spark):
    items = ["http://U@Sub.E.com:80/a/b.TAR.gz;p?x=1#y", "https://e.com", "mailto:x", "/rel/p?q", "http://[::1]:8/a;b/c"]
    assert values(spark, urls.netloc(F.col("v")), items) == ["u@sub.e.com:80", "e.com", "", "", "[::1]:8"]
    assert values(spark, urls.host(F.col("v")), items) == ["sub.e.com", "e.com", "", "", "[::1]"]
    assert values(spark, urls.path(F.col("v")), items) == ["/a/b.TAR.gz", "", "x", "/rel/p", "/a;b/c"]
    assert values(spark, urls.host_suffixes(F.col("v")), ["a.b.c"]) == [["a.b.c", "b.c", "c"]]


@pytest.mark.parametrize(("pattern", "text"), [
    (r'{"id":(\d+)}', 'x{"id":12}y{"id":7}'), (r"a.{,3}b", "a12b a1234b ab"), (r"x{}y|{z", "x{}y {z"), (r"}{1,2}", "}}}"), (r"(?#note)a+", "aaba"),
    (r"[\b]x", "\bx"), (r"\0", "a\0"), (r"\N{EM DASH}|\U0001F600", "—😀"), (re.compile(r"a # b", re.X), "ab a # b"), (re.compile(r"[ #]b", re.X), "#b b"),
    (re.compile("straße", re.I), "STRAßE"), (re.compile("^b.c$", re.M | re.S), "a\nb\nc\nd"), (re.compile(r"\w+", re.A), "caf\u00e9"), (r"\w+", "café"),
    (r"[{}]", "{a}"), (r"a{2}", "aaa"), (r"[[a&&b]", "[&"),
])
def test_patterns_read_as_python_does(spark, pattern, text):
    compiled = re.compile(pattern)
    want = [m[compiled.groups and 1] for m in compiled.finditer(text)]
    row = spark.createDataFrame([(text,)], "t string").select(captures(F.col("t"), pattern)).first()
    assert row[0] == want


@pytest.mark.parametrize("pattern", [r"(a)?(?(1)b|c)", r"(?a:\w)", re.compile(b"a")])
def test_patterns_without_counterpart_are_refused(pattern):
    with pytest.raises((ValueError, TypeError)):
        captures(F.col("v"), pattern)


def odd_urls(n, seed):
    """URLs of many forms: usual ones, and ones with a rare character, escape or part."""
    draw = random.Random(seed)
    chars = "abzAZ09-._~!$&'()*+,;=:@/ é|%<\"{}^`[]\\#?\x7f🙂"
    escapes = ("%20", "%7E", "%2F", "%2f", "%3F", "%C3%A9", "%c3%a9", "%FF", "%41", "%25", "%2B", "%26", "%3D", "%zz", "%", "%253F", "%22", "%5F")

    def text(most, rare):
        return "".join(draw.choice(escapes) if draw.random() < rare / 2 else draw.choice(chars if draw.random() < rare else "abcXY12-._/") for _ in range(draw.randint(0, most)))

    for _ in range(n):
        rare = draw.choice((0, 0.05, 0.3))
        host = draw.choice(("e.com", "a-b.e.com", "E.com", "u:p@e.com", "e.com:8080", "e.com:080", "bücher.de", "127.0.0.1", "e.com:", "x_y.com", ""))
        path = draw.choice(("", "/", "/" + text(9, rare), "/../" + text(4, rare), "/./a", "/a//b", "/a;p=1", "/a;"))
        query = draw.choice(("", "?", "?" + "&".join(draw.choice(("", "=")).join((text(4, rare), text(3, rare))) for _ in range(draw.randint(1, 4))), "?b=2&a=1&b=1", "?a&&b=&=c", "?a=b=c", "?x=1+2&x=1%202"))
        yield draw.choice(("http", "https", "http", "ftp", "HTTP")) + "://" + host + path + query + draw.choice(("", "", "#", "#" + text(4, rare)))


def test_plain_functions_equal_the_python_ones(spark):
    """Whatever plain functions rewrite comes out as in Python, and usual URLs never go there."""
    given = [*odd_urls(10_000, 6), "http://e.com/a?q=x,y/z:1", "http://e.com/%E2%82%AC?b=%21&a=%7C", None]
    rows = spark.createDataFrame(list(enumerate(given)), "i long, url string").select(
        "i", urls.is_plain(F.col("url")).alias("plain"), urls.canonical_plain(F.col("url")).alias("c"),
        urls.settled(F.col("url"), F.lit("http://e.com")).alias("settled")).collect()
    n_plain = n_settled = 0
    for r in rows:
        url = given[r.i]
        if r.plain:
            n_plain += 1
            assert r.c.key == urls.canonical_url(url, keep_fragment=True), url
            assert r.c.url == urls.canonical_url(url), url
        if r.settled is not None:
            n_settled += 1
            assert r.settled == urls._finish("http://page.com/x", urls._join("http://e.com/y", url)), url
    assert n_plain > 1500 and n_settled > 500
    assert all(r.plain for r in rows[10_000:10_002]) and not rows[-1].plain


def test_paths_are_encoded_as_in_python(spark):
    draw = random.Random(7)
    chars = "ab/~!$&'()*+,;=:@-._ é|%<\"{}^`[]🙂\x7f\u0301"
    values = ["/" + "".join(draw.choice(("%20", "%c3", "%25", *chars)) for _ in range(draw.randint(0, 12))) for _ in range(5000)]
    rows = spark.createDataFrame([(v,) for v in values], "v string").select(
        "v", urls.encoded_path(F.col("v")).alias("e"), urls.settled(F.col("v"), F.lit("http://e.com:81")).alias("s")).collect()
    for r in rows:
        assert r.e == quote(r.v, urls._PART_SAFE)
        if r.s is not None:
            assert r.s == urls._finish("http://p.com/", urls._join("http://e.com:81/x/y", r.v)), r.v
    assert sum(r.s is not None for r in rows) > 1000
