"""Selections, projections, arrays and regex captures."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tests.fixtures import LIST, SITE
from webgrove import Selection, SelectorError, css, drop, nonempty, parse_pages, select
from webgrove.functions import selectors
from webgrove.functions.page_tree import INT_FIELDS, PageColumns
from webgrove.sources.tables import store_docs


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        ("site", SITE), ("list", LIST), ("empty", "<div></div>"),
        ("nested", "<div id=1><div id=2><div id=3><p>x</p></div></div></div><p>y</p>"),
        ("parts", "<h1>Moss</h1><p class='lead'>Grows slowly</p><a href='/fern'>Fern</a>"),
        ("attrs", "<p lang='en-US' data-x='a,b' title=''>1</p><p hidden class=' one\ttwo\n'>2</p><p class='onetwo' TITLE='Q'>3</p><br>"),
        ("none", None),
    ]
    pages = spark.createDataFrame([(k, "http://example.com", v) for k, v in rows], "page_id string, url string, html string")
    return parse_pages(pages).persist()


@pytest.fixture
def read(docs):
    def run(page, column):
        return docs.where(F.col("page_id") == page).select(column.alias("v")).first().v

    return run


@pytest.mark.parametrize(("query", "expected"), [
    ("h2::text", ["Sailings today"]),
    ("ol a::text", ["North quay", "Old pier", "Lighthouse"]),
    ("a::attr(href)", ["/quay7", "/quay12", "/quay3"]),
    ("head > link[rel='canonical']::attr(href)", ["https://ferries.example.net/times"]),
    (".note::text", ["Bring a coat."]),
    ("#times::attr(class)", ["wide board"]),
    ("section.wide.board h2::text", ["Sailings today"]),
    ("SECTION > OL > LI:nth-child(2) a::text", ["Old pier"]),
    ("h2 + p::text", ["Bring a coat."]),
    ("h2 ~ ol a[href$='3']::text", ["Lighthouse"]),
    ("li:first-child a::text, li:last-child a::text", ["North quay", "Lighthouse"]),
    ("li:nth-child(odd) a::attr(href)", ["/quay7", "/quay3"]),
    ("li:nth-child(-n+2) a::attr(href)", ["/quay7", "/quay12"]),
    ("li:nth-last-child(1) a::text", ["Lighthouse"]),
    ("aside:not(#times):not(.x) p::text", ["Desk open till nine"]),
    ("aside:is(#desk, .zzz) p::text", ["Desk open till nine"]),
    ("body > *:first-child::attr(id)", ["times"]),
    ("table::text", []),
    ("aside a::text", []),
    ("a::attr(rel)", ["", "", ""]),
])
def test_site_values(read, query, expected):
    assert read("site", css(query).getall()) == expected


def test_html_projection(read):
    assert read("site", css("h2").getall()) == ["<h2>Sailings today</h2>"]
    assert read("list", css("li").get()) == '<li><a href="/tea">Tea</a></li>'
    assert read("attrs", css("p[hidden]").get()) == '<p hidden="" class=" one\ttwo\n">2</p>'


def test_root_reads_all_text(read):
    assert read("parts", css("::text").get()) == "MossGrows slowlyFern"
    assert read("parts", css("html::text").get()) == "MossGrows slowlyFern"
    assert read("none", css("::text").getall()) == []


def test_comma_parts_keep_their_order_and_duplicates(read):
    assert read("parts", css("p::text, h1::text , p.lead::attr(class), h1").getall()) == [
        "Grows slowly", "Moss", "lead", "<h1>Moss</h1>"]
    assert read("parts", css("h1::text, h1::text").getall()) == ["Moss", "Moss"]


def test_comma_inside_quotes_and_brackets(read):
    assert read("attrs", css("p[data-x='a,b']::text, p:is([hidden], .zz)::text").getall()) == ["1", "2"]


@pytest.mark.parametrize(("query", "expected"), [
    ("p[lang|=en]::text", ["1"]), ("p[title]::text", ["1", "3"]), ("p[title='']::text", ["1"]), ("p[hidden]::text", ["2"]),
    ("p[hidden='']::text", ["2"]), ("p.one::text", ["2"]), ("p.two::text", ["2"]), ("p[class~='one']::text", ["2"]),
    ("p[class*=onet]::text", ["3"]), ("p[data-x^='a']::text", ["1"]), ("p[data-x^='']::text", []), ("p[title='q' i]::text", ["3"]),
    ("p[title=q]::text", []), ("br:empty::attr(x)", [""]), (r".\6fne::text", ["2"]), ("p ::text", ["1", "2", "3"]),
])
def test_attribute_forms(read, query, expected):
    assert read("attrs", css(query).getall()) == expected


def test_missing_and_valueless_attributes(read):
    assert read("attrs", css("p::attr(hidden)").getall()) == ["", None, ""]
    assert read("attrs", css("p[hidden]::attr(hidden)").get("default")) is None
    assert read("attrs", css("p[hidden]").attrib()) == {"hidden": None, "class": " one\ttwo\n"}


def test_scoped_selection_is_descendants_only_with_outer_ancestors(read):
    assert read("nested", css("div").css("div").css("::attr(id)").getall()) == ["2", "3", "3"]
    assert read("nested", css("div").css("p::text").getall()) == ["x", "x", "x"]
    assert read("nested", css("div[id='3']").css("div p::text").getall()) == ["x"]
    assert read("nested", css("body p::text").getall()) == ["x", "y"]
    assert read("nested", css("div div p::text").getall()) == ["x"]


def test_chains(read):
    assert read("site", css("#times").css("a").css("::text").getall()) == ["North quay", "Old pier", "Lighthouse"]
    assert read("list", css("li").css("a::text").getall()) == ["Tea", "Milk", "Rye"]
    assert read("list", css("li").css("a::text, a::attr(href)").getall()) == ["Tea", "/tea", "Milk", "/milk", "Rye", "/rye"]


def test_first_value_and_default(read):
    assert read("site", css("table").get("no table")) == "no table"
    assert read("site", css("table").get()) is None
    assert read("empty", css("div::text").get("none")) == ""
    assert read("site", css("a::text").extract_first()) == "North quay"
    assert read("site", css("a::text").extract()) == ["North quay", "Old pier", "Lighthouse"]


def test_index_and_slice(read):
    items = css("a::text")
    assert read("list", items[1].getall()) == ["Milk"]
    assert read("list", items[-1].get()) == "Rye"
    assert read("list", items[9].get("none")) == "none"
    letters = ["Tea", "Milk", "Rye"]
    for start in (None, 0, 1, 2, 5, -1, -2, -9):
        for stop in (None, 0, 1, 3, 7, -1, -3, -9):
            assert read("list", items[start:stop].getall()) == letters[start:stop], (start, stop)
    assert read("list", css("li")[1:].css("a::text").getall()) == ["Milk", "Rye"]
    for cut in (slice(None, None, 2), slice(None, None, -1), slice(2, None, -2), slice(1, 9, 3), slice(-1, -9, -1), slice(2, 0, -1), slice(0, 2, -1), slice(5, None, 2)):
        assert read("list", items[cut].getall()) == letters[cut], cut
        assert read("empty", items[cut].getall()) == []
    with pytest.raises(ValueError, match="step"):
        items[::0]
    with pytest.raises(TypeError, match="iterable"):
        list(items)


def test_attrib(read):
    assert read("site", css("#times").attrib()) == {"id": "times", "class": "wide board"}
    assert read("list", css("a").attrib())["href"] == "/tea"
    assert read("list", css("table").attrib()) == {}


def test_count_and_rows(docs, read):
    assert read("site", css("li").count()) == 3
    assert read("none", css("li").count()) == 0
    rows = select(docs.where("page_id = 'list'"), "a::text").orderBy("pos").collect()
    assert [(r.pos, r.tag, r.value) for r in rows] == [(0, "a", "Tea"), (1, "a", "Milk"), (2, "a", "Rye")]


def test_nonempty(docs):
    row = docs.where("page_id = 'site'").select(nonempty(css("h2").get()).alias("a"), nonempty(css("zz").get()).alias("b")).first()
    assert tuple(row) == (True, False)
    assert docs.where("page_id = 'empty'").select(nonempty(css("div::text").get())).first()[0] is False


def test_regex(read):
    hrefs = css("a::attr(href)")
    assert read("site", hrefs.re(r"/quay(\d+)")) == ["7", "12", "3"]
    assert read("site", hrefs.re(r"/(q)uay(\d+)")) == ["q", "7", "q", "12", "q", "3"]
    assert read("site", hrefs.re(r"\d")) == ["7", "1", "2", "3"]
    assert read("site", hrefs.re(r"/(?P<kind>[a-z]+)(?P<extract>\d)")) == ["7", "1", "3"]
    assert read("site", hrefs.re_first(r"/quay(\d+)")) == "7"
    assert read("site", hrefs.re_first(r"ferry", "none")) == "none"
    assert read("site", css("zz").re(r".")) == []
    assert read("site", css("p::text").re(r"(\w+) (open)?")) == ["Bring", "", "a", "", "Desk", "open", "till", ""]


@pytest.mark.parametrize("query", ["a:hover", "a[", "a > ", "> a", "a b::before", ".", "a,[x='", "p:nth-child(x)", "a..b", ":not(a b)", "x:lang(y)"])
def test_unknown_forms_are_refused(query):
    with pytest.raises(SelectorError):
        css(query)


def test_outer_html_needs_the_markup(docs):
    text_only = docs.drop("markup")
    assert select(text_only, "h1::text, h2::text").count() == 2
    with pytest.raises(ValueError, match="keep"):
        select(text_only, "h1::text, p")


def test_many_siblings(spark):
    html = "<ul>" + "<li class=a>x<li>y" * 4000 + "</ul>"
    docs = parse_pages(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string"))
    got = docs.select(css("li.a + li").count(), css("li + li").count(), css("li.a ~ li").count(), css("li ~ li.a").count()).first()
    assert tuple(got) == (4000, 7999, 7999, 3999)


def test_selection_is_lazy():
    assert isinstance(css("a").css("b"), Selection)


def _brute(rows, attrs, steps):
    """Match right to left by walking parents: the textbook definition."""

    def ok(i, k):
        tag, cls = steps[k][1]
        if (tag != "*" and rows[i]["tag"] != tag) or (cls and cls not in (attrs[i].get("class") or "").split()):
            return False
        if k == 0:
            return True
        if steps[k][0] == ">":
            return rows[i]["parent"] >= 0 and ok(rows[i]["parent"], k - 1)
        if steps[k][0] in "+~":
            gap = [j for j in range(len(rows)) if rows[j]["parent"] == rows[i]["parent"] and rows[j]["sib"] < rows[i]["sib"]]
            return any(ok(j, k - 1) for j in (gap[-1:] if steps[k][0] == "+" else gap))
        up = rows[i]["parent"]
        while up >= 0:
            if ok(up, k - 1):
                return True
            up = rows[up]["parent"]
        return False

    return [i for i in range(len(rows)) if ok(i, len(steps) - 1)]


def test_combinators_agree_with_brute_force(spark):
    rng = random.Random(3)
    sources = ["".join(rng.choice(["<div>", "<div class=c>", "<span class='c d'>", "<span>", "</div>", "</span>", "<i>", "</i>", "t"])
                       for _ in range(rng.randint(5, 60))) for _ in range(40)]
    docs = parse_pages(spark.createDataFrame([(i, "u", s) for i, s in enumerate(sources)], "page_id long, url string, html string")).persist()
    for _ in range(8):
        steps = [("", (rng.choice(["div", "span", "*"]), rng.choice(["", "c", "d"])))]
        for _ in range(rng.randint(1, 3)):
            steps.append((rng.choice([" ", ">", "+", "~"]), (rng.choice(["div", "span", "i", "*"]), rng.choice(["", "c", ""]))))
        query = "".join((f" {c} " if c.strip() else c) + tag + (f".{cls}" if cls else "") for c, (tag, cls) in steps)
        got = {r.page_id: r.v for r in docs.select("page_id", F.transform(css(query).refs(), lambda r: r["pre"]).alias("v")).collect()}
        for i, source in enumerate(sources):
            columns = PageColumns()
            columns.add(source)
            rows = [dict(zip(INT_FIELDS, r, strict=True)) | {"tag": t} for r, t in zip(columns.numbers, columns.tags, strict=True)]
            attrs = [dict(zip(columns.attr_names[a:b], columns.attr_values[a:b], strict=True))
                     for a, b in zip(columns.attr_offsets, columns.attr_offsets[1:], strict=False)]
            assert got[i] == _brute(rows, attrs, steps), (query, source)


def test_selection_plan_has_no_shuffle_and_no_second_python_pass(spark, docs):
    pages = spark.createDataFrame([(1, "u", "<p>x")], "page_id long, url string, html string")
    plan = parse_pages(pages).select(css("div p::text").getall(), css("ul > li").css("a").count())
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text
    assert text.count("MapInArrow") == 1 and "ArrowEval" not in text


def test_parts_split():
    assert [p.read for p in selectors.parse("a::text, b::attr(x), c")] == ["text", "attr", "html"]


# :has() and places of type, against a walk over every element

def grown(draw, depth=0):
    """Random nested markup of a few tags."""
    if depth > 4 or draw.random() < 0.15:
        return draw.choice(("x", "", "<i class=a>y</i>", "<u>z</u>"))
    tag = draw.choice(("div", "ul", "i", "u"))
    mark = draw.choice(("", " class=a", " id=k"))
    return f"<{tag}{mark}>" + "".join(grown(draw, depth + 1) for _ in range(draw.randint(0, 4))) + f"</{tag}>"


def simple(n, text):
    tag, _, cls = text.partition(".")
    return n is not None and n.tag is not None and tag in ("*", "", n.tag) and (not cls or n.attrs.get("class") == cls)


def reached(page, n, combinator):
    beside = [m for m in page if m.tag is not None and m.parent == n.parent and m.pre > n.pre]
    return {" ": [m for m in page if n.pre < m.pre <= n.last], ">": [m for m in page if m.parent == n.pre], "+": beside[:1], "~": beside}[combinator]


def has(page, n, steps):
    """``steps``: (combinator, compound) pairs from the element on."""
    if not steps:
        return True
    return any(simple(m, steps[0][1]) and has(page, m, steps[1:]) for m in reached(page, n, steps[0][0]))


def test_has_and_types_equal_a_walk(spark):
    draw = random.Random(11)
    made = spark.createDataFrame([(i, "http://e.com", "".join(grown(draw) for _ in range(6))) for i in range(25)], "page_id long, url string, html string")
    parsed = parse_pages(made, keep=("text",))
    relative = {
        "u": [(" ", "u")], "> i.a": [(">", "i.a")], "+ div": [("+", "div")], "~ ul": [("~", "ul")], "ul > i": [(" ", "ul"), (">", "i")],
        "> div u": [(">", "div"), (" ", "u")], "+ ul .a": [("+", "ul"), (" ", "*.a")], "~ div > u + i": [("~", "div"), (">", "u"), ("+", "i")], "> *": [(">", "*")]}
    types = {"first": ":first-of-type", "last": ":last-of-type", "only": ":only-of-type", "even": ":nth-of-type(even)", "back": ":nth-last-of-type(n+2)"}
    for work in (parsed, drop(parsed, "ul > i"), drop(parsed, "div:has(> u)")):
        columns = [css(f"body *:has({q})").refs()["pre"].alias(f"h{k}") for k, q in enumerate(relative)]
        columns += [css(f"body *{q}").refs()["pre"].alias(name) for name, q in types.items()]
        columns += [css("body *:not(:has(u, > i.a)):is(:first-of-type, .a)").refs()["pre"].alias("mixed"), css("div:has(u) > i:last-of-type").refs()["pre"].alias("steps")]
        for row in work.select("nodes", *columns).collect():
            page = row.nodes
            body = next(n for n in page if n.tag == "body")
            inside = [n for n in page if n.tag is not None and body.pre < n.pre <= body.last]
            for k, steps in enumerate(relative.values()):
                assert row[f"h{k}"] == [n.pre for n in inside if has(page, n, steps)], list(relative)[k]

            def place(n, back=False):
                same = [m.pre for m in page if m.tag == n.tag and m.parent == n.parent]
                return (same[::-1] if back else same).index(n.pre) + 1

            assert row["first"] == [n.pre for n in inside if place(n) == 1]
            assert row["last"] == [n.pre for n in inside if place(n, True) == 1]
            assert row["only"] == [n.pre for n in inside if place(n) == place(n, True) == 1]
            assert row["even"] == [n.pre for n in inside if place(n) % 2 == 0]
            assert row["back"] == [n.pre for n in inside if place(n, True) >= 2]
            assert row["mixed"] == [n.pre for n in inside if not has(page, n, [(" ", "u")]) and not has(page, n, [(">", "i.a")])
                                    and (place(n) == 1 or simple(n, "*.a"))]
            divs = {n.pre for n in page if n.tag == "div" and has(page, n, [(" ", "u")])}
            assert row["steps"] == [n.pre for n in page if n.tag == "i" and n.parent in divs and place(n, True) == 1]


@pytest.mark.parametrize("query", ["p:has(", "p:has()", "p:has(> )", "p:nth-of-type()", "p:nth-of-type(x)", "p:first-of-type(1)", "p:has(a::text)", "p:has"])
def test_relative_selectors_that_cannot_be_read(query):
    with pytest.raises(SelectorError):
        css(query)


def test_context_reads_cost_their_matches(spark):
    """Nested contexts: each costs a slice, not a walk over what is below it."""
    html = "<div>" * 20_000 + "<em>x</em>" + "</div>" * 20_000
    pages = spark.createDataFrame([(1, "http://e.com", html)], "page_id long, url string, html string")
    stored = store_docs(parse_pages(pages, keep=("text",)))
    start = time.perf_counter()
    assert stored.select(css("div").css("em").count()).first()[0] == 20_000
    assert stored.select(css("div:has(em)").count()).first()[0] == 20_000
    assert stored.select(css("div:has(> div:only-of-type)").count()).first()[0] == 19_999
    assert time.perf_counter() - start < 60
