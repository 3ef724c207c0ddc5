"""One query per operator; every one runs over the whole ``pages`` table."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webgrove import (
    Field, Rule, SeenUrls, apply_rules, attribute_profile, classify_html, clean_text, css, decompress, drop, extract_links,
    extract_page_fields, extract_records, frontier, host_degrees, host_summary, html_only, iter_links, link_graph,
    links_from_pages, nodes, nonempty, parse_pages, restrict_domains, select, split_html, strip_blanks, tag_profile,
    to_pages, top_links, with_links,
)
from webgrove.functions.text import decode_entities, has_nofollow
from webgrove.operators.links import candidates
from webgrove.operators.rows import explode_structs
from webgrove.sources.tables import new_folder, store_docs, store_table, stream_pages, write_stream, write_table
from webgrove.plans.graph import estimated_graph, link_states, merge_link_states, merge_tag_states, tag_states
from webgrove.streaming.jobs import (
    crawl_tables, parse_responses, read_batches, stream_html, stream_links, stream_records, stream_tables,
)
from workload.inputs import as_responses, docs, link_pages, link_pages_of, pages, partitions, responses

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _exploded(df: DataFrame, array, name: str = "value") -> DataFrame:
    """``page_id, pos, <name>`` from an array of strings."""
    return explode_structs(df, F.transform(array, lambda v: F.struct(v.alias(name))), keep=("page_id",))


# -- sources, sinks, parse ---------------------------------------------------

@query
def page_scan(spark, sf):
    return pages(spark, sf).select("page_id", "url", F.length("html").alias("n_chars"))


@query
def response_text(spark, sf):
    decoded = to_pages(classify_html(responses(spark, sf)))
    return decoded.select("page_id", "url", F.md5("html").alias("digest"))


@query
def response_gunzip(spark, sf):
    decoded = to_pages(classify_html(decompress(responses(spark, sf, compressed=True))))
    return decoded.select("page_id", "url", F.md5("html").alias("digest"))


@query
def response_cut(spark, sf):
    """Bodies that lost their end stay packed, and say so."""
    cut = responses(spark, sf, compressed=True).withColumn("body", F.expr("substring(body, 1, octet_length(body) - 9)"))
    left = decompress(cut.withColumn("n_cut", F.octet_length("body")))
    return left.select("page_id", (F.octet_length("body") == F.col("n_cut")).alias("is_whole"), F.map_contains_key("headers", "content-encoding").alias("is_packed"))


@query
def sink_roundtrip(spark, sf):
    folder = new_folder(spark, "sink")
    write_table(links_from_pages(pages(spark, sf), partitions=partitions(spark)).select("page_id", "pos", "url"), folder)
    return spark.read.parquet(folder)


@query
def parse_tag_counts(spark, sf):
    tags = ("p", "br", "li", "a", "div", "meta", "script", "h1")
    return docs(spark, sf).select("page_id", *(css(t).count().alias(f"n_{t}") for t in tags))


@query
def node_rows(spark, sf):
    """Elements by tag; the depth where it is the same for all of a tag."""
    depth = F.when(~F.col("tag").isin("b", "br"), F.col("depth"))
    return nodes(docs(spark, sf)).groupBy("page_id", "tag", depth.alias("depth")).agg(F.count("*").alias("n"))


@query
def formatting_reopened(spark, sf):
    """Forty elements that a block leaves unclosed are all in the two blocks after it."""
    opened = F.concat(*(F.lit(f'<b id="u{i}">') for i in range(40)))
    marked = pages(spark, sf).withColumn("html", F.concat("html", F.lit("<p>"), opened, F.lit("x<p class=u>one<p class=u>two")))
    return parse_pages(marked, keep=("text",), partitions=partitions(spark)).select(
        "page_id", css("p.u b[id]").count().alias("n_inside"), css("p.u")[-1].css("#u39::text").get().alias("innermost"))


@query
def node_siblings(spark, sf):
    items = nodes(docs(spark, sf)).where(F.col("tag") == "li")
    return items.select("page_id", "sib", "nsib", (F.col("last") - F.col("pre")).alias("n_below"))


@query
def parse_null_pages(spark, sf):
    some = pages(spark, sf).withColumn("html", F.when(~F.col("url").contains("?"), F.col("html")))
    return parse_pages(some, keep=("text",), partitions=partitions(spark)).select(
        "page_id", F.size("nodes").alias("n_nodes") == 0, css("h1::text").get("none").alias("h1")).toDF("page_id", "is_empty", "h1")


@query
def stored_docs_reuse(spark, sf):
    stored = store_docs(docs(spark, sf))
    return stored.select(
        "page_id", css("title::text").get().alias("title"), css("h1::text").get().alias("h1"),
        css("li").count().alias("n_li"), css("nav a").count().alias("n_nav_links"))


# -- routing -----------------------------------------------------------------

@query
def route_kinds(spark, sf):
    return classify_html(responses(spark, sf)).select("page_id", "kind", "is_html")


@query
def route_split(spark, sf):
    html, rest = split_html(classify_html(responses(spark, sf)))
    labelled = html.select(F.lit("html").alias("branch"), "kind").unionAll(rest.select(F.lit("other").alias("branch"), "kind"))
    return labelled.groupBy("branch", "kind").agg(F.count("*").alias("n"))


@query
def route_overrides(spark, sf):
    url = F.col("url")
    rows = responses(spark, sf).withColumns({
        "has_override": url.contains("?"),
        "backend_override": F.when(url.contains("utm_source"), "lexbor").when(url.contains("/en/"), "false"),
    })
    on = classify_html(rows, default=True).select("page_id", F.lit("on").alias("default"), "is_html")
    off = classify_html(rows, default=None).select("page_id", F.lit("off").alias("default"), "is_html")
    return on.unionAll(off)


@query
def route_html_links(spark, sf):
    html = html_only(classify_html(responses(spark, sf)), "routing")
    return links_from_pages(to_pages(html), partitions=partitions(spark)).groupBy("page_id").agg(F.count("*").alias("n_links"))


@query
def nonempty_filter(spark, sf):
    found = docs(spark, sf).select(
        "page_id", css("div.ad::text").get().alias("ad"), css("br::text").get().alias("br"), css("em::text").get().alias("em"))
    return found.where(nonempty("ad") & ~nonempty("br") & ~nonempty("em")).select("page_id", "ad")


# -- selection ---------------------------------------------------------------

@query
def select_tag(spark, sf):
    return select(docs(spark, sf), "h1::text").select("page_id", "pos", "tag", "value")


@query
def select_id(spark, sf):
    marked = pages(spark, sf).withColumn("html", F.regexp_replace("html", "<article>", '<article id="main story">'))
    marked = marked.withColumn("html", F.regexp_replace("html", "<h1>", '<h1 id="head">'))
    return select(parse_pages(marked, keep=("text",), partitions=partitions(spark)), "#head::text").select("page_id", "pos", "value")


@query
def select_class(spark, sf):
    marked = pages(spark, sf).withColumn("html", F.regexp_replace("html", '<div class="ad">', '<div class="box\tad wide">'))
    return select(parse_pages(marked, keep=("text",), partitions=partitions(spark)), ".ad::text").select("page_id", "pos", "tag", "value")


@query
def select_compound(spark, sf):
    return select(docs(spark, sf), "div.ad::text").select("page_id", "pos", "value")


@query
def select_attr_present(spark, sf):
    return docs(spark, sf).select(
        "page_id", css("a[href]").count().alias("n_href"), css("[lang]").count().alias("n_lang"),
        css("a[rel]").count().alias("n_rel"), css("meta[charset]").count().alias("n_charset"))


@query
def select_attr_equals(spark, sf):
    return select(docs(spark, sf), "html[lang='en'] title::text").select("page_id", "pos", "value")


@query
def select_attr_operators(spark, sf):
    return docs(spark, sf).select(
        "page_id", css("a[href^='/a']").count().alias("n_prefix"), css("a[href$=',']").count().alias("n_suffix"),
        css('a[href*="th"]').count().alias("n_inside"), css("html[lang|=en]").count().alias("n_lang"),
        css("a[href='/THE' i]").count().alias("n_folded"))


@query
def select_descendant(spark, sf):
    return select(docs(spark, sf), "nav a::text").select("page_id", "pos", "value")


@query
def select_child(spark, sf):
    return docs(spark, sf).select(
        "page_id", css("ul > li").count().alias("n_li"), css("nav > li").count().alias("n_none"),
        css("body > nav > ul > li > a").count().alias("n_chain"), css("article > h1::text").get().alias("h1"))


@query
def select_siblings(spark, sf):
    return docs(spark, sf).select(
        "page_id", css("nav + div::text").get().alias("after_nav"), css("li + li").count().alias("n_next"),
        css("h1 ~ p").count().alias("n_later"), css("li:first-child::text").get().alias("first_li"),
        css("li:nth-child(2n+1)").count().alias("n_odd"), css("li:last-child").count().alias("n_last"),
        css("li:not(:first-child)").count().alias("n_not_first"))


@query
def select_has(spark, sf):
    """Elements by what they hold: descendants, children, siblings behind them, chains, and none of these."""
    work = docs(spark, sf)
    texts = {"child": 'li:has(> a[href*="th"])', "deep": 'nav li:has(a[href*="th"])', "none": 'li:not(:has(a[href*="th"]))', "before": 'li:has(+ li a[href*="th"])'}
    found = [_exploded(work, css(f"{q}::text").getall()).withColumn("form", F.lit(name)) for name, q in texts.items()]
    counts = {"chain": "body:has(nav > ul a)", "later": "nav:has(~ footer)", "not child": "nav:has(> a)", "any": ":has(> li, > h1)"}
    found += [work.select("page_id", F.lit(0).alias("pos"), css(q).count().cast("string").alias("value"), F.lit(name).alias("form")) for name, q in counts.items()]
    return reduce(DataFrame.unionByName, found)


@query
def select_of_type(spark, sf):
    """Places among siblings of one tag, also after some are dropped."""
    work = docs(spark, sf)
    texts = {"odd": "li:nth-of-type(2n+1)", "third from the end": "li:nth-last-of-type(3)", "first": "nav li:first-of-type", "last": "li:last-of-type",
             "only": "article > h1:only-of-type", "not only": "head > :not(title, :first-of-type)"}
    found = [_exploded(work, css(f"{q}::text").getall()).withColumn("form", F.lit(name)) for name, q in texts.items()]
    left = drop(work, "li:nth-of-type(2)")
    found.append(_exploded(left, css("li:nth-of-type(2)::text, li:last-of-type::text").getall()).withColumn("form", F.lit("dropped")))
    return reduce(DataFrame.unionByName, found)


@query
def select_comma_list(spark, sf):
    return select(docs(spark, sf), "h1::text, title::text, html::attr(lang), zz::text").select("page_id", "pos", "tag", "value")


@query
def select_scoped(spark, sf):
    return _exploded(docs(spark, sf), css("nav").css("li").css("a::attr(href), ::text").getall())


@query
def select_self(spark, sf):
    return _exploded(docs(spark, sf), css("li").css("::text").getall())


@query
def page_css(spark, sf):
    return docs(spark, sf).select("page_id", css("title::text").get().alias("title"), css("footer::text").count().alias("n_footer"))


# -- projections -------------------------------------------------------------

@query
def project_text(spark, sf):
    return docs(spark, sf).select(
        "page_id", css("title::text").get().alias("title"), css("nav::text").get().alias("nav"),
        css("br::text").get().alias("br"), css("style::text").get().alias("style"), css("script::text").get().alias("script"))


@query
def project_attr(spark, sf):
    return _exploded(docs(spark, sf), css("html::attr(lang), a::attr(rel), meta::attr(charset)").getall())


@query
def project_html(spark, sf):
    return docs(spark, sf, html=True).select(
        "page_id", css("nav").get().alias("nav"), css("meta").get().alias("meta"), css("style").get().alias("style"),
        css("h1").get().alias("h1"))


@query
def project_attrib(spark, sf):
    d = docs(spark, sf)
    return d.select(
        "page_id", css("html").attrib()["lang"].alias("lang"), css("a").attrib()["href"].alias("href"),
        F.size(css("a").attrib()).alias("n_a"), F.size(css("zz").attrib()).alias("n_none"))


@query
def project_link_parts(spark, sf):
    return iter_links(parse_pages(link_pages(spark, sf), keep=("text",), partitions=partitions(spark)), attrs=("href", "data-url")).select(
        "page_id", "pos", "attr", "value", "text", "nofollow")


# -- arrays ------------------------------------------------------------------

@query
def array_getall(spark, sf):
    return docs(spark, sf).select("page_id", F.array_join(css("li a::text").getall(), "|").alias("joined"))


@query
def array_get_default(spark, sf):
    return docs(spark, sf).select(
        "page_id", css("h1::text").get("none").alias("h1"), css("zz::text").get("none").alias("zz"),
        css("zz::text").get().alias("zz_null"), css("br::text").get("none").alias("br"))


@query
def array_index(spark, sf):
    items = css("li a::text")
    return docs(spark, sf).select(
        "page_id", items[0].get().alias("first"), items[-1].get().alias("last"), items[1].get().alias("second"),
        items[500].get().alias("beyond"))


@query
def array_slice(spark, sf):
    items = css("li a::text")
    return docs(spark, sf).select(
        "page_id", F.array_join(items[1:3].getall(), "|").alias("mid"), F.array_join(items[-2:].getall(), "|").alias("tail"),
        F.array_join(items[:-1].getall(), "|").alias("but_last"), items[4:2].count().alias("n_empty"))


@query
def array_flatten(spark, sf):
    return _exploded(docs(spark, sf), css("nav, ul").css("a::text").getall())


@query
def array_rows(spark, sf):
    return select(docs(spark, sf, html=True), "li").select("page_id", "pos", "tag", "value")


@query
def array_count(spark, sf):
    return docs(spark, sf).select("page_id", css("li").count().alias("n_li"), css("zz").count().alias("n_zz"))


# -- strings -----------------------------------------------------------------

@query
def regex_all(spark, sf):
    """Several groups over headings; literal braces, ``{,n}`` and flags over scripts, as text and compiled."""
    d = docs(spark, sf)
    words = _exploded(d, css("h1::text").re(r"([A-Za-z]+) ([a-z]+)")).withColumn("source", F.lit("h1"))
    braces = pages(spark, sf).withColumn("html", F.replace("html", F.lit("track("), F.lit('DATA={"id":7,"x{":"}"};track(')))
    parsed = parse_pages(braces, keep=("text",), partitions=partitions(spark))
    scripts = _exploded(parsed, F.concat(
        css("script::text").re(r'{"id":(\d+),'), css("script::text").re(r't.{,3}"'), css("script::text").re(re.compile(r"data={", re.I)))).withColumn("source", F.lit("script"))
    return words.unionByName(scripts)


@query
def regex_one_group(spark, sf):
    return _exploded(docs(spark, sf), css("a::attr(href)").re(r"/(th[a-z]*)"))


@query
def regex_first(spark, sf):
    return docs(spark, sf).select(
        "page_id", css("h1::text").re_first(r"[a-z]{5,}", "none").alias("word"),
        css("h1::text").re_first(r"(?P<extract>[A-Z])[a-z]+").alias("initial"),
        css("h1::text").re_first(r"[0-9]{7}", "none").alias("number"))


@query
def entity_decode(spark, sf):
    return pages(spark, sf).select("page_id", F.md5(decode_entities(F.col("html"), scalar=True)).alias("digest"))


@query
def strip_blank_values(spark, sf):
    padded = F.concat(F.lit(" \t\n"), "html", F.lit("\f\r "))
    return pages(spark, sf).select("page_id", F.md5(strip_blanks(padded)).alias("digest"))


@query
def rel_tokens(spark, sf):
    rel = F.concat(F.regexp_extract("url", "^(https?)", 1), F.lit(","), F.when(F.col("url").contains("spam"), "nofollow").otherwise("nofollowed"))
    marked = pages(spark, sf).withColumn("html", F.replace("html", F.lit("<a href"), F.concat(F.lit('<a rel="'), rel, F.lit('" href'))))
    links = iter_links(parse_pages(marked, keep=("text",), partitions=partitions(spark)))
    return links.select("page_id", "pos", "nofollow", has_nofollow(F.lit(None).cast("string")).alias("absent"))


# -- edits -------------------------------------------------------------------

@query
def drop_subtrees(spark, sf):
    cut = drop(docs(spark, sf, html=True), "nav", "div.ad", "article", "style", "zz")
    return cut.select(
        "page_id", css("head").get().alias("head"), css("a").count().alias("n_a"), css("body > *:first-child").get().alias("first"),
        css("body > footer:last-child").count().alias("n_last"), css("body").css("*").count().alias("n_left"))


@query
def drop_indexed(spark, sf):
    cut = drop(docs(spark, sf), css("li")[0], css("li")[-2:])
    return cut.select("page_id", F.array_join(css("li::text").getall(), "|").alias("left"), css("ul:empty").count().alias("n_empty"))


@query
def drop_scoped(spark, sf):
    cut = drop(docs(spark, sf), css("nav").css("li").css("a")[::2], "h1")
    return cut.select("page_id", F.array_join(css("a::text").getall(), "|").alias("left"), css("li:empty").count().alias("n_empty"), css("h1").count().alias("n_h1"))


@query
def drop_keeps_input(spark, sf):
    """The edited columns beside a count over those given, from one parse."""
    d = docs(spark, sf).withColumn("n_before", css("li").count())
    edited = drop(d, "li:first-child")
    return edited.select("page_id", "n_before", css("li").count().alias("n_after"), css("li:first-child::text").get().alias("new_first"))


@query
def page_clean_text(spark, sf):
    return clean_text(docs(spark, sf), ("nav", ".ad", "article", "script", "style"))


# -- links -------------------------------------------------------------------

def _links(spark, sf, **options):
    return links_from_pages(link_pages(spark, sf), partitions=partitions(spark), **options)


@query
def link_scan(spark, sf):
    return iter_links(docs(spark, sf)).select("page_id", "pos", "attr", "value", "text")


@query
def link_resolve(spark, sf):
    return links_from_pages(pages(spark, sf), partitions=partitions(spark), unique=False)


@query
def link_unique(spark, sf):
    return links_from_pages(pages(spark, sf), partitions=partitions(spark))


@query
def link_options_default(spark, sf):
    return _links(spark, sf, unique=False)


@query
def link_no_strip(spark, sf):
    return _links(spark, sf, strip=False).select("page_id", "pos", "url")


@query
def link_base(spark, sf):
    based = pages(spark, sf).withColumn("html", F.regexp_replace("html", "<title>", '<base href="/deep/er/"><title>'))
    based = based.withColumn("html", F.regexp_replace("html", '<a href="/', '<a href="'))
    return links_from_pages(based, partitions=partitions(spark), unique=False).select("page_id", "pos", "url")


@query
def link_process_value(spark, sf):
    def cut(u):
        return F.when(~u.startswith("mailto:"), F.regexp_replace(u, r"[?#].*", ""))

    return _links(spark, sf, process_value=cut).select("page_id", "pos", "url", "text")


@query
def link_process_udf(spark, sf):
    """The same rewriting by a pandas UDF, an Arrow UDF and a function of strings."""
    def cut(u: str) -> str | None:
        return None if u.startswith("mailto:") else re.sub(r"[?#].*", "", u, flags=re.S)

    @F.pandas_udf(T.StringType())
    def cut_series(u: pd.Series) -> pd.Series:
        return u.str.replace(r"[?#].*", "", regex=True, flags=re.S).where(~u.str.startswith("mailto:"), None)

    @F.arrow_udf(T.StringType())
    def cut_array(u: pa.Array) -> pa.Array:
        return pc.if_else(pc.starts_with(u, "mailto:"), None, pc.replace_substring_regex(u, r"(?s)[?#].*", ""))

    found = [_links(spark, sf, process_value=f).select("page_id", "pos", "url", "text", F.lit(name).alias("form"))
             for name, f in (("string", cut), ("series", cut_series), ("array", cut_array))]
    return reduce(DataFrame.unionByName, found)


@query
def link_normalise(spark, sf):
    urls = pages(spark, sf).withColumn("html", F.regexp_replace("html", '<a href="/([^"]*)">', '<a href="/x y|$1?q=\'$1\'">'))
    return links_from_pages(urls, partitions=partitions(spark), unique=False).select("page_id", "pos", "url")


@query
def link_allow(spark, sf):
    return _links(spark, sf, allow=(r"/en/", r"\?a=1"), deny_extensions=()).select("page_id", "pos", "url")


@query
def link_deny(spark, sf):
    return _links(spark, sf, deny=(r"/en/", r"[?]b="), deny_extensions=()).select("page_id", "pos", "url")


@query
def link_allow_domains(spark, sf):
    return _links(spark, sf, allow_domains=("Example.com", "m.ththth.example.net")).select("page_id", "pos", "url")


@query
def link_deny_domains(spark, sf):
    return _links(spark, sf, deny_domains="example.com").select("page_id", "pos", "url")


@query
def link_domain_table(spark, sf):
    spam = pages(spark, sf).where(F.col("url").rlike("spam|pills")).select(
        F.regexp_extract("url", "([^./]+[.]example[.][a-z]+)", 1).alias("domain")).distinct()
    return restrict_domains(_links(spark, sf), spam, keep=False).select("page_id", "pos", "url")


@query
def stream_domain_table(spark, sf):
    """Links of arriving pages, restricted to a table of domains on the way."""
    folder = new_folder(spark, "stream-domains")
    kept = pages(spark, sf).where(F.col("url").contains("/en/")).select(
        F.regexp_extract("url", "([^./]+[.]example[.][a-z]+)", 1).alias("domain")).distinct()
    links = links_from_pages(link_pages_of(_arriving(spark, sf)), partitions=partitions(spark))
    write_stream(restrict_domains(links, kept), f"{folder}/out", checkpoint=f"{folder}/state").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("page_id", "pos", "url")


@query
def link_deny_extensions(spark, sf):
    return _links(spark, sf, deny_extensions=("html", "htm")).select("page_id", "pos", "url")


@query
def link_schemes(spark, sf):
    return _links(spark, sf, deny_extensions=(), unique=True).select(
        "page_id", F.regexp_extract("url", "^([a-z]+):", 1).alias("scheme")).groupBy("page_id", "scheme").agg(F.count("*").alias("n"))


@query
def link_canonical(spark, sf):
    return _links(spark, sf, canonicalize=True).select("page_id", "pos", "url", "text")


@query
def link_tags_attrs(spark, sf):
    return _links(spark, sf, tags=("a", "link"), attrs=("href", "data-url"), deny_extensions=(), unique=False).select("page_id", "pos", "url")


# -- records, crawl jobs, summaries ------------------------------------------

@query
def records(spark, sf):
    return extract_records(docs(spark, sf), "nav li", {
        "label": "::text", "href": "a::attr(href)", "missing": "em::text", "word": Field("a::text", regex="[a-z]{4,}", default="none")})


@query
def page_fields(spark, sf):
    return extract_page_fields(docs(spark, sf), {
        "title": "title::text", "h1": "h1::text", "price": ".price::text", "lang": Field("html::attr(lang)", default="??"),
        "first_word": Field("h1::text", regex=r"^(\w+)", default="none")})


@query
def crawl_rules(spark, sf):
    rules = (
        Rule({"allow": r"/th"}, callback="parse_th", follow=True),
        Rule({"allow": r"/[a-z]{1,3}$"}, callback="parse_short"),
        Rule({"deny": r"%"}),
    )
    return apply_rules(docs(spark, sf), rules)


@query
def crawl_frontier(spark, sf):
    parsed = store_docs(docs(spark, sf))
    links = apply_rules(parsed, (Rule({"allow": r"/th"}, follow=True), Rule(callback="rest")))
    seen = extract_links(parsed).where(F.col("pos") == 0).select("url")
    return frontier(links, seen)


@query
def crawl_rounds(spark, sf):
    """Two rounds over one store of seen URLs; the second finds what the first did not."""
    links = store_table(links_from_pages(pages(spark, sf), partitions=partitions(spark)), "links")
    seen = SeenUrls(spark)
    seen.add(links.where(F.col("pos") == 0).select("url"))
    first = seen.next_round(links.where(F.col("url").contains("/th")))
    second = seen.next_round(links)
    return first.withColumn("round", F.lit(1)).unionByName(second.withColumn("round", F.lit(2)))


@query
def links_per_host(spark, sf):
    return host_summary(links_from_pages(pages(spark, sf), partitions=partitions(spark), keep=("page_id", "url"), unique=False))


@query
def host_graph(spark, sf):
    return link_graph(links_from_pages(link_pages(spark, sf), partitions=partitions(spark), keep=("page_id", "url")))


@query
def host_graph_merged(spark, sf):
    """Sketches of two crawls, merged; how far their estimates are from the exact counts."""
    links = store_table(links_from_pages(link_pages(spark, sf), partitions=partitions(spark), keep=("page_id", "url")), "links")
    crawls = [links.where(F.col("page_id") % 3 != k) for k in (0, 1)]      # a third of the pages is in both
    merged = estimated_graph(merge_link_states(reduce(DataFrame.unionByName, (store_table(link_states(c), "states") for c in crawls))))
    exact = link_graph(links).select("src_host", "dst_host", F.col("n_urls").alias("exact"))
    close = F.abs(F.col("n_urls") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.03 * F.col("exact"))
    return merged.join(exact, ["src_host", "dst_host"]).select("src_host", "dst_host", "n_links", close.alias("is_close"))


@query
def tag_pages_merged(spark, sf):
    parsed = store_docs(docs(spark, sf))
    crawls = [parsed.where(F.col("page_id") % 3 != k) for k in (0, 1)]
    merged = merge_tag_states(reduce(DataFrame.unionByName, (store_table(tag_states(c), "states") for c in crawls)))
    exact = tag_profile(parsed).select("tag", F.col("n_pages").alias("exact"))
    return merged.join(exact, "tag").select("tag", "exact", (F.abs(F.col("n_pages") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.03 * F.col("exact"))).alias("is_close"))


@query
def host_graph_degrees(spark, sf):
    return host_degrees(link_graph(links_from_pages(link_pages(spark, sf), partitions=partitions(spark), keep=("page_id", "url"))))


@query
def most_linked(spark, sf):
    return top_links(links_from_pages(pages(spark, sf), partitions=partitions(spark), unique=False), 20)


@query
def tag_frequency(spark, sf):
    return tag_profile(docs(spark, sf))


@query
def attribute_frequency(spark, sf):
    return attribute_profile(docs(spark, sf))


# -- user functions ----------------------------------------------------------

@query
def scan_predicates(spark, sf):
    d = parse_pages(link_pages(spark, sf), keep=("text",), partitions=partitions(spark))
    found = candidates(lambda t: t.startswith("a"), lambda a: a.contains("-") | (a == "rel"))
    return explode_structs(d, found, keep=("page_id",)).select("page_id", "pos", "attr", "value")


@query
def page_callback(spark, sf):
    def parse_item(d: DataFrame) -> DataFrame:
        return with_links(d).select(
            "page_id", css("h1::text").get().alias("name"), F.size("links").alias("n_links"))

    return docs(spark, sf).transform(parse_item)


@query
def links_in_scope(spark, sf):
    nav_only = drop(docs(spark, sf), "li:first-child")
    return extract_links(nav_only, unique=False).select("page_id", "pos", "text")


# -- streams -----------------------------------------------------------------

def _arriving(spark, sf) -> DataFrame:
    """The given pages as a stream."""
    pages(spark, sf)        # session settings
    return stream_pages(spark, f"{sf}/pages.parque[t]")     # as a pattern the path may be one file or a folder


@query
def stream_page_links(spark, sf):
    folder = new_folder(spark, "stream-links")
    stream_links(_arriving(spark, sf), f"{folder}/out", checkpoint=f"{folder}/state", partitions=partitions(spark)).awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@query
def stream_page_records(spark, sf):
    folder = new_folder(spark, "stream-records")
    fields = {"label": "a::text", "href": "a::attr(href)"}
    stream_records(_arriving(spark, sf), "li", fields, f"{folder}/out", checkpoint=f"{folder}/state", partitions=partitions(spark)).awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@query
def stream_three_tables(spark, sf):
    """Links, records and skipped responses from one parse of each batch."""
    folder = new_folder(spark, "stream-tables")
    tables = crawl_tables("li", {"label": "a::text", "href": "a::attr(href)"})
    source = as_responses(_arriving(spark, sf)).repartition(partitions(spark))
    stream_tables(source, tables, f"{folder}/out", prepare=parse_responses, checkpoint=f"{folder}/state").awaitTermination()
    links, records, skipped = (read_batches(spark, f"{folder}/out", name) for name in tables)
    return (links.select(F.lit("links").alias("part"), "page_id", "pos", F.col("url").alias("value"))
            .unionByName(records.select(F.lit("records").alias("part"), "page_id", "pos", F.concat_ws(" ", "label", "href").alias("value")))
            .unionByName(skipped.select(F.lit("skipped").alias("part"), "page_id", F.lit(0).alias("pos"), F.col("kind").alias("value"))))


@query
def stream_routing(spark, sf):
    folder = new_folder(spark, "stream-routing")
    rows = as_responses(_arriving(spark, sf)).drop("page_id").withColumns({
        "has_override": F.lit(False), "backend_override": F.lit(None).cast("string")})
    stream_html(rows, f"{folder}/out", checkpoint=f"{folder}/state").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("url", F.md5("html").alias("digest"))
