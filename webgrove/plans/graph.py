"""Corpus-wide summaries of links and elements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgrove.functions.urls import host
from webgrove.operators.parse import live
from webgrove.operators.rows import explode_structs

#: Bits of a sketch's register number: 65,536 registers of a byte each, fewer while it has seen little.  Merged sketches
#: have a standard error of 1.04 / sqrt(registers), here 0.4 percent, so one off by 3 percent is not to be expected in any crawl.
SKETCH_BITS = 16


def with_hosts(links: DataFrame) -> DataFrame:
    """Add ``src_host`` (of ``page_url``) and ``dst_host`` (of ``url``)."""
    return links.withColumns({"src_host": host(F.col("page_url")), "dst_host": host(F.col("url"))})


def link_graph(links: DataFrame) -> DataFrame:
    """One row per host pair: links, distinct URLs, share of nofollow.

    Counting distinct URLs shuffles on pair *and* URL first, so one host pair
    with very many links is spread out.
    """
    return with_hosts(links).groupBy("src_host", "dst_host").agg(
        F.count("*").alias("n_links"),
        F.count_distinct("url").alias("n_urls"),
        F.avg(F.col("nofollow").cast("int")).alias("nofollow_share"),
    )


def link_states(links: DataFrame) -> DataFrame:
    """``link_graph`` as states that can be stored per crawl and merged later: counts, and a sketch of the distinct URLs."""
    return with_hosts(links).groupBy("src_host", "dst_host").agg(
        F.count("*").alias("n_links"), F.count_if("nofollow").alias("n_nofollow"), F.hll_sketch_agg("url", F.lit(SKETCH_BITS)).alias("urls"))


def merge_link_states(states: DataFrame) -> DataFrame:
    """States of several crawls as one; URLs that several of them saw count once.

    States of fewer registers, stored earlier, merge at their own precision.
    """
    return states.groupBy("src_host", "dst_host").agg(
        F.sum("n_links").alias("n_links"), F.sum("n_nofollow").alias("n_nofollow"), F.hll_union_agg("urls", True).alias("urls"))


def estimated_graph(states: DataFrame) -> DataFrame:
    """``link_graph``'s columns from states; ``n_urls`` is an estimate with a standard error of 0.4 percent."""
    return states.select("src_host", "dst_host", "n_links", F.hll_sketch_estimate("urls").alias("n_urls"), (F.col("n_nofollow") / F.col("n_links")).alias("nofollow_share"))


def tag_states(docs: DataFrame) -> DataFrame:
    """``tag_profile`` as mergeable states; pages of several crawls, told apart by ``page_id``, count once per tag."""
    tags = F.array_distinct(F.transform(live(), lambda n: n["tag"]))
    rows = docs.select("page_id", F.explode(tags).alias("tag"))
    return rows.groupBy("tag").agg(F.hll_sketch_agg("page_id", F.lit(SKETCH_BITS)).alias("pages"))


def merge_tag_states(states: DataFrame) -> DataFrame:
    """``tag, n_pages`` (an estimate) over the states of several crawls."""
    return states.groupBy("tag").agg(F.hll_sketch_estimate(F.hll_union_agg("pages", True)).alias("n_pages"))


def host_summary(links: DataFrame) -> DataFrame:
    """Per source host: pages with links, links, distinct targets.

    Pages and targets are made distinct per host and value before a host's rows meet,
    so a host with very many links is spread out.
    """
    return links.groupBy(host(F.col("page_url")).alias("src_host")).agg(
        F.count_distinct("page_id").alias("n_pages"),
        F.count("*").alias("n_links"),
        F.count_distinct("url").alias("n_targets"),
    )


def host_degrees(graph: DataFrame) -> DataFrame:
    """Per host: hosts it links to and hosts linking to it, from ``link_graph`` rows."""
    both = graph.select(F.inline(F.array(
        F.struct(F.col("src_host").alias("host"), F.lit(1).alias("out"), F.lit(0).alias("into")),
        F.struct(F.col("dst_host").alias("host"), F.lit(0).alias("out"), F.lit(1).alias("into")),
    )))
    return both.groupBy("host").agg(F.sum("out").alias("out_degree"), F.sum("into").alias("in_degree"))


def top_links(links: DataFrame, k: int) -> DataFrame:
    """The ``k`` most linked URLs, ties by URL."""
    counted = links.groupBy("url").agg(F.count("*").alias("n_links"))
    return counted.orderBy(F.desc("n_links"), "url").limit(k)


def tag_profile(docs: DataFrame) -> DataFrame:
    """Per tag: elements and pages that hold it.

    A page is reduced to one row per tag before anything is shuffled, which also
    makes the page count a plain sum.
    """
    return _profile(docs, F.transform(live(), lambda n: n["tag"]), "tag")


def attribute_profile(docs: DataFrame) -> DataFrame:
    """Per ``tag.attribute``: elements and pages that hold it."""
    pairs = F.flatten(F.transform(live(), lambda n: F.transform(
        n["attr_names"], lambda a: F.concat(n["tag"], F.lit("."), a))))
    return _profile(docs, pairs, "attribute")


def _profile(docs: DataFrame, names, column: str) -> DataFrame:
    work = docs.select(F.array_sort(names).alias("_names"))
    # In sorted order each name is a run: its length is the distance between ends.
    ends = F.filter(
        F.transform("_names", lambda x, i: F.struct(x.alias("name"), (i + 1).alias("upto"))),
        lambda r: ~F.get("_names", r["upto"]).eqNullSafe(r["name"]),
    )
    work = work.select(ends.alias("_ends"))
    runs = F.transform("_ends", lambda r, i: F.struct(
        r["name"].alias(column),
        (r["upto"] - F.coalesce(F.get("_ends", i - 1)["upto"], F.lit(0))).alias("n"),
    ))
    return explode_structs(work, runs).groupBy(column).agg(
        F.sum("n").alias("n_elements"), F.count("*").alias("n_pages"))
