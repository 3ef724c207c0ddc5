"""Rules, frontier, link graph and profiles."""

from pyspark.sql import functions as F

from webgrove import (
    Rule, SeenUrls, apply_rules, attribute_profile, frontier, host_degrees, host_summary, link_graph, links_from_pages, parse_pages, tag_profile,
    top_links,
)
from webgrove.plans.graph import estimated_graph, link_states, merge_link_states, merge_tag_states, tag_states


def pages_of(spark, *items):
    return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(items)], "page_id long, url string, html string")


PAGE = '<a href="/products/1">p</a><a href="/about">a</a><a href="/products/2?b=1&a=2">q</a><link href="/products/1"><a href="/x.pdf">f</a>'


def test_rules_first_wins(spark):
    docs = parse_pages(pages_of(spark, ("http://e.com", PAGE)))
    rules = (
        Rule({"allow": "/products/1"}, callback="product", follow=True),
        Rule({"allow": "/products/", "canonicalize": True}, callback="list"),
        Rule({"tags": ("link",)}, callback="meta"),
        Rule(),
    )
    rows = apply_rules(docs, rules).orderBy("pos").collect()
    assert [(r.rule, r.callback, r.follow, r.url) for r in rows] == [
        (0, "product", True, "http://e.com/products/1"),
        (1, "list", False, "http://e.com/products/2?a=2&b=1"),
        (2, "meta", False, "http://e.com/products/1"),      # other text, so another link
        (3, None, True, "http://e.com/about"),
        (3, None, True, "http://e.com/products/2?b=1&a=2"),
    ]


def test_rules_share_one_url_pass(spark):
    docs = parse_pages(pages_of(spark, ("http://e.com", PAGE)))
    plan = apply_rules(docs, (Rule({"allow": "a"}), Rule({"deny": "b"}, callback="x"), Rule()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan


def test_frontier(spark):
    docs = parse_pages(pages_of(spark, ("http://e.com", PAGE), ("http://e.com/2", PAGE)))
    links = apply_rules(docs, (Rule({"allow": "/products"}, follow=True, callback="c"), Rule({"allow": "about"}, callback="d")))
    seen = spark.createDataFrame([("http://e.com/products/1",), ("http://e.com/zzz",)], "url string")
    assert [r.url for r in frontier(links, seen).collect()] == ["http://e.com/products/2?b=1&a=2"]
    assert frontier(links.drop("follow"), seen).count() == 2


def test_seen_urls_stay_where_they_are(spark):
    seen = SeenUrls(spark)
    seen.add(spark.range(1000).selectExpr("concat('http://e.com/', id) AS url"))
    seen.add(spark.createDataFrame([("http://e.com/x",), (None,)], "url string"))
    links = spark.range(995, 1005).selectExpr("concat('http://e.com/', id) AS url", "id % 2 = 0 AS follow")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for buckets, exchanges in ((None, 1), (16, 2)):         # of the new URLs alone
            store = SeenUrls(spark, buckets=buckets)
            plan = frontier(links, store.table())._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == exchanges, plan
            scan = plan[plan.index("LeftAnti"):].partition("FileScan")
            assert "Bucketed: true" in scan[2] and "Exchange" not in scan[0].rpartition("Range")[2]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(r.url for r in seen.next_round(links).collect()) == ["http://e.com/1000", "http://e.com/1002", "http://e.com/1004"]
    assert seen.next_round(links).count() == 0
    assert sorted(r.url for r in seen.next_round(links.drop("follow")).collect()) == ["http://e.com/1001", "http://e.com/1003"]


def test_states_of_crawls_merge(spark):
    links = spark.range(30_000).selectExpr("id % 3 AS crawl", "concat('http://h', id % 2, '.com/') AS page_url",
                                           "concat('http://t.net/', id % 7001) AS url", "id % 4 = 0 AS nofollow")
    states = [link_states(links.where(F.col("crawl") == k)) for k in range(3)]
    merged = estimated_graph(merge_link_states(states[0].unionByName(states[1]).unionByName(states[2])))
    exact = {r.src_host: r for r in link_graph(links).collect()}
    for r in merged.collect():
        want = exact[r.src_host]
        assert (r.n_links, r.nofollow_share) == (want.n_links, want.nofollow_share)
        assert abs(r.n_urls - want.n_urls) <= 0.03 * want.n_urls
    assert merged.count() == len(exact) == 2
    docs = parse_pages(pages_of(spark, *((f"http://e.com/{i}", "<p>x<p>y" + "<b>z</b>" * (i % 2)) for i in range(500))))
    again = tag_states(docs.where("page_id < 300")).unionByName(tag_states(docs.where("page_id >= 100")))
    pages = {r.tag: r.n_pages for r in merge_tag_states(again).collect()}
    assert abs(pages["p"] - 500) <= 15 and abs(pages["b"] - 250) <= 8

def test_merged_states_of_many_pairs_are_all_close(spark):
    links = spark.range(3_000_000).selectExpr("id % 3 AS crawl", "concat('http://h', id % 100, '.com/') AS page_url",
                                              "concat('http://t.net/', id) AS url", "false AS nofollow")
    states = [link_states(links.where(F.col("crawl") != k)) for k in (0, 1)]       # a third of the links is in both
    off = [abs(r.n_urls / 30_000 - 1) for r in estimated_graph(merge_link_states(states[0].unionByName(states[1]))).collect()]
    assert len(off) == 100 and max(off) <= 0.03
    pages = spark.range(3_000_000).selectExpr("id AS page_id", "array(named_struct('tag', concat('t', id % 100))) AS nodes")
    tags = [tag_states(pages.where(F.col("page_id") % 3 != k)) for k in (0, 1)]
    off = [abs(r.n_pages / 30_000 - 1) for r in merge_tag_states(tags[0].unionByName(tags[1])).collect()]
    assert len(off) == 100 and max(off) <= 0.03


def test_states_of_other_precision_merge(spark):
    links = spark.range(20_000).selectExpr("'http://h.com/' AS page_url", "concat('http://t.net/', id) AS url", "id % 4 = 0 AS nofollow")
    older = link_states(links).withColumn("urls", F.lit(links.agg(F.hll_sketch_agg("url", 12)).first()[0]))
    [row] = estimated_graph(merge_link_states(link_states(links).unionByName(older))).collect()
    assert (row.n_links, row.nofollow_share) == (40_000, 0.25) and abs(row.n_urls - 20_000) <= 0.1 * 20_000
    docs = spark.range(20_000).selectExpr("id AS page_id", "array(named_struct('tag', 'a')) AS nodes")
    older = docs.agg(F.lit("a").alias("tag"), F.hll_sketch_agg("page_id", 12).alias("pages"))
    [row] = merge_tag_states(tag_states(docs).unionByName(older)).collect()
    assert abs(row.n_pages - 20_000) <= 0.1 * 20_000


def test_graph_and_degrees(spark):
    pages = pages_of(
        spark, ("http://a.com/1", '<a href="http://b.com/x">1</a><a href="http://B.com:80/y" rel=nofollow>2</a><a href="/self">3</a>'),
        ("http://a.com/2", '<a href="http://b.com/x">1</a>'), ("http://c.com/", '<a href="http://a.com/1">1</a>'))
    links = links_from_pages(pages, keep=("page_id", "url"))
    graph = {(r.src_host, r.dst_host): (r.n_links, r.n_urls, r.nofollow_share) for r in link_graph(links).collect()}
    assert graph == {("a.com", "b.com"): (3, 2, 1 / 3), ("a.com", "a.com"): (1, 1, 0.0), ("c.com", "a.com"): (1, 1, 0.0)}
    degrees = {r.host: (r.out_degree, r.in_degree) for r in host_degrees(link_graph(links)).collect()}
    assert degrees == {"a.com": (2, 2), "b.com": (0, 1), "c.com": (1, 0)}
    hosts = {r.src_host: (r.n_pages, r.n_links, r.n_targets) for r in host_summary(links).collect()}
    assert hosts == {"a.com": (2, 4, 3), "c.com": (1, 1, 1)}
    assert [tuple(r) for r in top_links(links, 2).collect()] == [("http://b.com/x", 2), ("http://a.com/1", 1)]


def test_pages_are_counted_after_links_were_filtered(spark):
    pages = pages_of(spark, ("http://a.com/1", '<a href="/x" rel=nofollow>1</a><a href="/y">2</a>'), ("http://a.com/2", '<a href="/y">1</a>'))
    links = links_from_pages(pages, keep=("page_id", "url")).where("not nofollow")
    assert [tuple(r) for r in host_summary(links).collect()] == [("a.com", 2, 2, 1)]


def test_profiles(spark):
    docs = parse_pages(pages_of(spark, ("u", "<p>a<p class=x>b<i>c</i>"), ("u", "<p id=y class=z>"), ("u", None)))
    tags = {r.tag: (r.n_elements, r.n_pages) for r in tag_profile(docs).collect()}
    assert tags == {"html": (2, 2), "head": (2, 2), "body": (2, 2), "p": (3, 2), "i": (1, 1)}
    assert {r.attribute: (r.n_elements, r.n_pages) for r in attribute_profile(docs).collect()} == {"p.class": (2, 2), "p.id": (1, 1)}


def test_one_hot_host_is_counted_whole(spark):
    links = spark.range(30000).select(
        F.col("id").alias("page_id"), F.lit(0).alias("pos"),
        F.when(F.col("id") % 3 == 0, "http://hot.com/p").otherwise(F.concat(F.lit("http://h"), F.col("id") % 50, F.lit(".com/"))).alias("page_url"),
        F.concat(F.lit("http://t.com/"), F.col("id") % 1000).alias("url"), F.lit(False).alias("nofollow"))
    rows = {r.src_host: r for r in link_graph(links).collect()}
    assert (rows["hot.com"].n_links, rows["hot.com"].n_urls) == (10000, 1000)
    assert sum(r.n_links for r in rows.values()) == 30000
