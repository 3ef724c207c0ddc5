"""Crawl-shaped jobs: which links a set of rules follows, and what is left to fetch."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webgrove.operators.links import LinkOptions, _finish, first_per_key, resolve
from webgrove.operators.rows import explode_structs
from webgrove.sources.tables import new_folder, store_table


@dataclass(frozen=True)
class Rule:
    """Link options, the label of what handles the linked pages, and whether their
    own links are followed (by default only where nothing handles them)."""

    options: Mapping[str, Any] = field(default_factory=dict)
    callback: str | None = None
    follow: bool | None = None

    @property
    def follows(self) -> bool:
        return not self.callback if self.follow is None else self.follow


def apply_rules(docs: DataFrame, rules: Sequence[Rule], *, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``page_id, pos, rule, callback, follow, url, text, nofollow``.

    A link belongs to the first rule that extracts it.  Rules that look at the
    same tags and attributes share one scan and one pass of URL resolution.
    """
    work, scans, lists = docs, {}, []
    for i, rule in enumerate(rules):
        o = LinkOptions(**rule.options)
        if o.scan not in scans:
            scans[o.scan] = f"_scan{len(scans)}"
            work = resolve(work, o.scan, scans[o.scan])
        name = f"_rule{i}"
        work = _finish(work.withColumn(name, F.col(scans[o.scan])), name, o)
        lists.append(_labelled(name, i, rule))
    if not lists:
        raise ValueError("apply_rules needs at least one rule")
    work = work.withColumn("_links", F.concat(*lists))
    firsts = F.expr(first_per_key("_links", "struct(x.url, x.text, x.nofollow)"))
    return explode_structs(work, firsts, keep=keep)


def _labelled(name: str, i: int, rule: Rule) -> Column:
    return F.transform(name, lambda x: F.struct(
        F.lit(i).alias("rule"),
        F.lit(rule.callback).cast("string").alias("callback"),
        F.lit(rule.follows).alias("follow"),
        x["url"].alias("url"),
        x["text"].alias("text"),
        x["nofollow"].alias("nofollow"),
    ))


class SeenUrls:
    """The URLs fetched so far, as a table bucketed and sorted by URL.

    A crawl round joins its new URLs with the buckets where they lie: only the new ones
    are shuffled, however many were seen before.  That holds while there are at least as
    many buckets as the session has shuffle partitions, the default; with fewer, Spark
    shuffles the store instead.  The table's files are in the shared folder, its name in
    the session's catalog.
    """

    def __init__(self, spark: SparkSession, *, buckets: int | None = None, path: str | None = None, name: str | None = None) -> None:
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.path = path or new_folder(spark, "seen")
        self.name = name or f"seen_{uuid.uuid4().hex}"
        self.spark = spark
        self.add(spark.createDataFrame([], "url string"))

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, urls: DataFrame) -> None:
        """Remember ``urls.url``; one file a bucket."""
        rows = urls.select("url").where("url is not null").repartition(self.buckets, "url")
        rows.write.bucketBy(self.buckets, "url").sortBy("url").mode("append").option("path", self.path).saveAsTable(self.name)

    def next_round(self, links: DataFrame) -> DataFrame:
        """Followed URLs not seen before, each once, written to the shared folder and from now on seen."""
        found = store_table(frontier(links, self.table()), "frontier")
        self.add(found)
        return found


def frontier(links: DataFrame, seen: DataFrame) -> DataFrame:
    """Followed URLs not yet fetched, each once.

    ``distinct`` collapses repeats before the shuffle, and its partitioning by
    URL is the one the anti-join needs.
    """
    wanted = links.where("follow") if "follow" in links.columns else links
    return wanted.select("url").distinct().join(seen.select("url"), "url", "left_anti")
