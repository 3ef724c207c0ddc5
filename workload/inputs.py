"""Inputs that Spark derives from the ``pages`` table.

``responses`` gives pages headers, charsets and compression chosen by what their
URL looks like; ``link_pages`` adds links of many forms to each page's own.
"""

from __future__ import annotations

import gzip

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import workload
from webgrove import configure, parse_pages
from webgrove.functions.udf import task_udf
from webgrove.session import ship
from webgrove.sources.tables import read_pages


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(configure(spark), workload)
    return read_pages(spark, f"{sf_dir}/pages.parquet")


def docs(spark: SparkSession, sf_dir: str, *, html: bool = False) -> DataFrame:
    return parse_pages(pages(spark, sf_dir), keep=("text", "html") if html else ("text",), partitions=partitions(spark))


def partitions(spark: SparkSession) -> int:
    """The given tables are files of one row group, hence one task, unless dealt out."""
    return spark.sparkContext.defaultParallelism


def link_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_pages_of(pages(spark, sf_dir))


def link_pages_of(pages: DataFrame) -> DataFrame:
    url = F.regexp_replace("url", "&", "&amp;")
    bare = F.regexp_replace("url", "[?#].*", "")
    added = F.concat(
        F.lit('<a href="'), url, F.lit('">as is</a><a rel="noopener,nofollow" href="../up?b=2&amp;a=1#frag">up</a>'),
        F.lit('<a href="'), bare, F.lit('/report.PDF">file</a><a href="mailto:x@example.com">mail</a><a href>none</a>'),
        F.lit('<a href="  '), url, F.lit('\n">padded</a><area href="'), bare, F.lit('?a=1&amp;b=2">'),
        F.lit('<link href="/style.css" rel="stylesheet"><a href="http://[bad">bad</a><a href="" data-url="/data/'),
        F.col("page_id"), F.lit('">self</a><a href="../up?a=1&amp;b=2">twin</a>'),
    )
    return pages.withColumn("html", F.replace("html", F.lit("</ul>"), F.concat(added, F.lit("</ul>"))))


@task_udf(T.BinaryType())
def _gzip(bodies: pa.Array) -> pa.Array:
    return pa.array([None if b is None else gzip.compress(b, 1) for b in bodies.to_pylist()], pa.binary())


def responses(spark: SparkSession, sf_dir: str, *, compressed: bool = False) -> DataFrame:
    return as_responses(pages(spark, sf_dir), compressed=compressed)


def as_responses(pages: DataFrame, *, compressed: bool = False) -> DataFrame:
    """``www.`` hosts say XML, ``m.`` hosts say XHTML with a charset (an odd one with a query), ``blog.`` hosts
    say nothing; other hosts say plain text with https and HTML (UTF-16) with http."""
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    utf16 = ~host.rlike("^(www|m|blog)[.]") & F.col("url").startswith("http://")
    content_type = (
        F.when(host.startswith("www."), "application/xml")
        .when(host.startswith("m.") & F.col("url").contains("?"), "application/xhtml+xml; charset=unicode_escape")     # no charset of the web
        .when(host.startswith("m."), "Application/XHTML+xml; charset=utf-8")
        .when(host.startswith("blog."), F.lit(None))
        .when(F.col("url").startswith("https://"), "text/plain")
        .otherwise("text/html; charset=utf-16")
    )
    headers = F.when(content_type.isNotNull(), F.create_map(F.lit("Content-Type"), F.array(content_type))).otherwise(
        F.create_map().cast("map<string,array<string>>"))
    body = F.when(utf16, F.encode("html", "UTF-16")).otherwise(F.encode("html", "UTF-8"))
    out = pages.select("page_id", "url", headers.alias("headers"), body.alias("body"))
    if compressed:
        encoding = F.create_map(F.lit("content-encoding"), F.array(F.lit("gzip")))
        out = out.withColumns({"body": _gzip("body"), "headers": F.map_concat("headers", encoding)})
    return out
