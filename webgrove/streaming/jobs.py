"""Stream jobs.  Every operator used is narrow and stateless, so a stream runs the
batch functions as they are, in append mode or batch by batch into several tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from webgrove.operators.links import extract_links, links_from_pages
from webgrove.operators.parse import parse_pages
from webgrove.operators.routing import classify_html, decompress, html_only, to_pages, with_text
from webgrove.plans.records import FieldLike, extract_records
from webgrove.sources.tables import shared_folder, write_stream


def stream_links(pages: DataFrame, path: str, *, checkpoint: str | None = None, **options) -> StreamingQuery:
    """Links of arriving pages, appended to ``path``."""
    return write_stream(links_from_pages(pages, **options), path, checkpoint=checkpoint)


def stream_records(
    pages: DataFrame, container: str, fields: Mapping[str, FieldLike], path: str, *, checkpoint: str | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Records of arriving pages, appended to ``path``."""
    return write_stream(extract_records(parse_pages(pages, partitions=partitions), container, fields), path, checkpoint=checkpoint)


def stream_html(
    responses: DataFrame, path: str, *, default: bool | str | None = True, checkpoint: str | None = None,
    then: Callable[[DataFrame], DataFrame] | None = None, skipped: SkippedRows | None = None,
) -> StreamingQuery:
    """Arriving responses that are HTML, as pages; ``then`` maps them on, and ``skipped`` learns how many others each batch had."""
    classified = classify_html(decompress(responses), default=default)
    pages = to_pages(html_only(classified, skipped.name) if skipped else classified)
    return write_stream(then(pages) if then else pages, path, checkpoint=checkpoint)


class SkippedRows(StreamingQueryListener):
    """Rows that are no HTML, counted per micro-batch of the streams that observe them under ``name``.

    ``counts`` maps a query's id and a batch's number to its count; a batch that runs again
    after a restart has the same key, so it counts once.
    """

    def __init__(self, spark: SparkSession, name: str = "skipped_rows") -> None:
        self.name = name
        self.counts: dict[tuple[str, int], int] = {}
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        observed = event.progress.observedMetrics
        if self.name in observed:
            self.counts[str(event.progress.id), event.progress.batchId] = observed[self.name]["skipped"]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, query: StreamingQuery) -> dict[int, int]:
        """Counts of one query by batch."""
        return {batch: n for (id_, batch), n in self.counts.items() if id_ == str(query.id)}


TableFunction = Callable[[DataFrame], DataFrame]


def write_batch(batch: DataFrame, number: int, path: str, tables: Mapping[str, TableFunction], prepare: TableFunction | None = None) -> None:
    """Write every table of one micro-batch to ``path/<table>/batch=<number>``, replacing what an earlier try left there.

    ``prepare`` (such as a parse) is worked out once for all tables and kept on the
    executors' disks meanwhile; what a lost executor held is worked out again.
    """
    rows = prepare(batch) if prepare else batch
    rows = rows.persist(StorageLevel.DISK_ONLY)
    try:
        for name, table in tables.items():
            table(rows).write.mode("overwrite").parquet(f"{path}/{name}/batch={number}")
    finally:
        rows.unpersist()


def stream_tables(
    source: DataFrame, tables: Mapping[str, TableFunction], path: str, *, prepare: TableFunction | None = None, checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Several tables from one stream, each batch prepared once (``write_batch``).

    A batch that runs again, after a failure between its tables or before its commit,
    replaces its own folders, so every table holds every row once.  ``read_batches`` reads a
    table back.
    """
    for name in tables:
        if not name or "/" in name:
            raise ValueError(f"a table's name is one folder, not {name!r}")
    checkpoint = checkpoint or f"{shared_folder(source.sparkSession)}/{path.strip('/').replace('/', '_')}"
    writer = source.writeStream.foreachBatch(lambda batch, number: write_batch(batch, number, path, tables, prepare)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_batches(spark: SparkSession, path: str, name: str) -> DataFrame:
    """All rows of a table that ``stream_tables`` wrote."""
    return spark.read.parquet(f"{path}/{name}").drop("batch")


def parse_responses(responses: DataFrame, *, default: bool | str | None = True) -> DataFrame:
    """``docs`` rows of all responses, with ``kind`` and ``is_html``; those that are no HTML have no nodes."""
    classified = classify_html(decompress(responses), default=default)
    body = F.when(F.col("is_html"), F.col("body"))
    pages = with_text(classified.withColumn("body", body)).withColumn("page_id", F.col("page_id") if "page_id" in classified.columns else F.col("url"))
    return parse_pages(pages.select("page_id", "url", "html", "kind", "is_html"), keep=("text",), carry=("kind", "is_html"))


def crawl_tables(container: str, fields: Mapping[str, FieldLike], **options) -> dict[str, TableFunction]:
    """Tables for ``stream_tables`` over ``parse_responses``: ``links``, ``records`` and the ``skipped`` rows, which are no HTML."""
    return {
        "links": lambda docs: extract_links(docs.where("is_html"), **options),
        "records": lambda docs: extract_records(docs.where("is_html"), container, fields),
        "skipped": lambda docs: docs.where("not is_html").select("page_id", "url", "kind"),
    }
