"""Streams give the rows the batch gives."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.fixtures import LINKS, SHOP
from webgrove import classify_html, decompress, extract_links, extract_records, links_from_pages, parse_pages, to_pages
from webgrove.schema import RESPONSES_SCHEMA
from webgrove.sources.tables import (
    read_pages, read_responses, shared_folder, store_docs, stream_pages, stream_responses, write_stream, write_table,
)
from webgrove.operators.links import restrict_domains
from webgrove.streaming.jobs import (
    SkippedRows, crawl_tables, parse_responses, read_batches, stream_html, stream_links, stream_records, stream_tables, write_batch,
)


@pytest.fixture
def folder(spark, tmp_path):
    rows = [(i, f"http://e.com/{i}", LINKS if i % 2 else SHOP) for i in range(12)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    write_table(pages.repartition(4), str(tmp_path / "in"))
    return tmp_path


def test_links(spark, folder):
    source = stream_pages(spark, str(folder / "in"), files_per_trigger=1)
    stream_links(source, str(folder / "out"), checkpoint=str(folder / "state"), allow="/p").awaitTermination()
    batch = links_from_pages(read_pages(spark, str(folder / "in")), allow="/p")
    assert sorted(spark.read.parquet(str(folder / "out")).collect()) == sorted(batch.collect())


def test_records_and_restart(spark, folder):
    def run():
        stream_records(stream_pages(spark, str(folder / "in")), "div.product", {"name": "h2::text"}, str(folder / "out"),
                       checkpoint=str(folder / "state")).awaitTermination()
        return sorted(spark.read.parquet(str(folder / "out")).collect())

    batch = extract_records(parse_pages(read_pages(spark, str(folder / "in"))), "div.product", {"name": "h2::text"})
    assert run() == sorted(batch.collect())
    more = spark.createDataFrame([(99, "u", SHOP)], "page_id long, url string, html string")
    write_table(more, str(folder / "in"), mode="append")
    assert len(run()) == 18 + 3      # only the new page was read again


def test_routing(spark, tmp_path):
    rows = [("http://e.com/1", {"Content-Type": ["text/html"]}, b"<a href=/x>t", False, None),
            ("http://e.com/2", {"Content-Type": ["text/xml"]}, b"<a href=/x>t", False, None),
            ("http://e.com/3", {}, b"<html><a href=/y>t", True, "false")]
    df = spark.createDataFrame(rows, RESPONSES_SCHEMA)
    write_table(df, str(tmp_path / "in"))
    stream_html(stream_responses(spark, str(tmp_path / "in")), str(tmp_path / "out"), checkpoint=str(tmp_path / "state"),
                then=links_from_pages).awaitTermination()
    batch = links_from_pages(to_pages(classify_html(decompress(read_responses(spark, str(tmp_path / "in"))))))
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert got == batch.collect() and [r.url for r in got] == ["http://e.com/x"]


def test_stream_keeps_no_state(spark, folder):
    source = stream_pages(spark, str(folder / "in"))
    links = extract_links(parse_pages(source)).where(F.length("url") > 0)
    query = write_stream(links, str(folder / "out"), checkpoint=str(folder / "state"))
    query.awaitTermination()
    assert all(not p["stateOperators"] for p in query.recentProgress)


def test_shared_folder_comes_from_the_session():
    def session(value):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: value if key == "spark.checkpoint.dir" else default))

    assert shared_folder(session("hdfs://x/shared/")) == "hdfs://x/shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session(None))


def test_stored_docs_read_only_what_is_asked(spark, folder):
    stored = store_docs(parse_pages(read_pages(spark, str(folder / "in"))), str(folder / "docs"))
    tags = stored.select(F.explode("nodes.tag"))
    assert tags.count() > 0
    scan = next(line for line in tags._jdf.queryExecution().executedPlan().toString().splitlines() if "ReadSchema" in line)
    assert "tag" in scan.split("ReadSchema")[1] and "attrs" not in scan.split("ReadSchema")[1]


def arriving(spark, tmp_path, files=3):
    """Responses in several files: HTML, XML, text and broken ones."""
    rows = [(f"http://e.com/{i}", {"Content-Type": [("text/html", "text/xml", "text/plain")[i % 3]]}, (LINKS if i % 2 else SHOP).encode(), False, None)
            for i in range(12)] + [("http://e.com/null", {}, None, False, None)]
    df = spark.createDataFrame(rows, RESPONSES_SCHEMA)
    write_table(df.repartition(files), str(tmp_path / "in"))
    return spark.readStream.schema(RESPONSES_SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


TABLES = crawl_tables("div.product", {"name": "h2::text"}, allow="/")


def test_skipped_rows_per_batch(spark, tmp_path):
    skipped = SkippedRows(spark)
    try:
        query = stream_html(arriving(spark, tmp_path), str(tmp_path / "out"), checkpoint=str(tmp_path / "state"), skipped=skipped)
        query.awaitTermination()
        spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(skipped)
    counts = skipped.of(query)
    assert sum(counts.values()) == 9 and len(counts) == 3
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_several_tables_from_one_parse(spark, tmp_path):
    parses = spark.sparkContext.accumulator(0)

    def counted(batch):
        docs = parse_responses(batch)
        return docs.mapInArrow(lambda batches: (b for b in batches if parses.add(b.num_rows) is None), docs.schema)

    stream_tables(arriving(spark, tmp_path), TABLES, str(tmp_path / "out"), prepare=counted, checkpoint=str(tmp_path / "state")).awaitTermination()
    assert parses.value == 13           # every response once, for three tables
    batch = parse_responses(read_responses(spark, str(tmp_path / "in")))
    for name, table in TABLES.items():
        got = read_batches(spark, str(tmp_path / "out"), name)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, table(batch).select(*got.columns).collect())), name
    assert read_batches(spark, str(tmp_path / "out"), "skipped").count() == 9


def test_a_batch_that_runs_again_replaces_its_rows(spark, tmp_path):
    """A first try that failed between two tables, a replay of a whole batch, and other batches left alone."""
    out = str(tmp_path / "out")
    arriving(spark, tmp_path)
    rows = read_responses(spark, str(tmp_path / "in"))

    def broken(docs):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        write_batch(rows, 0, out, {"links": TABLES["links"], "records": broken}, parse_responses)
    for number in (0, 1, 0):
        write_batch(rows, number, out, TABLES, parse_responses)
    for name in TABLES:
        stored = spark.read.parquet(f"{out}/{name}")
        counts = {r["batch"]: r["count"] for r in stored.groupBy("batch").count().collect()}
        once = TABLES[name](parse_responses(rows)).count()
        assert counts == {0: once, 1: once}
    with pytest.raises(ValueError, match="one folder"):
        stream_tables(arriving(spark, tmp_path / "more"), {"a/b": broken}, out)


def test_domain_table_on_a_stream(spark, folder):
    domains = spark.createDataFrame([("example.org",), ("maps.example.org",), ("Example.org",)], "domain string")
    batch = links_from_pages(read_pages(spark, str(folder / "in")))
    for keep in (True, False):
        links = links_from_pages(stream_pages(spark, str(folder / "in"), files_per_trigger=1))
        query = write_stream(restrict_domains(links, domains, keep=keep), str(folder / f"out-{keep}"), checkpoint=str(folder / f"state-{keep}"))
        query.awaitTermination()
        assert all(not p["stateOperators"] for p in query.recentProgress)
        got = spark.read.parquet(str(folder / f"out-{keep}"))
        assert sorted(got.collect()) == sorted(restrict_domains(batch, domains, keep=keep).collect())
    assert 0 < spark.read.parquet(str(folder / "out-True")).count() < batch.count()
