"""Pages to rows: parse once, select many times."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webgrove.functions.page_tree import INT_FIELDS, PageColumns
from webgrove.functions.urls import safe_url
from webgrove.operators.rows import explode_structs
from webgrove.schema import NODES_TYPE, PIECES_TYPE, require

# Characters of markup handed back to Spark per Arrow batch.  Parsed rows are
# a few times larger than their markup; this bounds a task's memory whatever
# the page sizes are.  A single larger page is a batch of its own.
_BATCH_CHARS = 4 << 20

_ARROW_STRINGS = pa.list_(pa.string())
_ARROW_ATTRS = pa.map_(pa.string(), pa.string())


def parse_pages(
    pages: DataFrame,
    *,
    keep: Iterable[str] = ("text", "html"),
    carry: Iterable[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """``page_id, url, html`` -> one ``docs`` row per page.

    ``keep`` says which pieces to build: ``"text"`` (always built) and ``"html"``,
    which only outer-HTML reads need.  ``carry`` passes further columns through.
    Page filters belong *before* this call: Catalyst pushes them into the scan
    there, and cannot push them through the parse.  A null ``html`` gives a row
    without nodes; bytes that are no UTF-8 are replaced.  The scan's splits are the
    tasks; ``partitions`` deals pages out anew first, for files of few row groups.
    """
    keep = frozenset(keep)
    if unknown := keep - {"text", "html"}:
        raise ValueError(f"keep: unknown parts {sorted(unknown)}")
    return _parse(pages, markup="html" in keep, carry=tuple(carry), partitions=partitions)


def _parse(
    pages: DataFrame,
    *,
    markup: bool,
    carry: tuple[str, ...] = (),
    partitions: int | None = None,
    only_tags: Iterable[str] | None = None,
) -> DataFrame:
    require(pages, page_id=T.DataType, url=T.StringType, html=T.StringType)
    passed = pages.select("page_id", "url", *carry)
    fields = [*passed.schema.fields, T.StructField("base_url", T.StringType()), T.StructField("texts", PIECES_TYPE)]
    if markup:
        fields.append(T.StructField("markup", PIECES_TYPE))
    fields.append(T.StructField("nodes", NODES_TYPE))
    only = None if only_tags is None else frozenset(only_tags)
    names = [f.name for f in passed.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, chars, columns = 0, 0, PageColumns(markup=markup, only_tags=only)
            for row, source in enumerate(batch.column("html")):
                source = source.as_py()
                columns.add(source)
                chars += len(source or "")
                if chars >= _BATCH_CHARS:
                    yield _to_arrow(batch.slice(start, row + 1 - start), names, columns)
                    start, chars, columns = row + 1, 0, PageColumns(markup=markup, only_tags=only)
            if len(columns):
                yield _to_arrow(batch.slice(start), names, columns)

    source = pages.select(*names, "html").withColumns({c: F.make_valid_utf8(c) for c in ("url", "html")})
    return (source.repartition(partitions) if partitions else source).mapInArrow(run, T.StructType(fields))


def _to_arrow(pages: pa.RecordBatch, names: list[str], c: PageColumns) -> pa.RecordBatch:
    columns = {name: pages.column(name) for name in names}
    columns["base_url"] = pa.array(
        [_base_url(url, href) for url, href in zip(pages.column("url").to_pylist(), c.base_href, strict=True)],
        pa.string(),
    )
    columns["texts"] = _strings(c.text_offsets, c.texts)
    if c.want_markup:
        columns["markup"] = _strings(c.markup_offsets, c.markup)
    numbers = zip(*c.numbers, strict=True) if c.numbers else ((),) * len(INT_FIELDS)
    parts = dict(zip(INT_FIELDS, (pa.array(column, pa.int32()) for column in numbers), strict=True))
    attr_offsets = pa.array(c.attr_offsets, pa.int32())
    attr_names = pa.array(c.attr_names, pa.string())
    parts["tag"] = pa.array(c.tags, pa.string())
    parts["attrs"] = pa.MapArray.from_arrays(attr_offsets, attr_names, pa.array(c.attr_values, pa.string()))
    parts["attr_names"] = pa.ListArray.from_arrays(attr_offsets, attr_names)
    struct = pa.StructArray.from_arrays([parts[f] for f in _NODE_FIELDS], names=_NODE_FIELDS)
    columns["nodes"] = pa.ListArray.from_arrays(pa.array(c.node_offsets, pa.int32()), struct)
    return pa.RecordBatch.from_pydict(columns)


_NODE_FIELDS = [f.name for f in NODES_TYPE.elementType.fields]


def _strings(offsets: list[int], values: list[str]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.string()))


def _base_url(url: str | None, href: str | None) -> str | None:
    """The first ``<base href>`` resolved on the page URL, else the page URL."""
    if url is None or not href:
        return url
    try:
        return urljoin(url, safe_url(href.strip("\t\n\f\r ")))
    except ValueError:
        return url


def live(nodes: Column | str = "nodes") -> Column:
    """Elements that have not been dropped."""
    return F.filter(nodes, lambda n: n["tag"].isNotNull())


def nodes(docs: DataFrame) -> DataFrame:
    """One row per element, in document order within a page."""
    return explode_structs(docs, live(), keep=("page_id",)).drop("pos")
