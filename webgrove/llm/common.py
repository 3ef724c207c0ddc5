"""Reading, shared work folders and word splitting for the training-data operators."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webgrove.functions.udf import give_back
from webgrove.session import configure
from webgrove.sources.tables import new_folder, store_table

#: ASCII white space, the separators of the contract's words.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one of the given tables; only they are read."""
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared one (``spark.checkpoint.dir``)."""
    return new_folder(configure(spark), name)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a new shared folder and read back: computed once, and it survives lost executors."""
    configure(df.sparkSession)
    return store_table(df, name)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def in_batches(rows: Iterator[tuple], schema: pa.Schema, *, max_rows: int = 4096, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Row tuples as Arrow batches, bounded by rows and by bytes of their strings; behind the last the worker gives memory back."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, (str, bytes)))
        if len(held) >= max_rows or size >= max_bytes:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)
        held = []
    give_back()


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def rows_of(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """The named columns of Arrow batches, row by row."""
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)


def text_bytes(value: bytes | str | None) -> bytes:
    return b"" if value is None else value if isinstance(value, bytes) else value.encode("utf-8", "surrogatepass")


def runs(rows: Iterator[tuple], width: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Neighbouring rows with equal first ``width`` values, one run after the other."""
    return itertools.groupby(rows, key=lambda row: row[:width])
