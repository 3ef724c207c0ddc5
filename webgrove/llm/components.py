"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgrove.llm.common import shuffle_partitions, stored

_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("busy", pa.bool_())])
_TYPES = "a long, b long, busy boolean"
#: Links whose forest a task builds at a time.
FOREST_LINKS = 1 << 20


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Batches of rows sorted by ``a`` and ``b`` as arrays: a, b, busy, the least b of each row's a so far in its
    run, and which rows repeat the one before.  A run may go on over several batches."""
    last_a = last_b = least = None
    for batch in batches:
        a, b, busy = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "busy"))
        if not len(a):
            continue
        heads = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
        first = b[heads].copy()
        repeated = np.append(False, (a[1:] == a[:-1]) & (b[1:] == b[:-1]))
        if last_a is not None and a[0] == last_a:
            first[0], repeated[0] = least, b[0] == last_b
        mins = np.repeat(first, np.diff(np.append(heads, len(a))))
        last_a, last_b, least = a[-1], b[-1], mins[-1]
        yield a, b, busy.astype(bool), mins, repeated


def _table(a: np.ndarray, b: np.ndarray, busy: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(busy, pa.bool_())], schema=_LINKS)


def _large(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every node's greater neighbours go to its least one, or to itself.

    Rows are the links in both directions, sorted.  Where a node has a smaller neighbour and
    another one, the links are no stars yet.
    """
    for a, b, busy, mins, repeated in _runs(batches):
        target = np.minimum(a, mins)
        up = (b > a) & ~repeated
        yield _table(b[up], target[up], target[up] != a[up])


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every node and its smaller neighbours go to the least of them.  Rows are links from the greater node, sorted."""
    for a, b, busy, mins, repeated in _runs(batches):
        other = b != mins
        kept = ~repeated
        yield _table(np.where(other, b, a)[kept], mins[kept], (other | busy)[kept])


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task with as few as needed: each node to the least of its component there."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def grown() -> pa.RecordBatch:
        ends = np.concatenate([np.concatenate(pair) for pair in zip(*held, strict=True)])
        nodes, place = np.unique(ends, return_inverse=True)
        u, v = place[:len(place) // 2], place[len(place) // 2:]
        label = np.arange(len(nodes))
        while True:
            low = np.minimum(label[u], label[v])
            before = label.copy()
            np.minimum.at(label, label[u], low)
            np.minimum.at(label, label[v], low)
            label = label[label]
            if (label == before).all():
                break
        below = label != np.arange(len(nodes))
        return _table(nodes[below], nodes[label[below]], np.ones(int(below.sum()), dtype=bool))

    size = 0
    for batch in batches:
        held.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
        size += batch.num_rows
        if size >= FOREST_LINKS:
            yield grown()
            held, size = [], 0
    if size:
        yield grown()


def component_labels(links: DataFrame) -> DataFrame:
    """``node, label`` for links ``a, b`` (longs): the least node reachable; nodes that are
    their own label are left out.

    Each task first reduces its links to a forest.  Then a round is two shuffles of links
    sorted by node, through which they stream; no node's links are ever held together.
    Every round is written to the shared folder.
    """
    parts = shuffle_partitions(links.sparkSession)

    def star(rows: DataFrame, step: Callable) -> DataFrame:
        return rows.repartition(parts, "a").sortWithinPartitions("a", "b").mapInArrow(step, _TYPES)

    busy = F.lit(True).alias("busy")
    forest = links.select("a", "b").where("a != b").mapInArrow(_forest, _TYPES)
    state = stored(forest.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), busy), "links")
    while state.where("busy").limit(1).count():
        both = state.select(F.inline(F.array(F.struct("a", "b", "busy"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "busy"))))
        state = stored(star(star(both, _large), _small), "links")
    return state.select(F.col("a").alias("node"), F.col("b").alias("label")).distinct()
