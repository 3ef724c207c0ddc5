"""Similarity join on word shingles with R-trees of group-count vectors.

A text's set is its distinct five-word shingles, as 64-bit hashes.  Texts with equal
sets are one node.  Nodes meet in blocks: each is sent to the blocks of its smallest
hashes, as many as a pair of the wanted similarity needs to meet (``block_keys``).
In a block, hashed groups of shingles give every node a vector of group counts; the
vectors are indexed by an R-tree whose boxes bound the overlap from above by summed
coordinate minima.  Pairs that survive the bound are verified on the whole sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgrove.llm.common import in_batches, rows_of, runs, shuffle_partitions, stored, text_bytes
from webgrove.llm.components import component_labels

WORDS = 5
PERCENT = 75
#: Smallest hashes by which nodes meet.  Two sets of similarity 0.75 share none of the
#: first 30 hashes of their union with a chance of 0.25**30 < 1e-18, less than that of
#: a collision of the 64-bit hashes.  Small sets need fewer, and with these no chance is left.
KEYS = 30
#: Nodes compared in one task at a time; larger blocks are dealt out as pairs of tiles.
TILE = 4096
LEAF = 32
#: Classes whose last member a position meets before it searches.
LATELY = 8
_NO_CLASS = 1 << 62
#: At most so many member rows (three longs each) are broadcast to the texts.
SENT_ROWS = 1_000_000
REMEMBERED = 400_000
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
#: Fixed odd multipliers that tell a word's place in its shingle, and a mixer's constants.
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_word_hashes: dict[bytes, int] = {}


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_LOWER).split()


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; of the whole sequence if it is shorter."""
    words = words_of(text)
    known = _word_hashes
    if len(known) > REMEMBERED:
        known.clear()
    for word in words:
        if word not in known:
            known[word] = xxhash.xxh3_64_intdigest(word)
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b"\n".join(words), seed=len(words))] if words else [], dtype=np.uint64)
    codes = np.array([known[w] for w in words], dtype=np.uint64)
    n = len(codes) - WORDS + 1
    total = codes[:n] * _PLACES[0]
    for i in range(1, WORDS):
        total += codes[i:i + n] * _PLACES[i]
    total ^= total >> np.uint64(30)
    total *= _MIX_1
    total ^= total >> np.uint64(27)
    total *= _MIX_2
    total ^= total >> np.uint64(31)
    return np.unique(total)


def needed(size_a: int | np.ndarray, size_b: int | np.ndarray, percent: int) -> int | np.ndarray:
    """Least overlap of a linked pair: 100 |A and B| >= percent |A or B|."""
    return -(-percent * (size_a + size_b) // (100 + percent))


def block_keys(hashes: np.ndarray, percent: int) -> np.ndarray:
    """A linked set lacks so few of these hashes that one of the first, in any fixed order, is common."""
    prefix = len(hashes) - ceil(Fraction(percent, 100) * len(hashes)) + 1
    return hashes[:min(KEYS, prefix)] if len(hashes) else hashes


def groups_of(size: int) -> int:
    """Coordinates for a set of this size: a power of two, four shingles a group or fewer."""
    return max(16, 1 << max(0, -(-size // 4) - 1).bit_length())


def count_vector(hashes: np.ndarray, groups: int) -> np.ndarray:
    return np.bincount((hashes >> np.uint64(20)).astype(np.int64) & (groups - 1), minlength=groups)


def packed_vector(hashes: np.ndarray) -> bytes:
    counts = count_vector(hashes, groups_of(len(hashes)))
    return counts.astype(np.uint8 if counts.max(initial=0) < 256 else np.uint32).tobytes()


def unpacked_vector(data: bytes, size: int) -> np.ndarray:
    groups = groups_of(size)
    return np.frombuffer(data, dtype=np.uint8 if len(data) == groups else np.uint32).astype(np.uint32)


def folded(vectors: np.ndarray, groups: int) -> np.ndarray:
    """The vectors over fewer groups: hashes keep their low bits, so halves add up."""
    while vectors.shape[-1] > groups:
        half = vectors.shape[-1] // 2
        vectors = vectors[..., :half] + vectors[..., half:]
    return vectors


class CountTree:
    """R-tree over count vectors of one length, packed in the order of set size.

    A box keeps the largest count of every coordinate and the smallest set size below
    it.  ``sum(min(query, box))`` bounds the overlap with any point in the box.  A box also
    keeps the least and greatest class of the points put in so far, so a search goes past
    boxes that hold nothing but the searcher's own class.
    """

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray) -> None:
        self.vectors, self.sizes = vectors, sizes
        self.classes = np.full(len(sizes), -1)              # of points put in; -1 for the others
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        upper, least = vectors, sizes
        while len(upper) > LEAF:
            at = np.arange(0, len(upper), LEAF)
            upper, least = np.maximum.reduceat(upper, at, axis=0), np.minimum.reduceat(least, at)
            self.levels.append((upper, least))
        self.low = [np.full(len(least), _NO_CLASS) for _, least in self.levels]
        self.high = [np.full(len(least), -1) for _, least in self.levels]

    def put(self, at: int, class_: int) -> None:
        self.classes[at] = class_
        for low, high in zip(self.low, self.high, strict=True):
            at //= LEAF
            low[at], high[at] = min(low[at], class_), max(high[at], class_)

    def merge(self, old: int, new: int) -> None:
        """Points of one class become members of another."""
        held = self.classes == old
        if not held.any():
            return
        self.classes[held] = new
        low, high = np.where(self.classes < 0, _NO_CLASS, self.classes), self.classes
        for i in range(len(self.levels)):
            at = np.arange(0, len(low), LEAF)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.low[i], self.high[i] = low, high

    def search(self, query: np.ndarray, size: int, end: int, percent: int, own: int = -2) -> np.ndarray:
        """Points before ``end`` in other classes than ``own`` whose bounded overlap with the query reaches the needed one."""
        at = np.arange(len(self.levels[-1][0]) if self.levels else end)
        for i in range(len(self.levels) - 1, -1, -1):
            upper, least = self.levels[i]
            if own >= -1:
                at = at[(self.high[i][at] >= 0) & ((self.low[i][at] != own) | (self.high[i][at] != own))]
            bound = np.minimum(upper[at], query).sum(axis=1)
            at = at[bound >= needed(least[at], size, percent)]
            at = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
            at = at[at < (len(self.levels[i - 1][0]) if i else len(self.vectors))]
        at = at[at < end]
        at = at[(self.classes[at] != own) & (100 * self.sizes[at] >= percent * size)]
        bound = np.minimum(self.vectors[at], query).sum(axis=1)
        return at[bound >= needed(self.sizes[at], size, percent)]


def classes_in(vectors: list[np.ndarray], sizes: list[int], percent: int, linked=None) -> np.ndarray:
    """Least position of each position's class (sizes ascending): positions are joined where the bound, and
    ``linked(i, j)`` if given, holds.

    A position first meets the last members of the classes lately grown; once it has a
    class, boxes of that class alone are passed over.  So a group of copies costs about one
    comparison a member, and a pair is looked at only while it lies in different classes.
    """
    n = len(sizes)
    size = np.array(sizes, dtype=np.int64)
    class_of = np.arange(n)
    widths = np.array([len(v) for v in vectors])
    trees = {}
    for width in np.unique(widths).tolist():
        members = np.flatnonzero(widths == width)
        trees[width] = members, CountTree(np.array([vectors[i] for i in members], dtype=np.uint32), size[members])
    lately: list[int] = []                                  # a member of each class grown lately, the last one first

    def join(i: int, j: int) -> None:
        """Position ``i``, not in any tree yet, takes the class of ``j`` along."""
        new, old = sorted((int(class_of[i]), int(class_of[j])))
        class_of[class_of == old] = new
        if old == i:                        # of no other position, hence in no tree
            return
        for _, tree in trees.values():
            tree.merge(old, new)

    def near(i: int, j: int) -> bool:
        if 100 * sizes[j] < percent * sizes[i]:
            return False
        width = min(len(vectors[i]), len(vectors[j]))
        bound = np.minimum(folded(vectors[i], width), folded(vectors[j], width)).sum()
        return bool(bound >= needed(sizes[j], sizes[i], percent)) and (linked is None or linked(i, j))

    for i in range(n):
        if i > 4 * LEAF:                    # one search over a few points costs less than these meetings
            for j in lately:
                if near(i, j):
                    class_of[i] = class_of[j]
                    break
        for width, (members, tree) in trees.items():
            before = int(np.searchsorted(members, i))
            if not before or width > widths[i] or 100 * int(tree.sizes[before - 1]) < percent * sizes[i]:
                continue
            query = folded(vectors[i], width)
            found = members[tree.search(query, sizes[i], before, percent, int(class_of[i]))]
            if linked is None:
                for class_ in set(class_of[found].tolist()):
                    join(i, class_)
                continue
            while len(found := found[class_of[found] != class_of[i]]):
                j, found = int(found[-1]), found[:-1]
                if linked(i, j):
                    join(i, j)
        own = int(class_of[i])
        members, tree = trees[int(widths[i])]
        tree.put(int(np.searchsorted(members, i)), own)
        lately = [i, *(j for j in lately if class_of[j] != own)][:LATELY]
    return class_of


def _digest() -> Column:
    """Of a text without an id."""
    return F.when(F.isnull("doc_id"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


def _describe(docs: DataFrame, percent: int) -> DataFrame:
    """``doc_id, digest, n_shingles, node, keys, vector``; nodes are 64-bit digests of whole sets, null
    for empty ones.  ``digest``, of the text, stands in for a null id and is null elsewhere."""
    id_type, id_name = docs.limit(0).select("doc_id").toArrow().schema.field(0).type, docs.schema["doc_id"].dataType.simpleString()
    schema = pa.schema([("doc_id", id_type), ("digest", pa.binary()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("keys", pa.list_(pa.int64())), ("vector", pa.binary())])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for doc_id, digest, text in rows_of(batches, "doc_id", "digest", "text"):
                hashes = shingles(text_bytes(text))
                if len(hashes):
                    yield doc_id, digest, len(hashes), _node(hashes), block_keys(hashes, percent).view(np.int64), packed_vector(hashes)
                else:
                    yield doc_id, digest, 0, None, None, None

        yield from in_batches(rows(), schema)

    return docs.select("doc_id", _digest().alias("digest"), F.col("text").cast("binary").alias("text")).mapInArrow(
        describe, f"doc_id {id_name}, digest binary, n_shingles long, node long, keys array<long>, vector binary")


def _node(hashes: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def _tiled(rows: DataFrame, key: str, sizes: DataFrame, tile: int) -> DataFrame:
    """Rows with ``pair``: every pair of tiles of a block, so that any two rows of the block
    meet in one of its pairs, and no pair holds much more than two tiles.

    Only the few blocks of more than a tile are listed, so the rows of all others need
    not be shuffled for this.
    """
    large = stored(sizes.where(F.col("n") > tile).select(key, F.ceil(F.col("n") / tile).cast("int").alias("_tiles")), "large")
    own = F.pmod(F.xxhash64("node", F.lit(1)), F.col("_tiles")).cast("int")
    partners = F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1))
    return (rows.join(large, key, "left").withColumn("_tiles", F.coalesce("_tiles", F.lit(1))).withColumn("_own", own).withColumn("_other", partners)
            .withColumn("pair", F.greatest("_own", "_other").cast("long") * F.lit(1 << 31) + F.least("_own", "_other"))
            .drop("_own", "_other", "_tiles"))


def _candidates(nodes: DataFrame, percent: int, tile: int) -> DataFrame:
    """Links ``a, b`` that join, within every block, what the bound does not keep apart."""
    spark = nodes.sparkSession
    parts = shuffle_partitions(spark)
    members = nodes.select(F.explode("keys").alias("key"), "node", "n_shingles")
    shared = members.repartition(parts, "key").sortWithinPartitions("key", "n_shingles", "node").mapInArrow(
        _shared(percent), "key long, node long, n_shingles long")
    shared = stored(shared, "shared")
    sizes = shared.groupBy("key").agg(F.count("*").alias("n"))
    rows = _tiled(shared, "key", sizes, tile).join(nodes.select("node", "vector"), "node")
    links = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for _, block in runs(rows_of(batches, "key", "pair", "n_shingles", "node", "vector"), 2):
                members = list(block)
                sizes = [m[2] for m in members]
                roots = classes_in([unpacked_vector(m[4], m[2]) for m in members], sizes, percent)
                yield from ((members[i][3], members[r][3]) for i, r in enumerate(roots.tolist()) if i != r)

        yield from in_batches(found(), links)

    return (rows.repartition(parts, "key", "pair").sortWithinPartitions("key", "pair", "n_shingles", "node")
            .mapInArrow(bound, "a long, b long").distinct())


def _shared(percent: int):
    """Members of a block that have a neighbour of a fitting size there; one row is held back at a time."""
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("n_shingles", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            last, told = (None, None, None), True
            for row in rows_of(batches, "key", "node", "n_shingles"):
                fits = row[0] == last[0] and 100 * last[2] >= percent * row[2]
                if fits and not told:
                    yield last
                if fits:
                    yield row
                last, told = row, fits

        yield from in_batches(rows(), schema)

    return run


def _verified(docs: DataFrame, members: DataFrame, percent: int, tile: int) -> DataFrame:
    """Links ``a, b`` of nodes whose whole sets are as similar as wanted, enough to join each class.

    ``members``: ``doc_id, digest, node, block``, one document for every node to look at, by its
    id or, if only documents without one have that set, by the digest of its text.
    """
    parts = shuffle_partitions(docs.sparkSession)
    sets = pa.schema([("node", pa.int64()), ("block", pa.int64()), ("hashes", pa.binary()), ("size", pa.int64())])
    links = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            seen: set[int] = set()                  # a task sends each node once, however often its row is repeated
            for node, block, text in rows_of(batches, "node", "block", "text"):
                if node in seen:
                    continue
                hashes = shingles(text_bytes(text))
                if _node(hashes) == node:           # a repeated id may belong to another text
                    seen.add(node)
                    yield node, block, hashes.tobytes(), len(hashes)

        yield from in_batches(rows(), sets)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for _, block in runs(rows_of(batches, "block", "pair", "size", "node", "hashes"), 2):
                rows = {row[3]: row for row in block}
                nodes, hashes = list(rows), [np.frombuffer(row[4], dtype=np.uint64) for row in rows.values()]

                def linked(i: int, j: int) -> bool:
                    common = len(np.intersect1d(hashes[i], hashes[j], assume_unique=True))
                    return 100 * common >= percent * (len(hashes[i]) + len(hashes[j]) - common)

                vectors = [count_vector(h, groups_of(len(h))) for h in hashes]
                roots = classes_in(vectors, [len(h) for h in hashes], percent, linked)
                yield from ((nodes[i], nodes[r]) for i, r in enumerate(roots.tolist()) if i != r)

        yield from in_batches(found(), links)

    # few documents are members: behind a check of their number they go to the texts, beyond it both are shuffled
    few = members.count() <= SENT_ROWS
    def texts_by(key: str, rows: DataFrame, wanted: DataFrame) -> DataFrame:
        wanted = wanted.select(key, "node", "block")
        return rows.join(F.broadcast(wanted) if few else wanted, key).select("node", "block", "text")

    whole = F.col("text").cast("binary").alias("text")
    texts = texts_by("doc_id", docs.select("doc_id", whole), members.where("doc_id is not null")).unionByName(
        texts_by("digest", docs.where("doc_id is null").select(_digest().alias("digest"), whole), members.where("doc_id is null")))
    filled = texts.mapInArrow(to_sets, "node long, block long, hashes binary, size long")
    sizes = members.groupBy("block").agg(F.count("*").alias("n"))
    return (_tiled(filled, "block", sizes, tile).repartition(parts, "block", "pair")
            .sortWithinPartitions("block", "pair", "size", "node").mapInArrow(verify, "a long, b long"))


def jaccard_components(docs: DataFrame, *, percent: int = PERCENT, tile: int = TILE) -> DataFrame:
    """``doc_id, n_shingles, component_id``, a row per document.

    Two documents are linked when ``100 |A and B| >= percent |A or B|``; ``component_id``
    is the least ``doc_id`` that links reach.  Texts without words (null, empty, blank)
    have no shingles and are their own component.  Repeated rows are in one component.
    Null ids sort behind all others and are least only among themselves.  An empty
    table gives an empty one.  Only ``doc_id`` and ``text`` are read.
    """
    described = stored(_describe(docs, percent), "described")
    nodes = stored(described.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.min("digest").alias("digest"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"), F.first("vector").alias("vector")), "nodes")
    near = component_labels(_candidates(nodes, percent, tile))
    blocks = near.select("node", F.col("label").alias("block")).unionByName(near.select(F.col("label").alias("node"), F.col("label").alias("block")).distinct())
    members = stored(nodes.select("node", "doc_id", "digest").join(blocks, "node").select("doc_id", "digest", "node", "block"), "members")
    labels = component_labels(_verified(docs, members, percent, tile))
    placed = nodes.select("node", F.col("doc_id").alias("_least")).join(labels, "node", "left").select(
        "node", F.coalesce("label", "node").alias("label"), "_least")
    least = placed.groupBy("label").agg(F.min("_least").alias("component_id"))
    of_node = placed.join(least, "label").select("node", "component_id")
    return described.select("doc_id", "n_shingles", "node").join(of_node, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
