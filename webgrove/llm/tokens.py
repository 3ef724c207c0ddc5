"""Token counts from pre-token frequencies.

Documents are cut into pre-tokens, which no piece of the vocabulary can span.  A block
of neighbouring documents becomes, per hash bucket, its distinct pre-tokens with the
documents and frequencies they have there.  A shuffle brings all blocks' rows of a
bucket together; there every distinct pre-token is split into pieces once, its count is
joined to the frequencies, and each document's share goes back to its block to be
summed.  No document's ids are ever made, and a frequent pre-token is one entry per block.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgrove.llm.common import in_batches, rows_of, runs, shuffle_partitions, text_bytes

LIMIT = 4096
#: A block ends at so many distinct pre-tokens, documents (a 16-bit number each) or bytes of text.
BLOCK_WORDS, BLOCK_DOCS, BLOCK_BYTES = 60_000, 4096, 8 << 20
#: Pre-tokens whose counts a task remembers; beyond it the memory is emptied and counts are made again.
REMEMBERED = 1_000_000
BLANK = "▁"        # how the vocabulary writes a blank
_PRETOKEN = re.compile(f"{BLANK}+[^{BLANK}\n]*|[^{BLANK}\n]+")
_processors: dict[str, PieceCounter] = {}


def pretokens(text: str) -> list[str]:
    """Pre-tokens of a text, each with the blanks before it; line feeds (one piece each) are left out.

    Pieces hold blanks only at their beginning and never a line feed, and the model puts
    one blank before the text.  Empty strings may occur and have no pieces.
    """
    if not text:
        return []
    if text[0] == " " or "  " in text or BLANK in text:
        return _PRETOKEN.findall(BLANK + text.replace(" ", BLANK))
    return (BLANK + text.replace(" ", f" {BLANK}").replace("\n", " ")).split(" ")


class PieceCounter:
    def __init__(self, model_file: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.encode = SentencePieceProcessor(model_file=model_file).encode
        self.known: dict[str, int] = {}

    def learn(self, words: list[str]) -> None:
        """Count pieces of the words not seen before.

        The model adds a blank itself; a pre-token without one is encoded behind a line
        feed, which takes two pieces (blank and line feed) of its own.
        """
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        texts = [w[1:].replace(BLANK, " ") if w[0] == BLANK else "\n" + w for w in new]
        for word, ids in zip(new, self.encode(texts, num_threads=1) if new else (), strict=True):
            self.known[word] = (len(ids) if word != BLANK else 1) if word[0] == BLANK else len(ids) - 2


def counter(model_file: str) -> PieceCounter:
    found = _processors.get(model_file)
    if found is None:
        found = _processors[model_file] = PieceCounter(model_file)
    return found


class Block:
    """Documents and their pre-token frequencies until the block is full."""

    def __init__(self, most_docs: int) -> None:
        self.most_docs = most_docs
        self.words: defaultdict[str, int] = defaultdict(count().__next__)
        self.ids: list = []
        self.sizes: list[int] = []
        self.feeds: list[int] = []
        self.word_of: list[int] = []
        self.times: list[int] = []
        self.held: list[int] = []
        self.bytes = 0

    def add(self, doc_id: object, raw: bytes) -> bool:
        text = raw.decode("utf-8", "replace")
        found = Counter(pretokens(text))
        found.pop("", None)
        self.word_of.extend(map(self.words.__getitem__, found))
        self.times.extend(found.values())
        self.held.append(len(found))
        self.ids.append(doc_id)
        self.sizes.append(len(raw))
        self.feeds.append(text.count("\n"))
        self.bytes += len(raw)
        return len(self.words) >= BLOCK_WORDS or len(self.ids) >= self.most_docs or self.bytes >= BLOCK_BYTES

    def buckets(self, n_buckets: int) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
        """Per bucket: words, number of documents of each word, these documents, frequencies."""
        words = list(self.words)
        raw = [w.encode() for w in words]
        bucket = np.fromiter(map(zlib.crc32, raw), dtype=np.int64, count=len(raw)) % n_buckets
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        word = rank[np.array(self.word_of, dtype=np.int64)]
        doc = np.repeat(np.arange(len(self.ids), dtype=np.uint16), self.held)
        times = np.array(self.times, dtype=np.int64)
        over = (times - 1) // 255                       # frequencies are stored in bytes: larger ones take several entries
        if over.any():
            word, doc, times = np.repeat(word, over + 1), np.repeat(doc, over + 1), np.repeat(times, over + 1)
            last = np.cumsum(over + 1) - 1
            rest = times[last] - 255 * over
            times[:] = 255
            times[last] = rest
        by_word = np.argsort(word, kind="stable")
        doc, times = doc[by_word], times[by_word].astype(np.uint8)
        per_word = np.bincount(word, minlength=len(words))
        ends = np.concatenate(([0], np.cumsum(per_word)))
        edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=n_buckets))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            i, j = int(ends[a]), int(ends[b])
            yield (int(bucket[order[a]]), b"\n".join([raw[k] for k in order[a:b].tolist()]),
                   per_word[a:b].astype(np.uint32).tobytes(), doc[i:j].tobytes(), times[i:j].tobytes())


def count_tokens(docs: DataFrame, *, model_file: str, limit: int = LIMIT, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``, a row per document.

    ``n_tokens`` is what the vocabulary's library gives for the whole text without begin
    or end tokens.  Null and empty texts have none.  Repeated rows are rows of their own,
    null ids stay null, an empty table gives an empty one.  Only ``doc_id`` and ``text``
    are read, so other columns cannot clash.  ``model_file`` is a path every executor has.
    """
    n_buckets = shuffle_partitions(docs.sparkSession)
    id_type, id_name = docs.limit(0).select("doc_id").toArrow().schema.field(0).type, docs.schema["doc_id"].dataType.simpleString()
    block_rows = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("words", pa.binary()), ("per_word", pa.binary()), ("docs", pa.binary()),
                            ("times", pa.binary()), ("ids", pa.list_(id_type)), ("sizes", pa.list_(pa.int64())), ("feeds", pa.list_(pa.int64()))])
    share_rows = pa.schema([("block", pa.int64()), ("shares", pa.binary()), *(block_rows.field(i) for i in (6, 7, 8))])
    result = pa.schema([("doc_id", id_type), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << 32)

        def emit(block: Block) -> Iterator[tuple]:
            number = next(numbers)
            yield number % n_buckets, number, None, None, None, None, block.ids, block.sizes, block.feeds
            for bucket, *arrays in block.buckets(n_buckets):
                yield bucket, number, *arrays, None, None, None

        def rows() -> Iterator[tuple]:
            block = Block(block_docs)
            for doc_id, text in rows_of(batches, "doc_id", "text"):
                if block.add(doc_id, text_bytes(text)):
                    yield from emit(block)
                    block = Block(block_docs)
            if block.ids:
                yield from emit(block)

        yield from in_batches(rows(), block_rows)

    def to_shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = counter(model_file)

        def rows() -> Iterator[tuple]:
            for block, words, per_word, docs_, times, *own in rows_of(batches, "block", "words", "per_word", "docs", "times", "ids", "sizes", "feeds"):
                if words is None:
                    yield block, None, *own
                    continue
                found = words.decode().split("\n")
                pieces.learn(found)
                each = np.fromiter(map(pieces.known.__getitem__, found), dtype=np.int64, count=len(found))
                tokens = np.repeat(each, np.frombuffer(per_word, dtype=np.uint32)) * np.frombuffer(times, dtype=np.uint8)
                doc = np.frombuffer(docs_, dtype=np.uint16)
                sums = np.bincount(doc, weights=tokens)
                some = np.flatnonzero(sums)
                yield block, some.astype(np.uint16).tobytes() + sums[some].astype(np.uint32).tobytes(), None, None, None

        yield from in_batches(rows(), share_rows)

    def to_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for _, shares in runs(rows_of(batches, "block", "shares", "ids", "sizes", "feeds"), 1):
                total = np.zeros(1 << 16, dtype=np.int64)         # documents have 16-bit numbers in their block
                for _, packed, own_ids, own_sizes, own_feeds in shares:
                    if packed is None:
                        ids, sizes, feeds = own_ids, own_sizes, own_feeds
                    else:
                        n = len(packed) // 6
                        total[np.frombuffer(packed, np.uint16, n)] += np.frombuffer(packed, np.uint32, n, 2 * n) if n % 2 == 0 else np.frombuffer(packed[2 * n:], np.uint32)
                yield from zip(ids, sizes, (total[:len(ids)] + np.array(feeds)).tolist(), strict=True)

        yield from in_batches(rows(), result)

    blocks = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        to_blocks, f"bucket int, block long, words binary, per_word binary, docs binary, times binary, ids array<{id_name}>, sizes array<long>, feeds array<long>")
    shares = blocks.repartitionById(n_buckets, "bucket").mapInArrow(
        to_shares, f"block long, shares binary, ids array<{id_name}>, sizes array<long>, feeds array<long>")
    return (shares.repartition(n_buckets, "block").sortWithinPartitions("block")
            .mapInArrow(to_counts, f"doc_id {id_name}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > F.lit(limit)))
