"""Packing of tokenised documents into fixed-length sequences.

A document's ids are cut into pieces of ``seq_len``; what remains of it is packed by
first-fit decreasing.  Groups of documents are drawn by a hash and packed each on its
own, so the work spreads over any number of tasks.  Within a group a tournament tree
over the bins' free room finds the first bin that fits in logarithmic time.
"""

from __future__ import annotations

import array
import base64
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgrove.llm.common import in_batches, rows_of, shuffle_partitions, text_bytes

SEQ_LEN = 1024
END_ID = 0
GROUP_DOCS = 4096
GROUP_TOKENS = 8 << 20
#: Chunks whose ids a task remembers; the memory is emptied beyond it (about 60 MB) and when the task ends.
REMEMBERED = 400_000
SPECIAL = "<|endoftext|>"
_SPECIAL = SPECIAL.encode()
#: White space other than single blanks and line feeds, and the marker itself.
_RARE = re.compile("[\\x00\\t\\x0b-\\r\\x1c-\\x1f\\x85\\xa0\\u1680\\u180e\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
_tokenizers: dict[tuple[str, str], ChunkIds] = {}


class ChunkIds:
    """Ids of whole texts, worked out once per distinct chunk between white space.

    The vocabulary's split pattern always begins a token at a blank before a visible
    character and on both sides of a lone line feed, so ids of such chunks, put
    together, are the ids of the text.  Texts with other white space, and chunks that
    hold the special string, go to the reference tokenizer as they are.
    """

    def __init__(self, json_file: str, rank_file: str) -> None:
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.exact = Tokenizer.from_file(json_file)
        self.ranks = tiktoken.Encoding("chunks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return array.array("I", self.exact.encode(text, add_special_tokens=False).ids).tobytes()

    def chunk(self, key: str) -> bytes:
        plain = key if key == "\n" else key[1:] if key[:1] == "\0" else " " + key
        if not plain:
            return b""
        if SPECIAL in plain:
            return self.whole(plain)
        return array.array("I", self.ranks.encode_ordinary(plain)).tobytes()

    def packed(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text."""
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or _RARE.search(text):
            return self.whole(text)
        known = self.known
        keys = ("\0" + text.replace("\n", " \n \0")).split(" ")
        try:
            return b"".join([known[k] for k in keys])
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for key in keys:
                if key not in known:
                    known[key] = self.chunk(key)
            return b"".join([known[k] for k in keys])


def tokenizer(json_file: str, rank_file: str) -> ChunkIds:
    """One per Python worker, kept between its tasks."""
    found = _tokenizers.get((json_file, rank_file))
    if found is None:
        found = _tokenizers[json_file, rank_file] = ChunkIds(json_file, rank_file)
    return found


class FreeRoom:
    """Tournament tree: every inner node holds the largest free room below it."""

    def __init__(self, bins: int, room: int) -> None:
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [room] * (2 * self.leaves)

    def place(self, need: int) -> tuple[int, int]:
        """Put ``need`` into the first bin with room for it; the bin and its room before."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < need:
                node += 1
        before = room[node]
        room[node] = before - need
        bin_, node = node - self.leaves, node // 2
        while node:
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
            node //= 2
        return bin_, before


def first_fit_decreasing(lengths: list[int], seq_len: int) -> list[tuple[int, int]]:
    """Bin and offset of every length, longest first (ties: first given first)."""
    tree = FreeRoom(len(lengths), seq_len)
    out: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda j: -lengths[j]):
        bin_, before = tree.place(lengths[i])
        out[i] = bin_, seq_len - before
    return out


def pack_group(docs: list[tuple], seq_len: int, next_id: int) -> Iterator[tuple]:
    """``(document, start, length, sequence, offset)`` for documents ``(n_tokens, ...)`` of one group."""
    for doc in docs:
        for start in range(0, doc[0] - seq_len + 1, seq_len):
            yield doc, start, seq_len, next_id, 0
            next_id += 1
    rests = [doc for doc in docs if doc[0] % seq_len]
    for doc, (bin_, offset) in zip(rests, first_fit_decreasing([d[0] % seq_len for d in rests], seq_len), strict=True):
        rest = doc[0] % seq_len
        yield doc, doc[0] - rest, rest, next_id + bin_, offset


def _groups(rows: Iterable[tuple]) -> Iterator[list[tuple]]:
    held, tokens = [], 0
    for row in rows:
        held.append(row)
        tokens += row[0]
        if len(held) >= GROUP_DOCS or tokens >= GROUP_TOKENS:
            yield held
            held, tokens = [], 0
    if held:
        yield held


def pack_documents(
    docs: DataFrame, *, json_file: str, rank_file: str, seq_len: int = SEQ_LEN, seed: int = 17, keep_ids: bool = False
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and ``ids``), a row per piece.

    A document is its text's ids and an end id; a null or empty text is the end id alone.
    Every row of ``docs`` is packed, also repeated rows and null ids; an empty table gives
    an empty one.  Sequence ids are unique, not gapless.  Only ``doc_id`` and ``text`` are
    read, so other columns cannot clash.  ``json_file`` and ``rank_file`` hold the same
    byte-level vocabulary for the two libraries, at paths that every executor has.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    light = pa.schema([("doc_id", docs.limit(0).select("doc_id").toArrow().schema.field(0).type), ("n_tokens", pa.int64()),
                       ("checksums", pa.binary()), ("packed", pa.binary())])
    pieces = pa.schema([light.field(0), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
                        ("sequence_id", pa.int64()), ("offset", pa.int64())] + ([("ids", pa.list_(pa.int32()))] if keep_ids else []))
    end = array.array("I", [END_ID]).tobytes()
    step = 4 * seq_len

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = tokenizer(json_file, rank_file)

        def rows() -> Iterator[tuple]:
            for doc_id, text in rows_of(batches, "doc_id", "text"):
                packed = ids.packed(text_bytes(text).decode("utf-8", "replace")) + end
                sums = array.array("I", [zlib.crc32(packed[i:i + step]) for i in range(0, len(packed), step)])
                yield doc_id, len(packed) // 4, sums.tobytes(), packed if keep_ids else None
            ids.known.clear()

        yield from in_batches(rows(), light)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_id = TaskContext.get().partitionId() << 40

        def rows() -> Iterator[tuple]:
            nonlocal next_id
            for group in _groups(rows_of(batches, "n_tokens", "doc_id", "checksums", "packed")):
                last = next_id - 1
                for (n, doc_id, sums, packed), start, length, sequence, offset in pack_group(group, seq_len, next_id):
                    last = max(last, sequence)
                    at = 4 * (start // seq_len)
                    piece = doc_id, start, length, int.from_bytes(sums[at:at + 4], "little"), n, sequence, offset
                    yield (*piece, array.array("I", packed[4 * start:4 * (start + length)]).tolist()) if keep_ids else piece
                next_id = last + 1

        yield from in_batches(rows(), pieces)

    ids = ", ids array<int>" if keep_ids else ""
    # the row's place in its input split sends equal rows to different groups
    draw = F.xxhash64(F.lit(seed), "doc_id", "n_tokens", "checksums", F.monotonically_increasing_id())
    counted = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        tokenise, f"doc_id {id_type}, n_tokens long, checksums binary, packed binary")
    return (counted.withColumn("_draw", draw).repartition(shuffle_partitions(docs.sparkSession), "_draw")
            .sortWithinPartitions("_draw", "doc_id", "checksums").drop("_draw")
            .mapInArrow(pack, f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long{ids}"))


def padded_length(used: int, seq_len: int = SEQ_LEN) -> int:
    """A sequence is stored at ``seq_len``, or as it is where its length is a power of two."""
    return used if used & (used - 1) == 0 else seq_len


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id, used, ids, doc_starts``: each sequence's ids and where its pieces begin.

    Needs pieces packed with ``keep_ids``; one sequence's rows never exceed its length.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("used"), parts.alias("_parts")).select(
        "sequence_id", "used", F.flatten("_parts.ids").alias("ids"), F.col("_parts.offset").alias("doc_starts"))
