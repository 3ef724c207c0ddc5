"""Best-fit packing by a configuration linear program over the histogram of lengths.

A configuration is a multiset of lengths that fits one sequence.  The linear program asks
for the least mass of configurations that covers every length as often as it occurs.
Multiplicative weights solve it: lengths covered too little rise in price, an unbounded
knapsack by dynamic programming prices the configurations, and a walk through its table
draws many of nearly the best value at once.  The mass is rounded down to whole
sequences, what is left over gets a program of its own, and the last few lengths are
placed by best fit.

The program sees only counts of lengths, so its size depends on the sequence length and
not on the corpus.  Documents never move to be packed: a document's rank among those of
its length, from prefix counts over the tasks, names its configuration and its place in
it.
"""

from __future__ import annotations

import array
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webgrove.llm.common import in_batches, rows_of, stored, text_bytes
from webgrove.llm.packing import tokenizer

SEQ_LEN = 2048
END_ID = 0
#: Programs solved one after the other at most, price updates in each, and configurations drawn at each.
PROGRAMS, UPDATES, DRAWS = 10, 24, 1500
#: Rate of the prices and of the draws' weights; value that one step of a walk, and a whole configuration, may lack.
PRICE_RATE, WEIGHT_RATE = 0.06, 3.0
STEP_SLACK, SLACK = 0.001, 0.002

#: (length, copies) of every length of a configuration, and a configuration that so many sequences have.
Content = tuple[tuple[int, int], ...]
Filled = tuple[int, Content]


def knapsack(prices: np.ndarray) -> np.ndarray:
    """``best[c]``: the greatest value that fits room ``c``; ``prices[l]`` is negative for lengths that do not occur."""
    best = np.zeros(len(prices))
    for room in range(1, len(prices)):
        best[room] = max(best[room - 1], (prices[1:room + 1] + best[:room][::-1]).max())
    return best


def draw_configurations(prices: np.ndarray, best: np.ndarray, weights: np.ndarray, draws: int, rng: np.random.Generator) -> np.ndarray:
    """Rows of lengths (0: none) of nearly the best value, each step drawn by weight among the nearly best."""
    room = np.full(draws, len(prices) - 1)
    slack = STEP_SLACK * best[-1]
    steps, open_ = [np.zeros(draws, dtype=np.int64)], np.arange(draws)
    while len(open_):
        taken = np.zeros(draws, dtype=np.int64)
        order = open_[np.argsort(room[open_], kind="stable")]
        rooms, starts = np.unique(room[order], return_index=True)
        for c, walkers in zip(rooms.tolist(), np.split(order, starts[1:]), strict=True):
            near = 1 + np.flatnonzero(prices[1:c + 1] + best[:c][::-1] >= best[c] - slack)
            near = near[prices[near] > 0]
            upto = np.cumsum(weights[near])
            if len(near) and upto[-1] > 0:
                taken[walkers] = near[np.minimum(np.searchsorted(upto, rng.random(len(walkers)) * upto[-1], side="right"), len(near) - 1)]
        room -= taken
        steps.append(taken)
        open_ = open_[(taken[open_] > 0) & (room[open_] > 0)]
    return np.stack(steps, axis=1)


def fractional(counts: np.ndarray, rng: np.random.Generator) -> tuple[float, float, Counter[Content]]:
    """A lower bound of the program's value, the mass of one draw, and how often each configuration was drawn.

    Prices start at each length's share of a sequence.  Any prices, scaled until no
    configuration is worth more than one, bound the value from below.
    """
    room = len(counts) - 1
    lengths = np.arange(room + 1)
    occurs = counts > 0
    natural, safe = lengths / room, np.maximum(counts, 1)
    mass = max(float((counts * lengths).sum()) / room, 1.0) / (UPDATES * DRAWS)
    covered, bound, drawn = np.zeros(room + 1), 0.0, Counter()
    for update in range(UPDATES):
        ahead = covered - update / UPDATES
        prices = np.where(occurs, natural * np.exp(-PRICE_RATE * ahead), -1.0)
        best = knapsack(prices)
        bound = max(bound, float((counts[occurs] * prices[occurs]).sum() / best[-1]))
        rows = draw_configurations(prices, best, np.where(occurs, counts * np.exp(-WEIGHT_RATE * ahead), 0.0), DRAWS, rng)
        covered += mass * np.bincount(rows.ravel(), minlength=room + 1) / safe
        value = np.where(rows > 0, prices[rows], 0.0).sum(axis=1)
        drawn.update(tuple(sorted(Counter(row[row > 0].tolist()).items(), reverse=True)) for row in rows[value >= (1 - SLACK) * best[-1]])
    return bound, mass, drawn


def rounded(counts: np.ndarray, mass: float, drawn: Counter[Content], rng: np.random.Generator) -> Counter[Content]:
    """Whole sequences, taken from ``counts``: each configuration as often as its mass rounded down,
    then in random order once more for every draw, while all its lengths are left."""
    contents, out = list(drawn), Counter()
    for more in (False, True):
        for i in rng.permutation(len(contents)).tolist():
            content = contents[i]
            times = min([drawn[content] if more else int(mass * drawn[content]), *(int(counts[length]) // copies for length, copies in content)])
            if times > 0:
                for length, copies in content:
                    counts[length] -= copies * times
                out[content] += times
    return out


def best_fit(counts: np.ndarray, opened: Counter[Content] | None = None) -> list[Filled]:
    """Best fit, longest first, into the room of ``opened`` sequences and new ones.

    Sequences of equal content are filled as one, so the work does not grow with the counts.
    """
    whole = len(counts) - 1
    open_: dict[int, list[Filled]] = {}
    for content, times in (opened or {}).items():
        open_.setdefault(whole - sum(length * copies for length, copies in content), []).append((times, content))
    for length in range(whole, 0, -1):
        left, moved = int(counts[length]), []
        for room in sorted(r for r in open_ if r >= length):
            kept = []
            for times, content in open_.pop(room):
                copies = room // length
                for each, n in ((copies, min(times, left // copies)), (left % copies, 1)):
                    if each and n and times and each * n <= left and (each == copies or left < copies):
                        moved.append((room - each * length, n, (*content, (length, each))))
                        left, times = left - each * n, times - n
                if times:
                    kept.append((times, content))
            if kept:
                open_[room] = kept
        copies = whole // length
        for each, n in ((copies, left // copies), (left % copies, 1)):
            if each and n:
                moved.append((whole - each * length, n, ((length, each),)))
        for room, n, content in moved:
            open_.setdefault(room, []).append((n, content))
    return [filled for same in open_.values() for filled in same]


def sequence_plan(counts: np.ndarray, seed: int = 0) -> tuple[float, list[Filled]]:
    """A lower bound of the number of sequences, and the sequences; ``counts[l]`` pieces have length ``l``."""
    rng, left = np.random.default_rng(seed), counts.copy()
    out: Counter[Content] = Counter()
    bound = 0.0
    for program in range(PROGRAMS):
        if left.sum() < 2:
            break
        value, mass, drawn = fractional(left, rng)
        bound = bound if program else value
        found = rounded(left, mass, drawn, rng)
        out.update(found)
        if not found:
            break
    return bound, best_fit(left, out)


class Places:
    """Sequence and offset of the piece of a given rank among those of its length."""

    def __init__(self, plan: list[Filled]) -> None:
        rows, taken, first = [], Counter(), 0
        for times, content in plan:
            offset = 0
            for length, copies in content:
                rows.append((length, taken[length], copies, first, offset))
                taken[length] += copies * times
                offset += length * copies
            first += times
        rows.sort()
        self.n_sequences = first
        self.length, self.start, self.copies, self.first, self.offset = np.array(rows, dtype=np.int64).reshape(-1, 5).T
        self.key = (self.length << 48) + self.start

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (length << 48) + rank, side="right") - 1
        within = rank - self.start[at]
        return self.first[at] + within // self.copies[at], self.offset[at] + within % self.copies[at] * length


def best_fit_packing(docs: DataFrame, *, json_file: str, rank_file: str, seq_len: int = SEQ_LEN, keep_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and ``ids``), a row per piece.

    A document is its text's ids and an end id; a null or empty text is the end id alone.
    Documents of more than ``seq_len`` tokens are cut into pieces of that length, of which
    the first takes the remainder; no other is cut.  Every row of ``docs`` is packed, also
    repeated rows and null ids; very long texts are pieces like others; an empty table gives
    an empty one.  Sequence ids are any numbers.  Only ``doc_id`` and ``text`` are read, so
    other columns cannot clash.  With ``keep_ids``, ``packing.sequences`` puts the ids of
    whole sequences together.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    own = docs.limit(0).select("doc_id").toArrow().schema.field(0)
    light = pa.schema([own, ("n_tokens", pa.int64()), ("first", pa.int64()), ("part", pa.int64()), ("nth", pa.int64()), ("checksums", pa.binary()), ("packed", pa.binary())])
    pieces = pa.schema([own, ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
                        ("sequence_id", pa.int64()), ("offset", pa.int64())] + ([("ids", pa.list_(pa.int32()))] if keep_ids else []))
    end = array.array("I", [END_ID]).tobytes()

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, part = tokenizer(json_file, rank_file).packed, TaskContext.get().partitionId()
        seen = [0] * (seq_len + 1)

        def rows() -> Iterator[tuple]:
            for doc_id, text in rows_of(batches, "doc_id", "text"):
                packed = ids_of(text_bytes(text).decode("utf-8", "replace")) + end
                n = len(packed) // 4
                first = n % seq_len or seq_len
                cuts = [0, *range(4 * first, len(packed) + 1, 4 * seq_len)]
                sums = array.array("I", [zlib.crc32(packed[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)])
                yield doc_id, n, first, part, seen[first], sums.tobytes(), packed if keep_ids else None
                seen[first] += 1

        yield from in_batches(rows(), light)

    counted = stored(docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        tokenise, f"doc_id {id_type}, n_tokens long, first long, part long, nth long, checksums binary, packed binary"), "tokenised")
    cells = stored(counted.groupBy("part", "first").agg(F.count("*").alias("n")), "cells")
    counts = np.zeros(seq_len + 1, dtype=np.int64)
    for length, n in cells.groupBy("first").agg(F.sum("n")).collect():      # a row per length
        counts[length] = n
    counts[seq_len] = 0
    places = Places(sequence_plan(counts)[1])
    # a length's rows here are as many as tasks that met it
    earlier = Window.partitionBy("first").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = cells.select("part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_whole = -1 - (TaskContext.get().partitionId() << 40)

        def rows() -> Iterator[tuple]:
            nonlocal next_whole
            for batch in batches:
                length, rank = batch.column("first").to_numpy(), batch.column("rank").to_numpy()
                sequence, offset = np.zeros(len(length), dtype=np.int64), np.zeros(len(length), dtype=np.int64)
                cut = length < seq_len
                sequence[cut], offset[cut] = places.of(length[cut], rank[cut])
                for i, (doc_id, n, first, sums, packed) in enumerate(rows_of(iter([batch]), "doc_id", "n_tokens", "first", "checksums", "packed")):
                    checks = array.array("I", sums)
                    for piece, check in enumerate(checks):
                        start, size = (first + (piece - 1) * seq_len, seq_len) if piece else (0, first)
                        if size < seq_len:
                            where = int(sequence[i]), int(offset[i])
                        else:
                            where, next_whole = (next_whole, 0), next_whole - 1
                        row = doc_id, piece, start, size, check, n, *where
                        yield (*row, array.array("I", packed[4 * start:4 * (start + size)]).tolist()) if keep_ids else row

        yield from in_batches(rows(), pieces)

    ids = ", ids array<int>" if keep_ids else ""
    ranks = counted.join(before, ["part", "first"]).withColumn("rank", F.col("before") + F.col("nth")).select("doc_id", "n_tokens", "first", "rank", "checksums", "packed")
    return ranks.mapInArrow(place, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long{ids}")
