"""Benchmark decontamination with a generalised suffix automaton over words.

The automaton holds every word sequence of the benchmark items.  It is built in tasks, one per
share of the items, and stored as flat arrays in the shared folder; the tasks over the
documents read it there, so items never pass through the driver.  A training text is
streamed through it word by word; the longest match that ends at each word shows
where an item's window (``window`` words in a row, or a whole shorter item) occurs.
"""

from __future__ import annotations

import itertools
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgrove.llm.common import in_batches, let, rows_of, runs, text_bytes, work_folder

WINDOW = 13
COVERAGE_PERCENT = 5
SPANS = "array<struct<start:int,end:int,words:int>>"
#: Bytes of item texts in one automaton (a bound on memory, not on items): up to 320 bytes of building task and 16 of stored
#: arrays a byte.  More items make further automata, of which a worker keeps the last few.
AUTOMATON_BYTES, MACHINES_HELD = 1 << 20, 4
#: A stored automaton: its words, states, transitions (those of state s from ``first[s]``, by word), pairs of neighbouring words, and classes of hits.
MACHINE = pa.schema([(name, pa.binary()) for name in (
    "words", "link", "length", "top", "near", "first", "by", "to", "pairs", "class_state", "class_size", "class_first", "class_items")]
    + [("items", pa.list_(pa.string())), ("shortest", pa.int32())])
_SEPARATORS = bytes(32 if c < 0x30 or 0x3A <= c < 0x41 or 0x5B <= c <= 0x60 or 0x7B <= c <= 0x7F else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: bytes) -> list[bytes]:
    """Words with A-Z in lower case; every byte of a non-ASCII character belongs to a word."""
    return text.translate(_SEPARATORS).split()


class Builder:
    """Generalised suffix automaton of word sequences, grown word by word."""

    def __init__(self) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, words: list[bytes]) -> list[int]:
        """Take in one sequence; its word numbers."""
        number = self.vocabulary
        ids = [number.setdefault(w, len(number)) for w in words]
        last = 0
        for word in ids:
            last = self._extend(last, word)
        return ids

    def _new(self, length: int, follow: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.next.append(follow)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, state: int, word: int) -> int:
        """The state for the state's longest sequence and ``word``, cut off where it is too long."""
        target = self.next[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._new(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new = self._new(self.length[last] + 1, {}, 0)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word)
        return new


def build(items: list[tuple[str, list[bytes]]], window: int) -> dict[str, object]:
    """The automaton of the items as flat arrays, the columns of ``MACHINE``.

    A *class* is a word sequence that counts as a hit: a window of an item, found at the one
    ancestor of a state that holds the state's last ``window`` words, or a whole shorter item.
    """
    grown = Builder()
    coded = [(item, grown.add(words)) for item, words in items if words]
    link, length = grown.link, grown.length
    order = sorted(range(1, len(link)), key=length.__getitem__)      # links lead to shorter states
    top = [-1] * len(link)
    for state in order:
        if length[state] >= window:
            top[state] = top[link[state]] if length[link[state]] >= window else state
    names = {item: k for k, item in enumerate(sorted({item for item, _ in coded}))}
    classes: dict[tuple[int, int], set[int]] = {}                    # state and words -> items
    for item, ids in coded:
        state = 0
        for i, word in enumerate(ids, 1):
            state = grown.next[state][word]
            if i >= window:
                classes.setdefault((top[state], window), set()).add(names[item])
        if len(ids) < window:
            while length[link[state]] >= len(ids):
                state = link[state]
            classes.setdefault((state, len(ids)), set()).add(names[item])
    keys = sorted(classes)
    near = [0] * len(link)                                           # the nearest ancestor, itself included, with a short item
    holders = {state for state, size in keys if size < window}
    for state in order:
        near[state] = state if state in holders else near[link[state]]
    numbers = lambda values: np.fromiter(values, dtype=np.int32).tobytes()
    size = max(1, len(grown.vocabulary))
    pairs = {a * size + b for _, ids in coded for a, b in zip(ids, ids[1:], strict=False)}
    return {
        "words": b"\n".join(grown.vocabulary), "link": numbers(link), "length": numbers(length), "top": numbers(top), "near": numbers(near),
        "first": numbers(itertools.accumulate((len(f) for f in grown.next), initial=0)),
        "by": numbers(word for follow in grown.next for word in sorted(follow)),
        "to": numbers(follow[word] for follow in grown.next for word in sorted(follow)),
        "pairs": np.array(sorted(pairs), dtype=np.int64).tobytes(),
        "class_state": numbers(state for state, _ in keys), "class_size": numbers(size for _, size in keys),
        "class_first": numbers(itertools.accumulate((len(classes[k]) for k in keys), initial=0)),
        "class_items": numbers(item for k in keys for item in sorted(classes[k])), "items": list(names),
        "shortest": min((min(len(ids), window) for _, ids in coded), default=window),
    }


class Machine:
    """A built automaton as it is read by a task: arrays, and the numbers of its words."""

    def __init__(self, built: dict, window: int) -> None:
        self.window, self.shortest, self.items = window, built["shortest"], built["items"]
        self.vocabulary = {w: k for k, w in enumerate(built["words"].split(b"\n"))} if built["words"] else {}
        self.pairs = np.frombuffer(built["pairs"], dtype=np.int64)
        arrays = ("link", "length", "top", "near", "first", "by", "to", "class_state", "class_size", "class_first", "class_items")
        self.link, self.length, self.top, self.near, self.first, self.by, self.to, state, sizes, self.class_first, self.class_items = (
            memoryview(built[name]).cast("i") for name in arrays)
        self.whole: dict[int, int] = {}                              # state -> class of its last ``window`` words
        self.short: dict[int, list[tuple[int, int]]] = {}            # state -> short items that end there: words, class
        for k, (at, size) in enumerate(zip(state, sizes, strict=True)):
            if size == window:
                self.whole[at] = k
            else:
                self.short.setdefault(at, []).append((size, k))

    def candidates(self, words: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
        """Where the text follows pairs of the items for long enough: start and word numbers.

        No match spans two words that no item has in a row, so nothing is lost.
        """
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        inside = ids >= 0
        joined = inside[:-1] & inside[1:]
        at = np.flatnonzero(joined)
        if len(at) and len(self.pairs):
            codes = ids[at] * len(self.vocabulary) + ids[at + 1]
            found = np.searchsorted(self.pairs, codes)
            found[found == len(self.pairs)] = 0
            joined[at[self.pairs[found] != codes]] = False
        else:
            joined[:] = False
        starts = np.flatnonzero(inside & np.concatenate(([True], ~joined)))
        ends = np.flatnonzero(inside & np.concatenate((~joined, [True]))) + 1
        for k in np.flatnonzero(ends - starts >= self.shortest):
            yield int(starts[k]), ids[starts[k]:ends[k]]

    def matches(self, words: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """Merged word ranges inside occurring windows, and the items that these belong to.

        A word costs a bounded number of steps, also in texts that repeat themselves: the class
        of its last ``window`` words is one look-up, and of short items no more than one of each length ends at it.
        """
        ranges: list[list[int]] = []
        hits: set[int] = set()
        if not words or not self.vocabulary:
            return ranges, set()
        link, length, first, by, to, window = self.link, self.length, self.first, self.by, self.to, self.window
        for start, ids in self.candidates(words):
            state, longest = 0, 0
            for i, word in enumerate(ids.tolist(), start + 1):
                while True:
                    end = first[state + 1]
                    at = bisect_left(by, word, first[state], end)
                    if at < end and by[at] == word:
                        state = to[at]
                        longest += 1
                        break
                    if not state:
                        break
                    state = link[state]
                    longest = length[state]
                hit = 0
                if longest >= window:
                    # the class of a state that the match does not fill is that of an ancestor, and so is this one
                    hits.add(self.whole[self.top[state]])
                    hit = window
                at = self.near[state]
                while at > 0:
                    for size, number in self.short[at]:
                        if size <= longest:
                            hits.add(number)
                            hit = max(hit, size)
                    at = self.near[link[at]]
                if hit:
                    if ranges and i - hit <= ranges[-1][1]:
                        ranges[-1][1] = i
                        ranges[-1][0] = min(ranges[-1][0], i - hit)
                    else:
                        ranges.append([i - hit, i])
        below = {k for h in hits for k in self.class_items[self.class_first[h]:self.class_first[h + 1]]}
        return _merged(ranges), {self.items[k] for k in below}


def _merged(ranges: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _spans(raw: bytes, pairs: list[list[int]]) -> list[dict[str, int]]:
    """Ascending word ranges of a UTF-8 text as ranges of characters."""
    if not pairs:
        return []
    at = [m.span() for m in _WORD.finditer(raw)]
    edges = [edge for a, b in pairs for edge in (at[a][0], at[b - 1][1])]
    places = list(itertools.accumulate(len(raw[a:b].decode()) for a, b in itertools.pairwise([0, *edges])))
    return [{"start": a, "end": b, "words": last - first} for a, b, (first, last) in zip(places[::2], places[1::2], pairs, strict=True)]


def store_automatons(items: DataFrame, *, window: int = WINDOW, automaton_bytes: int = AUTOMATON_BYTES) -> list[str]:
    """Build the automatons in tasks and store them in the shared folder; the files' paths.

    Items are dealt to automatons by hash.  Items longer than a part are cut into parts that overlap
    by a window less one word, so that no task holds more than its share of one item.
    """
    words = max(2 * window, automaton_bytes // 16)
    texts = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text")).where("item is not null and text is not null").distinct()
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // automaton_bytes))
    part_rows = pa.schema([("block", pa.int32()), ("item", pa.string()), ("words", pa.binary())])

    def to_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for item, text in rows_of(batches, "item", "text"):
                found = words_of(text)
                for at in range(0, max(1, len(found) - window + 1), words - window + 1):
                    part = b" ".join(found[at:at + words])
                    if part:
                        yield zlib.crc32(item.encode() + part) % blocks, item, part

        yield from in_batches(rows(), part_rows)

    def to_automatons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in runs(rows_of(batches, "block", "item", "words"), 1):
            yield pa.RecordBatch.from_pylist([build([(item, part.split()) for _, item, part in parts], window)], MACHINE)

    columns = ", ".join(f"{f.name} {'array<string>' if pa.types.is_list(f.type) else 'int' if pa.types.is_integer(f.type) else 'binary'}" for f in MACHINE)
    parts = texts.mapInArrow(to_parts, "block int, item string, words binary")
    made = parts.repartition(blocks, "block").sortWithinPartitions("block").mapInArrow(to_automatons, columns)
    folder = work_folder(items.sparkSession, "automatons")
    made.write.option("maxRecordsPerFile", 1).parquet(folder)
    return sorted(items.sparkSession.read.schema(made.schema).parquet(folder).inputFiles())


@lru_cache(maxsize=MACHINES_HELD)
def machine(path: str, window: int) -> Machine | None:
    """A stored automaton, kept by the worker for its next texts; None for a file without a row."""
    system, name = FileSystem.from_uri(path)
    rows = pq.read_table(name, filesystem=system).to_pylist()
    return Machine(rows[0], window) if rows else None


def find_contamination(
    docs: DataFrame, items: DataFrame, *, window: int = WINDOW, coverage_percent: int = COVERAGE_PERCENT,
    automaton_bytes: int = AUTOMATON_BYTES, keep_text: bool = True,
) -> DataFrame:
    """``doc_id, text, n_words, n_hit, item_ids, spans, contaminated``, a row per document.

    ``spans`` are the character ranges of the hit words and their numbers of words.  A document is contaminated if
    ``coverage_percent`` of its words or more are hit.  Null and empty texts have no words
    and are clean; so is everything if there are no items.  Items without id or words are
    passed over; repeated items count once; repeated documents are judged row by row.
    Only ``doc_id``, ``text`` and ``item_id``, ``text`` are read.  Without ``keep_text``
    the ``text`` column comes back null, which saves its way out of Python.
    """
    id_type, id_name = docs.limit(0).select("doc_id").toArrow().schema.field(0).type, docs.schema["doc_id"].dataType.simpleString()
    done = pa.schema([("doc_id", id_type), ("text", pa.string()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("item_ids", pa.list_(pa.string())),
                      ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("words", pa.int32())])))])
    paths = store_automatons(items, window=window, automaton_bytes=automaton_bytes)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                texts = [text_bytes(text) for text in batch.column("text").to_pylist()]
                counts = [0] * len(texts)
                ranges: list[list[list[int]]] = [[] for _ in texts]
                found: list[set[str]] = [set() for _ in texts]
                for k, path in enumerate(paths or [None]):           # a whole batch passes through one automaton after the other
                    reader = machine(path, window) if path else None
                    for i, raw in enumerate(texts):
                        words = words_of(raw) if reader or not k else []
                        if not k:
                            counts[i] = len(words)
                        if reader:
                            new, more = reader.matches(words)
                            ranges[i] += new
                            found[i] |= more
                for doc_id, raw, n_words, hit, own in zip(batch.column("doc_id").to_pylist(), texts, counts, ranges, found, strict=True):
                    pairs = _merged(hit)
                    yield doc_id, raw.decode() if keep_text else None, n_words, sum(b - a for a, b in pairs), sorted(own), _spans(raw, pairs)

        yield from in_batches(rows(), done)

    plain = docs.select("doc_id", F.expr("make_valid_utf8(text)").alias("text"))
    out = plain.mapInArrow(judge, f"doc_id {id_name}, text string, n_words long, n_hit long, item_ids array<string>, spans {SPANS}")
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= coverage_percent * F.col("n_words")))


def cut(text: Column, spans: Column, *, min_words: int = WINDOW) -> Column:
    """``text`` without those ``spans`` that have ``min_words`` words or more.

    Null stays null, and a text without such spans stays as it is.  What stood on both sides
    of a span keeps its separators; its words become neighbours.
    """
    whole = F.make_valid_utf8(text)
    end = F.struct(F.length(whole).alias("start"), F.length(whole).alias("end"), F.lit(0).alias("words"))

    def rest(long: Column) -> Column:
        pieces = F.transform(F.concat(long, F.array(end)), lambda s, i: let(
            F.when(i == 0, F.lit(0)).otherwise(F.get(long, i - 1)["end"]), lambda at: F.substring(whole, at + 1, s["start"] - at)))
        return F.when(F.size(long) == 0, text).otherwise(F.concat_ws("", pieces))

    return F.when(text.isNotNull(), let(F.filter(F.array_sort(F.coalesce(spans, F.array().cast(SPANS))), lambda s: s["words"] >= min_words), rest))


def without_spans(found: DataFrame, *, min_words: int = WINDOW) -> DataFrame:
    """``doc_id, text`` of what ``find_contamination`` gave: contaminated documents, over the
    coverage limit, are removed; from the others every hit span of ``min_words`` words or more is cut."""
    return found.where(~F.col("contaminated")).select("doc_id", cut(F.col("text"), F.col("spans"), min_words=min_words).alias("text"))
