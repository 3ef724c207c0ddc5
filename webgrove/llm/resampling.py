"""Importance resampling of documents towards a target corpus.

Hashed runs of words give every document bucket counts.  Each bucket's gain, the log
ratio of its smoothed shares in target and corpus, goes into one array, and a document's
weight is the mean of its features' gains, looked up in that array.  Weight and a keyed
Gumbel draw make the score; the highest scores are drawn.

Ranks come from parallel sorting by regular sampling: runs are sorted where they lie,
regular samples of them give regular splitters, every segment between two splitters is
sent to one task and merged there, and prefix counts of the segments turn a row's place
into its rank.  Rows are ordered in full (ties by id, features and place in the input),
so a segment holds about twice its share at most, however many rows are equal.
"""

from __future__ import annotations

import bisect
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webgrove.llm.common import rows_of, shuffle_partitions, stored, text_bytes
from webgrove.llm.sharding import numbered

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = "2024"
#: Words whose bucket a task remembers; the memory is emptied beyond it (about 60 MB).
REMEMBERED = 400_000
RESULT = ("n_features", "weight", "score", "rank")
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_INDEX_BITS = 33        # monotonically_increasing_id() keeps the row's index in its partition here
_known: dict[tuple[int, bytes], int] = {}


def feature_buckets(text: bytes, runs: int, buckets: int) -> tuple[int, np.ndarray]:
    """Words of a text, and the buckets of all its runs of 1 to ``runs`` words."""
    words = _WORD.findall(text.translate(_LOWER))
    if len(_known) > REMEMBERED:
        _known.clear()
    codes: list[int] = []
    try:
        codes = [_known[buckets, w] for w in words]
    except KeyError:
        for word in words:
            if (buckets, word) not in _known:
                _known[buckets, word] = zlib.crc32(word) % buckets
        codes = [_known[buckets, w] for w in words]
    for width in range(2, runs + 1):
        codes += [zlib.crc32(b" ".join(words[i:i + width])) % buckets for i in range(len(words) - width + 1)]
    return len(words), np.array(codes, dtype=np.uint32)


def bucket_counts(texts: DataFrame, runs: int, buckets: int, name: str) -> DataFrame:
    """``bucket, n``: how many features of all texts fall into each bucket; a task sends one row per bucket."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for (text,) in rows_of(batches, "text"):
            total += np.bincount(feature_buckets(text_bytes(text), runs, buckets)[1], minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(total[hit])], schema=schema)

    counted = texts.select(F.col("text").cast("binary").alias("text")).mapInArrow(count, "bucket int, n long")
    return stored(counted.groupBy("bucket").agg(F.sum("n").alias("n")), name)


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """A thousand times each bucket's log ratio, rounded down.  Both tables have a row per bucket at most."""
    counts = []
    for table in (corpus, target):
        filled = np.zeros(buckets, dtype=np.int64)
        for bucket, n in table.select("bucket", "n").collect():     # bounded by the number of buckets
            filled[bucket] = n
        counts.append(filled)
    s, t = counts
    total_s, total_t = float(s.sum()) + buckets, float(t.sum()) + buckets
    return np.array([math.floor(1000 * math.log((float(b) + 1) * total_s / ((float(a) + 1) * total_t))) for a, b in zip(s.tolist(), t.tolist(), strict=True)], dtype=np.int64)


def gumbel(draw: int) -> int:
    """A thousand times a standard Gumbel value, rounded down, for an unsigned 32-bit draw."""
    return math.floor(-1000 * math.log(-math.log((draw + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, *, runs: int, seed: str, carry: tuple[str, ...]) -> DataFrame:
    """``doc_id``, the carried columns and ``n_words, n_features, weight, score``."""
    buckets = len(gain)
    shape = docs.select("doc_id", *carry)
    arrow = shape.limit(0).toArrow().schema
    schema = pa.schema([*arrow, ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64()), ("score", pa.int64())])
    types = T.StructType([*shape.schema.fields, *(T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight", "score"))])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            for text, draw in zip(batch.column("_text").to_pylist(), batch.column("_draw").to_pylist(), strict=True):
                n_words, codes = feature_buckets(text_bytes(text), runs, buckets)
                weight = int(gain[codes].sum()) // len(codes) if len(codes) else 0
                out.append((n_words, len(codes), weight, weight + gumbel(draw)))
            own = [batch.column(name) for name in arrow.names]
            numbers = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([*own, *(pa.array(v, pa.int64()) for v in numbers)], schema=schema)

    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    return docs.select("doc_id", *carry, F.col("text").cast("binary").alias("_text"), draw.alias("_draw")).mapInArrow(score, types)


def sorted_runs(rows: DataFrame, keys: list) -> DataFrame:
    """Rows sorted within their partitions, with ``_run`` and ``_at``, their place in it; written to the shared folder."""
    placed = rows.sortWithinPartitions(*keys).withColumns(
        {"_run": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))})
    return stored(placed, "runs")


def regular_splitters(runs: DataFrame, key: tuple[str, ...], segments: int) -> list[tuple]:
    """``segments - 1`` keys at regular places of ``segments`` regular samples from every run.

    Samples are about as many as runs times segments, whatever the number of rows; Spark
    sorts them, and only the splitters come to the driver.
    """
    lengths = runs.groupBy("_run").agg(F.count("*").alias("_length"))
    step = F.greatest(F.lit(1).cast("bigint"), F.expr(f"_length div {segments}"))
    samples = stored(runs.select("_run", *(c for c in key if c != "_run")).join(lengths, "_run").where(F.col("_at") % step == 0).select(*key), "samples")
    in_order, n = numbered(samples, key)
    stride = max(1, -(-n // segments))
    return [tuple(row) for row in in_order.where((F.col("_row") > 0) & (F.col("_row") % stride == 0)).orderBy(*key).select(*key).collect()]


def ranked(rows: DataFrame, keys: tuple[str, ...], *, name: str = "rank") -> DataFrame:
    """Rows with their exact rank, from 1, in the ascending order of ``keys`` (null last), by regular sampling."""
    spark = rows.sparkSession
    segments = shuffle_partitions(spark)
    flagged = rows
    key: list[str] = []
    for i, column in enumerate(keys):
        flagged = flagged.withColumn(f"_null{i}", F.col(column).isNull())
        key += [f"_null{i}", column]
    runs = sorted_runs(flagged, [F.col(c) for c in key])
    key += ["_run", "_at"]
    splitters = regular_splitters(runs, tuple(key), segments)
    types = T.StructType([*runs.schema.fields, T.StructField("_segment", T.IntegerType())])
    schema = runs.limit(0).toArrow().schema.append(pa.field("_segment", pa.int32()))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [bisect.bisect_right(splitters, row) for row in rows_of(iter([batch]), *key)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int32())], schema=schema)

    exchanged = runs.mapInArrow(deal, types).repartitionById(segments, F.col("_segment"))
    merged = exchanged.sortWithinPartitions("_segment", *key).withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _INDEX_BITS) - 1)))
    merged = stored(merged.drop("_run", "_at", *(f"_null{i}" for i in range(len(keys)))), "segments")
    sizes = {r["_segment"]: r["n"] for r in merged.groupBy("_segment").agg(F.count("*").alias("n")).collect()}      # a row per segment
    before, total = [], 0
    for segment in range(segments):
        before.append((segment, total))
        total += sizes.get(segment, 0)
    prefix = spark.createDataFrame(before, "_segment int, _before long")
    return merged.join(prefix, "_segment").withColumn(name, F.col("_before") + F.col("_place") + 1).drop("_segment", "_before", "_place")


def importance_resample(
    docs: DataFrame, target: DataFrame, *, percent: int = PERCENT, min_words: int = MIN_WORDS, runs: int = 1, buckets: int = BUCKETS, seed: str = SEED,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id``, the carried columns and ``n_features, weight, score, rank``, a row per document.

    Of the documents with at least ``min_words`` words, ``percent`` of a hundred (rounded
    down) with the highest scores are drawn, ties to the smaller id, then to fewer features;
    ``rank`` counts them from 1 and is null for all others.  ``drawn`` gives their rows.

    Null and empty texts have no features and weight 0.  A null id is drawn for like an
    empty one and comes last among ties.  Repeated rows tie and take ranks of their own.  An
    empty target gives gains from the corpus alone; an empty table an empty result.  Texts
    are read whole.  Only ``doc_id``, ``text`` and carried columns are read; a carried name
    must not be one of the above, start with ``_`` or be ``n_words``.
    """
    if clash := [c for c in carry if c in (*RESULT, "doc_id", "n_words") or c.startswith("_")]:
        raise ValueError(f"columns are named like results: {clash}")
    gain = gains(bucket_counts(docs, runs, buckets, "corpus-buckets"), bucket_counts(target, runs, buckets, "target-buckets"), buckets)
    rows = stored(scored(docs, gain, runs=runs, seed=seed, carry=carry), "scored")
    fit = rows.where(F.col("n_words") >= min_words)
    n_drawn = percent * fit.count() // 100
    in_order = ranked(fit.withColumn("_down", -F.col("score")), ("_down", "doc_id", "n_features")).drop("_down")
    in_order = in_order.withColumn("rank", F.when(F.col("rank") <= n_drawn, F.col("rank")))
    rest = rows.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("bigint"))
    return in_order.unionByName(rest).select("doc_id", *carry, *RESULT)


def drawn(resampled: DataFrame) -> DataFrame:
    """The rows that were drawn, the best first within each partition's range of ranks; texts too where they were carried."""
    return resampled.where("rank is not null").repartitionByRange("rank").sortWithinPartitions("rank")
