"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

Rows are numbered 0..N-1 in the order of their keys.  A keyed Feistel network with
cycle walking permutes exactly these numbers, so the place of a row follows from
its number, N and the seed alone: ``shard = p mod shards``, ``slot = p div shards``.
Shard sizes differ by one row at most.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgrove.llm.common import shuffle_partitions, stored

ROUNDS = 4
#: Odd multipliers below 2**32 of the round function.
MIX_A, MIX_B = 2654435761, 2246822519
#: Steps of cycle walking.  At most three quarters of the domain lie outside, so a
#: row needs more with a chance below 1e-60; such a row raises an error.
WALK = 512
_LOW_31 = (1 << 31) - 1
_INDEX_BITS = 33        # monotonically_increasing_id() keeps the row's index in its partition here


def round_keys(seed: int) -> list[int]:
    return [int.from_bytes(hashlib.sha256(f"{seed}:{i}".encode()).digest()[:4], "big") & _LOW_31 for i in range(ROUNDS)]


def half_bits(n_rows: int) -> int:
    """Bits of each half of the smallest even-width domain that holds ``n_rows`` numbers."""
    return max(1, (max(1, n_rows - 1).bit_length() + 1) // 2)


def permute(x: int, n_rows: int, seed: int) -> int:
    """The place of row ``x``: what ``permuted`` computes, for one number."""
    half, keys = half_bits(n_rows), round_keys(seed)
    mask = (1 << half) - 1
    while True:
        for key in keys:
            right = x & mask
            y = (right ^ key) * MIX_A
            y = ((y ^ (y >> 15)) & _LOW_31) * MIX_B
            x = (right << half) | ((x >> half) ^ ((y ^ (y >> 13)) & mask))
        if x < n_rows:
            return x


def permuted(row: Column, n_rows: int, seed: int) -> Column:
    """A permutation of 0..n_rows-1 as a Column expression."""
    half = half_bits(n_rows)
    mask = F.lit((1 << half) - 1).cast("bigint")
    keys = F.array(*(F.lit(k).cast("bigint") for k in round_keys(seed)))

    def mixed(right: Column, key: Column) -> Column:
        y = right.bitwiseXOR(key) * F.lit(MIX_A)
        y = y.bitwiseXOR(F.shiftright(y, 15)).bitwiseAND(F.lit(_LOW_31)) * F.lit(MIX_B)
        return y.bitwiseXOR(F.shiftright(y, 13)).bitwiseAND(mask)

    def once(x: Column) -> Column:
        return F.aggregate(keys, x, lambda s, k: F.shiftleft(s.bitwiseAND(mask), half).bitwiseOR(
            F.shiftright(s, half).bitwiseXOR(mixed(s.bitwiseAND(mask), k))))

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), once(row), lambda x, _: F.when(x < n_rows, x).otherwise(once(x)))
    return F.when(walked < n_rows, walked).otherwise(F.raise_error(F.lit("cycle walking did not end")).cast("bigint"))


def numbered(rows: DataFrame, order: tuple[str, ...], *, name: str = "_row") -> tuple[DataFrame, int]:
    """Rows with a gapless global number in the given order, and how many there are.

    A range shuffle sorts the rows; each takes its index within its partition plus the
    rows of earlier partitions.  The sorted rows are written to the shared folder first,
    so that numbers stay the same when a lost task runs again.  Equal rows are spread
    by their place in the input, hence no value needs to fit one task.  Null sorts first.
    """
    spark = rows.sparkSession
    parts = shuffle_partitions(spark)
    keys = [F.col(c).asc_nulls_first() for c in order]
    spread = rows.withColumn("_spread", F.monotonically_increasing_id())
    in_order = (spread.repartitionByRange(parts, *keys, "_spread").sortWithinPartitions(*keys, "_spread")
                .drop("_spread")
                .withColumns({"_part": F.spark_partition_id(),
                              "_index": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))}))
    in_order = stored(in_order, "numbered")
    sizes = {r["_part"]: r["n"] for r in in_order.groupBy("_part").agg(F.count("*").alias("n")).collect()}  # a row per partition
    starts, total = [], 0
    for part in range(parts):
        starts.append(total)
        total += sizes.get(part, 0)
    before = spark.createDataFrame([(p, s) for p, s in enumerate(starts)], "_part int, _before long")
    return in_order.join(before, "_part").withColumn(name, F.col("_before") + F.col("_index")).drop("_part", "_index", "_before"), total


def shard_documents(docs: DataFrame, n_shards: int = 16, *, seed: int = 20_240_601, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` and the carried columns, a row per document.

    ``size`` is the text's UTF-8 length plus one.  Null texts count as empty (size 1,
    checksum 0).  Repeated rows and ids are rows of their own with slots of their own.
    Null ids come first in the numbering.  An empty table gives an empty one.  Other
    columns are not read unless carried; a carried name must not be one of the above.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    text = F.coalesce("text", F.lit(""))
    light = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), *carry)
    rows, total = numbered(light, ("doc_id", "size", "text_crc32"))
    place = permuted(F.col("_row"), total, seed) if total else F.col("_row")
    return (rows.withColumn("_place", place)
            .withColumns({"shard": F.pmod("_place", F.lit(n_shards)).cast("int"), "slot": F.expr(f"_place div {n_shards}")})
            .drop("_row", "_place"))


def write_shards(placed: DataFrame, path: str) -> None:
    """Write each shard's rows in slot order, as several files whose names sort in that order."""
    parts = shuffle_partitions(placed.sparkSession)
    (placed.repartitionByRange(parts, "shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
