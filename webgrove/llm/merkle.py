"""Merkle manifest of a table: a digest for every row, for every group and for the whole.

A group's rows are the leaves of one tree, and the groups' roots are the leaves of a
last one.  Every level is one equijoin of its nodes with themselves on the computed
number of a sibling (``idx XOR 1`` in a binary tree, else the run's start plus a shifted
slot); the rows in slot zero then emit the parents.  Levels are written as they come,
each half as long as the one below it, so lineage stays short and lost tasks read files.

Proofs come from the top down: a node's path is its own siblings and its parent's path.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgrove.llm.common import stored
from webgrove.llm.sharding import numbered

#: Levels that one job of the downward pass joins.
STRIDE = 4
#: Parts of a group's rows while they learn the group's number and size.
SALTS = 32
RESULT = ("leaf", "subroot", "root", "path")


def hashed(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def hex_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value; no two lists of fields read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """A row's digest."""
    return hashed(*(field(v) for v in values))


def proof_digest(path: Column) -> Column:
    """Digest of a path's siblings, from the leaf's level to the root, each level left to right."""
    return hashed(F.array_join(F.transform(path, lambda level: hex_of(level["others"])), ""))


def folded_root(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""

    def up(own: Column, level: Column) -> Column:
        left = 64 * level["slot"]
        others = hex_of(level["others"])
        return hashed(F.substring(others, F.lit(1), left), own, F.substring(others, left + 1, F.length(others)))

    return F.aggregate(path, leaf, up)


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes with ``others``: the digests of their run's other nodes, left to right."""
    slot = F.pmod("idx", F.lit(arity))
    joined, found = nodes, []
    for shift in range(1, arity):
        place = F.col("idx").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("idx") - slot + F.pmod(slot + shift, F.lit(arity))
        found.append(f"_other{shift}")
        other = nodes.select(F.col("tree").alias("_tree"), F.col("idx").alias("_place"), F.col("digest").alias(found[-1]))
        joined = joined.join(other, (F.col("tree") == F.col("_tree")) & (place == F.col("_place")), "left").drop("_tree", "_place")
    if arity == 2:
        others = F.coalesce(found[0], F.lit(b""))
    else:
        placed = [F.struct(F.pmod(slot + shift, F.lit(arity)).alias("slot"), F.coalesce(name, F.lit(b"")).alias("digest")) for shift, name in enumerate(found, 1)]
        others = F.aggregate(F.array_sort(F.array(*placed)), F.lit(b""), lambda all_, x: F.concat(all_, x["digest"]))
    return joined.withColumn("others", others).drop(*found)


def _levels(leaves: DataFrame, arity: int, name: str) -> list[DataFrame]:
    """Stored levels ``tree, idx, n, digest, others`` from leaves ``tree, idx, n, digest``, a stored table.

    ``n`` counts the nodes of a tree on that level.  Other columns of the leaves stay on the first level.
    """
    levels = [stored(_with_siblings(leaves, arity), f"{name}-0")]
    size = levels[0].agg(F.max("n")).first()[0] or 0
    while size > 1:
        parents = levels[-1].where((F.col("n") > 1) & (F.pmod("idx", F.lit(arity)) == 0)).select(
            "tree", F.expr(f"idx div {arity}").alias("idx"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
            F.unhex(hashed(hex_of(F.col("digest")), hex_of(F.col("others")))).alias("digest"))
        levels.append(stored(_with_siblings(parents, arity), f"{name}-{len(levels)}"))
        size = -(-size // arity)
    return levels


def _tops(levels: list[DataFrame]) -> DataFrame:
    """``level, tree, digest``: the last node of each tree."""
    return reduce(DataFrame.unionByName, (rows.where("n = 1").select(F.lit(i).alias("level"), "tree", "digest") for i, rows in enumerate(levels)))


def _paths(levels: list[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """The leaves with the ``path`` from their own level to the root, and the ``top`` carried by ``level, tree, path, top``."""
    slot = F.pmod("idx", F.lit(arity)).cast("int")
    entry = F.when(F.col("n") > 1, F.struct(slot.alias("slot"), "others"))
    above = None
    for base in reversed(range(0, len(levels), STRIDE)):
        end = min(base + STRIDE, len(levels))
        rows = levels[base].withColumn("_entry0", entry)
        for step, level in enumerate(levels[base + 1:end], 1):
            upper = level.select(F.col("tree").alias("_tree"), F.col("idx").alias("_idx"), entry.alias(f"_entry{step}"))
            rows = rows.join(upper, (F.col("tree") == F.col("_tree")) & (F.expr(f"idx div {arity ** step}") == F.col("_idx")), "left").drop("_tree", "_idx")
        # trees that end in this stretch have one node there, so its number at the stretch's end is 0
        ended = tops.where(F.col("level").between(base, end - 1)).select(F.col("tree").alias("_tree"), F.lit(0).cast("bigint").alias("_idx"), F.col("path").alias("_path"), "top")
        if above is not None:
            ended = ended.unionByName(above.select(F.col("tree").alias("_tree"), F.col("idx").alias("_idx"), F.col("path").alias("_path"), "top"))
        rows = rows.join(ended, (F.col("tree") == F.col("_tree")) & (F.expr(f"idx div {arity ** (end - base)}") == F.col("_idx")))
        own = F.array_compact(F.array(*(f"_entry{i}" for i in range(end - base))))
        above = rows.withColumn("path", F.concat(own, F.col("_path"))).drop("_tree", "_idx", "_path", *(f"_entry{i}" for i in range(end - base)))
        if base:
            above = stored(above.select("tree", "idx", "path", "top"), f"paths-{base}")
    return above


def merkle_manifest(
    docs: DataFrame, *, fields: tuple[str, ...], group: str = "lang", order: str = "doc_id", arity: int = 2, carry: tuple[str, ...] = ()
) -> DataFrame:
    """The order and carried columns with ``leaf, subroot, root`` (hex) and ``path``, a row per document.

    ``path`` is an array from the leaf's level to the root, an entry per hashed level: the
    node's ``slot`` in its run and its run's ``others`` (digests, binary, left to right; empty
    for a lone node).  ``leaf`` covers ``fields`` in the order given; ``carry`` adds columns
    that the digests do not cover.

    Within a group leaves ascend by ``order`` (null first), equal ones by their digests;
    rows equal in all fields are leaves of their own, at places of their own.  A null group
    is a group, the first.  Null and empty texts differ (``-`` and ``0:``); texts of any
    length are hashed where they are read and never shuffled.  A group of one row is its
    own subroot; an empty table gives an empty result.  Columns that are not named are not
    read; a named column must not be called like a result.
    """
    if arity < 2:
        raise ValueError("arity must be at least 2")
    if clash := {order, *carry} & set(RESULT):
        raise ValueError(f"columns are named like results: {sorted(clash)}")
    carried = list(dict.fromkeys((order, *carry)))
    payload = F.struct(*carried).alias("kept")
    leaves = stored(docs.select(F.col(group).alias("group"), F.col(order).alias("place"), F.unhex(leaf_digest(*map(F.col, fields))).alias("digest"), payload), "leaves")
    rows, _ = numbered(leaves, ("group", "place", "digest"))
    rows = stored(rows.withColumnRenamed("_row", "at").withColumn("salt", F.pmod("at", F.lit(SALTS)).cast("int")).drop("place"), "in-order")
    sizes = stored(rows.groupBy("group").agg(F.min("at").alias("start"), F.count("*").alias("n")), "groups")
    groups, _ = numbered(sizes, ("group",))
    groups = stored(groups.withColumnRenamed("_row", "tree"), "trees").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = groups.select(F.col("group").alias("_group"), F.col("salt").alias("_salt"), "start", "n", "tree")
    placed = rows.join(own, F.col("group").eqNullSafe(F.col("_group")) & (F.col("salt") == F.col("_salt"))).select(
        "tree", (F.col("at") - F.col("start")).alias("idx"), "n", "digest", "kept")

    lower = _levels(stored(placed, "placed"), arity, "level")
    subroots = stored(_tops(lower), "subroots")
    trees = subroots.agg(F.count("*")).first()[0]
    upper = _levels(subroots.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("idx"), F.lit(trees).cast("bigint").alias("n"), "digest", "level"), arity, "upper")
    no_path = F.array().cast("array<struct<slot:int,others:binary>>")
    root = _tops(upper).select("level", "tree", no_path.alias("path"), F.col("digest").alias("top"))
    of_group = _paths(upper, root, arity).select(
        F.col("level"), F.col("idx").alias("tree"), "path", F.struct(F.col("digest").alias("subroot"), F.col("top").alias("root")).alias("top"))
    found = _paths(lower, stored(of_group, "group-paths"), arity)
    return found.select("kept.*", hex_of(F.col("digest")).alias("leaf"), hex_of(F.col("top.subroot")).alias("subroot"), hex_of(F.col("top.root")).alias("root"), "path")


def verified(manifest: DataFrame, claimed: str) -> DataFrame:
    """Adds ``folded_root``, recomputed from a claimed leaf (a column of hex digests) and the stored siblings, and ``verified``: does it equal ``root``."""
    return manifest.withColumn("folded_root", folded_root(F.col(claimed), F.col("path"))).withColumn("verified", F.col("folded_root") == F.col("root"))
