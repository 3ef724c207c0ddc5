"""Removing subtrees.  ``docs`` in, ``docs`` out; the input is not changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgrove.functions import selectors
from webgrove.operators.select import Selection, any_of, node_at, node_text, running_end_sql

# What a page holds besides its content; a starting point for ``clean_text``.
BOILERPLATE = ("nav", "script", "style", "noscript", "template", "header", "footer", "aside", ".ad")


# Per element, how far the dropped subtrees that start up to it reach.
_ENDS = running_end_sql("transform(_hit, (hit, i) -> IF(hit, nodes[i].last, -1))")

# The outermost dropped elements, in document order.
_TOPS = """filter(nodes, n -> get(_ends, n.pre) >= n.pre AND NOT coalesce(get(_ends, n.pre - 1) >= n.pre, false))"""

# Sibling numbers anew.  What is left is put in sibling order (dropped elements
# aside); an element's place is its distance from the start of its run, seen from
# the left and from the right.
_ORDER = """array_sort(transform(nodes, n ->
    struct(IF(n.tag IS NULL OR get(_ends, n.pre) >= n.pre, -2, n.parent) AS parent, n.pre AS pre)))"""


def _run_starts(order: str) -> str:
    return running_end_sql(f"transform({order}, (x, i) -> IF(get({order}, i - 1).parent <=> x.parent, -1, i))")


# Bound with one-item arrays: a column used once inside a lambda would be inlined
# there by the optimizer and computed again for every element.
_PLACES = f"""get(transform(array({_ORDER}), o ->
    get(transform(array(struct(
            {_run_starts("o")} AS here,
            get(transform(array(reverse(o)), r -> {_run_starts("r")}), 0) AS back)), s ->
        array_sort(transform(o, (x, i) -> struct(
            x.pre AS pre, i - get(s.here, i) + 1 AS sib, size(o) - i - get(s.back, size(o) - 1 - i) AS left)))), 0)), 0)"""

# Elements not beside a dropped one stay as they are.
_RENUMBERED = """transform(nodes, n -> IF(get(_ends, n.pre) < n.pre AND NOT array_contains(_parents, n.parent), n, named_struct(
    'pre', n.pre, 'last', n.last, 'parent', n.parent, 'depth', n.depth,
    'sib', get(_places, n.pre).sib,
    'nsib', get(_places, n.pre).sib + get(_places, n.pre).left - 1,
    'kids', n.kids,
    'tag', IF(get(_ends, n.pre) >= n.pre, NULL, n.tag),
    'attrs', IF(get(_ends, n.pre) >= n.pre, NULL, n.attrs),
    'attr_names', IF(get(_ends, n.pre) >= n.pre, NULL, n.attr_names),
    't0', n.t0, 't1', n.t1, 'h0', n.h0, 'h1', n.h1)))"""


# Parents of dropped elements have fewer children.
_NODES = f"""transform({_RENUMBERED}, n -> IF(array_contains(_parents, n.pre), named_struct(
    'pre', n.pre, 'last', n.last, 'parent', n.parent, 'depth', n.depth, 'sib', n.sib, 'nsib', n.nsib,
    'kids', n.kids - size(filter(_tops, t -> t.parent = n.pre)), 'tag', n.tag, 'attrs', n.attrs, 'attr_names', n.attr_names,
    't0', n.t0, 't1', n.t1, 'h0', n.h0, 'h1', n.h1), n))"""

# Which elements a list of element numbers names: both sorted together, each element
# looks at its neighbour.
_NAMED = """get(transform(array(array_sort(concat(
        transform(array_distinct(_chosen), p -> struct(p AS pre, 0 AS kind)), transform(nodes, n -> struct(n.pre AS pre, 1 AS kind))))),
    s -> transform(filter(transform(s, (x, i) -> struct(x.kind AS kind, coalesce(get(s, i - 1).pre = x.pre, false) AS hit)),
        x -> x.kind = 1), x -> x.hit)), 0)"""


def drop(docs: DataFrame, *queries: str | Selection) -> DataFrame:
    """Remove every matched element with all below it, in one pass.

    A query is a selector, or a selection such as ``css("li")[0]`` or
    ``css("nav").css("a")[2:]``.

    Later reads of the result see the elements gone: their pieces are emptied
    and their nodes lose tag and attributes, while all numbers stay valid.  A
    ``::text`` match drops its element.  No match leaves a page as it is.
    """
    parts = [part for query in queries if isinstance(query, str) for part in selectors.parse(query)]
    chosen = [query.refs() for query in queries if isinstance(query, Selection)]
    if not parts and not chosen:
        raise ValueError("drop needs at least one selector")
    hit = any_of(parts, lambda condition: F.transform("nodes", condition)) if parts else None
    if chosen:
        docs_ = docs.withColumn("_chosen", F.transform(F.concat(*chosen), lambda r: r["pre"]))
        named = F.expr(_NAMED)
        hit = named if hit is None else F.zip_with(hit, named, lambda a, b: a | b)
    else:
        docs_ = docs
    work = (
        docs_.withColumn("_hit", hit)
        .withColumn("_ends", F.expr(_ENDS))
        .withColumn("_tops", F.expr(_TOPS))
        .withColumns({"_parents": F.array_distinct("_tops.parent"), "_places": F.expr(f"IF(size(_tops) = 0, NULL, {_PLACES})")})
    )
    edited = {"texts": _emptied("texts", "t"), "markup": _emptied("markup", "h"), "nodes": _NODES}
    changed = F.struct(*(
        F.expr(f"IF(size(_tops) = 0, {c}, {edited[c]})").alias(c) for c in docs.columns if c in edited))
    # A one-row generator, so that later reads see plain columns: the optimizer
    # would otherwise inline an edited column into a lambda that reads it once.
    rows = work.select(*(c for c in docs.columns if c not in edited), F.inline_outer(F.array(changed)))
    return rows.select(*docs.columns)


def _emptied(pieces: str, bound: str) -> str:
    """SQL for: the pieces with those of dropped subtrees emptied, joined from the
    kept slices between them."""
    before = f"coalesce(get(_tops, i - 1).{bound}1, 0)"
    begin = f"coalesce(get(_tops, i).{bound}0, size({pieces}))"
    length = f"coalesce(get(_tops, i).{bound}1 - get(_tops, i).{bound}0, 0)"
    return f"""flatten(transform(sequence(0, size(_tops)), i ->
        concat(slice({pieces}, {before} + 1, {begin} - {before}), array_repeat('', {length}))))"""


def clean_text(docs: DataFrame, drop_queries: Sequence[str] = BOILERPLATE) -> DataFrame:
    """``page_id, text``: the page's text without the dropped parts."""
    for query in drop_queries:
        selectors.parse(query)
    work = drop(docs, *drop_queries) if drop_queries else docs
    return work.select("page_id", F.coalesce(node_text(node_at(F.lit(0))), F.lit("")).alias("text"))
