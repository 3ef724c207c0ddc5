"""CSS selections as Columns over a ``docs`` row.

Every selection is local to one page, so all of this is narrow: higher-order
functions over ``nodes``, no shuffle and no Python worker.  Cost per page stays
near linear in its elements.  In particular an ancestor test does not compare
candidates pairwise: subtrees are index ranges, and a running maximum of range
ends tells for every element whether some match to its left still covers it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_
from re import Pattern

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgrove.functions import selectors
from webgrove.functions.selectors import Compound, PageArray, Part, Predicate, plain
from webgrove.functions.text import captures, decode_entities
from webgrove.operators.rows import explode_structs

NODES = "nodes"
#: Up to so many elements a context is read by a walk over them.
_FEW_NODES = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it inside ``body``'s lambdas.

    Written straight into a lambda it would be evaluated once per element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def node_at(pre: Column) -> Column:
    return F.get(F.col(NODES), pre)


def node_text(n: Column) -> Column:
    """Deep text, whitespace kept."""
    return F.array_join(F.slice(F.col("texts"), n["t0"] + 1, n["t1"] - n["t0"]), "")


def node_html(n: Column) -> Column:
    """The element serialised with its own tags."""
    return F.array_join(F.slice(F.col("markup"), n["h0"] + 1, n["h1"] - n["h0"]), "")


def node_attr(n: Column, name: str) -> Column:
    """Missing -> "", valueless -> null."""
    return F.when(F.map_contains_key(n["attrs"], name), n["attrs"][name]).otherwise(F.lit(""))


# Distances 1, 2, 4, ... below the number of nodes.
_STEPS = "transform(sequence(0, CAST(ceil(log2(greatest(size(nodes), 2))) AS INT) - 1), k -> CAST(pow(2, k) AS INT))"


def running_end_sql(ends: str) -> str:
    """SQL for a running maximum over an int array with one item per node.

    A doubling scan: after k rounds each place has seen 2**k places to its left.
    """
    return f"aggregate({_STEPS}, {ends}, (seen, step) -> transform(seen, (x, i) -> greatest(x, get(seen, i - step))))"


def running_max(values: Column) -> Column:
    """``running_end_sql`` for a Column."""
    return F.aggregate(F.expr(_STEPS), values, lambda seen, step: F.transform(
        seen, lambda x, i: F.greatest(x, F.get(seen, i - step))))


def running_end(matched: Predicate) -> Column:
    """Per element: the greatest subtree end of the matches up to and including it."""
    return running_max(F.transform(F.col(NODES), lambda n: F.when(matched(n), n["last"]).otherwise(F.lit(-1))))


def beside(matched: Predicate, *, adjacent: bool, after: bool = False) -> Column:
    """Per element: is the sibling before it (or any earlier one) a match; with ``after``,
    the sibling behind it (or any later one).

    Elements are put in sibling order, each looks to its left, and the answers go
    back into document order; no sibling is compared with all the others.
    """
    order = F.array_sort(F.transform(F.col(NODES), lambda n: F.struct(
        F.when(n["tag"].isNotNull(), n["parent"]).otherwise(F.lit(-2)).alias("parent"),    # dropped ones apart
        (-n["pre"] if after else n["pre"]).alias("place"),
        n["pre"].alias("pre"),
        F.coalesce(matched(n), F.lit(False)).alias("hit"),
    )))

    def answers(s: Column, left: Callable[[Column], Column]) -> Column:
        found = F.transform(s, lambda x, i: F.struct(
            x["pre"].alias("pre"),
            F.coalesce(left(i)["hit"] & (left(i)["parent"] == x["parent"]), F.lit(False)).alias("hit")))
        return F.transform(F.array_sort(found), lambda x: x["hit"])

    if adjacent:
        return let(order, lambda s: answers(s, lambda i: F.get(s, i - 1)))
    return let(order, lambda s: let(
        running_max(F.transform(s, lambda x, i: F.when(x["hit"], i).otherwise(F.lit(-1)))),
        lambda nearest: answers(s, lambda i: F.get(s, F.get(nearest, i - 1)))))


def type_places(*, from_end: bool) -> Column:
    """Per element: its place, from 1, among the siblings of its tag; one sort by parent and tag."""
    order = F.array_sort(F.transform(F.col(NODES), lambda n: F.struct(
        F.when(n["tag"].isNotNull(), n["parent"]).otherwise(F.lit(-2)).alias("parent"),
        n["tag"].alias("tag"),
        (-n["pre"] if from_end else n["pre"]).alias("place"),
        n["pre"].alias("pre"),
    )))

    def starts(s: Column) -> Column:
        def same(x: Column, before: Column) -> Column:
            return before["parent"].eqNullSafe(x["parent"]) & before["tag"].eqNullSafe(x["tag"])

        return running_max(F.transform(s, lambda x, i: F.when(same(x, F.get(s, i - 1)), F.lit(-1)).otherwise(i)))

    return let(order, lambda s: let(starts(s), lambda first: F.transform(
        F.array_sort(F.transform(s, lambda x, i: F.struct(x["pre"].alias("pre"), (i - F.get(first, i) + 1).alias("place")))),
        lambda x: x["place"])))


def _holds(hits: Column) -> Column:
    """Per element: is a child of it flagged.  Parents of flagged elements and all elements meet in one sort."""
    parents = F.filter(F.transform(F.col(NODES), lambda n: F.when(F.get(hits, n["pre"]), F.struct(n["parent"].alias("at"), F.lit(0).alias("own")))), lambda x: x.isNotNull())
    both = F.array_sort(F.concat(parents, F.transform(F.col(NODES), lambda n: F.struct(n["pre"].alias("at"), F.lit(1).alias("own")))))
    return let(both, lambda s: F.transform(
        F.filter(
            F.transform(s, lambda x, i: F.struct(x["own"].alias("own"), F.get(s, i - 1)["at"].eqNullSafe(x["at"]).alias("hit"))),
            lambda x: x["own"] == 1),
        lambda x: x["hit"]))


def _reaches(combinator: str, hits: Column) -> Column:
    """Per element: does the combinator lead from it to a flagged one."""
    if combinator == " ":
        return let(running_count(hits), lambda upto: F.transform(
            F.col(NODES), lambda n: F.get(upto, n["last"]) > F.get(upto, n["pre"])))
    if combinator == ">":
        return _holds(hits)
    return beside(lambda n: F.get(hits, n["pre"]), adjacent=combinator == "+", after=True)


def _page_array(wanted: PageArray, body: Callable[[Column], Column]) -> Column:
    """Bind an array that a compound needs."""
    if wanted.kind == "type place":
        return let(type_places(from_end=bool(wanted.steps)), body)

    # from the last compound of the relative selector to the element it starts from
    def go(i: int, reached: Column | None) -> Column:
        if i < 0:
            return body(reached)
        combinator, compound = wanted.steps[i]

        def flags(condition: Predicate) -> Column:
            return F.transform(F.col(NODES), lambda n: F.coalesce(
                condition(n) if reached is None else condition(n) & F.get(reached, n["pre"]), F.lit(False)))

        return _bound(compound, lambda condition: let(flags(condition), lambda hits: let(
            _reaches(combinator, hits), lambda found: go(i - 1, found))))

    return go(len(wanted.steps) - 1, None)


def _bound(compound: Compound, body: Callable[[Predicate], Column]) -> Column:
    """Bind the arrays a compound needs, then hand ``body`` its test."""

    def go(arrays: list[Column]) -> Column:
        if len(arrays) == len(compound.needs):
            return body(lambda n: compound.test(n, arrays))
        return _page_array(compound.needs[len(arrays)], lambda found: go([*arrays, found]))

    return go([])


def _with_condition(steps: list[tuple[str, Compound]], body: Callable[[Predicate], Column]) -> Column:
    """Bind what the compounds and combinators need, then hand ``body`` the whole condition."""

    def go(i: int, condition: Predicate) -> Column:
        if i == len(steps):
            return body(condition)
        return _bound(steps[i][1], lambda own: after(i, condition, own))

    def after(i: int, condition: Predicate, own: Predicate) -> Column:
        combinator = steps[i][0]
        if combinator == " ":
            return let(
                running_end(condition),
                lambda ends: go(i + 1, lambda n: own(n) & (F.get(ends, n["pre"] - 1) >= n["pre"])),
            )
        if combinator == ">":
            flags = F.transform(F.col(NODES), lambda n: F.coalesce(condition(n), F.lit(False)))
            return let(flags, lambda f: go(i + 1, lambda n: own(n) & F.get(f, n["parent"])))
        flags = beside(condition, adjacent=combinator == "+")
        return let(flags, lambda f: go(i + 1, lambda n: own(n) & F.get(f, n["pre"])))

    return _bound(steps[0][1], lambda condition: go(1, condition))


def any_of(parts: list[Part], body: Callable[[Predicate], Column]) -> Column:
    """Hand ``body`` the condition that an element matches one of ``parts`` in the
    whole document; an empty part stands for the root element."""

    def go(i: int, conditions: list[Predicate]) -> Column:
        if i == len(parts):
            return body(lambda n: reduce(or_, [F.coalesce(c(n), F.lit(False)) for c in conditions]))
        steps = parts[i].steps or [("", plain(lambda n: n["pre"] == 0))]
        return _with_condition(steps, lambda condition: go(i + 1, [*conditions, condition]))

    return go(0, [])


def _ref(pre: Column, read: int) -> Column:
    return F.struct(pre.alias("pre"), F.lit(read).alias("read"))


def _no_ints() -> Column:
    return F.array().cast("array<int>")


class Selection:
    """An ordered list of matches, duplicates kept; turned into Columns on read.

    Built by ``css``.  ``refs`` makes an ``array<struct<pre,read>>``: the element
    and which of ``reads`` (html, text, attribute name) its comma part asked for.
    """

    def __init__(self, refs: Callable[[Callable[[Column], Column]], Column], reads: list[tuple[str, str | None]]) -> None:
        self._use = refs
        self._reads = reads

    # -- narrowing ---------------------------------------------------------

    def css(self, query: str) -> Selection:
        """Select inside each match, results joined in the order of the matches.

        Matches are descendants of the context element; the ancestors a
        combinator names may lie outside it.  An empty query (``"::text"``)
        reads the context element itself.
        """
        parts = selectors.parse(query)
        return Selection(lambda body: self._use(lambda refs: within_all(refs, parts, body)), _reads(parts))

    def item(self, index: int) -> Selection:
        """The match at ``index`` (negative counts from the end), or no match."""
        place = F.lit(index + 1 if index >= 0 else index)
        return self._map(lambda refs: F.array_compact(F.array(F.try_element_at(refs, place))))

    def slice(self, start: int | None = None, stop: int | None = None, step: int | None = None) -> Selection:
        if step == 0:
            raise ValueError("slice step cannot be zero")
        if step is not None and step != 1:
            return self._map(lambda refs: _stepped(refs, start, stop, step))

        def cut(refs: Column) -> Column:
            size = F.size(refs)

            def bound(i: int | None, default: Column) -> Column:
                if i is None:
                    return default
                return F.least(F.lit(i), size) if i >= 0 else F.greatest(size + i, F.lit(0))

            first = bound(start, F.lit(0))
            return F.slice(refs, first + 1, F.greatest(bound(stop, size) - first, F.lit(0)))

        return self._map(cut)

    def __getitem__(self, key: int | slice) -> Selection:
        if isinstance(key, slice):
            return self.slice(key.start, key.stop, key.step)
        return self.item(key)

    def __iter__(self):
        raise TypeError("a Selection is not iterable; use elements() and F.posexplode")

    def _map(self, change: Callable[[Column], Column]) -> Selection:
        return Selection(lambda body: self._use(lambda refs: let(change(refs), body)), self._reads)

    # -- reading -----------------------------------------------------------

    def value(self, ref: Column) -> Column:
        """What one match reads as."""
        n = node_at(ref["pre"])
        if len(self._reads) == 1:
            return _read(n, *self._reads[0])
        branch = F.when(ref["read"] == 0, _read(n, *self._reads[0]))
        for i, read in enumerate(self._reads[1:], 1):
            branch = branch.when(ref["read"] == i, _read(n, *read))
        return branch

    def refs(self) -> Column:
        """Matches as ``array<struct<pre,read>>``."""
        return self._use(lambda refs: refs)

    def elements(self) -> Column:
        """Matches as ``array<struct<pre,tag,attrs,value>>``, ready for ``posexplode``."""
        return self._use(lambda refs: F.transform(refs, lambda r: F.struct(
            r["pre"].alias("pre"),
            node_at(r["pre"])["tag"].alias("tag"),
            node_at(r["pre"])["attrs"].alias("attrs"),
            self.value(r).alias("value"),
        )))

    def getall(self) -> Column:
        return self._use(lambda refs: F.transform(refs, self.value))

    extract = getall

    def get(self, default: str | None = None) -> Column:
        """First value; ``default`` only when there is no match."""
        return self._use(lambda refs: F.when(F.size(refs) > 0, self.value(F.get(refs, F.lit(0)))).otherwise(F.lit(default)))

    extract_first = get

    def attrib(self) -> Column:
        """Attributes of the first match, an empty map if there is none."""
        return self._use(lambda refs: F.coalesce(
            node_at(F.get(refs, F.lit(0))["pre"])["attrs"],
            F.create_map().cast("map<string,string>"),
        ))

    def count(self) -> Column:
        return self._use(F.size)

    def re(self, regex: str | Pattern[str], *, replace_entities: bool = True) -> Column:
        """All captures over all values."""
        found = self._use(lambda refs: F.flatten(F.transform(refs, lambda r: captures(self.value(r), regex))))
        return decode_entities(found) if replace_entities else found

    def re_first(self, regex: str | Pattern[str], default: str | None = None, *, replace_entities: bool = True) -> Column:
        found = self.re(regex, replace_entities=replace_entities)
        return F.coalesce(F.get(found, F.lit(0)), F.lit(default))


def _stepped(refs: Column, start: int | None, stop: int | None, step: int) -> Column:
    """``refs[start:stop:step]`` as Python counts."""
    size, low, high = F.size(refs), F.lit(0 if step > 0 else -1), F.size(refs) - (0 if step > 0 else 1)

    def bound(i: int | None, default: Column) -> Column:
        return default if i is None else F.greatest(F.least(F.lit(i) if i >= 0 else size + i, high), low)

    first, end = bound(start, low if step > 0 else high), bound(stop, high if step > 0 else low)
    last = end - (1 if step > 0 else -1)
    some = last >= first if step > 0 else last <= first
    return F.transform(F.when(some, F.sequence(first, last, F.lit(step))).otherwise(_no_ints()), lambda i: F.get(refs, i))


def _read(n: Column, read: str, attr: str | None) -> Column:
    if read == "text":
        return node_text(n)
    return node_html(n) if read == "html" else node_attr(n, attr)


def _reads(parts: list[Part]) -> list[tuple[str, str | None]]:
    return list(dict.fromkeys((p.read, p.attr) for p in parts))


def css(query: str) -> Selection:
    """Select in the whole document."""
    parts = selectors.parse(query)
    reads = _reads(parts)

    def use(body: Callable[[Column], Column]) -> Column:
        lists = [_in_document(part, reads.index((part.read, part.attr))) for part in parts]
        return let(lists[0] if len(lists) == 1 else F.concat(*lists), body)

    return Selection(use, reads)


def _in_document(part: Part, read: int) -> Column:
    """The refs of one comma part over the whole page."""
    if not part.steps:
        root = F.filter(F.slice(F.col(NODES), 1, 1), lambda n: n["tag"].isNotNull())
        return F.transform(root, lambda n: _ref(n["pre"], read))
    return _with_condition(part.steps, lambda condition: F.transform(
        F.filter(F.col(NODES), condition), lambda n: _ref(n["pre"], read)))


def within_all(refs: Column, parts: list[Part], body: Callable[[Column], Column]) -> Column:
    """Evaluate ``parts`` inside every context, in context order."""
    return let(by_page_size(lambda counted: with_matchers(
        parts, lambda inside: F.flatten(F.transform(refs, lambda c: inside(c["pre"]))), counted=counted)), body)


def by_page_size(build: Callable[[bool], Column]) -> Column:
    """``build(counted)`` with counts on pages of many elements, by walks on others, where making counts would cost more."""
    return F.when(F.size(NODES) > _FEW_NODES, build(True)).otherwise(build(False))


def running_count(flags: Column) -> Column:
    """How many items of a boolean array, one per node, are true up to and including each place."""
    return F.aggregate(F.expr(_STEPS), F.transform(flags, lambda f: f.cast("int")), lambda seen, step: F.transform(
        seen, lambda x, i: x + F.coalesce(F.get(seen, i - step), F.lit(0))))


def with_matchers(parts: list[Part], body: Callable[[Callable[[Column], Column]], Column], *, counted: bool) -> Column:
    """Find the matches of each part once per page; ``body`` gets a function from a
    context element's number to the ``refs`` inside it.

    ``counted``: a part's matches are an array in document order and, per element, how many
    of them lie up to it.  A context's matches are the slice between two such counts, so
    reading it costs its matches alone, however large or deep its subtree is.  Otherwise
    matches are flags, and a context costs a walk over its subtree.
    """
    reads = _reads(parts)

    def go(i: int, found: list[tuple[Column, ...] | None]) -> Column:
        if i < len(parts):
            if not parts[i].steps:
                return go(i + 1, [*found, None])
            flagged = _with_condition(parts[i].steps, lambda cond: F.transform(
                F.col(NODES), lambda n: F.coalesce(cond(n), F.lit(False))))
            if not counted:
                return let(flagged, lambda flags: go(i + 1, [*found, (flags,)]))
            return let(flagged, lambda flags: let(_places(flags), lambda hits: let(
                running_count(flags), lambda upto: go(i + 1, [*found, (hits, upto)]))))

        def inside(pre: Column) -> Column:
            lists = [
                _in_context(pre, f, reads.index((part.read, part.attr)))
                for part, f in zip(parts, found, strict=True)
            ]
            return lists[0] if len(lists) == 1 else F.concat(*lists)

        return body(inside)

    return go(0, [])


def _places(flags: Column) -> Column:
    """The numbers of the flagged elements."""
    return F.filter(F.transform(flags, lambda f, i: F.when(f, i)), lambda i: i.isNotNull())


def _in_context(pre: Column, found: tuple[Column, ...] | None, read: int) -> Column:
    """The matches below ``pre``; without any search, the element itself."""
    if found is None:
        return F.array(_ref(pre, read))
    last = node_at(pre)["last"]
    if len(found) == 2:
        hits, upto = found
        first = F.get(upto, pre)
        return F.transform(F.slice(hits, first + 1, F.get(upto, last) - first), lambda j: _ref(j, read))
    below = F.when(last > pre, F.sequence(pre + 1, last)).otherwise(_no_ints())
    return F.transform(F.filter(below, lambda j: F.get(found[0], j)), lambda j: _ref(j, read))


def require_pieces(docs: DataFrame, *queries: str) -> None:
    """Say early, and clearly, that outer HTML was not kept by the parse."""
    for query in queries:
        if "markup" not in docs.columns and any(p.read == "html" for p in selectors.parse(query)):
            raise ValueError(f"{query!r} reads outer HTML: parse with keep=(\"text\", \"html\"), or read ::text or ::attr()")


def select(docs: DataFrame, query: str, *, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """One row per match: ``page_id, pos, pre, tag, value`` with ``pos`` from 0."""
    require_pieces(docs, query)
    return explode_structs(docs, css(query).elements(), keep=keep).drop("attrs")
