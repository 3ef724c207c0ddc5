"""Selector text -> predicates on an element struct (built on the driver).

A compound such as ``p.content[lang]`` becomes one boolean Column; combinators, and the
arrays that ``:has()`` and the tests of type need, are applied by ``webgrove.operators.select``.  Anything outside the forms below
raises ``SelectorError`` while the plan is built.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from operator import and_, or_
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

Predicate = Callable[[Column], Column]


class SelectorError(ValueError):
    """The selector is malformed or uses a form that is not offered."""


class PageArray(NamedTuple):
    """An array with an item per element that a test needs; ``operators.select`` builds it once per page.

    ``"type place"``: the element's place among its siblings of the same tag, counted from
    the end if ``steps`` is not empty.  ``"has"``: whether the relative selector ``steps`` leads
    from the element to some other one.
    """

    kind: str
    steps: list


class Compound(NamedTuple):
    """``test(n, arrays)``: does element ``n`` match, given the page's arrays that ``needs`` names."""

    needs: list[PageArray]
    test: Callable[[Column, list[Column]], Column]


class Part(NamedTuple):
    """One comma part: what to match (empty = the current element) and what to read."""

    steps: list[tuple[str, Compound]]      # (combinator before it, compound)
    read: str                              # "html", "text" or "attr"
    attr: str | None


_IDENT = r"(?:--|-?(?:[_a-zA-Z\u0080-\U0010ffff]|\\.))(?:[\w\-\u0080-\U0010ffff]|\\.)*"
_SIMPLE = re.compile(
    rf"(?P<tag>\*|{_IDENT})"
    rf"|\#(?P<id>(?:[\w\-\u0080-\U0010ffff]|\\.)+)"
    rf"|\.(?P<cls>{_IDENT})"
    rf"|\[\s*(?P<attr>{_IDENT})\s*(?:(?P<op>[~|^$*]?=)\s*"
    rf"(?:\"(?P<double>[^\"]*)\"|'(?P<single>[^']*)'|(?P<bare>[^\s\"'\]]+))\s*(?P<flag>[iIsS])?\s*)?\]"
    rf"|(?<!:):(?P<pseudo>{_IDENT})(?P<call>\()?"
)
_COMBINATOR = re.compile(r"\s*([>+~])\s*|(\s+)")
_NTH = re.compile(r"\s*(?:(?P<word>odd|even)|(?P<a>[+-]?\d*)n\s*(?:(?P<sign>[+-])\s*(?P<b>\d+))?|(?P<only>[+-]?\d+))\s*", re.I)
_READ_ATTR = re.compile(r"::attr\(([^)]+)\)$")


def parse(query: str) -> list[Part]:
    """Comma parts in the order written; each keeps its own read."""
    return [_part(text) for text in _split(query)]


def _split(query: str) -> list[str]:
    """Split on commas outside quotes, brackets and parentheses."""
    parts, depth, quote, start = [], 0, "", 0
    for i, char in enumerate(query):
        if quote:
            quote = "" if char == quote else quote
        elif char in "\"'":
            quote = char
        elif char in "[(":
            depth += 1
        elif char in "])":
            depth -= 1
        elif char == "," and not depth:
            parts.append(query[start:i])
            start = i + 1
    if quote or depth:
        raise SelectorError(f"unbalanced selector: {query!r}")
    return [p.strip() for p in (*parts, query[start:])]


def _part(text: str) -> Part:
    read, attr = "html", None
    if text.endswith("::text"):
        text, read = text[:-6], "text"
    elif match := _READ_ATTR.search(text):
        text, read, attr = text[:match.start()], "attr", match.group(1)
    text = text.strip()
    return Part(_steps(text) if text else [], read, attr)


def _steps(text: str) -> list[tuple[str, Compound]]:
    steps, at, combinator = [], 0, ""
    while True:
        compound, at = _compound(text, at)
        steps.append((combinator, compound))
        if at == len(text):
            return steps
        match = _COMBINATOR.match(text, at)
        if not match:
            raise SelectorError(f"cannot read {text[at:]!r} in selector {text!r}")
        combinator, at = match.group(1) or " ", match.end()


def plain(test: Predicate) -> Compound:
    """A test of the element alone."""
    return Compound([], lambda n, _: test(n))


def _joined(compounds: list[Compound], combine: Callable[[list[Column]], Column]) -> Compound:
    """Several tests of one element as one; each sees the arrays it needs."""
    needs, ends = [], []
    for compound in compounds:
        needs += compound.needs
        ends.append(len(needs))

    def test(n: Column, arrays: list[Column]) -> Column:
        return combine([c.test(n, arrays[end - len(c.needs):end]) for c, end in zip(compounds, ends, strict=True)])

    return Compound(needs, test)


def _compound(text: str, at: int) -> tuple[Compound, int]:
    tests: list[Compound] = []
    start, tagged = at, False
    while match := _SIMPLE.match(text, at):
        at = match.end()
        if match["tag"]:
            if tests:
                raise SelectorError(f"type selector must come first in {text[start:]!r}")
            if match["tag"] != "*":
                tagged = True
                tests.append(plain(_tag(_unescape(match["tag"]).lower())))
        elif match["id"]:
            tests.append(plain(_attribute("id", "=", _unescape(match["id"]), fold=False)))
        elif match["cls"]:
            tests.append(plain(_attribute("class", "~=", _unescape(match["cls"]), fold=False)))
        elif match["attr"]:
            value = next((match[k] for k in ("double", "single", "bare") if match[k] is not None), "")
            fold = (match["flag"] or "").lower() == "i"
            tests.append(plain(_attribute(_unescape(match["attr"]).lower(), match["op"], _unescape(value), fold=fold)))
        else:
            argument = None
            if match["call"]:
                end = _closing(text, at)
                argument, at = text[at:end], end + 1
            tests.append(_pseudo(match["pseudo"].lower(), argument))
    if at == start:
        raise SelectorError(f"cannot read {text[at:]!r} in selector {text!r}")
    if not tagged:      # a dropped element has no tag and matches nothing
        tests.insert(0, plain(lambda n: n["tag"].isNotNull()))
    return _joined(tests, lambda found: reduce(and_, found)), at


def _closing(text: str, at: int) -> int:
    depth = 1
    for i in range(at, len(text)):
        depth += {"(": 1, ")": -1}.get(text[i], 0)
        if not depth:
            return i
    raise SelectorError(f"unbalanced selector: {text!r}")


def _unescape(text: str) -> str:
    return re.sub(
        r"\\(?:([0-9a-fA-F]{1,6})\s?|(.))",
        lambda m: chr(int(m.group(1), 16)) if m.group(1) else m.group(2),
        text,
    )


def _tag(name: str) -> Predicate:
    return lambda n: n["tag"] == name


def has_token(value: Column, token: str) -> Column:
    """``token`` is one of the blank-separated tokens of ``value``."""
    padded = F.concat(F.lit(" "), F.translate(value, "\t\n\f\r", "    "), F.lit(" "))
    return F.contains(value, F.lit(token)) & F.contains(padded, F.lit(f" {token} "))


def _attribute(name: str, op: str | None, wanted: str, *, fold: bool) -> Predicate:
    def test(n: Column) -> Column:
        present = F.map_contains_key(n["attrs"], name)
        if op is None:
            return present
        value = F.coalesce(n["attrs"][name], F.lit(""))
        want = wanted
        if fold:
            value, want = F.lower(value), wanted.lower()
        if op == "=":
            return present & (value == want)
        if op == "|=":
            return present & ((value == want) | value.startswith(want + "-"))
        if not want or (op == "~=" and re.search(r"[ \t\n\f\r]", want)):
            return F.lit(False)
        if op == "~=":
            return has_token(value, want)
        if op == "^=":
            return value.startswith(want)
        return value.endswith(want) if op == "$=" else value.contains(want)

    return test


def _pseudo(name: str, argument: str | None) -> Compound:
    if argument is None and name in _PLAIN_PSEUDO:
        return plain(_PLAIN_PSEUDO[name])
    if argument is None and name in _TYPE_PLACES:
        return _joined([_of_type(lambda place: place == 1, from_end=end) for end in _TYPE_PLACES[name]], lambda found: reduce(and_, found))
    if argument is not None and name in ("nth-child", "nth-last-child"):
        test = _nth(argument)
        if name == "nth-child":
            return plain(lambda n: test(n["sib"]))
        return plain(lambda n: test(n["nsib"] - n["sib"] + 1))
    if argument is not None and name in ("nth-of-type", "nth-last-of-type"):
        return _of_type(_nth(argument), from_end=name == "nth-last-of-type")
    if argument is not None and name == "has":
        options = [_has(text) for text in _split(argument)]
        return _joined(options, lambda found: reduce(or_, found))
    if argument is not None and name in ("not", "is", "where"):
        options = []
        for text in _split(argument):
            steps = _steps(text)
            if len(steps) > 1:
                raise SelectorError(f":{name}({argument}) may only hold compound selectors")
            options.append(steps[0][1])

        def any_option(found: list[Column]) -> Column:
            return reduce(or_, [F.coalesce(f, F.lit(False)) for f in found])

        return _joined(options, (lambda found: ~any_option(found)) if name == "not" else any_option)
    raise SelectorError(f"pseudo-class not offered: :{name}")


#: From which ends an element must be the first of its tag.
_TYPE_PLACES = {"first-of-type": (False,), "last-of-type": (True,), "only-of-type": (False, True)}


def _of_type(test: Predicate, *, from_end: bool) -> Compound:
    return Compound([PageArray("type place", ["from end"] if from_end else [])], lambda n, arrays: test(F.get(arrays[0], n["pre"])))


def _has(text: str) -> Compound:
    """A relative selector; without a combinator in front it leads to descendants."""
    first = re.match(r"([>+~])\s*", text)
    steps = _steps(text[first.end():] if first else text)
    steps[0] = (first.group(1) if first else " ", steps[0][1])
    return Compound([PageArray("has", steps)], lambda n, arrays: F.get(arrays[0], n["pre"]))


_PLAIN_PSEUDO: dict[str, Predicate] = {
    "root": lambda n: n["parent"] < 0,
    "first-child": lambda n: n["sib"] == 1,
    "last-child": lambda n: n["sib"] == n["nsib"],
    "only-child": lambda n: n["nsib"] == 1,
    # the pieces' text, not their number: those of dropped elements are empty
    "empty": lambda n: (n["kids"] == 0) & (F.array_join(F.slice(F.col("texts"), n["t0"] + 1, n["t1"] - n["t0"]), "") == ""),
}


def _nth(argument: str) -> Predicate:
    """Whether a place, counted from 1, is one of those that ``an+b`` names."""
    match = _NTH.fullmatch(argument)
    if not match:
        raise SelectorError(f"cannot read the places {argument!r}")
    if match["word"]:
        a, b = 2, int(match["word"].lower() == "odd")
    elif match["only"]:
        a, b = 0, int(match["only"])
    else:
        a = int(match["a"] + "1") if match["a"] in ("", "+", "-") else int(match["a"])
        b = int((match["sign"] or "") + (match["b"] or "0"))

    def test(place: Column) -> Column:
        if not a:
            return place == b
        steps = (place - b) * (1 if a > 0 else -1)
        return (steps >= 0) & (steps % abs(a) == 0)

    return test
