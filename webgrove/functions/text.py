"""String functions on Columns: regex captures, entities, blanks, ``rel`` tokens."""

from __future__ import annotations

import html
import re
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webgrove.functions.udf import task_udf
from webgrove.schema import PIECES_TYPE

HTML_BLANKS = " \t\n\f\r"       # fixed value: the HTML standard's whitespace

# Fixed value: references that stay as written.
_KEPT = frozenset(("lt", "amp"))
_REFERENCE = re.compile(r"&(?:#\d+|#[xX][0-9a-fA-F]+|([A-Za-z0-9]+));?")


def nonempty(value: Column | str) -> Column:
    """True for a value that has content."""
    return F.coalesce(F.length(value), F.lit(0)) > 0


def strip_blanks(value: Column) -> Column:
    return F.btrim(value, F.lit(HTML_BLANKS))


def has_nofollow(rel: Column) -> Column:
    """``nofollow`` is one of the comma- or blank-separated tokens of ``rel``."""
    return F.coalesce(F.array_contains(F.split(rel, r"[,\s]+"), "nofollow"), F.lit(False))


_QUANTIFIER = re.compile(r"\{(?:(\d+)(,\d*)?|,(\d+))\}")
_UNSUPPORTED = re.compile(r"\(\?(?:\(|[aiLmsux]*[aLu][aiLmsux]*[-:)])")
_FLAGS = ((re.IGNORECASE, "i"), (re.MULTILINE, "m"), (re.DOTALL, "s"), (re.VERBOSE, "x"))


def _escaped(regex: str, at: int, in_class: bool) -> tuple[str, int]:
    """The escape at ``at`` as Java writes it, and its length."""
    two = regex[at:at + 2]
    if wide := re.match(r"\\U([0-9a-fA-F]{8})", regex[at:]):
        return f"\\x{{{wide[1]}}}", wide.end()
    if named := re.match(r"\\N\{([^}]*)\}", regex[at:]):
        return f"\\x{{{ord(unicodedata.lookup(named[1])):X}}}", named.end()
    if octal := re.match(r"\\(0[0-7]{0,2}|[1-3][0-7]{2})", regex[at:]):
        return f"\\x{{{int(octal[1], 8):X}}}", octal.end()
    if two == "\\b" and in_class:
        return "\\x08", 2
    return ("\\z" if two == "\\Z" else two), 2


def jvm_pattern(regex: str | re.Pattern[str]) -> str:
    """A Python pattern, as text or compiled, as Spark's regex functions read it.

    Character classes are Unicode's (unless compiled with ``re.ASCII``) and only a
    newline ends a line, as in Python; flags are carried over; named groups become
    plain ones; braces that begin no quantifier, and ``[`` and ``&`` inside a class, are
    literal.  What Java cannot express (conditional groups, inline ``(?a)``) raises
    ``ValueError``.
    """
    compiled = re.compile(regex)
    regex, numbers = compiled.pattern, compiled.groupindex
    if not isinstance(regex, str):
        raise TypeError("patterns over bytes are not offered")
    verbose = bool(compiled.flags & re.VERBOSE)
    flags = "d" + ("" if compiled.flags & re.ASCII else "U") + "".join(c for flag, c in _FLAGS if compiled.flags & flag)
    out, at, in_class = [f"(?{flags})"], 0, False
    while at < len(regex):
        char, size = regex[at], 1
        if char == "\\":
            text, size = _escaped(regex, at, in_class)
            out.append(text)
        elif in_class:
            in_class = char != "]"
            out.append("\\" + char if char in "[&" or verbose and (char.isspace() or char == "#") else char)
        elif char == "[":
            in_class = True
            size += regex.startswith("^", at + 1)
            out.append(regex[at:at + size])
            if regex.startswith("]", at + size):        # first in a class: literal
                out.append("\\]")
                size += 1
        elif char == "{":
            if count := _QUANTIFIER.match(regex, at):
                size = len(count[0])
                out.append(f"{{0,{count[3]}}}" if count[3] else count[0])
            else:
                out.append("\\{")
        elif char == "}":
            out.append("\\}")
        elif verbose and char == "#":
            size = (regex + "\n").index("\n", at) - at
        elif regex.startswith("(?#", at):
            size = regex.index(")", at) + 1 - at
        elif _UNSUPPORTED.match(regex, at):
            raise ValueError(f"this form has no counterpart in Spark's patterns: {regex[at:at + 8]!r} in {regex!r}")
        elif named := re.match(r"\(\?P<\w+>", regex[at:]):
            size = named.end()
            out.append("(")
        elif named := re.match(r"\(\?P=(\w+)\)", regex[at:]):
            size = named.end()
            out.append(f"(?:\\{numbers[named.group(1)]})")
        else:
            out.append(char)
        at += size
    return "".join(out)


def captures(value: Column, regex: str | re.Pattern[str]) -> Column:
    """Captures of every match, as an array: the groups of each match in turn, or
    the whole match without groups.  A group named ``extract`` means the first
    match of that group alone.
    """
    compiled = re.compile(regex)
    pattern = jvm_pattern(regex)
    literal = F.lit(pattern)
    if "extract" in compiled.groupindex:
        first = F.regexp_extract(value, pattern, compiled.groupindex["extract"])
        return F.when(value.rlike(pattern), F.array(first)).otherwise(F.array().cast(PIECES_TYPE))
    if compiled.groups < 2:
        found = F.regexp_extract_all(value, literal, F.lit(compiled.groups))
    else:
        groups = [F.regexp_extract_all(value, literal, F.lit(g + 1)) for g in range(compiled.groups)]
        zipped = F.arrays_zip(*(g.alias(f"g{i}") for i, g in enumerate(groups)))
        found = F.flatten(F.transform(zipped, lambda row: F.array(*(row[f"g{i}"] for i in range(compiled.groups)))))
    return F.coalesce(found, F.array().cast(PIECES_TYPE))


def _decode(text: str) -> str:
    def one(match: re.Match[str]) -> str:
        if (match.group(1) or "").lower() in _KEPT:
            return match.group()
        decoded = html.unescape(match.group())
        unknown = decoded == match.group()
        return "" if unknown and decoded.endswith(";") else decoded

    return _REFERENCE.sub(one, text)


@task_udf(PIECES_TYPE)
def _decode_lists(values: pa.Array) -> pa.Array:
    flat = values.flatten().to_pylist()
    lengths = pc.fill_null(pc.list_value_length(values), 0).to_pylist()
    offsets = [0]
    for n in lengths:
        offsets.append(offsets[-1] + n)
    decoded = [v if v is None or "&" not in v else _decode(v) for v in flat]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(decoded, pa.string()))


@task_udf(T.StringType())
def _decode_strings(values: pa.Array) -> pa.Array:
    return pa.array([v if v is None or "&" not in v else _decode(v) for v in values.to_pylist()], pa.string())


def decode_entities(value: Column, *, scalar: bool = False) -> Column:
    """Character references to characters, ``&lt;`` and ``&amp;`` kept."""
    return _decode_strings(value) if scalar else _decode_lists(value)
