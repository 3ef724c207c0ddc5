"""Pages to records: one row per container element, or one row per page."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webgrove.functions import selectors
from webgrove.functions.text import captures, decode_entities
from webgrove.operators.rows import explode_structs
from webgrove.operators.select import Selection, _reads, by_page_size, css, let, require_pieces, with_matchers


@dataclass(frozen=True)
class Field:
    """What one column of a record reads."""

    query: str
    many: bool = False              # all values as an array instead of the first
    default: str | None = None      # when nothing matches
    regex: str | None = None        # captures instead of the value


FieldLike = str | Field


def _fields(fields: Mapping[str, FieldLike]) -> dict[str, Field]:
    if not fields:
        raise ValueError("at least one field is required")
    return {name: f if isinstance(f, Field) else Field(f) for name, f in fields.items()}


def extract_page_fields(
    docs: DataFrame, fields: Mapping[str, FieldLike], *, keep: tuple[str, ...] = ("page_id", "url")
) -> DataFrame:
    """One row per page: the kept columns and each field read in the whole document."""
    columns, fields = [], _fields(fields)
    require_pieces(docs, *(f.query for f in fields.values()))
    for name, f in fields.items():
        found = css(f.query)
        if f.regex:
            value = found.re(f.regex) if f.many else found.re_first(f.regex, f.default)
        else:
            value = found.getall() if f.many else found.get(f.default)
        columns.append(value.alias(name))
    return docs.select(*keep, *columns)


def extract_records(
    docs: DataFrame, container: str, fields: Mapping[str, FieldLike], *, keep: tuple[str, ...] = ("page_id",)
) -> DataFrame:
    """One row per match of ``container``: ``page_id, pos`` and the fields read inside it.

    Records are built inside the page row and exploded last, so the parsed page
    is not copied once per record.
    """
    fields = _fields(fields)
    require_pieces(docs, *(f.query for f in fields.values()))
    names = list(fields)

    def build(i: int, inside: list[Callable[[Column], Column]], counted: bool) -> Column:
        if i < len(names):
            parts = selectors.parse(fields[names[i]].query)
            return with_matchers(parts, lambda match: build(i + 1, [*inside, match], counted), counted=counted)
        return F.transform(css(container).refs(), lambda c: F.struct(*(
            let(match(c["pre"]), _reader(fields[name])).alias(name)
            for name, match in zip(names, inside, strict=True)
        )))

    records = explode_structs(docs, by_page_size(lambda counted: build(0, [], counted)), keep=keep)
    for name, f in fields.items():
        if f.regex:
            records = records.withColumn(name, decode_entities(F.col(name), scalar=not f.many))
    return records


def _reader(f: Field) -> Callable[[Column], Column]:
    reads = _reads(selectors.parse(f.query))

    def read(refs: Column) -> Column:
        found = Selection(lambda body: body(refs), reads)
        if f.regex:
            values = F.flatten(F.transform(refs, lambda r: captures(found.value(r), f.regex)))
            return values if f.many else F.coalesce(F.get(values, F.lit(0)), F.lit(f.default))
        return found.getall() if f.many else found.get(f.default)

    return read
