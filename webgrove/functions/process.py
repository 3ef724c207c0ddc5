"""User functions over URLs: of Columns, of Python strings, or UDFs already declared."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import PythonEvalType

#: What maps a list of URLs to as many URLs, null where one is dropped.
ListFunction = Callable[[list[str]], Iterable]


def _row_by_row(function: Callable) -> ListFunction:
    return lambda values: map(function, values)


def _series(function: Callable) -> ListFunction:
    return lambda values: function(pd.Series(values, dtype=object)).tolist()


def _series_parts(function: Callable) -> ListFunction:
    return lambda values: (v for part in function(iter([pd.Series(values, dtype=object)])) for v in part.tolist())


def _arrow(function: Callable) -> ListFunction:
    return lambda values: function(pa.array(values, pa.string())).to_pylist()


def _arrow_parts(function: Callable) -> ListFunction:
    return lambda values: (v for part in function(iter([pa.array(values, pa.string())])) for v in part.to_pylist())


_DECLARED: dict[int, Callable[[Callable], ListFunction]] = {
    PythonEvalType.SQL_BATCHED_UDF: _row_by_row,
    PythonEvalType.SQL_ARROW_BATCHED_UDF: _row_by_row,
    PythonEvalType.SQL_SCALAR_PANDAS_UDF: _series,
    PythonEvalType.SQL_SCALAR_PANDAS_ITER_UDF: _series_parts,
    PythonEvalType.SQL_SCALAR_ARROW_UDF: _arrow,
    PythonEvalType.SQL_SCALAR_ARROW_ITER_UDF: _arrow_parts,
}


def list_function(function: Callable) -> ListFunction | None:
    """How a Python function or a scalar UDF maps a batch of URLs; None for a function of Columns.

    A UDF is called once per batch with the URLs of all its pages, a plain function once per
    URL.  A plain function is one of Columns if it turns a Column into a Column; where both
    would work (``lambda u: u + "?a"``), an annotation ``str`` on its argument or result says
    that it is one of strings.
    """
    kind = getattr(function, "evalType", None)
    if kind is not None:
        if kind not in _DECLARED:
            raise TypeError("process_value takes scalar UDFs: plain, pandas or Arrow, over one string")
        if not isinstance(function.returnType, T.StringType):
            raise TypeError(f"process_value must return strings, not {function.returnType.simpleString()}")
        return _DECLARED[kind](function.func)
    return None if _of_columns(function) else _row_by_row(function)


def _of_columns(function: Callable) -> bool:
    try:
        signature = inspect.signature(function)
    except (TypeError, ValueError):
        signature = None
    if signature is not None:
        notes = [signature.return_annotation, *(p.annotation for p in list(signature.parameters.values())[:1])]
        if any(n is str or (isinstance(n, str) and n.split("|")[0].strip() == "str") or n == (str | None) for n in notes):
            return False
    try:
        return isinstance(function(F.col("url")), Column)
    except Exception:       # a function of strings fails on a Column in ways of its own
        return False


def checked(values: list[str], got: Iterable) -> list[str | None]:
    """One string or null for each value."""
    out = [None if v is None or v is pd.NA or v != v else v for v in got]
    if len(out) != len(values):
        raise ValueError(f"process_value returned {len(out)} values for {len(values)}")
    for v in out:
        if v is not None and not isinstance(v, str):
            raise TypeError(f"process_value must return strings or None, not {type(v).__name__}")
    return out
