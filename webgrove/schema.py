"""Row shapes that the operators exchange, and the checks made up front.

A page is parsed once into one ``docs`` row.  The tree is an array of element
structs in document order, so an element's number (``pre``) is also its array
index and its subtree is the index range ``pre .. last``.  Text and markup are
arrays of pieces: an element's text is a *slice of pieces*.  (Offsets into one
long string would make every read walk that string from its first byte.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

NODE_TYPE = T.StructType([
    T.StructField("pre", T.IntegerType()),        # document order, 0 = root element
    T.StructField("last", T.IntegerType()),       # greatest pre inside this subtree
    T.StructField("parent", T.IntegerType()),     # pre of the parent, -1 at the root
    T.StructField("depth", T.IntegerType()),
    T.StructField("sib", T.IntegerType()),        # 1-based place among element siblings
    T.StructField("nsib", T.IntegerType()),       # number of element siblings, itself included
    T.StructField("kids", T.IntegerType()),       # number of element children
    T.StructField("tag", T.StringType()),         # lower case; null once dropped
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("attr_names", T.ArrayType(T.StringType())),   # source order
    T.StructField("t0", T.IntegerType()),         # slice [t0, t1) of texts
    T.StructField("t1", T.IntegerType()),
    T.StructField("h0", T.IntegerType()),         # slice [h0, h1) of markup
    T.StructField("h1", T.IntegerType()),
])

NODES_TYPE = T.ArrayType(NODE_TYPE)
PIECES_TYPE = T.ArrayType(T.StringType())

PAGES_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

RESPONSES_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("headers", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    T.StructField("body", T.BinaryType()),
    T.StructField("has_override", T.BooleanType()),
    T.StructField("backend_override", T.StringType()),
])


def require(df: DataFrame, **columns: type[T.DataType]) -> None:
    """Fail while the plan is built when a column is missing or mistyped."""
    types = {f.name: f.dataType for f in df.schema.fields}
    for name, wanted in columns.items():
        if name not in types:
            raise ValueError(f"column {name!r} is required; found {sorted(types)}")
        if not isinstance(types[name], wanted):
            raise TypeError(f"column {name!r} must be {wanted.__name__}, found {types[name].simpleString()}")
