"""Arrays inside a page row -> one row per item."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_structs(df: DataFrame, array: Column | str, *, keep: Iterable[str] = ()) -> DataFrame:
    """``keep``, ``pos`` (from 0) and the struct's fields; rows without items vanish.

    The outer form plus a filter on ``pos`` says the same as a plain explode, but
    a plain explode makes Spark infer ``size(array) > 0`` and evaluate the whole
    array expression a second time to test it.
    """
    rows = df.select(*keep, F.posexplode_outer(array).alias("pos", "_item"))
    return rows.where(F.col("pos").isNotNull()).select(*keep, "pos", "_item.*")
