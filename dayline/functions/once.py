"""Compute expensive columns once per row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row.

    Expressions inside a generator (see ``once``) share nothing: a value that a rule names five times is
    computed five times.  A variable of a one-element array holds it.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``withColumns`` whose columns are evaluated once, whatever is done with them later.

    A filter on a computed column is pushed through projections by copying the
    expression, and a column used by many others is copied into each.  For rule chains
    over long texts that multiplies the cost.  A one-element generator keeps its result.
    """
    kept = [c for c in df.columns if c not in columns]
    packed = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_once")
    return df.select(*kept, packed).select(*kept, *[F.col(f"_once.{n}").alias(n) for n in columns])
