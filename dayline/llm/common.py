"""Helpers shared by the operators: text forms, tables in the shared folder, hot-key joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayline.session import durable

#: Blank characters of the text contracts, as a pattern class.
BLANKS = r"[\x20\x09-\x0D]"


def content(col: str = "text") -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(col), F.lit(""))


def blank_words(col: Column) -> Column:
    """Number of words between blanks (null: 0)."""
    squeezed = F.regexp_replace(F.coalesce(col, F.lit("")), f"{BLANKS}+", " ")
    trimmed = F.trim(squeezed)
    return F.when(trimmed == "", F.lit(0).cast("long")).otherwise(
        (F.length(trimmed) - F.length(F.translate(trimmed, " ", "")) + 1).cast("long")
    )


def match_rows(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join many rows to one row per key, nulls matching nulls, so that a hot key can be split.

    The hash of the keys is a join key of its own: both inputs are then plain shuffles, and
    adaptive execution may deal a hot partition to several tasks.
    """
    names = {k: f"_right_{k}" for k in keys}
    renamed = right.select(*[F.col(c).alias(names.get(c, c)) for c in right.columns])
    l = left.withColumn("_hash_left", F.xxhash64(*keys))
    r = renamed.withColumn("_hash_right", F.xxhash64(*names.values()))
    on = l["_hash_left"] == r["_hash_right"]
    for k in keys:
        on = on & l[k].eqNullSafe(r[names[k]])
    return l.join(r, on, how).drop("_hash_left", "_hash_right", *names.values())


def shared(df: DataFrame) -> DataFrame:
    """Cut lineage through a table in the folder of ``spark.checkpoint.dir``."""
    return durable(df)
