"""Group helpers that hold when one key owns a third of all rows.

* ``top_per_group`` keeps k rows per group; Spark limits each map partition before
  the shuffle, so a hot group ships at most k rows per partition.
* ``number_rows`` numbers *all* rows of a group without putting the group into one
  task: rows are numbered inside small slices and shifted by the slice offsets.
* ``lookup`` joins many rows to one row per key in a form whose hot keys adaptive
  execution can split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_ROWS = 200_000


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First k rows per group by ``order`` (which must be total), with their rank."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    slices: Sequence[Column],
    out: str = "rn",
) -> DataFrame:
    """1-based row number over every row of each group.

    ``slices`` are columns that never decrease along ``order`` (for instance the score,
    then the position divided by ``SLICE_ROWS``), written in the same direction.
    """
    names = [f"_slice{i}" for i in range(len(slices))]
    sliced = df.withColumns(dict(zip(names, slices)))
    where = [*keys, *names]
    sizes = sliced.groupBy(*where).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*where, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy(*where).orderBy(*order)
    return (
        sliced.join(offsets, where)
        .withColumn(out, F.col("_offset") + F.row_number().over(within))
        .drop(*names, "_offset")
    )


def lookup(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join many left rows to a right side with one row per key (or a semi or anti join).

    The key hash is a join key of its own.  It is always equal when the keys are, and it
    makes both inputs of the join plain shuffles: an aggregated right side would bring its
    own partitioning, and adaptive execution only splits hot partitions between two
    shuffles.  So a key that owns a third of the left rows is spread over many tasks.
    """
    shard = F.xxhash64(*[F.col(k).cast("string") for k in on])
    return (
        left.withColumn("_shard", shard).join(right.withColumn("_shard", shard), [*on, "_shard"], how).drop("_shard")
    )


def explode_keys(df: DataFrame, carry: Sequence[str], fields: Sequence[str], values: Sequence[Column]) -> DataFrame:
    """One row per non-empty identity key: the equi-join form of an OR of equalities."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), v.cast("string").alias("value")) for f, v in zip(fields, values)])
    return df.select(*carry, F.explode(pairs).alias("_k")).select(*carry, "_k.field", "_k.value").where(
        F.col("value").isNotNull() & (F.col("value") != "")
    )
