"""The strong keys of history as an index that appends maintain and look up in.

Keys lie in sorted files by bucket, a folder per bucket and batch.  Beside them stand bit filters: the keys
of a slice of a bucket set a few bits each of one bitmap.  A batch of claims is held against the filters first, which are
small; only buckets where a claim may be known are then read, and those are joined exactly.  A batch that
is repeated replaces its own keys, and does not meet them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayline.operators.groups import lookup

#: Bits of a filter's bitmap (fixed by the engine's bitmap functions), and bits that a key sets.
BITS, PROBES = 32_768, 4
_SHAPE = "value string, bucket int, batch_id string"


def _bits(value: Column) -> list[Column]:
    """The places that a key sets in its slice's bitmap."""
    return [F.pmod(F.xxhash64(value, F.lit(probe)), F.lit(BITS)).cast("int") for probe in range(PROBES)]


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, bit % 8).bitwiseAND(1) == 1


@dataclass(frozen=True)
class KeyIndex:
    """An index under ``path``; ``slices`` filters per bucket, each good for about 3,000 keys."""

    spark: SparkSession
    path: str
    buckets: int = 64
    slices: int = 16

    def _placed(self, keys: DataFrame) -> DataFrame:
        place = F.xxhash64("value", F.lit("place"))
        slice_of = F.pmod(F.floor(place / self.buckets), F.lit(self.slices)).cast("int")
        return keys.withColumns({"bucket": F.pmod(place, F.lit(self.buckets)).cast("int"), "slice": slice_of})

    def _table(self, name: str, shape: str) -> DataFrame:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        there = folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)
        return self.spark.read.schema(shape).parquet(f"{self.path}/{name}") if there else self.spark.createDataFrame([], shape)

    def add(self, keys: DataFrame, batch_id: int | str) -> None:
        """Enter ``keys(value)`` as those of a batch, in place of what it entered before."""
        placed = self._placed(keys.select("value").distinct()).withColumn("batch_id", F.lit(str(batch_id)))
        write = lambda rows, name: (
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id", "bucket").parquet(f"{self.path}/{name}")
        )
        rows = placed.select("value", "bucket", "batch_id").repartition("bucket").sortWithinPartitions("bucket", "value")
        write(rows, "keys")
        marks = placed.select("batch_id", "bucket", "slice", F.explode(F.array(*_bits(F.col("value")))).alias("bit"))
        write(marks.groupBy("batch_id", "bucket", "slice").agg(F.bitmap_construct_agg("bit").alias("bitmap")), "filters")

    def filters(self) -> DataFrame:
        """One bitmap per bucket and slice over all batches."""
        every = self._table("filters", "slice int, bitmap binary, batch_id string, bucket int")
        return every.groupBy("bucket", "slice").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))

    def candidates(self, claims: DataFrame) -> DataFrame:
        """Those of ``claims(value, ...)`` whose bits are all set, with their ``bucket``: all known ones, and a few more."""
        met = lookup(self._placed(claims), self.filters(), ["bucket", "slice"], "inner")
        every = None
        for bit in _bits(F.col("value")):
            found = _is_set(F.col("bitmap"), bit)
            every = found if every is None else every & found
        return met.where(every).drop("bitmap", "slice")

    def stored(self, buckets: list[int], but_of: int | str | None = None) -> DataFrame:
        """Keys of some buckets; no file of another is read.  ``but_of`` leaves a batch's own keys out."""
        rows = self._table("keys", _SHAPE).where(F.col("bucket").isin(buckets) if buckets else F.lit(False))
        return rows if but_of is None else rows.where(F.col("batch_id") != str(but_of))

    def known(self, claims: DataFrame, but_of: int | str | None = None) -> DataFrame:
        """Those of ``claims(value, ...)`` that the index holds, exactly."""
        likely = self.candidates(claims)
        touched = [r["bucket"] for r in likely.select("bucket").distinct().collect()]  # at most one per bucket
        held = self.stored(touched, but_of).select("bucket", "value").distinct()
        return lookup(likely, held, ["bucket", "value"], "left_semi").drop("bucket")
