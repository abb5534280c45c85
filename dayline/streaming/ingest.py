"""Incremental ingestion: landed items to history entries, appended once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from dayline.operators.clean import identity, require_fields
from dayline.operators.key_index import KeyIndex
from dayline.operators.memory import appendable_by_index, claims
from dayline.sources.tables import append_history


def ingest(
    items: DataFrame, prepare: Callable[[DataFrame], DataFrame], index: KeyIndex, history_path: str, checkpoint: str
) -> DataStreamWriter:
    """Writer that appends the entries which neither history nor an earlier row knows.

    ``prepare`` makes entries of complete items with their identity keys.  The keys that are taken are the
    stream's state: ``index`` holds them, a batch meets the few buckets that its keys may be in, and adds its
    own when its entries are written.  History itself is never read.  A batch that is repeated, as after a restart
    between its two writes, replaces both.
    """

    def append(batch: DataFrame, number: int) -> None:
        append_history(appendable_by_index(prepare(batch), index, number), history_path, number)
        mine = batch.sparkSession.read.parquet(history_path).where(F.col("batch_id") == str(number))
        index.add(claims(mine), number)

    return identity(require_fields(items)).writeStream.option("checkpointLocation", checkpoint).foreachBatch(append)
