"""Session defaults and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the session options that results depend on (UTC) and the adaptive ones."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """Shared folder of ``spark.checkpoint.dir``; only a local session may go without one.

    A machine-local folder would lose data with its executor, so a cluster session that
    names no folder is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        sc = spark.sparkContext
        folder = sc.getCheckpointDir()
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="dayline-checkpoint-")
            sc.setCheckpointDir(folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage: write a table to the shared checkpoint folder and read it back.

    Unlike an RDD checkpoint the table is columnar and has a known size, so the joins
    that follow can be planned by it.
    """
    path = f"{checkpoint_folder(df.sparkSession)}/dayline-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.durable_path = path
    return table


def append(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Add rows to the table that ``durable`` wrote; a task that is repeated adds them once."""
    rows.write.mode("append").parquet(table.durable_path)
    more = table.sparkSession.read.schema(table.schema).parquet(table.durable_path)
    more.durable_path = table.durable_path
    return more


def discard(table: DataFrame) -> None:
    """Delete the table that ``durable`` wrote; nothing may read it any more."""
    path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.durable_path)
    path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
