"""Stage tables, run snapshots and publishing."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_stage(df: DataFrame, path: str, partition: str = "report_date") -> None:
    """Replace the report dates present in ``df`` and leave all others alone."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def write_snapshot(df: DataFrame, path: str, run_id: str) -> None:
    """Immutable copy of a stage under its run; writing the same run twice is an error."""
    df.write.mode("errorifexists").parquet(f"{path}/run_id={run_id}")


def read_snapshot(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """A stage as a given run left it; replays read this instead of copying files."""
    return spark.read.parquet(path).where(F.col("run_id") == run_id)


REPLAY_STAGES = {"raw": ("clean", "relevance", "memory_dedupe", "extract", "validate", "analyze"), "relevant": ("extract", "validate", "analyze"), "validated": ("analyze",)}


def replay_input(spark: SparkSession, base: str, run_id: str, stage: str) -> tuple[DataFrame, tuple[str, ...]]:
    """Snapshot of the stage to restart from and the steps left to run."""
    if stage not in REPLAY_STAGES:
        raise ValueError(f"cannot replay from {stage}")
    return read_snapshot(spark, f"{base}/{stage}", run_id), REPLAY_STAGES[stage]


def _pointers(spark: SparkSession, target: str) -> dict[int, str]:
    """Versions by the number of their publish; a pointer that was never written to is none."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{target}/pointer")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        name = status.getPath().getName()
        if name.isdigit() and status.getLen():
            stream = fs.open(status.getPath())
            found[int(name)] = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
    return found


def publish(df: DataFrame, target: str, version: str, check=None) -> int:
    """All or nothing: write a version aside, check what was written, then point to it; returns the publish's number.

    Pointers are small files named by rising numbers, each created by one publish only; one that finds its number
    taken has the next.  Until its pointer is written, and after a failing query or check, readers see
    the version before.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{target}/version={version}")
    if check is not None:
        check(spark.read.parquet(f"{target}/version={version}"))
    number = max(_pointers(spark, target), default=0)
    while True:
        number += 1
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/pointer/{number:012d}")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        try:
            stream = fs.create(path, False)
        except Py4JJavaError:
            if not fs.exists(path):
                raise
            continue
        stream.write(version.encode())
        stream.close()
        return number


def published(spark: SparkSession, target: str, number: int | None = None) -> DataFrame:
    """The version of the last publish, or of the one with this number."""
    versions = _pointers(spark, target)
    if not versions or (number is not None and number not in versions):
        raise ValueError(f"nothing was published to {target}" + ("" if number is None else f" as number {number}"))
    return spark.read.parquet(f"{target}/version={versions[max(versions) if number is None else number]}")


def append_history(df: DataFrame, path: str, batch_id: int | str) -> None:
    """Append a batch under its id; a repeated batch replaces itself instead of adding twice."""
    df.withColumn("batch_id", F.lit(str(batch_id))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)
