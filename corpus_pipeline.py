"""From documents to a training mix: the operators in the order of a corpus build.

Quality, exact duplicates, near duplicates, benchmark passages, mix.  Each stage reads all rows
the one before kept; the driver of the stages writes them as Parquet between.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from dayline.llm import decontamination, exact_dedup, mixing, quality, simhash
from dayline.session import checkpoint_folder, configure


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of the benchmark."""
    return decontamination.remove_phrases(docs, _table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, with how many of their words it takes."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_duplicates),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("source mix", source_mix),
]

#: Fingerprints and the classifier's bins are outside SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder that the next stage reads."""
    configure(spark)
    docs = _table(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{folder}/{i}")
        docs = spark.read.schema(made.schema).parquet(f"{folder}/{i}")
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
