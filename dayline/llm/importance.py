"""Importance resampling towards a target distribution, over hashed word n-grams.

A table of 256 bytes lower-cases and blanks separators of the text's UTF-8 form, ``bytes.split``
gives its words, and CRC-32 values are extended word by word: the checksum of ``a b`` is that of
``" b"`` seeded with that of ``a``.  Counters add the features up.  Both distributions are counted
whole into a fixed number of buckets, so what travels to the driver and back is bounded by them.
Documents are drawn by Gumbel top-k: a seeded draw of each document is added to its weight and
the highest scores are taken; ranks are the places in ranges of the score, sorted side by side.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayline.llm.common import shared

GRAMS, BUCKETS, SEED, PERCENT, LEAST_WORDS = 1, 10_000, 2024, 10, 20
#: Digits and letters of words stay, as do bytes above ASCII; A-Z are lower-cased, the rest are blanks.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
#: Bytes of a text whose words are held at once.
SLICE_BYTES = 1 << 22


def words_of(text: bytes, most: int = SLICE_BYTES) -> Iterator[list[bytes]]:
    """Words of a text, in lists of those in about ``most`` bytes; no word is cut."""
    data = text.translate(WORD_BYTES)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + most)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def feature_counts(text: bytes | None, grams: int = GRAMS, most: int = SLICE_BYTES) -> tuple[Counter, int]:
    """Checksums of all runs of 1 to ``grams`` words with their numbers, and the number of words."""
    counts: Counter = Counter()
    total, tail = 0, []
    for new in words_of(text or b"", most):
        total += len(new)
        words = tail + new
        sums = list(map(crc32, words))
        counts.update(sums[len(tail) :])
        spaced = [b" " + w for w in words] if grams > 1 else []
        for k in range(2, grams + 1):
            sums = list(map(crc32, spaced[k - 1 :], sums))
            counts.update(sums[max(0, len(tail) - k + 1) :])  # the runs before lie in the last slice
        tail = words[max(0, len(words) - grams + 1) :]
    return counts, total


def bucket_counts(texts: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket; at most ``buckets`` numbers per task and in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                found, _ = feature_counts(text.as_py(), grams)
                for key, n in found.items():
                    total[key % buckets] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["bucket", "n"]
        )

    parts = texts.select(F.col("text").cast("binary").alias("text")).mapInArrow(count, "bucket long, n long")
    found = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(buckets, np.int64)
    counts[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return counts


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target to raw share of each bucket, each count one higher, rounded down."""
    n, raw_all, target_all = len(raw), int(raw.sum()), int(target.sum())
    ratio = lambda s, t: ((t + 1.0) * (raw_all + n)) / ((s + 1.0) * (target_all + n))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def noise(seed: int = SEED) -> Column:
    """Thousandths of a Gumbel draw that the seed and ``doc_id`` (null: empty) decide."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weighed(docs: DataFrame, target: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)`` per row of ``docs(doc_id, text)``: the gains of its features, added up."""
    made = gains(bucket_counts(docs, grams, buckets), bucket_counts(target, grams, buckets))
    sent = docs.sparkSession.sparkContext.broadcast(made)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_words", "n_features", "weight"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        for batch in batches:
            rows = []
            for text in batch["text"]:
                found, n_words = feature_counts(text.as_py(), grams)
                keys = np.fromiter(found.keys(), np.int64, len(found))
                times = np.fromiter(found.values(), np.int64, len(found))
                rows.append((n_words, int(times.sum()), int((gain[keys % buckets] * times).sum())))
            columns = np.array(rows, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *map(pa.array, columns.T)], names)

    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(weigh, f"doc_id {kind}, n_words long, n_features long, weight long")


def resample(
    docs: DataFrame, target: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS, seed: int = SEED,
    percent: int = PERCENT, least_words: int = LEAST_WORDS,
) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score, rank)`` per row of ``docs(doc_id, text)``.

    Of the N documents with at least ``least_words`` words, ``percent`` in a hundred are drawn (rounded
    down), those of the highest scores, ties to the smaller ``doc_id`` (null first); ``rank`` counts
    them from 1 and is null for all others.  Texts are weighed against ``target(text)``.  Null and empty texts
    have no features and weight 0.  Rows that repeat are scored alike and ranked one after the other;
    an empty target leaves every document what smoothing says; an empty table gives no rows.  Other
    columns are not read.
    """
    scored = weighed(docs, target, grams, buckets).withColumn("score", F.col("weight") + noise(seed))
    scored = shared(scored.withColumn("_fits", F.col("n_words") >= least_words))
    wanted = scored.where("_fits").count() * percent // 100
    # Rows in order of rank, those that may be drawn first, in ranges dealt to tasks; the written
    # table holds each row's range and place in it.
    order = [F.col("_fits").desc(), F.col("score").desc(), F.col("doc_id").asc()]
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = scored.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    placed = shared(ordered.withColumn("_at", F.monotonically_increasing_id()))
    at = {"_range": F.shiftright("_at", 33), "_place": F.col("_at").bitwiseAND((1 << 33) - 1)}
    sizes = placed.withColumns(at).groupBy("_range").agg(F.count(F.lit(1)).alias("n")).orderBy("_range").collect()
    before = np.cumsum([0] + [r["n"] for r in sizes])[:-1].tolist()
    offsets = docs.sparkSession.createDataFrame(
        [(r["_range"], b) for r, b in zip(sizes, before)], "_range long, _before long"
    )
    rank = F.col("_before") + F.col("_place") + 1
    return (
        placed.withColumns(at).join(F.broadcast(offsets), "_range")
        .withColumn("rank", F.when(rank <= wanted, rank))
        .select("doc_id", "n_words", "n_features", "weight", "score", "rank")
    )
