"""Toxicity by class-conditional Kneser-Ney models.

Two models over byte n-grams of folded text, one per class, have discounted counts of their
own and share the lower order: how many different n-grams end in the same bytes in either
class.  So an expression that is rare in both says little, and one that a class knows says
much.  A text has the mean log-likelihood ratio of all its n-grams, and that of its worst
passage; a logistic curve, fitted on learning rows that were not counted, makes a score of both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayline.llm.blocks import folded, grams, in_blocks, sums
from dayline.llm.common import match_rows, shared

ORDER = 4
DISCOUNT = 0.75
ALPHABET = 64
#: n-grams of a passage; slots of the model's table (two to that power), which bounds what is broadcast.
PASSAGE, SLOT_BITS, SLOT_FACTOR = 100, 20, 0x5851F42D
#: Contexts are numbered behind all n-grams where both are asked for.
CONTEXTS = 1 << 8 * ORDER
#: Widths of the bins that the curve is fitted on, and how many there are for each feature.
BIN, BINS = (0.005, 0.02), (200, 200)


def fold_of(col: str = "doc_id") -> Column:
    """Remainder by 5 of the checksum of the id; rows of remainder 0 are held out."""
    return F.coalesce(F.crc32(F.col(col).cast("string")) % 5, F.lit(0))


def count_grams(labelled: DataFrame) -> DataFrame:
    """``(gram, toxic, ordinary)`` of all n-grams of ``labelled(text, toxic)``, exact, summed by gram."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, marks = [t or "" for t in batch["text"].to_pylist()], np.asarray(batch["toxic"].to_pylist(), np.int64)
            for a, b in in_blocks(texts):
                value, bounds = grams(*folded(texts[a:b]), ORDER)
                mark = np.repeat(marks[a:b], np.diff(bounds))
                gram, place = np.unique(value, return_inverse=True)
                toxic = np.bincount(place, weights=mark, minlength=len(gram)).astype(np.int64)
                every = np.bincount(place, minlength=len(gram))
                yield pa.RecordBatch.from_arrays([pa.array(gram.astype(np.int64)), pa.array(toxic), pa.array(every - toxic)], ["gram", "toxic", "ordinary"])

    made = labelled.select("text", F.col("toxic").cast("int")).mapInArrow(count, "gram long, toxic long, ordinary long")
    return made.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def ratios(counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Log-likelihood ratios ``(gram, ratio, seen)`` of known n-grams, and ``(context, ratio, seen)`` for others."""
    d = F.lit(DISCOUNT)
    known = counted.withColumns({"context": F.shiftright("gram", 8), "suffix": F.col("gram").bitwiseAND((1 << 8 * (ORDER - 1)) - 1)})
    some = lambda c: F.sum((F.col(c) > 0).cast("long"))
    contexts = known.groupBy("context").agg(
        F.sum("toxic").alias("all_t"), F.sum("ordinary").alias("all_o"), some("toxic").alias("types_t"), some("ordinary").alias("types_o")
    )
    # Shared backoff: different n-grams that end in the same bytes, whatever class has them.
    suffixes = known.groupBy("suffix").agg(F.count(F.lit(1)).alias("ends")).withColumn("lower", F.shiftright("suffix", 8))
    lower = suffixes.groupBy("lower").agg(F.sum("ends").alias("lower_ends"), F.count(F.lit(1)).alias("lower_types"))
    backoff = suffixes.join(lower, "lower").select(
        "suffix", ((F.greatest(F.col("ends") - d, F.lit(0.0)) + d * F.col("lower_types") / ALPHABET) / F.col("lower_ends")).alias("shared")
    )
    rows = known.join(contexts, "context").join(backoff, "suffix")

    def left(c: str) -> Column:
        return F.when(F.col(f"all_{c}") > 0, d * F.col(f"types_{c}") / F.col(f"all_{c}")).otherwise(F.lit(1.0))

    def chance(col: str, c: str) -> Column:
        own = F.when(F.col(f"all_{c}") > 0, F.greatest(F.col(col) - d, F.lit(0.0)) / F.col(f"all_{c}")).otherwise(F.lit(0.0))
        return own + left(c) * F.col("shared")

    by_gram = rows.select("gram", F.log(chance("toxic", "t") / chance("ordinary", "o")).alias("ratio"), (F.col("toxic") + F.col("ordinary")).alias("seen"))
    by_context = contexts.select("context", F.log(left("t") / left("o")).alias("ratio"), (F.col("all_t") + F.col("all_o")).alias("seen"))
    return by_gram, by_context


def slot_of(value: np.ndarray, slots: int) -> np.ndarray:
    return ((value.astype(np.int64) * SLOT_FACTOR) >> 24) & (slots - 1)


def _table(rows: DataFrame, key: str, slots: int) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], DataFrame]:
    """Keys, ratios and whether others met there, by slot; and ``(key, ratio)`` of those others.

    Of keys that meet in one slot the most frequent has it; the slots bound the size.  The others stay a table.
    """
    slot = F.shiftright(F.col(key) * SLOT_FACTOR, 24).bitwiseAND(slots - 1)
    won = rows.groupBy(slot.alias("slot")).agg(F.max(F.struct("seen", key, "ratio")).alias("w"), (F.count(F.lit(1)) > 1).alias("more"))
    won = shared(won.select("slot", f"w.{key}", "w.ratio", "more"))
    found = won.toPandas()
    keys, values, more = np.full(slots, -1, np.int64), np.zeros(slots, np.float32), np.zeros(slots, bool)
    keys[found["slot"]], values[found["slot"]], more[found["slot"]] = found[key], found["ratio"], found["more"]
    others = rows.join(won.where("more").select(key), key, "left_anti").select(F.col(key).alias("key"), F.col("ratio").cast("float").alias("ratio"))
    return (keys, values, more), others


def _at(keys: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Whether sorted ``table`` holds each key, and its ratio there."""
    if not len(table[0]):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.float32)
    at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    return table[0][at] == keys, table[1][at]


def features(
    value: np.ndarray, bounds: np.ndarray, model: dict, rest: tuple[np.ndarray, np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Mean ratio of each text, the greatest mean of any ``PASSAGE`` n-grams in a row (of all if fewer), and what is open.

    Open are keys of each text that its slots do not answer, where others met in the slot; contexts are numbered
    behind n-grams.  ``rest`` answers them: sorted keys and their ratios.
    """
    keys, ratios_, more = model["grams"]
    slot = slot_of(value, len(keys))
    known = keys[slot] == value
    context = (value >> np.uint32(8)).astype(np.int64)
    low_keys, low_ratios, low_more = model["contexts"]
    low = slot_of(context, len(low_keys))
    held = low_keys[low] == context
    backed = np.where(held, low_ratios[low], np.float32(0))
    ask, ask_low = ~known & more[slot], ~known & ~held & low_more[low]
    open_keys = [np.zeros(0, np.int64)] * (len(bounds) - 1)
    if rest is not None:
        there, found = _at(context + CONTEXTS, rest)
        backed = np.where(ask_low & there, found, backed)
    elif ask.any() or ask_low.any():
        starts = bounds[:-1]
        for i in np.unique(np.searchsorted(starts, np.flatnonzero(ask | ask_low), "right") - 1):
            part = slice(bounds[i], bounds[i + 1])
            wanted = [value[part][ask[part]].astype(np.int64), context[part][ask_low[part]] + CONTEXTS]
            open_keys[i] = np.unique(np.concatenate(wanted))
    ratio = np.where(known, ratios_[slot], backed)
    if rest is not None:
        there, found = _at(value.astype(np.int64), rest)
        ratio = np.where(ask & there, found, ratio)
    n = np.diff(bounds)
    mean = sums(ratio, bounds) / np.maximum(n, 1)
    worst = mean.copy()
    total = np.concatenate([[0.0], np.cumsum(ratio, dtype=np.float64)])
    for i in np.flatnonzero(n > PASSAGE):
        a, b = bounds[i], bounds[i + 1]
        worst[i] = (total[a + PASSAGE : b + 1] - total[a : b + 1 - PASSAGE]).max() / PASSAGE
    return mean, worst, open_keys


def measured(docs: DataFrame, model: dict) -> DataFrame:
    """``(doc_id, mean, worst)`` per row of ``docs(doc_id, text)``.

    All texts are read by the slots.  Those with keys that met others in a slot ask the table of the others for
    them, text by text, and are read once more with the answers, so every ratio is that of its own n-gram.
    """
    sent = docs.sparkSession.sparkContext.broadcast({k: model[k] for k in ("grams", "contexts")})
    kind = docs.schema["doc_id"].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            both = [features(*grams(*folded(texts[a:b]), ORDER), sent.value) for a, b in in_blocks(texts)]
            columns = [pa.array(np.concatenate([np.zeros(0), *(x[k] for x in both)])) for k in (0, 1)]
            asked = pa.array([k for x in both for k in x[2]], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["digest"], *columns, asked], ["doc_id", "digest", "mean", "worst", "asked"])

    def measure_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = []
            for text, told in zip(batch["text"], batch["told"]):
                rest = told.values.field("key").to_numpy(), told.values.field("ratio").to_numpy()
                both.append(features(*grams(*folded([text.as_py() or ""]), ORDER), sent.value, rest)[:2])
            columns = [pa.array(np.concatenate([np.zeros(0), *(x[k] for x in both)])) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], ["doc_id", "mean", "worst"])

    texts = docs.select("doc_id", F.xxhash64("text").alias("digest"), "text")
    first = texts.mapInArrow(measure, f"doc_id {kind}, digest long, mean double, worst double, asked array<bigint>")
    if model["rest"] is None:
        return first.select("doc_id", "mean", "worst")
    first = shared(first)
    # Texts of one digest have their answers together; an answer to another text's question changes nothing.
    asked = first.select("digest", F.explode("asked").alias("key")).distinct()
    answers = asked.join(model["rest"], "key").groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("key", "ratio"))).alias("told"))
    answers = shared(answers)
    settled = first.join(answers.select("digest"), "digest", "left_anti").select("doc_id", "mean", "worst")
    again = match_rows(texts, answers, ["digest"]).select("doc_id", "text", "told").mapInArrow(measure_again, f"doc_id {kind}, mean double, worst double")
    return settled.unionByName(again)


def fit_curve(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve on weighted rows, with a small penalty; by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(x.shape[1]), np.diag([0.0] + [1e-3] * (x.shape[1] - 1))
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (y - p)) - penalty @ w
        step = np.linalg.solve(x.T @ (x * (n * p * (1 - p))[:, None]) + penalty + 1e-9 * np.eye(len(w)), slope)
        w = w + np.clip(step, -20, 20)
        if np.abs(step).max() < 1e-6:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, slot_bits: int = SLOT_BITS) -> dict | None:
    """Model and curve from all rows of ``docs`` that ``labels(doc_id, toxic)`` mark and that are not held out.

    The model has the ratios by slot, and as a table (``rest``) those that a slot has no room for; None if all have.
    Rows of folds 2 to 4 are counted, those of fold 1 fit the curve.  A document that is marked
    twice is toxic if one mark says so.  None if either fold lacks a class.
    """
    marks = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    marks = marks.withColumn("_fold", fold_of())
    texts = docs.where(fold_of() >= 1).select("doc_id", "text")
    # Texts are always shuffled to their marks, whatever the size of the labels: the plan is the same at every scale.
    counted = shared(count_grams(texts.where(fold_of() >= 2).join(marks.where("_fold >= 2").hint("merge"), "doc_id")))
    by_gram, by_context = ratios(counted)
    by_gram = shared(by_gram)
    grams_, rest = _table(by_gram, "gram", 1 << slot_bits)
    contexts, low = _table(shared(by_context), "context", 1 << slot_bits)
    rest = shared(rest.unionByName(low.withColumn("key", F.col("key") + CONTEXTS)))
    model = {"grams": grams_, "contexts": contexts, "rest": None if rest.isEmpty() else rest}
    rows = measured(texts.where(fold_of() == 1), model).join(marks.where("_fold = 1"), "doc_id")
    bins = [F.greatest(F.lit(-n), F.least(F.lit(n), F.round(F.col(c) / w))).cast("int").alias(c) for c, w, n in zip(("mean", "worst"), BIN, BINS)]
    seen = rows.select(*bins, "toxic").groupBy("mean", "worst", "toxic").agg(F.count(F.lit(1)).alias("n")).toPandas()
    if seen["toxic"].nunique() < 2 or not (model["grams"][1] > 0).any():
        return None
    model["curve"] = fit_curve(seen[["mean", "worst"]].to_numpy() * np.array(BIN), seen["toxic"].to_numpy(), seen["n"].to_numpy())
    return model


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """``(doc_id, score, predicted, mean, worst)`` per row of ``docs(doc_id, text)``.

    Only the text decides.  Null and empty texts, and texts without letters, have ratios of 0 and
    the score of those; without a model every score is 0.  Repeated rows get equal scores;
    an empty table gives none; other columns are not read.
    """
    if model is None:
        zero = F.lit(0.0)
        return docs.select("doc_id", zero.alias("score"), F.lit(0).alias("predicted"), zero.alias("mean"), zero.alias("worst"))
    a, b, c = map(float, model["curve"])
    z = F.lit(a) + F.col("mean") * b + F.col("worst") * c
    rows = measured(docs, model).withColumn("score", 1 / (1 + F.exp(-z)))
    return rows.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "mean", "worst")
