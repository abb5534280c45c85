"""Language identification by error-correcting output codes.

Every language has a codeword; one binary classifier per bit, over hashed byte n-grams, predicts
that bit of the codeword.  Decoding weighs the loss of each bit by how well its classifier
separates the languages, takes the codeword of least loss, and flags a text whose best two
codewords are too close.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayline.llm.blocks import folded, grams, in_blocks, sums

#: Slots of the n-gram features; n-grams of each order go to slots of their own part.
BITS = 15
ORDERS = (2, 3)
SMOOTH = 0.5
#: A text is ambiguous when the best codeword has less than this share against the second.
MARGIN = 0.65
SHARPNESS = 12.0
#: Characters that are scored together: each n-gram holds a row of weights for as long.
SCORED = 1_000_000


def codewords(n: int, seed: int = 0) -> np.ndarray:
    """``n`` words of +1 and -1: all splits of up to six languages, else the best of seeded random codes."""
    if n <= 6:
        splits = [[1 if (s >> i) & 1 else -1 for i in range(n)] for s in range(1, 2 ** max(n - 1, 1))]
        return np.array(splits, float).T.reshape(n, -1)
    rng, best = np.random.default_rng(seed), None
    length = int(np.ceil(10 * np.log2(n)))
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], (n, length))
        far = (length - code @ code.T)[~np.eye(n, dtype=bool)].min()
        if best is None or far > best[0]:
            best = far, code
    code = best[1]
    return code[:, np.abs(code.sum(0)) < n]  # a bit that is equal for all languages tells nothing


def slots(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Feature slots of every n-gram of the texts, by order."""
    part = 1 << BITS
    for i, n in enumerate(ORDERS):
        value, bounds = grams(data, offsets, n)
        mixed = (value * np.uint32(2654435761)) >> np.uint32(32 - BITS)
        yield mixed.astype(np.int64) + i * part, bounds


def learn(docs: DataFrame) -> dict | None:
    """Classifiers from every row of ``docs(text, lang)`` with a language; None if there is none.

    Counts are summed by language and slot on the cluster; the model is ``languages x slots``.
    """
    width = len(ORDERS) << BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = [t or "" for t in batch["text"].to_pylist()], batch["lang"].to_pylist()
            for lang in sorted(set(langs)):
                mine = [t for t, l in zip(texts, langs) if l == lang]
                total = table.setdefault(lang, np.zeros(width, np.int64))
                for a, b in in_blocks(mine):
                    for slot, _ in slots(*folded(mine[a:b])):
                        total += np.bincount(slot, minlength=width)
        for lang, total in table.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(total[at])], ["lang", "slot", "n"])

    rows = docs.where("lang IS NOT NULL").select("text", F.col("lang").cast("string"))
    found = rows.mapInArrow(count, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    if found.empty:
        return None
    languages = sorted(found["lang"].unique())
    counts = np.zeros((len(languages), width))
    counts[[languages.index(l) for l in found["lang"]], found["slot"].to_numpy()] = found["n"]
    share = np.empty_like(counts)
    for i in range(len(ORDERS)):
        part = slice(i << BITS, (i + 1) << BITS)
        share[:, part] = (counts[:, part] + SMOOTH) / (counts[:, part] + SMOOTH).sum(1, keepdims=True)
    code = codewords(len(languages))
    weights = np.zeros((width, code.shape[1]), np.float32)
    for j in range(code.shape[1]):
        ones, zeros = share[code[:, j] > 0], share[code[:, j] < 0]
        if len(ones) and len(zeros):
            weights[:, j] = np.log(ones.mean(0)) - np.log(zeros.mean(0))
    # How far each classifier parts the languages: the mean n-gram of a language against its bit.
    mean = share @ weights / len(ORDERS)
    scale = np.maximum(np.abs(mean).mean(0), 1e-6)
    trust = np.maximum((mean * code).min(0) / scale, 0.05)
    return {"languages": languages, "code": code, "weights": weights, "scale": scale, "trust": trust / trust.sum() if code.size else trust}


def decode(bits: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Share of each language by the weighted loss of its codeword, and the bits (+1 or -1) as predicted."""
    code, trust = model["code"], model["trust"]
    if len(code) == 1:
        return np.ones((len(bits), 1)), np.ones((len(bits), 0))
    margins = code[None, :, :] * (bits / model["scale"])[:, None, :]
    loss = (np.logaddexp(0, -2 * margins) * trust).sum(2)
    share = np.exp(-SHARPNESS * (loss - loss.min(1, keepdims=True)))
    return share / share.sum(1, keepdims=True), np.where(bits > 0, 1, -1)


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """``(doc_id, lang_pred, score, ambiguous)`` per row of ``docs(doc_id, text)``.

    Only the text decides.  A null text, or one without a letter, is ``und`` with score 0, as is
    every text when nothing was learned.  Equal shares go to the first language by code point.
    Repeated rows get equal answers; an empty table gives none; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id " + docs.schema["doc_id"].dataType.simpleString() + ", lang_pred string, score double, ambiguous boolean"

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            names, scores, doubt = [], [], []
            for a, b in in_blocks(texts, SCORED):
                bits, seen = 0.0, 0
                for slot, bounds in slots(*folded(texts[a:b])):
                    bits = bits + sums(model["weights"][slot], bounds)
                    seen = seen + np.diff(bounds)
                share, _ = decode(bits / np.maximum(seen, 1)[:, None], model)
                best = share.argmax(1)
                names += [model["languages"][i] for i in best]
                scores.append(share.max(1))
                doubt.append(share.max(1) < MARGIN)
            empty = np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(names, pa.string()), pa.array(np.concatenate([empty, *scores])), pa.array(np.concatenate([empty, *doubt]).astype(bool))],
                ["doc_id", "lang_pred", "score", "ambiguous"],
            )

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select("doc_id", "text", lettered.alias("_lettered"))
    none = F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous")
    if model is None:
        return rows.select("doc_id", *none)
    told = rows.where("_lettered").select("doc_id", "text").mapInArrow(label, schema)
    return told.unionByName(rows.where("NOT _lettered").select("doc_id", *none))


def held_out(col: str = "doc_id"):
    """Rows that are never learned from: those whose checksum of the id leaves 2 by 4."""
    return F.coalesce(F.crc32(F.col(col).cast("string")) % 4 == 2, F.lit(False))
