"""Hierarchical packing of documents into sequences of several context sizes.

Texts become token ids once.  What fills whole windows of the longest context is cut off a
document; the rest is routed to the smallest context size that holds it.  Tiers are packed
from the longest down: each rest of a tier opens a window of that size, and the gaps behind the
openers, laid end to end, are filled by the rests of shorter tiers, laid end to end as well,
shortest first, and cut where a gap ends.  Where the fill does not last for every window, the
shortest openers become fill too, so a window is full or isn't opened.  What is left in the end is less than the
shortest context and makes the one sequence that may need padding.

All this depends on the numbers of rests of each length alone: they are counted on the
cluster, the plan of the windows is made from those counts (at most as many as the longest
context has tokens), and a rest finds its windows from its length and its number among the
rests of that length.  No task sees more than its own rows.  Windows of a tier are dealt to the training
steps in turn, in the order of their openers, so that steps hold like numbers and lengths.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayline.llm.common import match_rows, shared

#: Context sizes, longest first; the id that ends a document; tokens of a training step.
TIERS, END, STEP_TOKENS = (2048, 1024, 512, 256), 1, 1 << 19
# How the vocabulary file's own library splits a text before the merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: Rows of an Arrow batch of pieces.
ROWS = 50_000


class Encoder:
    """Ids of a text by a byte-level BPE file, its special strings in texts taken as its library does.

    The ranks of the file run in a faster engine; what that engine refuses (runs of blanks beyond
    its stack) goes to the library itself.
    """

    def __init__(self, file: str):
        import tiktoken

        self.file, self.library = file, None
        made = json.loads(file)
        letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in letters}
        byte_of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(letters))}
        specials = {t["content"]: t["id"] for t in made["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in made["model"]["vocab"].items() if t not in specials}
        self.kind = "<u2" if max(ranks.values()) < 1 << 16 and max(specials.values(), default=0) < 1 << 16 else "<u4"
        self.fast = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=specials)

    def __call__(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            from tokenizers import Tokenizer

            self.library = self.library or Tokenizer.from_str(self.file)
            found = self.library.encode_batch_fast([text], add_special_tokens=False)[0]
            return np.array(found.ids, np.uint32)


def encoded(docs: DataFrame, tokenizer: str, window: int = TIERS[0], end: int = END) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: tokens, checksums of its whole windows, and the ids of the rest.

    ``(part, nth)`` numbers the rests of each length within a task, ``first`` the whole windows.
    """
    with open(tokenizer, encoding="utf-8") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n long, rest int, ids binary, sums array<bigint>, part int, nth long, first long"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = Encoder(sent.value), TaskContext.get().partitionId()
        seen, windows = np.zeros(window, np.int64), 0
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.append(encoder(text.as_py() or ""), np.uint32(end)).astype("<u4")
                whole, rest = divmod(len(ids), window)
                sums = [crc32(ids[k * window : (k + 1) * window]) for k in range(whole)]
                rows.append((len(ids), rest, ids[whole * window :].astype(encoder.kind).tobytes(), sums, part, int(seen[rest]), windows))
                seen[rest] += 1
                windows += whole
            columns = [list(c) for c in zip(*rows)] or [[] for _ in range(7)]
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                ["doc_id", "n", "rest", "ids", "sums", "part", "nth", "first"],
            )

    return docs.select("doc_id", "text").mapInArrow(encode, schema)


@dataclass
class Tier:
    """Windows of one size: how their openers lie by length, and where their gaps lie on the line of the fill.

    Openers of each of ``lengths``, which fall, have windows from number ``opens`` on, and gaps from place
    ``gaps`` on, counted from ``start``; the tier takes the line up to ``end``.
    """

    size: int
    base: int
    lengths: np.ndarray
    opens: np.ndarray
    gaps: np.ndarray
    start: int
    end: int


@dataclass
class Plan:
    """All tiers; ``line[r]`` is where rests of ``r`` tokens start on the line, ``opener[r]`` the first of them that opens a window."""

    tiers: list[Tier]
    line: np.ndarray
    opener: np.ndarray
    sequences: int


def plan(counts: np.ndarray, sizes: tuple[int, ...] = TIERS, base: int = 0) -> Plan:
    """Windows for ``counts[r]`` rests of ``r`` tokens each; sequence numbers start at ``base``.

    All rests lie on one line, shortest first.  A tier's openers are its longest rests, at the end of what
    the longer tiers left; its fill is taken from the front.
    """
    counts = np.asarray(counts, np.int64).copy()
    counts[0] = 0
    lengths = np.arange(len(counts), dtype=np.int64)
    ends = np.cumsum(counts * lengths)
    line, opener = ends - counts * lengths, counts.copy()
    tiers: list[Tier] = []
    at, back = 0, int(ends[-1])  # the line that is left

    def add(size: int, of: np.ndarray, number: np.ndarray) -> None:
        nonlocal at, base
        gap = number * (size - of)
        total, windows = int(gap.sum()), int(number.sum())
        tiers.append(Tier(size, base, of, np.cumsum(number) - number, np.cumsum(gap) - gap, at, at + total))
        at, base = at + total, base + windows

    for size, below in zip(sizes, (*sizes[1:], 0)):
        of = np.arange(min(size, len(counts) - 1), below, -1)
        # Rests of this tier that the fill before has not reached; one that it cut is fill itself.
        reached = np.clip(-((line[of] - at) // of), 0, counts[of]) if at else np.zeros(len(of), np.int64)
        number = counts[of] - reached
        tokens = int((number * of).sum())
        scarce = size * int(number.sum()) > back - at
        if scarce:  # as many windows as the tokens fill; the shortest openers become fill
            windows = (back - at) // size
            number = np.minimum(number, np.maximum(windows - (np.cumsum(number) - number), 0))
            tokens = int((number * of).sum())
        opener[of] = counts[of] - number
        back -= tokens
        add(size, of[number > 0], number[number > 0])
        if scarce:  # less than a window is left, in one stretch
            break
    for size in sizes:  # what no opener is left for
        if back - at >= size:
            add(size, np.zeros(1, np.int64), np.array([(back - at) // size]))
    if back > at:
        add(back - at, np.zeros(1, np.int64), np.ones(1, np.int64))
    return Plan(tiers, line, opener, base)


def places(made: Plan, sizes: tuple[int, ...], rest: int, number: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(start, length, sequence, offset, size)`` of the rest with this number among those of its length."""
    if number >= made.opener[rest]:
        home = max(i for i, size in enumerate(sizes) if size >= rest)
        tier = made.tiers[home]
        c = int(np.flatnonzero(tier.lengths == rest)[0])
        return [(0, rest, tier.base + int(tier.opens[c]) + number - int(made.opener[rest]), 0, tier.size)]
    found = []
    first = int(made.line[rest]) + number * rest
    at, end = first, first + rest
    for tier in made.tiers:
        while tier.start <= at < min(end, tier.end):
            c = int(np.searchsorted(tier.gaps, at - tier.start, "right")) - 1
            gap = tier.size - int(tier.lengths[c])
            window, inside = divmod(at - tier.start - int(tier.gaps[c]), gap)
            length = min(gap - inside, end - at)
            offset = int(tier.lengths[c]) + inside
            found.append((at - first, length, tier.base + int(tier.opens[c]) + window, offset, tier.size))
            at += length
    return found


def pack(
    docs: DataFrame, tokenizer: str, sizes: tuple[int, ...] = TIERS, end: int = END, step_tokens: int = STEP_TOKENS
) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, context, step)``, one row per piece.

    The ids of each row of ``docs(doc_id, text)``, with ``end`` behind them, are laid out without loss: a piece is
    ``length`` ids from ``start`` on, at ``offset`` of sequence ``sequence_id``, whose size is ``context`` (that of the last
    sequence is what was left).  ``sizes`` fall.  ``step`` deals the
    sequences to steps of about ``step_tokens``.  Null and empty texts are the one id ``end``; repeated rows are packed each;
    an empty table gives no rows; other columns are not read.  Long texts need memory for their own ids.
    """
    if list(sizes) != sorted(set(sizes), reverse=True):
        raise ValueError("sizes must fall")
    spark = docs.sparkSession
    made = shared(encoded(docs, tokenizer, sizes[0], end))
    by_length = made.groupBy("part", "rest").agg(F.count(F.lit(1)).alias("rows"))
    totals = by_length.groupBy("rest").agg(F.sum("rows").alias("rows")).collect()  # at most one row per length
    counts = np.zeros(sizes[0], np.int64)
    for r in totals:
        counts[r["rest"]] = r["rows"]
    tasks = made.groupBy("part").agg(F.sum(F.size("sums")).alias("whole"), F.sum("n").alias("n")).orderBy("part").collect()
    whole = np.cumsum([0] + [r["whole"] for r in tasks])
    steps = max(1, -(-sum(r["n"] for r in tasks) // step_tokens))
    layout = plan(counts, sizes, int(whole[-1]))
    sent = spark.sparkContext.broadcast((layout, {r["part"]: int(w) for r, w in zip(tasks, whole)}))
    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = by_length.select("part", "rest", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    rows = match_rows(made, ranks, ["part", "rest"])
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "context"]

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout, whole = sent.value
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("n", "rest", "ids", "sums", "part", "nth", "first", "before")]
            owner, found = [], []
            for i, (n, rest, ids, sums, part, nth, first, before) in enumerate(zip(*columns)):
                done = len(sums) * sizes[0]
                width = len(ids) // max(rest, 1)
                pieces = [
                    (k * sizes[0], sizes[0], crc, n, whole[part] + first + k, 0, sizes[0]) for k, crc in enumerate(sums)
                ]
                ids = np.frombuffer(ids, f"<u{width or 4}").astype("<u4")
                for start, length, sequence, offset, size in places(layout, sizes, rest, before + nth) if rest else ():
                    pieces.append((done + start, length, crc32(ids[start : start + length]), n, sequence, offset, size))
                owner += [i] * len(pieces)
                found += pieces
            table = np.array(found, np.int64).reshape(-1, 7)
            for a in range(0, len(owner), ROWS):
                of = batch["doc_id"].take(pa.array(owner[a : a + ROWS], pa.int64()))
                yield pa.RecordBatch.from_arrays([of, *map(pa.array, table[a : a + ROWS].T)], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    pieces = rows.mapInArrow(lay, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in names[1:]))
    return pieces.withColumn("step", F.col("sequence_id") % steps)
