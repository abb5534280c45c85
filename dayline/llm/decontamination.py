"""Benchmark decontamination through an FM-index of each training shard.

A shard is a block of whole documents as a sequence of word numbers.  Words that no test phrase
has can't be part of a match, so they are separators.  The shard's suffix array gives its
Burrows-Wheeler transform, a wavelet tree over that answers ranks, and backward search finds
all windows of the test phrases at once; sampled suffix positions locate the occurrences, and
the spans they cover are merged.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayline.llm.blocks import in_blocks

#: Words of a window, and rows of the index whose text position is kept (one in so many).
WINDOW, SAMPLE = 10, 16
#: Bytes of test phrases that one search holds; more phrases are searched in several parts.
PHRASE_BYTES = 32_000_000
#: A-Z lower-cased, other letters, digits and bytes above ASCII kept, anything else a space.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(WORDS).split()


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start of every suffix in order, by prefix doubling; the last symbol must be the only smallest."""
    _, rank = np.unique(text, return_inverse=True)
    n, step, rank = len(text), 1, rank.astype(np.int64)
    while True:
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1 or step >= n:
            return order
        step *= 2


class WaveletTree:
    """Ranks of symbols in a sequence: one bit vector with counts for each bit of the symbols."""

    def __init__(self, sequence: np.ndarray, size: int):
        self.levels = max(1, int(size - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in reversed(range(self.levels)):
            bit = (sequence >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(len(sequence) - int(bit.sum()))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each end."""
        start, end = np.zeros_like(end), end.copy()
        for i, level in enumerate(reversed(range(self.levels))):
            one = ((symbol >> level) & 1).astype(bool)
            ones_s, ones_e = self.ones[i][start], self.ones[i][end]
            start = np.where(one, self.zeros[i] + ones_s, start - ones_s)
            end = np.where(one, self.zeros[i] + ones_e, end - ones_e)
        return end - start


class FMIndex:
    """Backward search over a sequence of positive numbers (0 separates); holds nothing of the sequence itself."""

    def __init__(self, sequence: np.ndarray, size: int):
        text = np.concatenate([sequence.astype(np.int64) + 1, [0]])
        order = suffix_array(text)
        self.last = text[order - 1]
        self.tree = WaveletTree(self.last, size + 1)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size + 1))])
        self.sampled = order % SAMPLE == 0
        self.before = np.concatenate([[0], np.cumsum(self.sampled)])
        self.kept = order[self.sampled]

    def _back(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.first[symbol] + self.tree.rank(symbol, row)

    def search(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``[low, high)`` whose suffixes start with each window (row of numbers, filled up with 0)."""
        low, high = np.zeros(len(windows), np.int64), np.full(len(windows), len(self.last), np.int64)
        for step in range(windows.shape[1]):
            live = np.flatnonzero((lengths > step) & (low < high))
            symbol = windows[live, lengths[live] - 1 - step].astype(np.int64) + 1
            low[live], high[live] = self._back(symbol, low[live]), self._back(symbol, high[live])
        return low, np.maximum(high, low)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position of the suffix of each row: step back to a sampled one."""
        rows, at = rows.copy(), np.zeros(len(rows), np.int64)
        live = np.flatnonzero(~self.sampled[rows])
        while len(live):
            rows[live] = self._back(self.last[rows[live]], rows[live])
            at[live] += 1
            live = live[~self.sampled[rows[live]]]
        return self.kept[self.before[rows]] + at


def phrase_tables(items: list[tuple[str, str]], window: int = WINDOW) -> dict | None:
    """Word numbers, distinct windows and the items of each, from ``(item_id, text)`` rows."""
    numbers: dict[bytes, int] = {}
    found: dict[tuple[int, ...], set[str]] = {}
    for item, text in items:
        ids = [numbers.setdefault(w, len(numbers) + 1) for w in words_of(text)]
        for i in range(max(1, len(ids) - window + 1) if ids else 0):
            found.setdefault(tuple(ids[i : i + window]), set()).add(item)
    if not found:
        return None
    windows = sorted(found)
    lengths = np.fromiter(map(len, windows), np.int64, len(windows))
    table = np.zeros((len(windows), window), np.int32)
    for i, w in enumerate(windows):
        table[i, : len(w)] = w
    names = sorted({n for s in found.values() for n in s})
    place = {n: i for i, n in enumerate(names)}
    members = [sorted(place[n] for n in found[w]) for w in windows]
    return {
        "numbers": numbers, "windows": table, "lengths": lengths, "names": names,
        "members": np.array([m for ms in members for m in ms], np.int64), "bounds": np.concatenate([[0], np.cumsum([len(m) for m in members])]),
    }


def search_shard(texts: list[str | None], tables: dict) -> tuple[list[int], list[np.ndarray], list[list[str]]]:
    """Of each text: its number of words, the positions of its hit words, and the items that occur in it."""
    get = tables["numbers"].get
    ids, owner, place, sizes = [], [], [], []
    shortest = int(tables["lengths"].min())
    for i, text in enumerate(texts):
        words = words_of(text)
        sizes.append(len(words))
        known = np.fromiter(map(get, words, repeat(0)), np.int32, len(words))
        # Runs of known words that are shorter than any window hold no match.
        edge = np.flatnonzero(np.diff(np.concatenate([[0], known > 0, [0]]).astype(np.int8)))
        for a, b in zip(edge[::2], edge[1::2]):
            if b - a >= shortest:
                ids += [known[a:b], np.zeros(1, np.int32)]
                place.append(np.arange(a, b + 1))
                owner.append(np.full(b + 1 - a, i))
    hits: list[np.ndarray] = [np.zeros(0, np.int64)] * len(texts)
    names: list[list[str]] = [[] for _ in texts]
    if not ids:
        return sizes, hits, names
    owner, place = np.concatenate(owner), np.concatenate(place)
    index = FMIndex(np.concatenate(ids), len(tables["numbers"]) + 1)
    low, high = index.search(tables["windows"], tables["lengths"])
    which = np.flatnonzero(high > low)
    count = (high - low)[which]
    if not len(which):
        return sizes, hits, names
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    pattern = np.repeat(which, count)
    at = index.locate(np.repeat(low[which], count) + step)
    cover = np.zeros(len(owner) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + tables["lengths"][pattern], -1)
    hit = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
    docs, first = np.unique(owner[hit], return_index=True)
    for i, words in zip(docs, np.split(place[hit], first[1:])):
        hits[i] = words
    # Items by document: distinct windows first, as one passage may hold many.
    pairs = np.unique(owner[at] * np.int64(len(low)) + pattern)
    held, which = np.divmod(pairs, len(low))
    bounds = tables["bounds"]
    sizes_of = bounds[which + 1] - bounds[which]
    member = tables["members"][np.repeat(bounds[which], sizes_of) + np.arange(sizes_of.sum()) - np.repeat(np.cumsum(sizes_of) - sizes_of, sizes_of)]
    for key in np.unique(np.repeat(held, sizes_of) * np.int64(len(tables["names"])) + member):
        names[key // len(tables["names"])].append(tables["names"][key % len(tables["names"])])
    return sizes, hits, names


def runs(positions: np.ndarray) -> list[tuple[int, int]]:
    """Merged spans ``[start, end)`` of sorted positions."""
    if not len(positions):
        return []
    cut = np.flatnonzero(np.diff(positions) > 1)
    return list(zip(positions[np.concatenate([[0], cut + 1])].tolist(), (positions[np.concatenate([cut, [len(positions) - 1]])] + 1).tolist()))


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    data = text.encode("utf-8", "replace")
    words = [m.span() for m in re.finditer(rb"[^ ]+", data.translate(WORDS))]
    out, at = [], 0
    for a, b in spans:
        out.append(data[at : words[a][0]])
        at = words[b - 1][1]
    return b"".join([*out, data[at:]]).decode("utf-8", "replace")


def _parts(benchmark: DataFrame, window: int, most: int) -> list[dict]:
    """Phrase tables of at most about ``most`` bytes each; every item is in one."""
    rows = benchmark.where("text IS NOT NULL").select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // most))
    parts = (rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i).collect() for i in range(n))
    return [t for t in (phrase_tables([(r["item"], r["text"]) for r in part], window) for part in parts) if t]


def _marked(texts: list[str | None], sent: list) -> Iterator[tuple[int, list[tuple[int, int]], list[str]]]:
    """Number of words, merged spans of hit words and items of each text, shard by shard."""
    for a, b in in_blocks([t or "" for t in texts]):
        shard = texts[a:b]
        sizes, hits, names = [len(words_of(t)) for t in shard], [np.zeros(0, np.int64)] * len(shard), [[] for _ in shard]
        for tables in sent:
            _, more, found = search_shard(shard, tables.value)
            hits = [np.union1d(x, y) if len(x) else y for x, y in zip(hits, more)]
            names = [sorted({*x, *y}) for x, y in zip(names, found)]
        yield from zip(sizes, map(runs, hits), names)


def _sent(docs: DataFrame, benchmark: DataFrame, window: int, most: int) -> list:
    return [docs.sparkSession.sparkContext.broadcast(p) for p in _parts(benchmark, window, most)]


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = PHRASE_BYTES) -> DataFrame:
    """``(doc_id, n_words, spans, items)`` per row of ``docs(doc_id, text)``.

    A word of a document is hit when it lies in any occurrence of a window of ``window`` words
    of ``benchmark(item_id, text)``; an item of fewer words is one window.  ``spans`` are the
    maximal runs of hit words, ``items`` the sorted ids of items with an occurrence.  Null
    and empty texts have no words, and items without words no window.  Repeated rows, and equal
    items under several ids, each count.  Phrases beyond ``most`` bytes are held in parts, each
    searched over all documents before the spans are merged.  An empty benchmark hits nothing.
    """
    sent = _sent(docs, benchmark, window, most)
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_marked(batch["text"].to_pylist(), sent))
            spans = [[{"start": s, "end": e} for s, e in r] for _, r, _ in found]
            columns = [pa.array([n for n, _, _ in found], pa.int64()), pa.array(spans, span), pa.array([i for _, _, i in found], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], ["doc_id", "n_words", "spans", "items"])

    schema = f"doc_id {kind}, n_words long, spans array<struct<start: long, end: long>>, items array<string>"
    return docs.select("doc_id", "text").mapInArrow(search, schema)


def digest(found: DataFrame) -> DataFrame:
    """Counts of ``occurrences`` by document."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def remove_phrases(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = PHRASE_BYTES) -> DataFrame:
    """``docs(text)`` with all its columns; hit spans are cut out of ``text``.

    ``n_chars`` follows where there is one of whole numbers or of text; of another type it stays.  Rows keep their place and number; those without a hit, null texts among them, stay as they are.
    """
    sent = _sent(docs, benchmark, window, most)
    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(names.index("text")).to_pylist()
            spans = [r for _, r, _ in _marked(texts, sent)]
            clean = [without_spans(t, r) if r else t for t, r in zip(texts, spans)]
            columns = list(batch.columns)
            columns[names.index("text")] = pa.array(clean, columns[names.index("text")].type)
            at = names.index("n_chars") if "n_chars" in names else None
            written = None if at is None else int if pa.types.is_integer(columns[at].type) else str if pa.types.is_string(columns[at].type) else None
            if written:
                counted = [written(len(t)) if r else n for t, r, n in zip(clean, spans, columns[at].to_pylist())]
                columns[at] = pa.array(counted, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(cut, docs.schema)
