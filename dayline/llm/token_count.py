"""Token counts by a compiled finite-state tokenizer.

The pre-tokenizer is a deterministic transducer over classes of code points: its transitions
say where a pre-token starts, and each start carries the number of tokens that the merges
make of that pre-token.  Text is cut into chunks of equal size, wherever they fall; the state
map of every chunk (entry state -> exit state) is found for all chunks at once, a prefix scan
composes the maps, and so every chunk knows its entry state.  Weights of pre-tokens are
compiled when first met, for all new ones of a batch together, and kept in a bounded table.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayline.llm.blocks import in_blocks

# Classes of code points: space, other letter, number, other, apostrophe, letters of contractions.
SPACE, LETTER, NUMBER, OTHER, QUOTE, SINGLE, R, V, E, ELL = range(10)
# States: no open pre-token, in letters, in other signs, behind an apostrophe, behind 'r, 'v, 'l.
BETWEEN, LETTERS, SIGNS, AFTER_QUOTE, AFTER_R, AFTER_V, AFTER_L = range(7)
#: Outputs of a transition: a pre-token starts here, or at the character before (or both).
HERE, BEFORE = 1, 2
#: Code points of a chunk, of a piece of a long text, and pre-tokens whose weight is kept.
CHUNK, PIECE, KEPT_WEIGHTS = 512, 1 << 20, 1 << 20
#: Bytes of a word from which its pairs are kept in a heap.
LONG_WORD = 512


def transducer() -> tuple[np.ndarray, np.ndarray]:
    """Next state and output by state and class, for the split pattern that ``compiled`` checks for."""
    letters = (LETTER, SINGLE, R, V, E, ELL)
    to, out = np.zeros((7, 10), np.uint8), np.zeros((7, 10), np.uint8)
    for state in range(7):
        # Behind an unfinished contraction, the letter before turns out to start a run of letters.
        waits = BEFORE if state in (AFTER_R, AFTER_V, AFTER_L) else 0
        to[state, SPACE], out[state, SPACE] = BETWEEN, waits
        to[state, NUMBER], out[state, NUMBER] = BETWEEN, waits | HERE
        to[state, OTHER], out[state, OTHER] = SIGNS, waits | HERE
        to[state, QUOTE], out[state, QUOTE] = AFTER_QUOTE, waits | HERE
        for c in letters:
            to[state, c], out[state, c] = LETTERS, waits or HERE
    for c in letters:
        out[LETTERS, c] = 0
    for state in (SIGNS, AFTER_QUOTE):
        for c in (OTHER, QUOTE):
            to[state, c], out[state, c] = SIGNS, 0
    for c, state in ((R, AFTER_R), (V, AFTER_V), (ELL, AFTER_L)):
        to[AFTER_QUOTE, c], out[AFTER_QUOTE, c] = state, 0
    for state, c in ((AFTER_QUOTE, SINGLE), (AFTER_R, E), (AFTER_V, E), (AFTER_L, ELL)):
        to[state, c], out[state, c] = BETWEEN, 0
    return to, out


def code_point_classes() -> np.ndarray:
    """Class of each code point."""
    import regex

    table = np.full(0x110000, OTHER, np.uint8)
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    every = "".join(map(chr, points))
    for pattern, value in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        for m in regex.finditer(f"{pattern}+", every):
            first, last = points[m.start()], points[m.end() - 1]
            table[first : last + 1] = value
    for sign, value in (("'", QUOTE), ("s", SINGLE), ("t", SINGLE), ("m", SINGLE), ("d", SINGLE), ("r", R), ("v", V), ("e", E), ("l", ELL)):
        table[ord(sign)] = value
    return table


def byte_letters() -> list[str]:
    """The sign that stands for each byte in byte-level vocabularies: printable ones for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    signs = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [signs[b] for b in range(256)]


#: The only split this transducer is for.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def compiled(path: str) -> dict:
    """Tables of a tokenizer file: classes, transitions, merges and special strings.  Bounded by the file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
    steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
    if model["type"] != "BPE" or pre[0]["pattern"]["Regex"] != SPLIT or steps != ["NFC", "Replace", "Lowercase"]:
        raise ValueError(f"{path}: not a tokenizer of the kind that this transducer compiles")
    vocab, size, end = model["vocab"], len(model["vocab"]), model["end_of_word_suffix"] or ""
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    keys = np.array([vocab[a] * size + vocab[b] for a, b in merges], np.int64)
    order = np.argsort(keys, kind="stable")
    made = np.array([vocab[a + b] for a, b in merges], np.int64)
    signs = byte_letters()
    to, out = transducer()
    return {
        "classes": code_point_classes(), "to": to, "out": out, "size": size, "keys": keys[order], "ranks": order.astype(np.int64),
        "made": made, "inner": np.array([vocab[s] for s in signs], np.int64), "last": np.array([vocab[s + end] for s in signs], np.int64),
        "specials": [t["content"] for t in spec["added_tokens"]],
    }


def entry_states(classes: np.ndarray, to: np.ndarray, first: int = BETWEEN) -> tuple[np.ndarray, int]:
    """State before each chunk (rows of ``classes``) and after the last: maps per chunk, composed by a scan."""
    maps = np.repeat(np.arange(7, dtype=np.uint8)[None, :], len(classes), axis=0)
    flat = to.ravel()
    for step in range(classes.shape[1]):
        maps = flat[maps * np.uint8(10) + classes[:, step, None]]
    reach = 1
    while reach < len(maps):  # maps[i] becomes the composition of all chunks up to i
        maps = np.concatenate([maps[:reach], np.take_along_axis(maps[reach:], maps[:-reach].astype(np.intp), axis=1)])
        reach *= 2
    after = maps[:, first]
    return np.concatenate([[first], after[:-1]]).astype(np.uint8), int(after[-1])


def starts_and_ends(points: np.ndarray, tables: dict) -> tuple[np.ndarray, np.ndarray]:
    """Where the pre-tokens of a text (as code points) start and end."""
    n = len(points)
    classes = np.full(-(-(n + 1) // CHUNK) * CHUNK, SPACE, np.uint8)  # a space behind the end closes what is open
    classes[:n] = tables["classes"][points]
    chunks = classes.reshape(-1, CHUNK)
    state, _ = entry_states(chunks, tables["to"])
    flat_to, flat_out = tables["to"].ravel(), tables["out"].ravel()
    out = np.empty(chunks.shape, np.uint8)
    for step in range(CHUNK):
        at = state * np.uint8(10) + chunks[:, step]
        out[:, step], state = flat_out[at], flat_to[at]
    out = out.ravel()
    is_start = (out & HERE) > 0
    is_start[:-1] |= (out[1:] & BEFORE) > 0
    starts = np.flatnonzero(is_start)
    # A pre-token ends where the next starts or a space stands.
    spaces = np.flatnonzero(classes == SPACE)
    ends = np.minimum(np.append(starts[1:], n), spaces[np.searchsorted(spaces, starts)])
    return starts, ends


def merge_counts(words: list[bytes], tables: dict) -> np.ndarray:
    """Tokens that the merges leave of each word: lowest rank first, of equals the leftmost."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    counts = np.zeros(len(words), np.int64)
    long = np.flatnonzero(lengths > LONG_WORD)
    if len(long):
        ranks = dict(zip(tables["keys"].tolist(), tables["ranks"].tolist()))
        counts[long] = [_merge_long(words[i], ranks, tables) for i in long.tolist()]
    width = 8
    low = 0
    while low < min(max(lengths.max(initial=0), 1), LONG_WORD):
        chosen = np.flatnonzero((lengths > low) & (lengths <= width))
        for part in np.array_split(chosen, max(1, len(chosen) * width // 4_000_000)):
            if len(part):
                counts[part] = _merge_block([words[i] for i in part], lengths[part], width, tables)
        low, width = width, width * 2
    return counts


def _merge_long(word: bytes, ranks: dict[int, int], tables: dict) -> int:
    """Tokens of one long word: pairs wait in a heap by rank and place, and merged neighbours are linked."""
    letters = np.frombuffer(word, np.uint8)
    ids = tables["inner"][letters].astype(np.int64)
    ids[-1] = tables["last"][letters[-1]]
    size, made = tables["size"], tables["made"].tolist()
    known = (ids[:-1] >= 0) & (ids[1:] >= 0)
    keys = (ids[:-1] * size + ids[1:]).tolist()
    heap = [(rank, i) for i, (key, ok) in enumerate(zip(keys, known.tolist())) if ok and (rank := ranks.get(key)) is not None]
    heapq.heapify(heap)
    ids = ids.tolist()
    n = left = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def rank_at(i: int) -> int | None:
        j = after[i]
        return ranks.get(ids[i] * size + ids[j]) if j < n and ids[i] >= 0 and ids[j] >= 0 else None

    gone = bytearray(n)
    while heap:
        rank, i = heapq.heappop(heap)
        if gone[i] or rank_at(i) != rank:
            continue
        j = after[i]
        ids[i], gone[j], after[i] = made[rank], 1, after[j]
        if after[j] < n:
            before[after[j]] = i
        left -= 1
        for k in (before[i], i):
            more = rank_at(k) if k >= 0 else None
            if more is not None:
                heapq.heappush(heap, (more, k))
    return left


def _merge_block(words: list[bytes], lengths: np.ndarray, width: int, tables: dict) -> np.ndarray:
    never = np.int64(1 << 40)
    letters = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
    column = np.arange(width)
    ids = np.where(column < lengths[:, None] - 1, tables["inner"][letters], tables["last"][letters])
    ids = np.where(column < lengths[:, None], ids, -1)

    def rank(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * tables["size"] + b
        at = np.minimum(np.searchsorted(tables["keys"], key), len(tables["keys"]) - 1)
        return np.where((a >= 0) & (b >= 0) & (tables["keys"][at] == key), tables["ranks"][at], never)

    pad = np.full((len(words), 1), -1, np.int64)
    ids = np.concatenate([ids, pad], axis=1)
    ranks = np.concatenate([rank(ids[:, :-1], ids[:, 1:]), np.full((len(words), 1), never)], axis=1)
    left = lengths.copy()
    rows = np.arange(len(words))
    column = np.arange(width + 1)
    forward = np.minimum(column + 1, width)
    while len(rows):
        best = ranks.argmin(axis=1)
        lowest = ranks[np.arange(len(rows)), best]
        open_ = lowest < never
        rows, ids, ranks, best, lowest = rows[open_], ids[open_], ranks[open_], best[open_], lowest[open_]
        if not len(rows):
            break
        left[rows] -= 1
        here = np.arange(len(rows))
        behind = column > best[:, None]
        ids = np.where(behind, ids[:, forward], ids)
        ranks = np.where(behind, ranks[:, forward], ranks)
        ids[here, best] = tables["made"][lowest]
        ranks[here, best] = rank(ids[here, best], ids[here, np.minimum(best + 1, width)])
        before = np.maximum(best - 1, 0)
        ranks[here, before] = np.where(best > 0, rank(ids[here, before], ids[here, best]), ranks[here, before])
    return left


class Counter:
    """Counts tokens of texts with compiled tables; keeps the weights of at most ``KEPT_WEIGHTS`` pre-tokens."""

    def __init__(self, tables: dict):
        self.tables, self.weights = tables, {}
        self.special = re.compile("|".join(map(re.escape, tables["specials"]))) if tables["specials"] else None

    def normal(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            # Lower case is taken sign by sign: no rule of final letters.
            return "".join(c.lower() for c in text) if "Σ" in text else text.lower()
        return text.lower()

    def weigh(self, words: Iterable[str]) -> None:
        new = [w for w in set(words) if w not in self.weights]
        if len(self.weights) + len(new) > KEPT_WEIGHTS:
            self.weights = {}
            new = list(set(words))
        self.weights.update(zip(new, merge_counts([w.encode() for w in new], self.tables).tolist()))

    def pieces(self, texts: list[str]) -> list[int]:
        """Tokens of each of some normalised pieces, taken together with spaces between them."""
        joined = " ".join(texts)
        if not joined:
            return [0] * len(texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts, ends = starts_and_ends(points, self.tables)
        words = [joined[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        self.weigh(words)
        counts = np.fromiter(map(self.weights.__getitem__, words), np.int64, len(words))
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        edges = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]))
        total = np.concatenate([[0], np.cumsum(counts)])
        return (total[edges[1:]] - total[edges[:-1]]).tolist()

    def chunk_map(self, piece: str) -> tuple[str, int | None, str]:
        """What a piece does whatever stands before it: its head up to the first space, the tokens
        between its spaces, and its tail; a piece without a space has only a head (None)."""
        first = re.search("[ \n]", piece)  # some spaces are enough
        if first is None:
            return piece, None, ""
        last = max(piece.rfind(" "), piece.rfind("\n"))
        return piece[: first.start()], self.pieces([piece[first.start() : last]])[0], piece[last:]

    def compose(self, a: tuple, b: tuple) -> tuple:
        """The map of two pieces in a row; associative."""
        if a[1] is None:
            return (a[0] + b[0], *b[1:])
        if b[1] is None:
            return (*a[:2], a[2] + b[0])
        return a[0], a[1] + self.pieces([a[2] + b[0]])[0] + b[1], b[2]

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        parts, owner, totals = [], [], [0] * len(texts)
        for i, text in enumerate(texts):
            found = self.special.split(text) if self.special else [text]
            totals[i] += len(found) - 1
            for part in map(self.normal, found):
                if len(part) <= PIECE:
                    parts.append(part)
                    owner.append(i)
                    continue
                whole = None
                for at in range(0, len(part), PIECE):
                    piece = self.chunk_map(part[at : at + PIECE])
                    whole = piece if whole is None else self.compose(whole, piece)
                head, inner, tail = whole
                totals[i] += sum(self.pieces([head, tail])) + (inner or 0)
        for i, n in zip(owner, self.pieces(parts)):
            totals[i] += n
        return totals


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` per row of ``docs(doc_id, text)``.

    ``tokenizer`` is the path of the vocabulary file on the driver; the compiled tables are
    bounded by it and go to the executors.  Counts are those of the file's own library, without
    begin and end tokens; special strings inside a text count as one token.  Null and empty
    texts have 0.  Rows that repeat are counted each; an empty table gives no rows; other
    columns are not read.
    """
    tables = docs.sparkSession.sparkContext.broadcast(compiled(tokenizer))
    schema = "doc_id " + docs.schema["doc_id"].dataType.simpleString() + ", n_bytes long, n_tokens long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tables.value)
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            numbers: list[int] = []
            for a, b in in_blocks(texts):
                numbers += counter.counts(texts[a:b])
            sizes = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(numbers, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(count, schema).withColumn("over_limit", F.col("n_tokens") > limit)
