"""Removal of repeated passages through suffix arrays and their common-prefix intervals.

A passage of ``LENGTH`` bytes is known by the least hash of the ``GRAM``-byte strings in it, which
its content alone decides; neighbouring starts with the same least hash form a run.  Only runs
whose hash occurs again can repeat.  Their bytes are shuffled by that hash, and each task builds
an enhanced suffix array (order and common prefixes) of what it holds.  A stack scan over the
common prefixes visits the intervals of the array, deepest first.  An interval whose
occurrences have different bytes before them is a maximal repeat: all its occurrences are
reported with the earliest.  One whose occurrences all continue to the left lies inside a
longer one and is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from dayline.llm.blocks import in_blocks
from dayline.llm.common import shared as shared_table

LENGTH, GRAM = 100, 24
#: Bits that mark hashes that occur again (a bounded prefilter; the suffix arrays are exact).
SHARED_BITS, HOT_BITS = 26, 20
#: A hash with more runs than twice a task's share is dealt out by passages instead; share by at least, at most.
HOT, MOST_RUNS = 1000, 100_000
#: Bytes of runs in one suffix array, and of texts remembered to find repeats inside a task.
ARRAY, REMEMBERED = 2_000_000, 64_000_000


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as an integer, first byte highest."""
    one = data.astype(np.uint64)
    two = one[:-1] << np.uint64(8) | one[1:]
    four = two[:-2] << np.uint64(16) | two[2:]
    return four[:-4] << np.uint64(32) | four[4:]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the strings of ``GRAM`` bytes, by their start."""
    eight = eight_bytes(data)
    n = len(data) - GRAM + 1
    h = eight[:n] * np.uint64(0x9E3779B97F4A7C15)
    h ^= eight[8 : 8 + n] * np.uint64(0xC2B2AE3D27D4EB4F) + (eight[16 : 16 + n] * np.uint64(0x165667B19E3779F9) >> np.uint64(7))
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def least_hashes(h: np.ndarray, length: int) -> np.ndarray:
    """Of each passage, by its start, the least of the hashes ``h`` of the strings in it."""
    width, have = length - GRAM + 1, 1
    while have * 2 <= width:
        h = np.minimum(h[:-have], h[have:])
        have *= 2
    rest = width - have
    return np.minimum(h[: len(h) - rest], h[rest:]) if rest else h


def held_twice(h: np.ndarray, least: np.ndarray, start: np.ndarray, end: np.ndarray, length: int) -> np.ndarray:
    """Which runs may hold their least string twice; all that repeat within themselves do.

    If a passage of a run stands in it again, ``p`` bytes on, the bytes from the first to the end of the
    second have period ``p``, so the least string starts at one of the first ``p`` starts.  Where it is
    first in its passage and held again, it is so at the latest one string after the passage.
    """
    at = np.flatnonzero(h[: len(least)] == least)
    run = np.searchsorted(start, at, side="right") - 1
    inside = run >= 0
    inside[inside] = at[inside] < end[run[inside]]
    at, run = at[inside], run[inside]
    twice = np.zeros(len(start), bool)
    for on in range(1, length - GRAM + 2):
        near = at + on < len(h)
        at, run = at[near], run[near]
        again = h[at + on] == h[at]
        if again.any():
            twice[run[again]] = True
            open_ = ~twice[run]
            at, run = at[open_], run[open_]
    return twice


def content_runs(texts: list[bytes], length: int = LENGTH, inner: bool = False) -> tuple[np.ndarray, ...]:
    """Runs of passages inside the texts: text number, start and end (in the joined bytes), hash; and the text offsets.

    With ``inner`` also which runs may repeat within themselves.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    none = np.zeros(0, np.int64)
    if len(data) < length or sizes.max(initial=0) < length:
        found = none, none, none, none.astype(np.uint64), offsets
        return (*found, none.astype(bool)) if inner else found
    h = gram_hashes(data)
    least = least_hashes(h, length)
    inside = np.zeros(len(least) + 1, np.int8)
    long = sizes >= length
    first = np.zeros(len(least) + 1, bool)
    first[offsets[:-1][long]] = True
    np.add.at(inside, offsets[:-1][long], 1)
    np.add.at(inside, (offsets[1:] - length + 1)[long], -1)
    valid = np.cumsum(inside[:-1]) > 0
    change = first[:-1].copy()
    change[0] = True
    change[1:] |= (least[1:] != least[:-1]) | (valid[1:] != valid[:-1])
    start = np.flatnonzero(change)
    end = np.append(start[1:], len(least))
    kept = valid[start]
    start, end = start[kept], end[kept]
    found = np.searchsorted(offsets, start, side="right") - 1, start, end, least[start], offsets
    return (*found, held_twice(h, least, start, end, length)) if inner else found


def ranks_by_depth(data: np.ndarray, left: np.ndarray) -> tuple[list[tuple[int, np.ndarray]], np.ndarray]:
    """Order of all suffixes by their first 8, 16, 32... bytes; ``left`` bytes remain of each before its end."""
    eight = eight_bytes(np.concatenate([data, np.zeros(8, np.uint8)]))[: len(data)]
    short = left < 8
    eight[short] &= ~((np.uint64(1) << ((np.uint64(8) - left[short].astype(np.uint64)) * np.uint64(8))) - np.uint64(1))
    _, rank = np.unique(eight, return_inverse=True)
    if short.any():
        _, rank = np.unique(rank * 9 + np.minimum(left, 8), return_inverse=True)
    depth, found = 8, [(8, rank)]
    longest = int(left.max(initial=0))
    at = np.arange(len(data))
    while depth < longest and rank.max(initial=0) < len(data) - 1:
        more = left > depth
        key = rank * np.int64(len(data) + 1)
        key[more] += rank[at[more] + depth] + 1
        _, rank = np.unique(key, return_inverse=True)
        depth *= 2
        found.append((depth, rank))
    return found, eight


def common_prefixes(a: np.ndarray, b: np.ndarray, left: np.ndarray, ranks: list[tuple[int, np.ndarray]], eight: np.ndarray) -> np.ndarray:
    """Length of the common prefix of suffixes ``a`` and ``b``, up to their ends."""
    common = np.zeros(len(a), np.int64)
    room = np.minimum(left[a], left[b])
    top = len(ranks) - 1
    for i in range(top, -1, -1):
        depth, rank = ranks[i]
        live = np.arange(len(a))
        while len(live):
            live = live[room[live] - common[live] >= depth]
            live = live[rank[a[live] + common[live]] == rank[b[live] + common[live]]]
            common[live] += depth
            if i < top:
                break
    live = np.flatnonzero(common < room)
    apart = eight[a[live] + common[live]] ^ eight[b[live] + common[live]]
    # Leading equal bytes of the next eight.
    same = np.zeros(len(live), np.int64)
    for k in range(1, 9):
        same += (apart >> np.uint64(64 - 8 * k)) == 0
    common[live] += np.minimum(same, room[live] - common[live])
    return common


def maximal_repeats(data: np.ndarray, left: np.ndarray, place: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences ``(suffix, length, earliest)`` of maximal repeats of at least ``length`` bytes.

    ``data`` holds several texts in a row, ``left`` the bytes that remain of the text at each
    position, and ``place`` a number that orders positions.  Every occurrence but the earliest
    is reported once, with the longest repeat in which it isn't the earliest.
    """
    ranks, eight = ranks_by_depth(data, left)
    start = np.flatnonzero(left >= length)
    order = start[np.lexsort((place[start], ranks[-1][1][start]))]
    if len(order) < 2:
        return (np.zeros(0, np.int64),) * 3
    common = np.concatenate([[0], common_prefixes(order[:-1], order[1:], left, ranks, eight)])
    # Only suffixes that share a passage with a neighbour are in an interval.
    touching = common >= length
    kept = touching | np.append(touching[1:], False)
    order, common = order[kept], np.where(touching, common, 0)[kept]
    # Byte before a suffix; at the start of a text it differs from any.
    opens = np.concatenate([[True], left[1:] != left[:-1] - 1])
    before = np.where(opens[order], -10 - order, data[np.maximum(order - 1, 0)].astype(np.int64))
    return _stack_scan(order.tolist(), common.tolist(), place[order].tolist(), before.tolist())


#: State of an interval whose occurrences have different bytes before them.
DIVERSE = -2


def _stack_scan(order: list[int], common: list[int], places: list[int], before: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of an enhanced suffix array from the deepest up, each closed when the common prefix falls below it."""
    found, lengths, firsts = [], [], []
    # Open intervals: depth, place and suffix of the earliest member, byte before, the other members.
    stack: list[list] = [[0, -1, -1, DIVERSE, []]]
    common.append(0)
    for i, suffix in enumerate(order):
        depth, place, byte = common[i + 1], places[i], before[i]
        top = stack[-1]
        if depth > top[0]:
            stack.append([depth, place, suffix, byte, []])
            continue
        while True:
            # The suffix, or the interval just closed, joins the interval on top.
            if top[0]:
                if place < top[1]:
                    top[4].append(top[2])
                    top[1], top[2] = place, suffix
                else:
                    top[4].append(suffix)
                if byte != top[3]:
                    top[3] = DIVERSE
            if top[0] <= depth:
                break
            stack.pop()
            if top[3] == DIVERSE:
                found += top[4]
                lengths += [top[0]] * len(top[4])
                firsts += [top[2]] * len(top[4])
            place, suffix, byte = top[1], top[2], top[3]
            top = stack[-1]
            if top[0] < depth:
                stack.append([depth, place, suffix, byte, []])
                break
    return np.array(found, np.int64), np.array(lengths, np.int64), np.array(firsts, np.int64)


def _pieces(blocks: Iterator[tuple], shared: np.ndarray, hot: np.ndarray, length: int) -> Iterator[tuple]:
    """Rows ``(key, doc_id, start, end, bytes)`` of runs whose hash may occur again.

    Equal bytes met before in this task, with an earlier document or place, settle a run at
    once: it has no bytes then, only the range of starts that repeat.
    """
    seen: dict[bytes, tuple] = {}
    held = 0
    for ids, texts in blocks:
        owner, start, end, least, offsets = content_runs(texts, length)
        data = b"".join(texts)
        kept = np.flatnonzero(_marked(shared, least))
        many = _marked(hot, least[kept])
        rows: list[tuple] = []
        for i, wide in zip(kept.tolist(), many.tolist()):
            a, b, doc = int(start[i]), int(end[i]), int(owner[i])
            base = int(offsets[doc])
            spans = [(a, b, int(least[i]))]
            whole = data[a : b + length - 1]
            if wide and not (whole in seen and seen[whole] <= (ids[doc], a - base)):
                if b - a > 1:
                    seen[whole] = ids[doc], a - base
                spans = [(s, s + 1, xxhash.xxh64_intdigest(data[s : s + length])) for s in range(a, b)]
            for s, e, key in spans:
                piece, at = data[s : e + length - 1], (ids[doc], s - base)
                earlier = seen.get(piece)
                if earlier == at:  # a row that repeats is the same place
                    continue
                if earlier is not None and earlier < at:
                    rows.append((xxhash.xxh64_intdigest(str(at)), ids[doc], s - base, e - base, None))
                    continue
                seen[piece] = at
                held += len(piece) + 300  # and what Python keeps besides
                rows.append((key, ids[doc], s - base, e - base, piece))
        if held > REMEMBERED:
            seen, held = {}, 0
        yield rows


def _marked(bits: np.ndarray, value: np.ndarray) -> np.ndarray:
    at = value & np.uint64(len(bits) * 8 - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bit vector of the low ``bits`` bits of ``hashes(least)``, which being least leaves even; at most
    ``2 ** bits / 32`` numbers reach the driver."""
    slot = F.col("least").bitwiseAND((1 << bits) - 1)
    words = hashes.select(F.shiftright(slot, 5).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(31).cast("int")).alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    vector = np.zeros(1 << (bits - 5), "<u4")
    vector[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).astype(np.uint32)
    return vector.view(np.uint8)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    for batch in batches:
        ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
        for a, b in in_blocks([t or "" for t in texts]):
            pairs = [(i, (t or "").encode("utf-8", "replace")) for i, t in zip(ids[a:b], texts[a:b]) if i is not None]
            yield [i for i, _ in pairs], [t for _, t in pairs]


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(doc_id, start, length, first_doc, first_start)`` of passages of ``docs(doc_id, text)`` that occur earlier.

    Positions are bytes of the UTF-8 text.  A row is an occurrence of a maximal repeat, inside
    the runs of one hash, with the earliest occurrence of that repeat; every passage of
    ``length`` bytes that occurs at an earlier place (by ``doc_id``, then start) lies in a row.
    Rows that a task settled by equal bytes name no earliest occurrence (null).
    """
    texts = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    spark = docs.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block in _blocks(batches):
            *_, hashes, _, twice = content_runs(block, length, inner=True)
            least, at = np.unique(hashes, return_inverse=True)
            # A run that holds its least string twice may repeat within itself.
            n = np.bincount(at, weights=1 + twice, minlength=len(least))
            yield pa.RecordBatch.from_arrays([pa.array(least.view(np.int64)), pa.array(n.astype(np.int32))], ["least", "n"])

    counted = texts.mapInArrow(count, "least long, n int").groupBy("least").agg(F.sum("n").alias("n")).where("n > 1")
    again = shared_table(counted)
    shared = spark.sparkContext.broadcast(_bitmap(again, SHARED_BITS))
    share = (again.agg(F.sum("n")).first()[0] or 0) / int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = spark.sparkContext.broadcast(_bitmap(again.where(F.col("n") > min(MOST_RUNS, max(HOT, 2 * share))), HOT_BITS))
    names = ["key", "doc_id", "start", "end", "bytes"]
    types = [pa.int64(), None, pa.int64(), pa.int64(), pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _pieces(_blocks(batches), shared.value, hot.value, length):
            columns = list(zip(*rows)) or [[]] * 5
            keys = np.array(columns[0], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), *(pa.array(list(c), id_type if n == "doc_id" else t) for c, n, t in zip(columns[1:], names[1:], types[1:]))], names
            )

    pieces = texts.mapInArrow(cut, f"key long, doc_id {kind}, start long, end long, bytes binary")
    out = f"doc_id {kind}, start long, length long, first_doc {kind}, first_start long"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_keys(batches):
            yield _repeats_of(rows, length)

    # Rows of one hash meet in one task, in order, and are worked on in blocks of whole hashes.
    return pieces.repartition("key").sortWithinPartitions("key").mapInArrow(scan, out)


def _whole_keys(batches: Iterator[pa.RecordBatch], most: int = ARRAY) -> Iterator[pa.Table]:
    """Sorted rows in blocks that hold all rows of their keys and, where keys allow, about ``most`` bytes."""
    kept: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        kept.append(batch)
        size += batch.nbytes
        if size < most:
            continue
        table = pa.Table.from_batches(kept)
        keys = table["key"].to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield table.slice(0, cut)
            kept = table.slice(cut).combine_chunks().to_batches()
            size = sum(b.nbytes for b in kept)
    if kept:
        yield pa.Table.from_batches(kept)


def _repeats_of(table: pa.Table, length: int) -> pa.RecordBatch:
    """Repeats among the rows of some whole keys."""
    names = ["doc_id", "start", "length", "first_doc", "first_start"]
    id_type = table.schema.field("doc_id").type
    ids, starts, ends, pieces = (table[c].to_pylist() for c in ("doc_id", "start", "end", "bytes"))
    keys = table["key"].to_numpy()
    out: list[tuple] = []
    by_key: dict[int, dict[bytes, tuple]] = {}
    for key, doc, start, end, piece in zip(keys.tolist(), ids, starts, ends, pieces):
        if piece is None:
            out.append((doc, start, end - start + length - 1, None, None))
            continue
        known = by_key.setdefault(key, {})
        first = known.get(piece)
        if first is None:
            known[piece] = (doc, start)
        elif first != (doc, start):  # equal bytes: all of the later one repeats the earlier one
            (a, b) = sorted((first, (doc, start)))
            known[piece] = a
            out.append((b[0], b[1], len(piece), a[0], a[1]))
    # Different bytes under one hash: a suffix array tells what they share.  A run may repeat within itself.
    alone = [p for known in by_key.values() if len(known) == 1 for p in known if len(p) > length]
    owner, *_, twice = content_runs(alone, length, inner=True)
    inner = {alone[i] for i in owner[twice].tolist()}
    several = [(d, s, piece) for known in by_key.values() if len(known) > 1 or not inner.isdisjoint(known) for piece, (d, s) in known.items()]
    for block in [several] if several else []:
        lengths = np.fromiter((len(p) for _, _, p in block), np.int64, len(block))
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        data = np.frombuffer(b"".join(p for _, _, p in block), np.uint8)
        which = np.repeat(np.arange(len(block)), lengths)
        inner = np.arange(len(data)) - offsets[:-1][which]
        docs = sorted({d for d, _, _ in block})
        number = {d: i for i, d in enumerate(docs)}
        rank = np.fromiter((number[d] for d, _, _ in block), np.int64, len(block))
        begins = np.fromiter((s for _, s, _ in block), np.int64, len(block))
        place = (rank[which] << 40) + begins[which] + inner
        suffix, long, first = maximal_repeats(data, lengths[which] - inner, place, length)
        for s, n, f in zip(suffix.tolist(), long.tolist(), first.tolist()):
            a, b = which[s], which[f]
            out.append((block[a][0], int(begins[a] + inner[s]), n, block[b][0], int(begins[b] + inner[f])))
    columns = list(zip(*out)) or [[]] * 5
    kinds = [id_type, pa.int64(), pa.int64(), id_type, pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names)


def removed(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)`` per row of ``docs(doc_id, text)``: the maximal removed runs and the bytes that stay.

    A byte goes when a passage of ``length`` bytes over it also starts earlier: in a document of
    smaller ``doc_id``, or before it in the same.  Null and empty texts have no bytes; a text
    shorter than ``length`` keeps all.  A ``doc_id`` names one document: rows that share one
    are one place, of which nothing goes because it is there twice.  Rows with a null ``doc_id`` neither lose
    nor cause anything.
    """
    spans = repeats(docs, length).select("doc_id", F.struct("start", (F.col("start") + F.col("length")).alias("end")).alias("span"))
    gathered = spans.groupBy("doc_id").agg(F.collect_list("span").alias("spans")).withColumnRenamed("doc_id", "_id")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").join(gathered, F.col("doc_id") == F.col("_id"), "left").select("doc_id", "text", "spans")
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, merged, kept = [], [], []
            for text, spans in zip(batch["text"].to_pylist(), batch["spans"].to_pylist()):
                data = (text or "").encode("utf-8", "replace")
                joined = _merged(spans or [], len(data))
                out, at = [], 0
                for span in joined:
                    out.append(data[at : span["start"]])
                    at = span["end"]
                sizes.append(len(data))
                merged.append(joined)
                kept.append(b"".join([*out, data[at:]]))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(merged, span_type), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    return rows.mapInArrow(apply, f"doc_id {kind}, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")


def _merged(spans: list[dict], size: int) -> list[dict]:
    """Maximal runs of some spans, within a text of ``size`` bytes."""
    out: list[dict] = []
    for start, end in sorted((s["start"], min(s["end"], size)) for s in spans):
        if start >= end:
            continue
        if out and start <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], end)
        else:
            out.append({"start": start, "end": end})
    return out


def digest(found: DataFrame) -> DataFrame:
    """Counts and a hash of what ``removed`` leaves."""
    n = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", n.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
