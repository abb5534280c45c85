"""SimHash near-dedup by multi-index hashing.

A fingerprint has a bit for each bit that most hashes of the text's word shingles have set.
Two fingerprints within three bits agree, but for at most one bit, in one of their two halves.
So every half is entered in a table, and each fingerprint asks for its half and for the halves
of the small Hamming ball around it; whole distances are verified for what is found.  A flipped
bit is asked for only where it is 0, so each pair is met once for a half.  Links join
distinct fingerprints; copies follow by lookup.

Near copies by a similarity are proposed in the same way by wider fingerprints of their sets of shingles, with
more and shorter segments, and decided by the sets of the proposed ends alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayline.llm.common import match_rows, shared
from dayline.operators.components import connected_components

SHINGLE, DISTANCE, SEED = 3, 3, 42
#: Hashes of a long text are counted in blocks.
HASHES = 1 << 18
SEGMENT_BITS = 32
#: Near copies by similarity: words of a shingle, Jaccard similarity, and the share of pairs just at it that
#: fingerprints may miss.
WIDE_SHINGLE, SIMILARITY, MISSED = 5, 0.8, 0.002
#: Shingles below which a set counts as small.
SMALL_SET = 16
#: Texts that hold a key, beyond those that do so by chance, from which on it is a crowd: they are told apart by a pivot.
CROWD = 16
#: Shingles of a pivot's texts that come last in their order.
COMMON = 1024


def fingerprint(text: str | None, shingle: int = SHINGLE, words: int = 1) -> np.ndarray:
    """Unsigned 64-bit words of a text's fingerprint; all 0 for a text without words.

    The first word is of the shingles' XXH64 hashes, others of further mixes of those.
    """
    tokens = (text or "").encode("utf-8", "replace").lower().split()
    if not tokens:
        return np.zeros(words, np.uint64)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(tokens) - shingle + 1)
    ends = ends[min(shingle, len(tokens)) - 1 :]
    ones = np.zeros(64 * words, np.int64)
    for at in range(0, n, HASHES):
        spans = zip(starts[at : min(at + HASHES, n)].tolist(), ends[at : at + HASHES].tolist())
        first = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], np.uint64)
        hashes = [first]
        for k in range(1, words):
            mixed = (first ^ np.uint64(k * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ mixed >> np.uint64(31)) * np.uint64(0x94D049BB133111EB)
            hashes.append(mixed ^ mixed >> np.uint64(29))
        for k, h in enumerate(hashes):
            bits = np.unpackbits(h.astype(">u8").view(np.uint8)).reshape(-1, 64)
            # Bytes are added up in groups that one byte can hold.
            full = len(bits) // 255 * 255
            ones[64 * k : 64 * k + 64] += bits[:full].reshape(-1, 255, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64) + bits[full:].sum(0, dtype=np.int64)
    return np.packbits(ones * 2 > n).view(">u8").astype(np.uint64)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fingerprint)`` per row of ``docs(doc_id, text)``, as a signed 64-bit integer."""
    return wide_fingerprints(docs, shingle, 1).select("doc_id", F.element_at("words", 1).alias("fingerprint"))


def wide_fingerprints(docs: DataFrame, shingle: int, words: int) -> DataFrame:
    """``(doc_id, words)`` per row of ``docs(doc_id, text)``: the fingerprint as signed 64-bit integers."""
    schema = "doc_id " + docs.schema["doc_id"].dataType.simpleString() + ", words array<bigint>"

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t, shingle, words) for t in batch["text"].to_pylist()], np.uint64).reshape(-1, words)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * words, pa.int32()), pa.array(made.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], lists], ["doc_id", "words"])

    return docs.select("doc_id", "text").mapInArrow(make, schema)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row of ``docs(doc_id, text)``.

    ``fingerprint`` has 16 hexadecimal digits; ``component_id`` is the smallest ``doc_id`` that
    links within ``distance`` bits reach.  Null and empty texts have fingerprint 0 and link
    like any other.  A null ``doc_id`` has a row, and is the component's id only where
    there is no other.  Repeated rows get equal results; an empty table gives none.
    """
    if not 0 <= distance <= 3:
        raise ValueError("two halves within one bit each cover distances up to 3")
    made = shared(fingerprints(docs, shingle))
    prints = shared(made.select(F.col("fingerprint").alias("number"), F.array("fingerprint").alias("words")).distinct())
    groups = linked_groups(prints, 1, SEGMENT_BITS, distance, distance)
    members = made.withColumn("root", F.col("fingerprint"))
    if groups is not None:
        roots = groups.select(F.col("node").alias("fingerprint"), F.col("component").alias("_root"))
        members = match_rows(made, roots, ["fingerprint"], "left").withColumn("root", F.coalesce("_root", "fingerprint")).drop("_root")
    first = members.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return match_rows(members, first, ["root"]).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def _segment_keys(words: int, segment: int) -> Column:
    """Keys of all segments of ``words``: the segment's bits, and its number above them."""
    word = lambda k: F.element_at("words", k + 1)
    keys = []
    for s in range(64 * words // segment):
        at, shift = divmod(s * segment, 64)
        value = F.shiftrightunsigned(word(at), shift)
        if shift + segment > 64:
            value = value.bitwiseOR(F.shiftleft(word(at + 1), 64 - shift))
        keys.append(value.bitwiseAND((1 << segment) - 1) + F.lit(s << segment))
    return F.array(*keys)


def _verified(pairs: DataFrame, prints: DataFrame, limit: int) -> DataFrame:
    """Distinct ``pairs(a, b)`` whose complete distance is within the limit."""
    met = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    of = lambda c: prints.select(F.col("number").alias(c), F.col("words").alias(f"words_{c}"))
    both = met.join(of("a"), "a").join(of("b"), "b")
    apart = F.aggregate(F.zip_with("words_a", "words_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    return both.where(apart <= limit).select("a", "b")


def linked_groups(prints: DataFrame, words: int, segment: int, limit: int, loose: int) -> DataFrame | None:
    """``(node, component)`` of rows of ``prints(number, words)`` that links within ``limit`` bits join; None without links.

    Each segment is entered in a table, and its ball of one bit is asked for.  A pair is met
    unless every one of its segments differs in two bits or more; ``loose`` bits of the first
    word are allowed before the complete distance is verified.  First each entry meets the least
    entry of its own keys alone; links so found make groups.  Then the balls are asked for, and
    only texts of different groups are compared, so a large group of near copies isn't written out
    as pairs, and no link that would join two groups is lost.
    """
    near = F.bit_count(F.col("first").bitwiseXOR(F.col("first_b"))) <= loose
    rows = prints.select("number", F.element_at("words", 1).alias("first"), _segment_keys(words, segment).alias("keys"))
    entries = rows.select(F.col("number").alias("b"), F.col("first").alias("first_b"), F.explode("keys").alias("key"))
    least = entries.groupBy("key").agg(F.min(F.struct("b", "first_b")).alias("least"))
    least = least.select("key", F.col("least.b").alias("a"), F.col("least.first_b").alias("first"))
    met = match_rows(entries, least, ["key"]).where((F.col("a") != F.col("b")) & near)
    links = shared(_verified(met, prints, limit))
    group = connected_components(links) if not links.isEmpty() else None
    grouped = rows.withColumn("group", F.col("number"))
    if group is not None:
        of = group.select(F.col("node").alias("number"), F.col("component").alias("_group"))
        grouped = match_rows(rows, of, ["number"], "left").withColumn("group", F.coalesce("_group", "number"))
    grouped = shared(grouped.select("number", "first", "keys", "group"))
    ball = lambda key: F.filter(
        F.array(key, *[F.when(key.bitwiseAND(1 << bit) == 0, key + F.lit(1 << bit)) for bit in range(segment)]), lambda k: k.isNotNull()
    )
    asked = grouped.select(F.col("number").alias("a"), "first", F.col("group").alias("group_a"), F.explode("keys").alias("own"))
    asked = asked.select("a", "first", "group_a", F.explode(ball(F.col("own"))).alias("key"))
    held = grouped.select(F.col("number").alias("b"), F.col("first").alias("first_b"), F.col("group").alias("group_b"), F.explode("keys").alias("key"))
    apart = asked.join(held, "key").where((F.col("group_a") != F.col("group_b")) & near)
    more = shared(_verified(apart, prints, limit))
    return group if more.isEmpty() else connected_components(links.unionByName(more))


def shingle_set(text: str | None, shingle: int = WIDE_SHINGLE) -> np.ndarray:
    """Distinct hashes of a text's word shingles, sorted; a text of fewer words is one shingle, one of none has none."""
    tokens = (text or "").encode("utf-8", "replace").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(tokens) - shingle + 1)
    ends = ends[min(shingle, len(tokens)) - 1 :]
    parts = []
    for at in range(0, n, HASHES):
        spans = zip(starts[at : min(at + HASHES, n)].tolist(), ends[at : at + HASHES].tolist())
        parts.append(np.unique(np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], np.uint64)))
    return np.unique(np.concatenate(parts))


def set_fingerprint(hashes: np.ndarray, words: int) -> np.ndarray:
    """Unsigned 64-bit words whose bits most members of a set have, in as many mixes of their hashes; 0 for an empty set."""
    ones = np.zeros(64 * words, np.int64)
    for at in range(0, len(hashes), HASHES):
        block = hashes[at : at + HASHES]
        for k in range(words):
            mixed = (block ^ np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ mixed >> np.uint64(31)) * np.uint64(0x94D049BB133111EB)
            bits = np.unpackbits((mixed ^ mixed >> np.uint64(29)).byteswap().view(np.uint8)).reshape(-1, 64)
            full = len(bits) // 255 * 255  # bytes are added up in groups that one byte can hold
            sums = bits[:full].reshape(-1, 255, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
            ones[64 * k : 64 * k + 64] += sums + bits[full:].sum(0, dtype=np.int64)
    return np.packbits(ones * 2 > len(hashes)).view(">u8").astype(np.uint64)


def differing_share(similarity: float) -> float:
    """Share of bits in which fingerprints of two large sets of this Jaccard similarity differ, as expected."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def wide_shape(rows: int, similarity: float = SIMILARITY, missed: float = MISSED) -> tuple[int, int]:
    """Bits of a segment and 64-bit words of a fingerprint for so many texts.

    A segment has 16 bits, and one more for each doubling beyond a million texts, so that the texts a key
    finds by chance stay few.  There are as many segments as leave at most the share ``missed`` of the
    pairs at the similarity without one segment that agrees but for one bit.
    """
    segment = max(16, math.ceil(math.log2(max(rows, 1))) - 4)
    p = differing_share(similarity)
    met = (1 - p) ** segment + segment * p * (1 - p) ** (segment - 1)
    return segment, math.ceil(math.ceil(math.log(missed) / math.log(1 - met)) * segment / 64)


def set_prints(docs: DataFrame, shingle: int, words: int) -> DataFrame:
    """``(doc_id, digest, node, n, words)`` per row of ``docs(doc_id, text)``: name, size and fingerprint of its set of shingles."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, prints = [], [], np.zeros((batch.num_rows, words), np.uint64)
            for i, text in enumerate(batch["text"]):
                hashes = shingle_set(text.as_py(), shingle)
                nodes.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                sizes.append(len(hashes))
                prints[i] = set_fingerprint(hashes, words)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(batch.num_rows + 1) * words, pa.int32()), pa.array(prints.ravel().view(np.int64))
            )
            columns = [batch["doc_id"], batch["digest"], pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "node", "n", "words"])

    texts = docs.select("doc_id", F.xxhash64("text").alias("digest"), "text")
    return texts.mapInArrow(make, f"doc_id {kind}, digest long, node binary, n long, words array<bigint>")


def _texts(numbers: DataFrame, prints: DataFrame, docs: DataFrame) -> DataFrame:
    """``(number, text)`` of distinct ``numbers(number)``."""
    ends = shared(numbers.join(prints, "number").select("doc_id", "digest", "number"))
    told = docs.select("doc_id", F.xxhash64("text").alias("digest"), "text")
    return shared(match_rows(told, ends, ["doc_id", "digest"]).groupBy("number").agg(F.first("text").alias("text")))


def similar_pairs(pairs: DataFrame, prints: DataFrame, docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Those of ``pairs(a, b)`` whose sets of shingles have at least the Jaccard similarity, by the texts of both ends.

    Only texts of the ends travel, and not their hashes, which are longer; rows arrive by ``a``, whose set
    is made once for those in a row.
    """
    pairs = shared(pairs)
    texts = _texts(pairs.select(F.explode(F.array("a", "b")).alias("number")).distinct(), prints, docs)
    of = lambda c: texts.select(F.col("number").alias(c), F.col("text").alias(f"text_{c}"))
    both = match_rows(match_rows(pairs, of("b"), ["b"]), of("a"), ["a"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, mine = None, None
        for batch in batches:
            good = []
            for a, text_a, text_b in zip(batch["a"].to_pylist(), batch["text_a"], batch["text_b"]):
                if a != last:
                    last, mine = a, shingle_set(text_a.as_py(), shingle)
                other = shingle_set(text_b.as_py(), shingle)
                common = len(np.intersect1d(mine, other, assume_unique=True))
                good.append(common >= similarity * (len(mine) + len(other) - common) - 1e-9)
            kept = batch.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept["a"], kept["b"]], ["a", "b"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(verify, "a long, b long")


def distance_limit(bits: int, similarity: float, small: bool = False, deviations: float = 3.5) -> int:
    """Bits that two sets at the similarity may differ in, so many deviations beyond what is expected.

    In small sets a shingle decides more bits than in large ones: at most 3 of 16, where one of five is missing.
    """
    p = differing_share(similarity)
    return math.floor(bits * (max(p, 3 / 16) if small else p) + deviations * math.sqrt(bits * p * (1 - p)))


def _proposed(pairs: DataFrame, prints: DataFrame, bits: int, similarity: float) -> DataFrame:
    """``(a, b, apart)`` of distinct ``pairs(a, b)``: complete distance within the limit, sizes that allow the similarity."""
    met = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    of = lambda c: prints.select(*[F.col(x).alias(y) for x, y in (("number", c), ("words", f"words_{c}"), ("n", f"n_{c}"))])
    both = met.join(of("a"), "a").join(of("b"), "b")
    differing = F.zip_with("words_a", "words_b", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.aggregate(differing, F.lit(0), lambda n, x: n + x)
    sizes = F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b") - 1e-9
    small = F.least("n_a", "n_b") < SMALL_SET
    limit = F.when(small, distance_limit(bits, similarity, small=True)).otherwise(distance_limit(bits, similarity))
    return both.where(sizes & (apart <= limit)).select("a", "b", apart.alias("apart"))


def deviations(mine: np.ndarray, pivot: np.ndarray, similarity: float, common: np.ndarray) -> tuple[bool, np.ndarray, int]:
    """Whether a set is similar to its pivot, the first of its deviations from it, and how many of them it holds.

    Deviations are the shingles that only one of set and pivot has, in one order for all sets of the pivot: own ones,
    those that are lacking, own ones that are ``common``.  Two sets differ in what
    only one of their deviations has, so d and e deviations of similar sets that may differ in L share (d + e - L) / 2,
    and one among the first (d - e + L) / 2 + 1 of the one and (e - d + L) / 2 + 1 of the other.  Where d + e <= L
    both are similar to the pivot, so of all other pairs one set is not, and has more deviations than it may have
    from the pivot.  Against such a set the ``held`` first are enough, mostly a set's own shingles that hardly another
    has; a set that is not similar asks with all that are returned for those that are.
    """
    own, lacking = np.setdiff1d(mine, pivot, assume_unique=True), np.setdiff1d(pivot, mine, assume_unique=True)
    n, of, apart = len(mine), len(pivot), len(own) + len(lacking)
    linked = n - len(own) >= similarity * (of + len(own)) - 1e-9
    share = (1 - similarity) / (1 + similarity)
    most = math.floor(n * (1 - similarity) / similarity + 1e-6) + 1  # sets that differ more aren't similar, nor are their numbers
    held = max(0, min(most, math.ceil((apart + share * (n - of)) / 2)))
    asked = 0 if linked else min(most, math.floor((apart + share * (n + of)) / 2 + 1e-6) + 1)
    often = np.isin(own, common)
    return linked, np.concatenate([own[~often], lacking, own[often]])[: max(held, asked)], held


def _crowds(entries: DataFrame, crowded: DataFrame, segment: int) -> DataFrame:
    """Distinct ``(number, pivot)``: texts within one bit of a key of ``crowded(key, n)``, and the text that stands for the key.

    The pivot is of the group that has most of the key's texts, and of its texts the one whose own keys are the
    most crowded, so that all keys of the same near copies mostly have one pivot.  Any pivot gives the same links.
    """
    around = F.array("key", *[F.col("key").bitwiseXOR(1 << bit) for bit in range(segment)])
    crowds = crowded.select(F.col("key").alias("crowd"), "n", F.explode(around).alias("key"))
    members = shared(entries.join(crowds, "key").select("number", "group", "crowd", F.when(F.col("key") == F.col("crowd"), F.col("n")).otherwise(0).alias("n")))
    weights = members.groupBy("group", "number").agg(F.sum("n").alias("weight"))
    tops = weights.groupBy("group").agg(F.max(F.struct("weight", (-F.col("number")).alias("number"))).alias("top"))
    sizes = match_rows(members.groupBy("crowd", "group").agg(F.count(F.lit(1)).alias("size")), tops, ["group"])
    pivots = sizes.groupBy("crowd").agg(F.max(F.struct("size", "top")).alias("e"), F.count(F.lit(1)).alias("groups"))
    pivots = pivots.where("groups > 1").select("crowd", (-F.col("e.top.number")).alias("pivot"))
    return match_rows(members, pivots, ["crowd"]).select("number", "pivot").distinct()


def _deviating(crowds: DataFrame, prints: DataFrame, docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """``(number, pivot, linked, shingles, held)`` per row of ``crowds(number, pivot)``, as ``deviations`` says.

    Own shingles that many texts of a pivot have are found first, and the ``COMMON`` most frequent of them come last in
    its order: which are taken for common decides what is compared in vain, and no link.
    """
    numbers = crowds.select("number").unionByName(crowds.select(F.col("pivot").alias("number"))).distinct()
    texts = _texts(numbers, prints, docs)
    both = match_rows(crowds, texts, ["number"])
    both = match_rows(both, texts.select(F.col("number").alias("pivot"), F.col("text").alias("pivot_text")), ["pivot"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, last, pivot = {}, None, None
            for of, text, pivot_text in zip(batch["pivot"].to_pylist(), batch["text"], batch["pivot_text"]):
                if of != last:
                    last, pivot = of, shingle_set(pivot_text.as_py(), shingle)
                own.setdefault(of, []).append(np.setdiff1d(shingle_set(text.as_py(), shingle), pivot, assume_unique=True))
            for of, sets in own.items():
                found, n = np.unique(np.concatenate(sets), return_counts=True)
                found, n = found[n > 1].view(np.int64), n[n > 1].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), of, np.int64)), pa.array(found), pa.array(n)], ["pivot", "shingle", "n"])

    counts = both.select("pivot", "text", "pivot_text").mapInArrow(count, "pivot long, shingle long, n long")
    counts = counts.groupBy("pivot", "shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= CROWD)
    first = Window.partitionBy("pivot").orderBy(F.desc("n"), "shingle")
    often = counts.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= COMMON)
    often = shared(often.groupBy("pivot").agg(F.collect_list("shingle").alias("common")))

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, pivot, often = None, None, None
        for batch in batches:
            linked, shingles, held = [], [], []
            for of, text, pivot_text, common in zip(batch["pivot"].to_pylist(), batch["text"], batch["pivot_text"], batch["common"]):
                if of != last:
                    last, pivot = of, shingle_set(pivot_text.as_py(), shingle)
                    often = np.array(common.as_py() or [], np.int64).view(np.uint64)
                told = deviations(shingle_set(text.as_py(), shingle), pivot, similarity, often)
                linked.append(told[0])
                shingles.append(told[1].view(np.int64))
                held.append(told[2])
            columns = [batch["number"], batch["pivot"], pa.array(linked, pa.bool_()), pa.array(shingles, pa.list_(pa.int64())), pa.array(held, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["number", "pivot", "linked", "shingles", "held"])

    rows = match_rows(both, often, ["pivot"], "left").select("number", "pivot", "text", "pivot_text", "common")
    return rows.mapInArrow(tell, "number long, pivot long, linked boolean, shingles array<bigint>, held int")


def _sharing(told: DataFrame) -> DataFrame:
    """``(a, b)`` of ``told(number, group, pivot, linked, shingles, held)``: texts of different groups that may be similar by their deviations."""
    each = told.select("number", "group", "pivot", "linked", "held", F.posexplode("shingles").alias("at", "shingle"))
    names = {"number": "b", "group": "group_b", "linked": "linked_b"}
    held = each.where("at < held").select(*[F.col(c).alias(names.get(c, c)) for c in ("number", "group", "linked", "pivot", "shingle")])
    asked = each.where("NOT linked").select(F.col("number").alias("a"), "group", "pivot", "shingle", (F.col("at") < F.col("held")).alias("mutual"))
    met = asked.join(held, ["pivot", "shingle"]).where("group <> group_b AND (linked_b OR mutual AND a < b)")
    return met.select("a", "b")


def similar_groups(prints: DataFrame, docs: DataFrame, segment: int, shingle: int, similarity: float) -> DataFrame | None:
    """``(node, component)`` of rows of ``prints(number, doc_id, digest, n, words)`` that links of the similarity join; None without links.

    Segments are entered in a table.  First a text meets the least text of each of its keys, and is
    compared with the one of the least distance.  Then groups meet: of a key's groups, each is compared
    through its least text with the key's least, until that joins none.  Then texts of crowded keys are held
    against a pivot each key has, and only those are compared that share what they deviate in: templates just below
    the similarity are not compared pair by pair either.  In the end every other key's ball of one
    bit is asked for, and all texts so met whose groups differ are compared: a large group of near copies is not
    written out as pairs, and no link that would join two groups is lost.
    """
    words = len(prints.select("words").first()[0])
    # One word tells most of what a key finds by chance apart, before any of it is written.
    near = F.bit_count(F.col("first").bitwiseXOR(F.col("first_b"))) <= distance_limit(64, similarity, small=True, deviations=2.5)
    propose = lambda pairs: _proposed(pairs, prints, 64 * words, similarity)
    similar = lambda pairs: shared(similar_pairs(pairs, prints, docs, shingle, similarity))
    # The word that is held against is one that the key is not part of, or what agrees in the key would count again.
    other = lambda at: F.when(at * segment < 64, F.element_at("words", 2)).otherwise(F.element_at("words", 1))
    keys = F.transform(_segment_keys(words, segment), lambda key, at: F.struct(key.alias("key"), other(at).alias("first")))
    rows = shared(prints.select("number", keys.alias("keys")))
    entries_of = lambda df, *names: df.select(*names, F.explode("keys").alias("k")).select(*names, F.col("k.key").alias("key"), F.col("k.first").alias("first"))

    def regrouped(groups: DataFrame) -> DataFrame:
        of = groups.select(F.col("node").alias("number"), F.col("component").alias("_group"))
        grouped = match_rows(rows, of, ["number"], "left").withColumn("group", F.coalesce("_group", "number")).drop("_group")
        return shared(grouped)

    grouped = rows.withColumn("group", F.col("number"))
    links, groups = None, None
    while True:
        entries = entries_of(grouped, "number", "group").withColumnsRenamed({"number": "b", "group": "group_b", "first": "first_b"})
        if links is not None:
            least = F.min(F.struct("b", "first_b")).alias("e")
            entries = entries.groupBy("key", "group_b").agg(least).select("key", "group_b", "e.b", "e.first_b")
        least = entries.groupBy("key").agg(F.min(F.struct("b", "first_b", "group_b")).alias("e"))
        least = least.select("key", F.col("e.b").alias("a"), F.col("e.first_b").alias("first"), F.col("e.group_b").alias("group_a"))
        met = match_rows(entries, least, ["key"]).where((F.col("group_a") != F.col("group_b")) & near)
        found = propose(met)
        if links is None:
            best = found.groupBy("b").agg(F.min(F.struct("apart", "a")).alias("e"))
            found = best.select(F.col("e.a").alias("a"), "b")
        more = similar(found.select("a", "b"))
        done = more.isEmpty()
        links = more if links is None else links.unionByName(more)
        if done:
            break
        groups = shared(connected_components(links))
        grouped = regrouped(groups)
    entries = entries_of(grouped, "number", "group")
    crowded = shared(entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= CROWD + rows.count() / (1 << segment)))
    crowds = None if crowded.isEmpty() else shared(_crowds(entries, crowded, segment))
    if crowds is not None:
        told = shared(_deviating(crowds, prints, docs, shingle, similarity))
        linked = told.where("linked AND number <> pivot").select(F.col("number").alias("a"), F.col("pivot").alias("b"))
        links = links.unionByName(linked)
        groups = shared(connected_components(links))
        grouped = regrouped(groups)
        entries = entries_of(grouped, "number", "group").join(crowded, "key", "left_anti")
    ball = lambda key: F.filter(
        F.array(key, *[F.when(key.bitwiseAND(1 << bit) == 0, key + F.lit(1 << bit)) for bit in range(segment)]), lambda k: k.isNotNull()
    )
    asked = entries.select(F.col("number").alias("a"), "first", F.col("group").alias("group_a"), F.explode(ball(F.col("key"))).alias("key"))
    held = entries.withColumnsRenamed({"number": "b", "group": "group_b", "first": "first_b"})
    met = asked.join(held, "key").where((F.col("group_a") != F.col("group_b")) & near).select("a", "b")
    if crowds is not None:
        met = met.unionByName(_sharing(match_rows(told, grouped.select("number", "group"), ["number"])))
    more = similar(propose(met).select("a", "b"))
    return groups if more.isEmpty() else connected_components(links.unionByName(more))


def similar_documents(docs: DataFrame, shingle: int = WIDE_SHINGLE, similarity: float = SIMILARITY, missed: float = MISSED) -> DataFrame:
    """``(doc_id, component_id)`` per row of ``docs(doc_id, text)``: near copies by the similarity of their shingles.

    Wide fingerprints propose pairs, all but the share ``missed`` of those at the similarity and fewer above it;
    texts whose sets of shingles have at least this Jaccard similarity (over 64-bit hashes) are linked, and no
    others.  ``component_id`` is the smallest ``doc_id`` that links reach; a null ``doc_id`` has a row and is the
    component's only where there is no other.  Null and empty texts are one group; repeated rows get equal results.
    """
    segment, words = wide_shape(docs.count(), similarity, missed)
    made = shared(set_prints(docs, shingle, words))
    # Texts of equal sets are one class; a text of the class stands for it.
    classes = made.groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("e"), F.first("n").alias("n"), F.first("words").alias("words"))
    prints = classes.select("node", F.col("e.doc_id").alias("doc_id"), F.col("e.digest").alias("digest"), "n", "words")
    prints = shared(prints.withColumn("number", F.monotonically_increasing_id()))
    members = made.select("doc_id", F.col("node").alias("root"))
    groups = None
    if not prints.isEmpty():
        groups = similar_groups(prints, docs, segment, shingle, similarity)
    if groups is not None:
        top = prints.select(F.col("number").alias("component"), F.col("node").alias("_root"))
        roots = prints.join(groups, prints["number"] == groups["node"]).select(prints["node"].alias("root"), "component").join(top, "component")
        members = match_rows(members, roots.select("root", "_root"), ["root"], "left").select("doc_id", F.coalesce("_root", "root").alias("root"))
    least = members.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return match_rows(members, least, ["root"]).select("doc_id", "component_id")


def drop_near_duplicates(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each group of near copies its smallest ``doc_id``."""
    found = similar_documents(docs, **parameters)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept"))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept"]), "left_semi")
