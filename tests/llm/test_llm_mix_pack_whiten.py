"""Importance resampling, packing and whitening against brute force, on odd inputs and whole tables."""

import hashlib
import math
import random
import re
import time
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_llm_operators import documents, empty, odd_texts, prose

from dayline.llm import importance, packing, whitening

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


# --- 11
def word_list(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def runs(text, grams):
    words = word_list(text)
    return [" ".join(words[i : i + k]) for k in range(1, grams + 1) for i in range(len(words) - k + 1)]


@pytest.mark.parametrize("grams", [1, 3])
@pytest.mark.parametrize("most", [1, 7, 1 << 20])
def test_features_of_slices_are_those_of_the_text(grams, most):
    rng = random.Random(grams)
    for text in [None, "", "  ", "one", "A b", "ÄÖ É-x 12'3", prose(rng, 200), "a" * 50, "x\x00y z 日本 語"]:
        counts, words = importance.feature_counts(None if text is None else text.encode(), grams, most)
        assert counts == Counter(crc32(r.encode()) for r in runs(text, grams))
        assert words == len(word_list(text))


@pytest.mark.parametrize("grams", [1, 2])
def test_resampling_matches_brute_force(spark, grams):
    texts = odd_texts() + [prose(random.Random(i), 15 + i) for i in range(40)]
    goal = ["ab cd ef", None, prose(random.Random(9), 300, "abc")]
    docs = documents(spark, texts).repartition(5)
    docs = docs.withColumn("score", F.lit("clash")).withColumn("_at", F.lit(1)).withColumn("rank", F.lit(2))
    target = spark.createDataFrame([(i, t) for i, t in enumerate(goal)], "item_id long, text string")
    got = {r["doc_id"]: r for r in importance.resample(docs, target, grams=grams, buckets=97).collect()}
    raw, aim = Counter(), Counter()
    for side, found in ((texts, raw), (goal, aim)):
        for t in side:
            found.update(crc32(r.encode()) % 97 for r in runs(t, grams))
    ratio = lambda b: (aim[b] + 1) * (sum(raw.values()) + 97) / ((raw[b] + 1) * (sum(aim.values()) + 97))
    gain = [math.floor(1000 * math.log(ratio(b))) for b in range(97)]
    scores = {}
    for i, t in enumerate(texts):
        features = runs(t, grams)
        h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[crc32(r.encode()) % 97] for r in features)
        scores[i] = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        assert (got[i]["n_features"], got[i]["weight"], got[i]["score"]) == (len(features), weight, scores[i])
    fits = sorted((i for i, t in enumerate(texts) if len(word_list(t)) >= 20), key=lambda i: (-scores[i], i))
    drawn = {i: k + 1 for k, i in enumerate(fits[: len(fits) * 10 // 100])}
    assert drawn and {i: r["rank"] for i, r in got.items() if r["rank"]} == drawn


def test_resampling_edges(spark):
    docs = documents(spark, ["a b", None, prose(random.Random(1), 30)])
    target = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert importance.resample(empty(docs), target).collect() == []
    twice = docs.unionAll(docs).withColumn("doc_id", F.when(F.col("doc_id") != 1, F.col("doc_id")))
    rows = importance.resample(twice, target.where("false"), percent=100).collect()
    assert len(rows) == 6 and sorted(r["rank"] for r in rows if r["rank"]) == [1, 2]
    again = importance.resample(docs, target, percent=100, least_words=0).collect()
    assert sorted(r["rank"] for r in again) == [1, 2, 3]


def test_a_long_text_is_counted_in_slices():
    text = (b"word other " * 3_000_000)[:30_000_000]
    counts, words = importance.feature_counts(text)
    wanted = Counter(text.split())
    assert counts == {crc32(w): n for w, n in wanted.items()} and words == sum(wanted.values())


# --- 12
@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def check_packed(rows, wanted, sizes):
    """Pieces cover each row's ids once, sequences are gapless, and at most one is short."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(wanted)
    for i, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            part = np.array(wanted[i][at : at + r["length"]], "<u4")
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(wanted[i]), crc32(part))
            at += r["length"]
        assert at == len(wanted[i])
    short = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert {r["context"] for r in pieces} == {at} and len({r["step"] for r in pieces}) == 1
        short += at not in sizes
    assert short <= 1 and sorted(by_sequence) == list(range(len(by_sequence)))
    return by_sequence


@pytest.mark.parametrize("sizes", [packing.TIERS, (64, 32), (128,)])
def test_packing_is_a_whole_layout(spark, library, sizes):
    rng = random.Random(4)
    texts = odd_texts() + [prose(rng, rng.choice([1, 20, 60, 400])) for _ in range(60)]
    texts += ["a <|endoftext|> b", "<|endoftext|>", "İ ﬁ 日本語 \x1c\x85  x"] + ["same"] * 30
    docs = documents(spark, texts).repartition(4)
    for name in ("part", "rest", "n", "start", "offset"):
        docs = docs.withColumn(name, F.lit("clash"))
    rows = packing.pack(docs, VOCABULARY, sizes, step_tokens=1000).collect()
    sequences = check_packed(rows, {i: ids_of(library, t) for i, t in enumerate(texts)}, sizes)
    steps = Counter((p[0]["context"], p[0]["step"]) for p in sequences.values())
    for size in sizes:
        dealt = [n for (context, _), n in steps.items() if context == size]
        assert max(dealt, default=1) - min(dealt, default=1) <= 1


def test_plans_of_random_lengths():
    rng = random.Random(3)
    for _ in range(150):
        sizes = rng.choice([(64, 32, 16), (64,), (32, 16, 8, 4, 2, 1), (16, 8), (48, 20)])
        counts = np.zeros(sizes[0], np.int64)
        for _ in range(rng.choice([0, 1, 2, 5, 40, 300])):
            low, high = rng.choice([(1, sizes[0] - 1), (1, sizes[0] // 8), (sizes[0] // 2, sizes[0] - 1)])
            counts[rng.randint(low, high)] += rng.choice([1, 1, 7])
        made = packing.plan(counts, sizes, 10)
        held = {}
        for r in range(1, sizes[0]):
            for number in range(counts[r]):
                at = 0
                for start, length, sequence, offset, size in packing.places(made, sizes, r, number):
                    assert start == at and length > 0
                    at += length
                    held.setdefault(sequence, []).append((offset, length, size))
                assert at == r
        assert sorted(held) == list(range(10, made.sequences))
        for pieces in held.values():
            assert sum(length for _, length, _ in pieces) == pieces[0][2]
            for (a, n, _), (b, _, _) in zip(sorted(pieces), sorted(pieces)[1:]):
                assert a + n == b
        assert sum(pieces[0][2] not in sizes for pieces in held.values()) <= 1


def test_packing_edges(spark, library):
    docs = documents(spark, [None, "", "b"])
    assert packing.pack(empty(docs), VOCABULARY).collect() == []
    twice = packing.pack(docs.unionAll(docs), VOCABULARY).collect()
    assert sum(r["length"] for r in twice) == 2 * (1 + 1 + 2) and len({(r["sequence_id"], r["offset"]) for r in twice}) == len(twice)
    odd = docs.withColumn("doc_id", F.when(F.col("doc_id") > 0, F.col("doc_id").cast("string")))
    assert {r["doc_id"] for r in packing.pack(odd, VOCABULARY).collect()} == {None, "1", "2"}


def test_ids_of_long_runs_are_the_librarys(library):
    rng = random.Random(2)
    encoder = packing.Encoder(open(VOCABULARY, encoding="utf-8").read())
    begun = time.time()
    for text in [" " * 1_000_000 + "x", "".join(rng.choices("acgt", k=1_000_000)), "." * 300_000, "\n \t" * 100_000 + "b", prose(rng, 400_000)]:
        assert encoder(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert time.time() - begun < 60


# --- 13
def vector_rows(vectors):
    return [(i, None if v is None else [None if c is None else float(c) for c in v], i % 3, "x") for i, v in enumerate(vectors)]


def whitened(spark, vectors, most=8, kind="float", parts=3):
    rows = spark.createDataFrame(vector_rows(vectors), f"vec_id long, embedding array<{kind}>, label int, n string")
    return whitening.whiten(rows.repartition(parts), most).collect()


def expected(vectors, kind=np.float32):
    good = {i: np.array(v, kind).astype(np.float64) for i, v in enumerate(vectors) if v and all(c is not None and np.isfinite(c) for c in v)}
    x = np.array([np.floor(1024 * v).astype(np.int64) + 100_000 for v in good.values()])
    return list(good), x


@pytest.mark.parametrize("spread", ["even", "steep", "rank"])
def test_whitening_matches_brute_force(spark, spread):
    rng = np.random.default_rng(7)
    rows = rng.normal(size=(300, 12))
    if spread == "steep":
        rows = rows * np.logspace(3, -2, 12) @ np.linalg.qr(rng.normal(size=(12, 12)))[0]
    if spread == "rank":  # whole steps of 1/1024, so copies of a dimension stay copies
        rows = np.round(rows * 1024) / 1024
        rows[:, 5:] = rows[:, :1]
        rows[:, 3] = 0
    vectors = [None, [], [1.0] * 11 + [None], [1.0] * 11 + [float("nan")], [1.0] * 11 + [float("inf")], [1.0, 2.0], *rows.tolist(), rows[0].tolist()]
    vectors[5] = None if spread == "even" else vectors[5]
    ids, x = expected([v if v and len(v) == 12 else None for v in vectors])
    n, sums = len(x), x.sum(0)
    v = np.cov(x.T, bias=True)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    rank = 4 if spread == "rank" else 8
    got = whitened(spark, vectors)
    assert len(got) == n * rank
    table = {(r["vec_id"], r["component"]): r for r in got}
    for i, row in zip(ids, x):
        assert table[i, 1]["deviation"] == int(((n * row - sums).astype(object) ** 2).sum()) and table[i, 1]["n"] == n
    for k in range(rank):
        mine = np.array([table[i, k + 1]["whitened"] for i in ids])
        theirs = (x - sums / n) @ axes[:, k] / np.sqrt(values[k])
        assert np.allclose(mine * np.sign(mine @ theirs), theirs, atol=1e-8)
        assert math.isclose(table[ids[0], k + 1]["explained"], values[k] / np.trace(v), rel_tol=1e-9)
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-9


def test_whitening_edges(spark):
    assert whitened(spark, []) == [] and whitened(spark, [None, []]) == []
    assert whitened(spark, [[1.0, 2.0]]) == [] and whitened(spark, [[1.0, 2.0]] * 9) == []
    line = whitened(spark, [[0.0, 0.0], [1.0, 1.0]] * 50)
    assert len(line) == 100 and {r["component"] for r in line} == {1} and math.isclose(line[0]["explained"], 1)
    wide = whitened(spark, [[1e15, 0.0], [1e9, 1.0], [-1e9, 2.0], [0.0, 5.0]], kind="double")
    assert {r["vec_id"] for r in wide} == {1, 2, 3} and all(r["deviation"] is None or r["deviation"] >= 0 for r in wide)


def test_factors_of_the_passes_compose(spark):
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(500, 6)) * np.logspace(4, 0, 6)
    rows[:, 1] = rows[:, 0] + rng.normal(size=500) * 0.01
    frame = spark.createDataFrame(vector_rows(rows.tolist()), "vec_id long, embedding array<double>, label int, n string")
    n, sums = whitening.fit_list(frame)
    _, x = expected(rows.tolist(), np.float64)
    assert (n, sums) == (500, x.sum(0).tolist())
    r = whitening.decomposed(frame, n, sums)
    y = x - x.mean(0)
    assert np.allclose(np.linalg.svd(r)[1], np.linalg.svd(y)[1], rtol=1e-9)
    assert np.allclose(r.T @ r, y.T @ y, rtol=1e-9)
