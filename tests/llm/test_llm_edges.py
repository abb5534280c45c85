"""Rows that repeat, columns that clash, ids of any type, and very long words."""

import random
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_llm_operators import brute_removed, documents, prose

from dayline.llm import decontamination, exact_dedup, mixing, quality, simhash, suffix_dedup, token_count, toxicity


def test_a_row_that_repeats_is_one_place(spark):
    rng = random.Random(1)
    one, two, shared = (prose(rng, 60) for _ in range(3))
    texts = [one, two, one, shared + two, "-" * 150]
    docs = documents(spark, texts)
    got = {tuple(r) for r in suffix_dedup.digest(suffix_dedup.removed(docs.unionAll(docs).repartition(3))).collect()}
    assert {r[0]: r[1:] for r in got} == brute_removed(list(enumerate(texts)), suffix_dedup.LENGTH) and len(got) == len(texts)


@pytest.mark.parametrize("kind", ["smallint", "decimal(12,0)", "string", "date"])
def test_ids_of_any_type(spark, kind):
    rng = random.Random(2)
    long = prose(rng, 50)
    docs = documents(spark, [long, long + " x", None])
    id_of = F.date_add(F.lit("2020-01-01").cast("date"), F.col("doc_id").cast("int")) if kind == "date" else F.col("doc_id").cast(kind)
    docs = docs.withColumn("doc_id", id_of)
    rows = suffix_dedup.digest(suffix_dedup.removed(docs)).orderBy("doc_id").collect()
    assert [r["n_removed"] for r in rows] == [0, len(long.encode()), 0]
    assert simhash.similar_documents(docs).count() == 3


def test_clashing_columns_pass_through_the_stages(spark):
    rng = random.Random(3)
    docs = documents(spark, [prose(rng, 300) for _ in range(30)])
    for name in ("_id", "_kept", "host", "group", "number", "node", "digest", "target", "rank", "_planned_"):
        docs = docs.withColumn(name, F.lit("clash"))
    docs = docs.withColumn("n_chars", F.col("n_chars").cast("string"))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    benchmark = docs.where("doc_id = 3").select(F.col("doc_id").alias("item_id"), F.substring("text", 200, 300).alias("text"))
    names = docs.columns
    assert quality.keep_good(docs, labels).columns == names
    kept = simhash.drop_near_duplicates(exact_dedup.drop_exact_duplicates(docs))
    clean = decontamination.remove_phrases(kept, benchmark)
    assert kept.columns == clean.columns == names
    hit = clean.where("doc_id = 3").first()
    assert hit["n_chars"] == str(len(hit["text"])) and len(hit["text"]) < len(kept.where("doc_id = 3").first()["text"])
    mixed = mixing.mixed_documents(clean)
    assert mixed.columns == [*names, *mixing.OWN]
    assert all(r["mix_taken"] == r["mix_whole"] * r["mix_size"] + r["mix_extra"] and 0 <= r["mix_extra"] <= r["mix_size"] for r in mixed.collect())
    odd = decontamination.remove_phrases(docs.withColumn("n_chars", F.lit(1.5)), benchmark)
    assert {r["n_chars"] for r in odd.collect()} == {1.5}


def test_very_long_words_are_counted_in_little_time(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(4)
    texts = ["".join(rng.choices("acgt", k=n)) for n in (511, 512, 513, 3000, 1_000_000)] + ["a" * 200_000, "日本" * 20_000, "." * 5000]
    begun = time.time()
    got = {r["doc_id"]: r["n_tokens"] for r in token_count.token_counts(documents(spark, texts), path).collect()}
    assert time.time() - begun < 90
    assert [got[i] for i in range(len(texts))] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_wide_fingerprints_of_pairs_at_the_similarity():
    """Of pairs of a Jaccard similarity just at the limit, hardly any has no segment that agrees but for one bit."""
    rng = np.random.default_rng(5)
    segment, words = simhash.wide_shape(1000)
    met = Counter()
    for n in (9, 45, 180, 900):  # eight ninths in common make 0.8
        for _ in range(400):
            common = rng.integers(0, 2**63, 8 * n // 9, dtype=np.uint64)
            own = [rng.integers(0, 2**63, n - len(common), dtype=np.uint64) for _ in range(2)]
            a, b = (set(np.concatenate([common, x]).tolist()) for x in own)
            assert len(a & b) / len(a | b) == 0.8
            x, y = (simhash.set_fingerprint(np.array(sorted(s), np.uint64), words) for s in (a, b))
            bits = np.unpackbits((x ^ y).byteswap().view(np.uint8))
            met[n, bool((bits[: len(bits) // segment * segment].reshape(-1, segment).sum(1) <= 1).any())] += 1
    assert all(met[n, True] >= 0.99 * 400 for n in (9, 45, 180, 900))


def test_toxicity_answers_every_gram_however_few_the_slots(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 6))) for _ in range(120)]
    bad = ["".join(rng.choices("klmnop", k=4)) for _ in range(20)]
    text = lambda toxic: " ".join(rng.choices(words + bad * (3 if toxic else 0), k=rng.randint(3, 90)))
    rows = [(i, text(i % 3 == 0), int(i % 3 == 0)) for i in range(400)] + [(400, None, 0), (401, "", 1)]
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([r[::2] for r in rows], "doc_id long, toxic int")
    read = []
    for bits in (20, 6):
        model = toxicity.learn(docs, labels, bits)
        scored = toxicity.score(docs.unionByName(docs.where("doc_id < 3")), model)
        read.append(sorted((r["doc_id"], round(r["score"], 6), round(r["mean"], 6), round(r["worst"], 6)) for r in scored.collect()))
    assert model["rest"] is not None and len(model["grams"][0]) == 64
    assert len(read[0]) == 405 and read[0] == read[1]


def test_deviations_of_similar_sets_share_one():
    """Of similar sets that are not both similar to the pivot, the first deviations meet, whatever counts as common."""
    rng = np.random.default_rng(6)
    met = 0
    for similarity in (0.6, 0.8, 0.9):
        for _ in range(30):
            base, pool = (rng.integers(0, 2**63, k, dtype=np.uint64) for k in (int(rng.integers(3, 90)), 60))
            sets = [np.unique(base)]
            while len(sets) < 40:
                of = sets[0] if rng.random() < 0.4 else sets[rng.integers(len(sets))]
                gone, more = rng.integers(0, max(2, len(of) // 4), 2)
                made = np.unique(np.concatenate([rng.permutation(of)[gone:], rng.choice(pool, more)]))
                sets += [made] if len(made) else []
            pivot, common = sets[rng.integers(len(sets))], pool[: rng.integers(60)]
            told = [simhash.deviations(s, pivot, similarity, common) for s in sets]
            for i, x in enumerate(sets):
                for j, y in enumerate(sets[:i]):
                    (linked, a, held), (other, b, holds) = told[i], told[j]
                    both = len(np.intersect1d(x, y))
                    if both >= similarity * (len(x) + len(y) - both) - 1e-9 and not (linked and other):
                        a, b = a[:held] if linked or not other else a, b[:holds] if other or not linked else b
                        assert len(np.intersect1d(a, b))
                        met += 1
    assert met > 500


def test_a_template_below_the_similarity_is_not_compared_pair_by_pair(spark, monkeypatch):
    """Copies of one text with 0 to 12 words changed: links as of all pairs, but not all pairs looked at."""
    rng = random.Random(16)
    base, other = prose(rng, 150).split(), prose(rng, 150).split()
    texts = []
    for i in range(360):
        words = list(base if i % 6 else other)
        for at in rng.sample(range(150), i % 13):
            words[at] = prose(rng, 1) + str(rng.randint(0, 300))
        texts.append(" ".join(words))
    texts += [texts[k] + " x" for k in range(12, 360, 40)] + [" ".join(texts[k].split()[1:]) for k in range(11, 360, 40)]
    sets = [{" ".join(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, (t.lower() for t in texts))]
    root = list(range(len(texts)))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if len(x & y) >= 0.8 * len(x | y):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    monkeypatch.setattr(simhash, "CROWD", 3, raising=False)
    compared, pairs = [], simhash.similar_pairs
    monkeypatch.setattr(simhash, "similar_pairs", lambda found, *more: compared.append(found.count()) or pairs(found, *more))
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(documents(spark, texts)).collect()}
    assert got == dict(enumerate(root)) and 100 < len(set(root)) < 300
    assert sum(compared) < 10 * len(texts)
