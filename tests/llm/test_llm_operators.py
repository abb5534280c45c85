"""Each operator against brute force, with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from dayline.llm import decontamination, exact_dedup, language_id, mixing, quality, simhash, suffix_dedup, token_count, toxicity, url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string, words string"


def documents(spark, texts, source=lambda i: f"src{i % 3}"):
    rows = [(i, t, "en", source(i), len(t or ""), "x", "y", "z") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(rng, n, alphabet="abcdefgh"):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 7))) for _ in range(n))


def odd_texts(seed=5):
    rng = random.Random(seed)
    long = prose(rng, 9000)
    near = [prose(rng, 300) for _ in range(5)]
    texts = [None, "", " \t\n", "a", long, long, long.replace(" ", "\n"), "é" * 5000, " x", *near, *near, "!!! ???", "123 456", long + " tail"]
    return texts + [t[: len(t) // 2] + "z" + t[len(t) // 2 :] for t in near]


def empty(docs):
    return docs.where("false")


def strip(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


# --- 1
@pytest.mark.parametrize("identify", [F.xxhash64, lambda c: F.length(c).cast("long") % 3])
def test_exact_duplicates_match_brute_force(spark, identify):
    texts = odd_texts()
    got = {r["doc_id"]: r for r in exact_dedup.exact_duplicates(documents(spark, texts), identify=identify).collect()}
    groups = {}
    for i, t in enumerate(texts):
        groups.setdefault(strip(t), []).append(i)
    for i, t in enumerate(texts):
        group = groups[strip(t)]
        keep = min(group, key=lambda k: (-len(texts[k] or ""), k))
        r = got[i]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (keep, len(group), i == keep)
        assert r["text_sha256"] == hashlib.sha256(strip(t).encode()).hexdigest()


def test_exact_chunks_are_content_defined(spark):
    rng = random.Random(1)
    text = strip(prose(rng, 4000))
    rows = spark.createDataFrame([(0, text), (1, "inserted" + text)], "doc_id long, text string")
    cut = [r[0] for r in rows.select(exact_dedup.chunks(F.col("text"))).collect()]
    assert ["".join(c).encode("latin-1").decode() for c in cut] == [text, "inserted" + text]
    assert len(set(cut[0]) & set(cut[1])) > len(cut[0]) // 2


def test_exact_stage_keeps_columns_and_empty(spark):
    docs = documents(spark, odd_texts())
    left = exact_dedup.drop_exact_duplicates(docs)
    assert left.columns == docs.columns and left.count() == len({strip(t) for t in odd_texts()})
    assert exact_dedup.exact_duplicates(empty(docs)).count() == 0


# --- 2
def test_language_codes_and_answers(spark):
    rng = random.Random(2)
    sets = {"aa": "abcde", "bb": "defgh", "cc": "ghijk", "dd": "jklmn", "ee": "mnopq", "ff": "pqrst", "gg": "stuvw"}
    rows = [(i, prose(rng, 60, sets[l]), l) for i, l in enumerate(list(sets) * 30)]
    rows += [(900, None, "aa"), (901, "12 !", "bb"), (902, prose(rng, 5), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = language_id.held_out()
    got = {r["doc_id"]: r for r in language_id.predict(docs, language_id.learn(docs.where(~held))).collect()}
    assert len(got) == len(rows)
    assert np.mean([got[i]["lang_pred"] == l for i, _, l in rows[:210]]) > 0.98
    assert got[900]["lang_pred"] == got[901]["lang_pred"] == "und" and got[900]["score"] == 0
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert language_id.predict(docs, language_id.learn(docs.where("false"))).where("lang_pred <> 'und'").count() == 0


def test_codewords_differ():
    for n in (1, 2, 3, 4, 6, 7, 30):
        code = language_id.codewords(n)
        assert len({tuple(r) for r in code}) == n if n > 1 else code.shape[0] == 1


# --- 3
def test_aliases_take_decisions(spark):
    page = '<html><head>{}</head></html>'.format
    pages = [
        (1, "http://a.example.net/x", None),
        (2, "https://b.org/x", page('<link href="http://a.example.net/x" rel="canonical">').replace('href="http://a.example.net/x" rel="canonical"', 'rel="canonical" href="http://a.example.net/x"')),
        (3, "https://c.org/y?q=1", page('<meta http-equiv="refresh" content="0; url=https://b.org/x">')),
        (4, "https://d.org/z", page("<link rel=canonical href=/fr/ok>")),
        (5, "https://e.info/", page("<link rel='canonical' href='https://d.org/fr/ok'>") + page('<meta http-equiv=refresh content="1;URL=http://x.net/">')),
        (6, "HTTP://Www.Example.NET/en/1#t", None),
        (7, None, page("<link rel=canonical href=http://x.net/>")),
        (8, "not a url", None),
        (9, "http://x.net", None),
        (9, "http://x.net", None),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"], r["via"]) for r in url_filter.judge(df).collect()}
    assert got[1] == ("a.example.net", "/x", "net/", "block", "rule")
    assert got[2][2:] == (None, "block", "alias") and got[3][2:] == (None, "block", "alias")
    assert got[4][2:] == (None, "allow", "alias") and got[5][2:] == (None, "allow", "alias")
    assert got[6] == ("www.example.net", "/en/1", "example.net/en/", "allow", "rule")
    assert got[7] == ("", "", None, "allow", "default") and got[8][:2] == ("", "")
    assert got[9] == ("x.net", "", None, "allow", "default")
    assert url_filter.judge(df).count() == len(pages) and url_filter.judge(df.where("false")).count() == 0


# --- 4
def test_quality_held_out(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.measured(docs)
    model = quality.learn(rows, labels.where("doc_id % 2 = 0"))
    told = quality.assess(rows, model, keep_from=0.5).join(labels.where("doc_id % 2 = 1"), "doc_id").select("quality", "quality_kept").collect()
    good = [r["quality_kept"] for r in told if r["quality"] == 1]
    bad = [r["quality_kept"] for r in told if r["quality"] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.3


def test_quality_edges(spark):
    docs = documents(spark, odd_texts(), source=lambda i: None if i % 4 == 0 else f"s{i}")
    labels = spark.createDataFrame([(4, 1), (4, 1), (5, 0), (7, 1), (8, None), (None, 1)], "doc_id long, quality int")
    rows = quality.measured(docs)
    got = quality.assess(rows, quality.learn(rows, labels)).collect()
    assert len(got) == docs.count() and all(0 < r["quality_score"] < 1 for r in got)
    assert quality.keep_good(docs, labels.where("false")).count() == docs.count()
    assert quality.keep_good(empty(docs), labels).count() == 0
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_small_sites_are_drawn_to_the_whole(spark):
    rows = spark.createDataFrame([(1, 0, 0.8), (1000, 100, 0.8), (1000, 990, 0.8)], "n long, good long, above double")
    prior = {r["n"]: r["prior"] for r in quality.shrunk(rows, 0.8).where("good < 900").collect()}
    assert prior[1] > 0.25 and prior[1000] < 0.2


# --- 5
def test_toxicity_edges_and_held_out(spark):
    rng = random.Random(4)
    texts = [prose(rng, 80) for _ in range(500)]
    toxic = [i for i in range(500) if i % 4 == 0]
    for i in toxic:
        words = texts[i].split()
        for at in rng.sample(range(80), 6):
            words[at] = rng.choice(["vilezzz", "xoxqq", "grrkk"])
        texts[i] = " ".join(words)
    rows = list(enumerate(texts)) + [(600, None), (601, ""), (602, "12 34")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("toxic", F.lit(9))
    labels = spark.createDataFrame([(i, int(i in toxic)) for i in range(500)] + [(0, 0), (1, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(docs, toxicity.learn(docs, labels)).withColumn("held", toxicity.fold_of() == 0).collect()}
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    held = [(got[i]["predicted"], int(i in toxic)) for i in range(500) if got[i]["held"]]
    assert held and np.mean([a == b for a, b in held]) > 0.97
    assert got[600]["score"] == got[601]["score"] == got[602]["score"] < 0.5
    none = toxicity.score(docs, toxicity.learn(docs, labels.where("toxic = 0")))
    assert none.agg(F.max("score")).first()[0] == 0


def test_kneser_ney_ratios_match_brute_force(spark):
    rows = [("abab cab", 1), ("abba bac abab", 0), ("caca bab", 0)]
    counted = toxicity.count_grams(spark.createDataFrame(rows, "text string, toxic int"))
    grams = lambda t: [f" {t} "[i : i + 4] for i in range(len(t) - 1)]
    counts = [Counter(g for t, y in rows if y == c for g in grams(t)) for c in (0, 1)]
    known = set(counts[0]) | set(counts[1])
    d = toxicity.DISCOUNT

    def shared(g):
        ends = Counter(k[1:] for k in known)
        lower = [k for k in ends if k[:2] == g[1:3]]
        return (max(ends[g[1:]] - d, 0) + d * len(lower) / toxicity.ALPHABET) / sum(ends[k] for k in lower)

    def chance(c, g):
        own = {k: n for k, n in counts[c].items() if k[:3] == g[:3]}
        total = sum(own.values())
        return shared(g) if not total else max(own.get(g, 0) - d, 0) / total + d * len(own) / total * shared(g)

    got = {int(r["gram"]).to_bytes(4, "big").decode(): r["ratio"] for r in toxicity.ratios(counted)[0].collect()}
    assert got.keys() == known
    for g in known:
        assert got[g] == pytest.approx(np.log(chance(1, g) / chance(0, g)))


# --- 6
def brute_hits(text, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w = words(text)
    hit, names = set(), set()
    for item, phrase in items:
        p = words(phrase)
        n = min(len(p), window)
        known = {tuple(p[i : i + n]) for i in range(len(p) - n + 1)} if p else set()
        for i in range(len(w) - n + 1) if p else ():
            if tuple(w[i : i + n]) in known:
                hit.update(range(i, i + n))
                names.add(str(item))
    return len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("most", [decontamination.PHRASE_BYTES, 100])
def test_decontamination_matches_brute_force(spark, most):
    rng = random.Random(6)
    items = [(i, prose(rng, rng.choice([3, 8, 10, 11, 25, 40]), "abc")) for i in range(25)] + [(90, None), (91, "?!"), (92, "ab a")]
    items += [(93, items[0][1])]
    texts = [None, "", "?", "ab a", "AB-a ab;A"]
    for _ in range(60):
        parts = [rng.choice([prose(rng, rng.randint(0, 30), "abc"), prose(rng, 5), rng.choice(items[:25])[1].upper()]) for _ in range(rng.randint(0, 5))]
        texts.append(rng.choice([" ", ", "]).join(parts))
    docs = documents(spark, texts)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.occurrences(docs, benchmark, most=most)
    got = {r[0]: tuple(r)[1:] for r in decontamination.digest(found).collect()}
    for i, t in enumerate(texts):
        assert got[i] == brute_hits(t, items), t
    clean = {r["doc_id"]: r for r in decontamination.remove_phrases(docs, benchmark, most=most).collect()}
    for i, t in enumerate(texts):
        assert (clean[i]["text"] == t) == (got[i][1] == 0)
        assert clean[i]["n_chars"] == len(clean[i]["text"] or "")
    none = decontamination.digest(decontamination.occurrences(docs, benchmark.where("false"))).agg(F.sum("n_hit"), F.count("*")).first()
    assert tuple(none) == (0, len(texts))


def test_wavelet_ranks_and_index():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 6, 300)
    tree = decontamination.WaveletTree(text, 6)
    for c in range(6):
        ends = np.arange(301)
        assert (tree.rank(np.full(301, c), ends) == np.concatenate([[0], np.cumsum(text == c)])).all()
    index = decontamination.FMIndex(text, 6)
    windows = np.array([[1, 2, 0], [3, 4, 5], [2, 2, 2]])
    low, high = index.search(windows, np.array([2, 3, 3]))
    for w, n, a, b in zip(windows, (2, 3, 3), low, high):
        want = [i for i in range(300 - n + 1) if (text[i : i + n] == w[:n]).all()]
        assert sorted(index.locate(np.arange(a, b))) == want


# --- 7
def brute_removed(rows, length):
    seen, out = set(), {}
    for i, t in sorted(rows):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            w = data[s : s + length]
            if w in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(w)
        spans = sum(1 for k in range(len(data)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 3])
def test_suffix_dedup_matches_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "ARRAY", 20_000)
    rng = random.Random(hot)
    passages = ["".join(rng.choice("abcdefg é") for _ in range(rng.randint(60, 400))) for _ in range(10)]
    texts = [None, "", "a" * 99, "a" * 3000, "ab" * 700]
    for _ in range(150):
        parts = [rng.choice([rng.choice(passages), "".join(rng.choice("abcdefg é") for _ in range(rng.randint(0, 120)))]) for _ in range(rng.randint(0, 6))]
        texts.append("".join(parts))
    texts += texts[20:25]
    monkeypatch.setattr(suffix_dedup, "MOST_RUNS", hot)
    docs = documents(spark, texts).repartition(5)
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.digest(suffix_dedup.removed(docs)).collect()}
    assert got == brute_removed(list(enumerate(texts)), suffix_dedup.LENGTH)
    assert suffix_dedup.removed(empty(docs)).count() == 0


@pytest.mark.parametrize("copies", [1, 3])
def test_suffix_dedup_of_short_periodic_texts(spark, copies):
    """Texts that repeat themselves within one run of few passages, alone and as copies."""
    rng = random.Random(copies)
    texts = []
    for size in range(100, 221, 3):
        for period in (1, 2, 3, 7, 20, 24, 40, 76, 77, 78, 90):
            unit = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz -.é") for _ in range(period))
            head, tail = ("".join(rng.choice("ABCDEFG") for _ in range(rng.randint(0, 90) * (size % 2))) for _ in range(2))
            texts += [head + (unit * size)[:size] + tail] * copies
    texts += ["#" * 150, "=" * 120, "word " * 20]
    docs = documents(spark, texts).repartition(5)
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.digest(suffix_dedup.removed(docs)).collect()}
    assert got == brute_removed(list(enumerate(texts)), suffix_dedup.LENGTH)
    assert got[len(texts) - 3][1] == 149


def test_maximal_repeats_have_all_occurrences():
    texts = [b"xabcdey", b"zabcdew", b"qabcdev", b"abcd"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    left = np.concatenate([np.arange(len(t), 0, -1) for t in texts])
    suffix, length, first = suffix_dedup.maximal_repeats(data, left, np.arange(len(data)), 4)
    assert sorted(zip(suffix.tolist(), length.tolist(), first.tolist())) == [(8, 5, 1), (15, 5, 1), (21, 4, 1)]


# --- 8
def test_token_counts_match_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(8)
    signs = ["'s", "'re", "'v", "'", "''", "!", "a", "re", "ll", "É", "é", "1", "²", " ", "\n", "\x1c", "<|endoftext|>", "中文", "İ", "ΑΣ ", "😀", "don't", "\x00", "ﬁ", "é"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 25))) for _ in range(3000)] + [t or "" for t in odd_texts()]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    got = {r["doc_id"]: r for r in token_count.token_counts(documents(spark, [*texts, None]), path).collect()}
    assert [got[i]["n_tokens"] for i in range(len(texts))] == want
    assert got[len(texts)]["n_tokens"] == got[len(texts)]["n_bytes"] == 0
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in got.values())


def test_maps_of_pieces_compose(monkeypatch):
    import public_tokenizers

    counter = token_count.Counter(token_count.compiled(public_tokenizers.path("word_bpe_49k.json")))
    text = prose(random.Random(3), 400) + "don't" * 30 + " x'll y"
    want = counter.counts([text])
    for piece in (1, 7, 64, 1000):
        monkeypatch.setattr(token_count, "PIECE", piece)
        assert counter.counts([text]) == want


# --- 9
def brute_fingerprint(text, k=3):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash_components_match_brute_force(spark):
    rng = random.Random(9)
    base = [prose(rng, 200) for _ in range(6)]
    texts = odd_texts() + [b if rng.random() < 0.3 else b + " " + prose(rng, 1) for b in base for _ in range(6)] + ["a b", "A\tB", None]
    prints = [brute_fingerprint(t) for t in texts]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(documents(spark, texts)).collect()}
    assert got == {i: (f"{prints[i]:016x}", find(i)) for i in range(len(texts))}
    assert simhash.near_duplicates(empty(documents(spark, texts))).count() == 0


def test_groups_of_random_prints(spark):
    """Chains and large clusters of fingerprints, as all pairs would join them."""
    rng = random.Random(10)
    prints = {rng.getrandbits(64) for _ in range(40)}
    for p in list(prints):
        for n in (1, 2, 3, 4):
            prints.add(p ^ sum(1 << b for b in rng.sample(range(64), n)))
    centre = rng.getrandbits(64)
    for _ in range(300):
        prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    parent = {p: p for p in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(signed):
        for b in signed[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    rows = spark.createDataFrame([(p, [p]) for p in signed], "number long, words array<long>")
    got = {r["node"]: r["component"] for r in simhash.linked_groups(rows, 1, 32, 3, 3).collect()}
    assert all(got.get(p, p) == find(p) for p in signed)


def test_near_copies_by_similarity(spark):
    rng = random.Random(11)
    texts, of = [], []
    for g in range(12):
        base = prose(rng, 250).split()
        for c in range(6):
            words = list(base)
            for at in rng.sample(range(250), 4 if c else 0):  # Jaccard similarity about 0.85
                words[at] = prose(rng, 1)
            texts.append(" ".join(words))
            of.append(g)
    docs = documents(spark, [*texts, None, ""])
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(docs).collect()}
    assert all(of[got[i]] == of[i] for i in range(len(texts)))  # never across groups
    assert np.mean([got[i] == of.index(of[i]) for i in range(len(texts))]) >= 0.9
    assert got[len(texts)] == got[len(texts) + 1] == len(texts)
    left = simhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns and left.count() <= 12 + 8


def test_near_copies_are_all_pairs_of_the_similarity(spark):
    """Pairs from 0.6 to 0.95, many close to 0.8, joined as all pairs by exact similarity would be."""
    rng = random.Random(13)
    texts = []
    for g in range(60):
        base = prose(rng, rng.randint(20, 200)).split()
        texts.append(" ".join(base))
        for c in range(2):
            words = list(base)
            for at in rng.sample(range(len(base)), max(1, round(len(base) * rng.uniform(0.01, 0.06)))):
                words[at] = prose(rng, 1)
            texts.append(" ".join(words))
    line = prose(rng, 60)
    texts += [line + " " + prose(rng, rng.randint(5, 20)) for _ in range(60)] + [None, "", "a b", "A  b"]
    sets = [{" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for t in texts for w in [(t or "").lower().split()]]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    near = 0
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            alike = len(x & y) / len(x | y) if x | y else 1
            near += 0.75 < alike < 0.85
            if alike >= 0.8:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    assert near > 20
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(documents(spark, texts).repartition(5)).collect()}
    assert got == {i: find(i) for i in range(len(texts))}
    assert simhash.similar_documents(empty(documents(spark, texts))).count() == 0


def test_templated_pages_below_the_similarity_stay(spark):
    """Pages that share 70 to 79% of their shingles are no near copies, though each has many such neighbours."""
    rng = random.Random(14)
    line = prose(rng, 204)  # 200 shingles; with 35 words of its own, two pages have 200 of 270 in common
    docs = documents(spark, [line + " " + prose(rng, 35) for _ in range(80)])
    assert simhash.drop_near_duplicates(docs).count() == 80


# --- 10
def test_mix_targets_and_takings(spark):
    rng = random.Random(12)
    texts = [None if i % 50 == 0 else prose(rng, rng.randint(0, 60)) for i in range(600)]
    texts[7] = prose(rng, 3000)
    names = [None, "", "a", "b", "ä", "z"]
    docs = documents(spark, texts, source=lambda i: names[min(5, i % 40)])
    rows = mixing.mix(docs).collect()
    sizes = Counter()
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]] or ""))
        assert 0 <= r["taken"] <= 3 * r["size"]
        sizes[r["source"]] += r["size"]
    order = ["", "a", "b", "z", "ä", None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    while True:
        rest = sum(sizes.values()) - sum(target.values())
        level = rest / sum(weight[s] for s in open_)
        over = {s for s in open_ if 3 * sizes[s] < level * weight[s]}
        if not over:
            break
        for s in over:
            target[s] = 3 * sizes[s]
        open_ -= over
    target |= {s: level * weight[s] for s in open_}
    taken = Counter()
    for r in rows:
        assert r["target"] == pytest.approx(target[r["source"]])
        taken[r["source"]] += r["taken"]
    assert all(taken[s] == pytest.approx(target[s], abs=1.001) for s in order)
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(docs.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}
    other = {r["doc_id"]: r["taken"] for r in mixing.mix(docs, seed=7).collect()}
    assert other != again
    assert mixing.mix(empty(docs)).count() == 0
    assert mixing.mix(documents(spark, [None, ""])).agg(F.sum("taken")).first()[0] == 0
    assert set(docs.columns) < set(mixing.mixed_documents(docs).columns)
