"""Components and keys that grow batch by batch, against all at once."""

import random
import re

from pyspark.sql import functions as F

from dayline.operators import components, memory
from dayline.operators.key_index import KeyIndex
from dayline.streaming.ingest import ingest


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "a string, b string")


def roots(pairs):
    parent = {}

    def find(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {n: find(n) for n in parent}


def test_components_grow_as_they_are_all_at_once(spark):
    rng = random.Random(1)
    days = [[(f"n{rng.randint(0, 400):03d}", f"n{rng.randint(0, 400):03d}") for _ in range(60)] for _ in range(4)]
    known, so_far = None, []
    for day in days:
        known = components.extend_components(known, edges(spark, day))
        so_far += [(a, b) for a, b in day if a != b]
        assert {r["node"]: r["component"] for r in known.collect()} == roots(so_far)
    again = components.extend_components(known, edges(spark, days[0] + [("n001", "n001")]))
    assert {r["node"]: r["component"] for r in again.collect()} == roots(so_far)


def test_a_day_only_touches_the_roots_it_joins(spark):
    chain = [(f"a{i:04d}", f"a{i + 1:04d}") for i in range(300)] + [(f"b{i:04d}", f"b{i + 1:04d}") for i in range(300)]
    known = components.extend_components(None, edges(spark, chain))
    day = edges(spark, [("a0007", "a0200"), ("a0100", "b0100"), ("c1", "c2"), ("b0300", "c2")])
    met = components.contract(known, day).where("x <> y")
    # Of 602 known nodes and 4 new edges, three pairs of roots and new nodes enter the rounds.
    assert {(r["x"], r["y"]) for r in met.collect()} == {("a0000", "b0000"), ("c1", "c2"), ("b0000", "c2")}
    grown = components.extend_components(known, day)
    assert grown.count() == 604 and {r["component"] for r in grown.collect()} == {"a0000"}


def test_the_key_index_finds_all_and_reads_few(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path), buckets=32, slices=4)
    claims = lambda names: spark.createDataFrame([(i, n) for i, n in enumerate(names)], "pos long, value string")
    assert index.known(claims(["x"])).count() == 0  # nothing entered yet
    index.add(claims([f"k{i}" for i in range(20_000)] * 2), 0)
    index.add(claims([f"m{i}" for i in range(5_000)]), 1)
    asked = claims([f"k{i}" for i in range(0, 20_000, 500)] + ["m7", "m7"] + [f"other{i}" for i in range(20_000)])
    known = {r["value"] for r in index.known(asked).collect()}
    assert known == {f"k{i}" for i in range(0, 20_000, 500)} | {"m7"}
    likely = index.candidates(asked).count()
    assert 42 <= likely < 42 + 20_000 * 0.05  # a key in some twenty passes the filters unknown, at most
    one = index.known(claims(["k9"]))
    bucket = index.candidates(claims(["k9"])).first()["bucket"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1 and re.search(rf"PartitionFilters: \[[^\]]*bucket#\d+ = {bucket}", plan)
    files = index.stored([bucket]).select(F.input_file_name().alias("f")).distinct().collect()
    assert len(files) == 2 and all(f"/bucket={bucket}/" in r["f"] for r in files)
    assert index.known(claims(["k9", "m9"]), but_of=1).count() == 1
    index.add(claims(["only"]), 1)  # a repeated batch replaces its keys
    held = index.stored(list(range(32)))
    assert held.where("batch_id = '1'").count() <= 5_000 and index.known(claims(["only"])).count() == 1


FIELDS = "pos long, report_date date, id string, title string, source string, url string, published_at timestamp, source_type string, language string, summary string, content string, metadata map<string,string>"


def test_a_stream_meets_its_state_across_batches_and_restarts(spark, tmp_path):
    def land(part, *rows):
        full = [(p, None, f"raw-{p}", f"title {t}", "s", f"https://a.com/{u}", None, "news", "en", "sum", "con", {}) for p, t, u in rows]
        spark.createDataFrame(full, FIELDS).write.parquet(f"{tmp_path}/in/{part}")

    def entries(batch):
        keyed = batch.withColumns({"memory_item_id": F.col("id"), "validated_item_id": F.col("id"), "source_item_id": F.col("id"), "topic_key": F.lit("t")})
        return keyed.select("pos", "topic_key", *memory.ENTRY_KEYS)

    index = KeyIndex(spark, f"{tmp_path}/keys", buckets=4)
    index.add(spark.createDataFrame([("t\x1fhttps://a.com/old",)], "value string"), "history")
    run = lambda: ingest(
        spark.readStream.schema(FIELDS).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in"), entries, index, f"{tmp_path}/out", f"{tmp_path}/offsets"
    ).trigger(availableNow=True).start().awaitTermination()
    kept = lambda: sorted(r["pos"] for r in spark.read.parquet(f"{tmp_path}/out").collect())
    land(1, (1, "one", "x"), (2, "two", "old"), (3, "one", "y"), (4, "three", "z"))
    run()
    assert kept() == [1, 4]  # 2 is known from history, 3 repeats the title of 1
    land(2, (5, "five", "x"), (6, "six", "w"))
    run()
    land(3, (7, "six", "v"), (8, "eight", "u"))
    run()
    assert kept() == [1, 4, 6, 8]
    # A batch that is repeated finds its own keys in the index, and adds the same rows once.
    batch = spark.read.schema(FIELDS).parquet(f"{tmp_path}/in/3")
    from dayline.operators.clean import identity, require_fields

    again = memory.appendable_by_index(entries(identity(require_fields(batch))), index, 2)
    assert [r["pos"] for r in again.collect()] == [8]


def test_finished_components_leave_the_rounds(spark, monkeypatch):
    written = []

    def counted(table, keep=components.durable):
        made = keep(table)
        written.append(made.count())
        return made

    monkeypatch.setattr(components, "durable", counted)
    pairs = [(f"p{i:04d}", f"q{i:04d}") for i in range(600)] + [(f"x{i:03d}", f"x{i + 1:03d}") for i in range(100)]
    got = {r["node"]: r["component"] for r in components.connected_components(edges(spark, pairs)).collect()}
    assert got == roots(pairs)
    # 700 links, moves of 1,301 nodes twice and their components twice; every later round has the chain's rest alone.
    assert sum(written) < 700 + 4 * 1301 + 700 and sum(n >= 600 for n in written) <= 5


def test_a_group_is_named_by_its_first_position(spark):
    from dayline.operators import clean

    rows = spark.createDataFrame(
        [(7, "u1", "t1"), (9, "u1", "t2"), (4, "u2", "t2"), (5, "u3", "t3"), (2, "u4", ""), (3, "u5", ""), (6, "u5", "")],
        "pos long, canonical_url string, title_fingerprint string",
    ).select(
        "*", F.concat(F.lit("raw-"), F.col("pos")).alias("id"), F.col("canonical_url").alias("url"), F.lit("s").alias("source"), F.lit("h").alias("content_hash"),
        F.lit("c").alias("content"), F.lit("s").alias("summary"), F.create_map(F.lit("k"), F.lit("v")).alias("metadata"),
    )
    grouped = clean.duplicate_groups(rows, scope=())
    assert {r["pos"]: r["group_key"] for r in grouped.collect()} == {7: 4, 9: 4, 4: 4, 5: 5, 2: 2, 3: 3, 6: 3}
    summary = {r["group_key"]: (r["group_size"], r["reasons"]) for r in clean.duplicate_summary(grouped).collect()}
    every = "canonical_url,title_fingerprint,content_hash"
    assert summary == {4: (3, every), 3: (2, every)}


def test_a_value_that_a_rule_names_often_is_computed_once(spark):
    from dayline.functions.text import first_sentence, title_fingerprint

    rows = spark.createDataFrame([("  One two.  Three",)], "t string")
    # Inside a generator nothing is shared by the engine: what is written twice runs twice.
    for made, name, wanted in ((first_sentence, "regexp_extract(", "One two."), (title_fingerprint, "lower(", "one two three")):
        got = rows.select(made(F.col("t")).alias("v"))
        assert got._jdf.queryExecution().analyzed().toString().count(name) == 1
        assert got.first()["v"] == wanted
