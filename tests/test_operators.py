"""Small cases of single operators, stated as rows."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from dayline import lexicon
from dayline.functions import text, urls, values
from dayline.functions.arrow import match_text
from dayline.operators import clean, memory, relevance, runlog, similarity, trends
from dayline.operators.components import connected_components, first_fit
from dayline.operators.groups import lookup, number_rows

RAW = "pos BIGINT, id STRING, title STRING, source STRING, url STRING, published_at TIMESTAMP, source_type STRING, language STRING, summary STRING, content STRING, metadata MAP<STRING,STRING>, report_date DATE"


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def raw(spark, *rows):
    from datetime import date, datetime

    base = {"title": "OpenAI launches developer agents", "source": "s", "url": "https://example.com/a", "published_at": datetime(2026, 5, 20, 10), "source_type": "blog", "language": "en", "summary": "text", "content": "body", "metadata": {}, "report_date": date(2026, 5, 20)}
    names = ["pos", "id", *base]
    data = [tuple({**base, "pos": i, "id": f"raw-{i}", **r}[n] for n in names) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, RAW)


def test_unicode_space_and_fingerprint(spark):
    assert one(spark, text.squeeze(F.lit(" a 　 b\x1c\n"))) == "a b"
    assert one(spark, text.strip(F.lit(" x "))) == "x"
    assert one(spark, text.title_fingerprint(F.lit("Héllo—World_9，你好!"))) == "héllo world_9 你好"
    assert one(spark, text.first_sentence(F.lit("一。 二"))) == "一。"


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("https://Example.com/a?utm_source=newsletter&id=42#section", "https://example.com/a?id=42"),
        ("http://x.com:80", "http://x.com/"),
        ("https://x.com:443/a//?b=2&a=1&c&ref=x", "https://x.com/a?a=1&b=2&c="),
        ("foo/BAR", "foo/bar"),
        ("https://x.com/?q=a+b%7E*", "https://x.com/?q=a+b~%2A"),
        ("", ""),
    ],
)
def test_canonical_url(spark, given, wanted):
    assert one(spark, urls.canonical_url(F.lit(given))) == wanted


def test_dates_and_cost(spark):
    at = lambda s: one(spark, F.unix_seconds(values.feed_timestamp(F.lit(s))))
    assert at("2026-05-20T10:00:00Z") == at("Wed, 20 May 2026 18:00:00 +0800") == at("2026-05-20T10:00:00")
    assert at("junk") is None
    assert one(spark, values.token_cost(F.lit(1000), F.lit(-5), F.lit(0.5), F.lit(1.0), F.lit(1000))) == 0.5


def test_quote_form(spark):
    assert one(spark, match_text(F.lit("“Straße”  Ｘ"))) == '"strasse" x'


def test_duplicates_by_url_and_title(spark):
    rows = raw(
        spark,
        {"url": "https://a.com/1?utm_source=x", "title": "First"},
        {"url": "https://a.com/1", "title": "Second"},
        {"url": "https://b.com/2", "title": "second!", "content": "a much longer body"},
        {"url": "https://c.com/3", "title": "Other"},
    )
    ready = clean.identity(clean.require_fields(rows))
    groups = clean.duplicate_groups(ready)
    assert {r["pos"] for r in clean.survivors(groups).collect()} == {2, 3}
    audit = clean.duplicate_audit(groups).collect()
    assert {(r["kept_id"], r["discarded_id"], r["reasons"]) for r in audit} == {("raw-2", "raw-0", "canonical_url,title_fingerprint,content_hash"), ("raw-2", "raw-1", "canonical_url,title_fingerprint,content_hash")}


def test_report_timezone(spark):
    from datetime import datetime

    rows = raw(spark, {"published_at": datetime(2026, 5, 19, 16, 30)}, {"published_at": datetime(2026, 5, 20, 16, 30)})
    assert [r["pos"] for r in clean.on_report_date(rows, "Asia/Shanghai").collect()] == [0]


@pytest.mark.parametrize(
    "title, summary, accepted",
    [
        ("Inference engine", "vllm improves model serving and token throughput", True),
        ("New AI Act policy", "targets generative ai audits", True),
        ("Phone camera filter", "launch of a phone with perplexity photo effects", False),
        ("Privacy bill", "general data compliance", False),
        ("某云服务", "该云服务没有明确的大模型训练任务", False),
        ("大模型推理", "推理引擎 提升 token 吞吐", True),
    ],
)
def test_relevance(spark, title, summary, accepted):
    got = relevance.relevance(raw(spark, {"title": title, "summary": summary, "content": ""})).first()
    assert got["is_ai_related"] is accepted


def test_components_and_first_fit_match_brute_force(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 130)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    wanted = {n: find(n) for e in edges if e[0] != e[1] for n in e}
    got = connected_components(spark.createDataFrame(edges, "a BIGINT, b BIGINT"))
    assert {r["node"]: r["component"] for r in got.collect()} == wanted

    claims = [(pos, f"k{rng.randrange(40)}") for pos in range(60) for _ in range(2)]
    taken, kept = set(), set()
    for pos in range(60):
        keys = {v for p, v in claims if p == pos}
        if not keys & taken:
            kept.add(pos)
            taken |= keys
    assert {r["pos"] for r in first_fit(spark.createDataFrame(claims, "pos BIGINT, value STRING")).collect()} == kept


def test_numbering_a_hot_group(spark):
    rows = spark.range(5000).select((F.col("id") % 7).alias("score"), F.col("id").alias("pos"), F.lit("hot").alias("g"))
    got = number_rows(rows, ["g"], [F.col("score").desc(), F.col("pos")], [-F.col("score"), F.floor(F.col("pos") / 100)]).collect()
    ordered = sorted(got, key=lambda r: (-r["score"], r["pos"]))
    assert [r["rn"] for r in ordered] == list(range(1, 5001))


def test_hot_lookup_is_split(spark):
    """A key owning most rows is spread over several tasks by adaptive execution."""
    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor") if spark.conf.get(k, None) is not None}
    for key, value in {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}.items():
        spark.conf.set(key, value)
    try:
        left = spark.range(400_000, numPartitions=8).select(F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), F.sha1(F.col("id").cast("string")).alias("v"))
        right = left.groupBy("k").agg(F.min("v").alias("m"))
        joined = lookup(left, right, ["k"], "inner")
        collected = joined.agg(F.count(F.lit(1)).alias("n"), F.max("v"), F.max("m"))
        assert collected.collect()[0]["n"] == 400_000
        assert "skew=true" in collected._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor"):
            spark.conf.set(key, saved[key]) if key in saved else spark.conf.unset(key)


@pytest.mark.parametrize(
    "current, history, state",
    [([(88, "low", "high")], [(82, "low", "high")], "continuing"), ([(80, "low", "high"), (75, "low", "high")], [(70, "low", "high")], "heating_up"), ([(70, "low", "high")], [(92, "low", "high"), (88, "low", "high")], "cooling_down"), ([(80, "high", "low")], [(80, "low", "high")], "reversing"), ([(80, "low", "low")], [], "new")],
)
def test_trend_states(spark, current, history, state):
    schema = "report_date STRING, topic STRING, topic_key STRING, pos BIGINT, importance_score INT, risk_level STRING, opportunity_level STRING, event_type STRING"
    frame = lambda rows: spark.createDataFrame([("d", "AI Agents", "ai agents", i, *r, "research") for i, r in enumerate(rows)], schema)
    assert trends.trend_signals(frame(current), frame(history)).first()["trend_state"] == state


def test_similarity_cases(spark):
    item = "report_date STRING, topic STRING, id STRING, pos BIGINT, title STRING, summary STRING, entities ARRAY<STRING>, event_type STRING"
    now = spark.createDataFrame([("d", "agents", "i1", 0, "OpenAI releases GPT-5.1", "A new model", ["OpenAI"], "model_release"), ("d", "AI Agents", "i2", 1, "OpenAI expands GPT-5.2 rollout", "More users", ["OpenAI"], "model_release")], item)
    past = spark.createDataFrame([("d", "AI Agents", "ai agents", "m1", 0, 1, "OpenAI releases GPT-5.1", "A new model", ["OpenAI"], "model_release")], "report_date STRING, topic STRING, topic_key STRING, memory_item_id STRING, pos BIGINT, rank INT, title STRING, summary STRING, entities ARRAY<STRING>, event_type STRING")
    got = {r["item_id"]: r["relationship"] for r in similarity.score_pairs(similarity.candidate_pairs(now, past)).collect()}
    assert got == {"i1": "likely_duplicate", "i2": "continuing"}


def test_results_do_not_depend_on_partitioning(spark):
    rows = raw(spark, *[{"title": f"Title {i % 7}", "url": f"https://a.com/{i % 11}"} for i in range(60)])
    ready = clean.identity(clean.require_fields(rows))
    first = {r["pos"] for r in clean.dedupe(ready).select("pos").collect()}
    again = {r["pos"] for r in clean.dedupe(ready.repartition(13).orderBy(F.rand(1))).select("pos").collect()}
    assert first == again


def test_write_guard_and_progress(spark):
    assert memory.may_write("replay", True) == (False, "non_fresh_run")
    assert memory.may_write("fresh", False) == (False, "daily_report_missing")
    steps = spark.createDataFrame([("r", "running", "a", 1, "succeeded"), ("r", "running", "b", 2, "pending")], "run_id STRING, run_status STRING, step_name STRING, step_order INT, status STRING")
    row = runlog.run_progress(steps).first()
    assert (row["percent"], row["current_step"]) == (50, "b")


def test_vocabularies_stay_consistent():
    assert len(lexicon.TOPICS) == 8 and set(lexicon.TOPIC_WORDS) == set(lexicon.TOPICS)


def test_retrieval_by_instant_prunes_history(spark, tmp_path):
    from datetime import date, datetime

    columns = "pos BIGINT, id STRING, memory_item_id STRING, validated_item_id STRING, source_item_id STRING, url STRING, content_hash STRING, topic STRING, published_at TIMESTAMP"
    days = [datetime(2026, 1, 3, 0, 30), datetime(2026, 1, 4), datetime(2026, 1, 10, 23), datetime(2026, 1, 11)]
    rows = [(i, f"e{i}", f"m{i}", f"v{i}", "", f"u{i}", f"h{i}", "AI Agents", at) for i, at in enumerate(days)]
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "history"))
    history = spark.read.parquet(str(tmp_path / "history"))
    current = spark.createDataFrame([(date(2026, 1, 10), "AI Agents", "c", "x", "y")], "report_date DATE, topic STRING, id STRING, url STRING, content_hash STRING")
    ids = lambda **k: [r["memory_item_id"] for r in memory.retrieve(history, current, **k).orderBy("rank").collect()]
    assert ids() == ["m2", "m1"]
    assert ids(as_of=F.lit(datetime(2026, 1, 10))) == ["m1", "m0"]
    assert ids(window_days=0) == []
    plan = memory.retrieve(history, current)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Filter .*published_at#\d+ >= 2026.* < 2026.*\n.*Relation .*parquet", plan)


def test_null_fields_of_context_lines_are_empty(spark):
    from datetime import datetime

    row = (1, datetime(2026, 1, 1), "t", "s", 5, None, "AI Agents")
    line = memory.context_lines(spark.createDataFrame([row], "rank INT, published_at TIMESTAMP, title STRING, source STRING, importance_score INT, summary STRING, topic STRING")).first()["line"]
    assert line == "1. [2026-01-01T00:00:00+00:00] t (s) importance=5: "


def test_null_step_is_not_the_total(spark):
    calls = spark.createDataFrame(
        [("r", None, True, 1, 1, 2, 0.5, 3, None)],
        "run_id STRING, step_name STRING, success BOOLEAN, prompt_tokens INT, completion_tokens INT, total_tokens INT, cost_usd DOUBLE, elapsed_ms INT, error STRING",
    )
    assert sorted(str(r["step_name"]) for r in runlog.call_rollup(calls).collect()) == ["None", "all"]


def test_publish_that_fails_in_the_middle_keeps_the_version_before(spark, tmp_path):
    from dayline.sources import tables

    target = str(tmp_path)
    tables.publish(spark.range(5).select("id"), target, "1")
    broken = spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        tables.publish(broken, target, "2")
    assert tables.published(spark, target).count() == 5
    tables.publish(spark.range(2).select("id"), target, "3")
    assert tables.published(spark, target).count() == 2


def test_squeeze_is_one_blank_per_run_of_any_blanks(spark):
    parts = ["a", "ä", "–", ".", " ", "  ", "\n", " \n", "\t ", "\x1c", "\x85", "\xa0", " ", " ", " ", " ", "　"]
    texts = ["".join(p) for p in itertools.product(parts, repeat=3)] + ["", None, "x" + " y\n z" * 50]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select("t", text.squeeze(F.col("t")).alias("s"), text.plain_spacing(F.col("t")).alias("p"), text.first_sentence(text.squeeze(F.col("t"))).alias("a"), text.squeeze(text.first_sentence(F.col("t"))).alias("b")).collect()
    for r in got:
        squeezed = re.sub(text.SPACE + "+", " ", r["t"] or "").strip(" ")
        assert r["s"] == squeezed and r["p"] == re.sub(" ([.,;:!?])", r"\1", squeezed) and r["a"] == r["b"]


def test_what_a_row_gives_once_is_not_made_per_pair(spark):
    """Patterns are searched per item and per entry: behind the join of pairs no text is searched."""
    shape = "report_date date, id string, pos long, title string, summary string, topic string, entities array<string>, event_type string"
    items = spark.createDataFrame([], shape)
    pairs = similarity.candidate_pairs(items, items.withColumns({"memory_item_id": F.col("id"), "rank": F.lit(1)}))
    assert {"l_specific", "r_specific", "l_follows"} <= set(pairs.columns) and not {"l_both", "r_both", "l_title"} & set(pairs.columns)


def test_lines_of_article_blocks_are_spaced_once(spark):
    from dayline.plans import source_plans

    plan = source_plans.blocks(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("([.,;:!?])") == 1


def test_counting_complete_items_squeezes_no_text(spark):
    shape = "title string, source string, url string, summary string, content string, published_at timestamp, report_date date"
    rows = [("t", "s", "u", "", " 　x", None, None), ("　", "s", "u", "a", "b", None, None), ("t", "s", "u", None, " \n", None, None)]
    counts = clean.clean_counts(spark.createDataFrame(rows, shape))
    assert counts.first()["raw_count"] == 3 and counts.first()["filtered_incomplete_count"] == 2
    assert "regexp_replace" not in counts._jdf.queryExecution().optimizedPlan().toString().lower()
