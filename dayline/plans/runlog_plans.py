"""Cost, health and progress: conversations as call logs, events as trace logs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from dayline.functions.text import word_count
from dayline.operators import extract, memory, runlog, scoring
from dayline.operators.key_index import KeyIndex
from dayline.plans import inputs, memory_plans
from dayline.plans.inputs import STRUCTURED_SQL, squeeze_sql, table
from dayline.session import checkpoint_folder
from dayline.sources import tables
from dayline.streaming.health import windowed_health
from dayline.streaming.ingest import ingest

PRICES = [("deepseek", "alpha", 0.0005, 0.004, 1000), ("other", "alpha", 0.001, 0.002, 1000), ("other", "beta", 2.0, 6.0, 1_000_000)]


def prices(spark):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(PRICES)], "pos INT, provider STRING, model STRING, input_price DOUBLE, output_price DOUBLE, unit_tokens INT")


def calls(spark, sf):
    """Each conversation turn as a model call of the run it belongs to."""
    c = table(spark, sf, "conversations")
    n = F.col("conv_id") + F.col("turn")
    return c.select(
        F.concat(F.lit("run-"), F.pmod(F.col("conv_id"), F.lit(50)).cast("string")).alias("run_id"), F.col("role").alias("step_name"), F.concat_ws("-", "conv_id", "turn").alias("item_id"),
        F.when(n % 3 == 0, "DeepSeek").when(n % 3 == 1, "other ").otherwise("").alias("provider"), F.when(n % 4 == 3, "gamma").when(n % 2 == 0, "Alpha").otherwise("beta").alias("model"),
        word_count(F.col("text")).cast("bigint").alias("prompt_tokens"), F.length("text").cast("bigint").alias("completion_tokens"), (word_count(F.col("text")) + F.length("text")).cast("bigint").alias("total_tokens"),
        (n % 11 != 0).alias("success"), (F.col("turn") * 7 + 3).alias("elapsed_ms"), F.when(n % 11 == 0, "timeout").alias("error"),
    )


def priced(spark, sf):
    return runlog.price_calls(calls(spark, sf), prices(spark))


def priced_calls(spark, sf):
    return priced(spark, sf).select("item_id", "cost_usd")


_TOK = "greatest(1, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')))"
CALLS_SQL = f"""calls AS (SELECT 'run-' || (conv_id % 50) AS run_id, role AS step_name, conv_id || '-' || turn AS item_id, CASE (conv_id + turn) % 3 WHEN 0 THEN 'deepseek' WHEN 1 THEN 'other' ELSE '' END AS provider,
  CASE WHEN (conv_id + turn) % 4 = 3 THEN 'gamma' WHEN (conv_id + turn) % 2 = 0 THEN 'alpha' ELSE 'beta' END AS model, {_TOK} AS pt, length(text) AS ct, (conv_id + turn) % 11 <> 0 AS success, turn * 7 + 3 AS elapsed_ms FROM conversations),
priced AS (SELECT *, CASE WHEN model = 'alpha' AND provider = 'other' THEN round(pt / 1000 * 0.001::DOUBLE + ct / 1000 * 0.002::DOUBLE, 10) WHEN model = 'alpha' THEN round(pt / 1000 * 0.0005::DOUBLE + ct / 1000 * 0.004::DOUBLE, 10)
  WHEN model = 'beta' THEN round(pt / 1000000 * 2::DOUBLE + ct / 1000000 * 6::DOUBLE, 10) ELSE 0 END AS cost_usd FROM calls)"""


def call_rollup(spark, sf):
    return runlog.call_rollup(priced(spark, sf))


_ROLLUP = f"""WITH {CALLS_SQL} SELECT run_id, coalesce(step_name, 'all') AS step_name, count(*) AS call_count, bool_and(success) AS success, sum(pt) AS prompt_tokens, sum(ct) AS completion_tokens, sum(pt + ct) AS total_tokens,
 sum(cost_usd::DECIMAL(20, 10))::DOUBLE AS cost_usd, sum(elapsed_ms) AS elapsed_ms, count_if(NOT success) AS error_count FROM priced GROUP BY GROUPING SETS ((run_id, step_name), (run_id))"""


def _trace(spark, sf):
    """Events as step events: a user is a run, an event type a step."""
    e = table(spark, sf, "events")
    kind = F.when(F.col("event_type") == "error", "step_failed").when(F.col("event_id") % 2 == 0, "step_started").otherwise("step_finished")
    return e.select(F.col("user_id").alias("run_id"), F.col("event_type").alias("step_name"), kind.alias("event_type"), F.col("ts").cast("timestamp").alias("timestamp"), F.col("event_id").alias("pos"), F.floor("value").alias("duration_ms"), F.lit("bad").alias("error_message"))


TRACE_SQL = "trace AS (SELECT user_id AS run_id, event_type AS step_name, CASE WHEN event_type = 'error' THEN 'step_failed' WHEN event_id % 2 = 0 THEN 'step_started' ELSE 'step_finished' END AS event_type, ts, event_id AS pos, floor(value)::BIGINT AS duration_ms FROM events)"
_LAST = "last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id, step_name ORDER BY ts DESC, pos DESC) AS n FROM trace WHERE event_type <> 'step_started') WHERE n = 1)"


def completions(spark, sf):
    return runlog.last_completions(_trace(spark, sf)).select("run_id", "step_name", "event_type", "duration_ms")


def _steps(spark, sf):
    """Manifest steps: each started step with the state of its last completion."""
    t = _trace(spark, sf)
    return t.where("event_type = 'step_started'").groupBy("run_id", "step_name").agg(F.min("timestamp").alias("started_at"), F.max("timestamp").alias("finished_at"))


def step_metrics(spark, sf):
    m = runlog.step_metrics(_steps(spark, sf), runlog.last_completions(_trace(spark, sf)))
    return m.select("run_id", "step_name", F.col("started_at").isNotNull().alias("in_manifest"), "duration_ms", "last_event")


_STEPS = f"WITH {TRACE_SQL}, {_LAST}, st AS (SELECT DISTINCT run_id, step_name FROM trace WHERE event_type = 'step_started') SELECT coalesce(st.run_id, last.run_id) AS run_id, coalesce(st.step_name, last.step_name) AS step_name, st.run_id IS NOT NULL AS in_manifest, duration_ms, event_type AS last_event FROM st FULL JOIN last ON last.run_id = st.run_id AND last.step_name = st.step_name"


def errors(spark, sf):
    t = _trace(spark, sf).where("event_type = 'step_failed'")
    kind = F.when(F.col("pos") % 2 == 0, "business_error").otherwise("fallback")
    error = F.when(F.col("pos") % 3 == 0, " invalid_json ").when(F.col("pos") % 3 == 1, "transport_error").otherwise("")
    return runlog.error_histogram(t.select("run_id", kind.alias("kind"), error.alias("error_type"), F.when(F.col("pos") % 5 != 0, F.col("pos").cast("string")).alias("item_id")))


_ERRORS = f"WITH {TRACE_SQL} SELECT run_id, CASE WHEN pos % 2 = 0 THEN 'business_error' ELSE 'fallback' END AS kind, CASE pos % 3 WHEN 0 THEN 'invalid_json' ELSE 'transport_error' END AS error_type, count(*) AS n, count_if(pos % 5 <> 0) AS with_item FROM trace WHERE event_type = 'step_failed' AND pos % 3 < 2 GROUP BY ALL"


def _requests(spark, sf):
    """Events as requests: the user's day is a run, the event type a source."""
    e = table(spark, sf, "events")
    n = F.col("event_id")
    category = F.when(n % 13 == 0, "repo").when(n % 17 == 0, "rate_limit").when(n % 19 == 0, "rate_limited")
    return e.select(F.concat_ws("/", "user_id", F.date_format("ts", "yyyy-MM-dd")).alias("run_id"), F.col("event_type").alias("source"), F.when(F.col("value") > 40, 1).otherwise(0).alias("items"), F.lit(1).alias("attempts"), F.floor("value").alias("duration_ms"), (n % 23 == 0).alias("failed"), category.alias("error_category"))


_STATUS = """req AS (SELECT user_id || '/' || strftime(ts, '%Y-%m-%d') AS run_id, event_type AS source, (value > 40)::INT AS items, floor(value)::BIGINT AS d, event_id % 23 = 0 AS failed, CASE WHEN event_id % 13 = 0 THEN 'repo' WHEN event_id % 17 = 0 THEN 'rate_limit' WHEN event_id % 19 = 0 THEN 'rate_limited' END AS cat FROM events),
st AS (SELECT run_id, source, sum(items) AS items, count(*) AS attempts, sum(d) AS duration_ms, CASE WHEN bool_or(failed) THEN CASE WHEN count_if(cat = 'rate_limited') > 0 THEN 'rate_limited' ELSE 'failed' END
  WHEN sum(items) = 0 THEN CASE WHEN count_if(cat = 'rate_limit') > 0 AND count_if(cat = 'repo') = 0 THEN 'rate_limited' ELSE 'empty' END WHEN count_if(cat IN ('repo', 'rate_limit')) > 0 THEN 'partial' ELSE 'succeeded' END AS status FROM req GROUP BY run_id, source)"""


def source_status(spark, sf):
    return runlog.source_status(_requests(spark, sf)).select("run_id", "source", "items", "attempts", "duration_ms", "status")


def source_rollup(spark, sf):
    return runlog.source_rollup(runlog.source_status(_requests(spark, sf)))


_SOURCES = f"WITH {_STATUS} SELECT run_id, count(*) AS total, count_if(status = 'succeeded') AS succeeded, count_if(status = 'partial') AS partial, count_if(status = 'failed') AS failed, count_if(status = 'rate_limited') AS rate_limited, count_if(status = 'empty') AS empty, sum(items) AS items, sum(attempts) AS attempts, sum(duration_ms) AS duration_ms FROM st GROUP BY run_id"


def durations(spark, sf):
    runs = _trace(spark, sf).groupBy("run_id").agg(F.min("timestamp").alias("started_at"), F.max("timestamp").alias("finished_at"))
    return runlog.run_durations(runs).select("run_id", "duration_ms")


def stage_counts(spark, sf):
    by_day = lambda df: df.withColumn("run_id", F.date_format("report_date", "yyyy-MM-dd"))
    return runlog.stage_counts(raw=by_day(inputs.raw(spark, sf)), clean=by_day(inputs.clean(spark, sf)), structured=by_day(inputs.structured(spark, sf)))


_COUNTS = f"WITH {STRUCTURED_SQL} SELECT strftime(report_date, '%Y-%m-%d') AS run_id, 'raw' AS stage, count(*) AS n FROM raw GROUP BY 1 UNION ALL SELECT strftime(report_date, '%Y-%m-%d'), 'clean', count(*) FROM clean GROUP BY 1 UNION ALL SELECT strftime(report_date, '%Y-%m-%d'), 'structured', count(*) FROM structured GROUP BY 1"


def health(spark, sf):
    sources = runlog.source_rollup(runlog.source_status(_requests(spark, sf)))
    n = F.hash("run_id")
    runs = sources.select("run_id", F.when(F.col("total") == 1, "failed").when(F.col("total") == 2, "running").otherwise("succeeded").alias("status"))
    call_rows = sources.select("run_id", (F.col("empty") * 2).alias("error_count"))
    error_rows = sources.select("run_id", F.col("partial").alias("business_errors"), F.col("rate_limited").alias("fallbacks"))
    quality = sources.select("run_id", F.when(F.col("failed") > 0, "warning").otherwise("ok").alias("quality_status"))
    return runlog.run_health(runs, sources, call_rows, error_rows, quality)


_HEALTH = f"""WITH {_STATUS}, s AS (SELECT run_id, count(*) AS total, count_if(status = 'partial') AS partial, count_if(status = 'failed') AS failed, count_if(status = 'rate_limited') AS rl, count_if(status = 'empty') AS empty FROM st GROUP BY run_id),
w AS (SELECT run_id, CASE total WHEN 1 THEN 'failed' WHEN 2 THEN 'running' ELSE 'succeeded' END AS status, array_to_string(list_filter([CASE WHEN failed > 0 THEN failed || ' source(s) failed' END, CASE WHEN partial > 0 THEN partial || ' source(s) partially succeeded' END,
 CASE WHEN rl > 0 THEN rl || ' source(s) were rate limited' END, CASE WHEN empty > 0 THEN empty * 2 || ' LLM error(s) recorded' END, CASE WHEN partial > 0 THEN partial || ' LLM business error(s) recorded' END, CASE WHEN rl > 0 THEN rl || ' LLM fallback(s) used' END,
 CASE WHEN failed > 0 THEN 'clean quality status is warning' END], lambda x: x IS NOT NULL), '; ') AS warnings FROM s)
SELECT run_id, status, CASE WHEN status = 'failed' THEN 'failed' WHEN warnings <> '' THEN 'warning' WHEN status = 'succeeded' THEN 'healthy' ELSE status END AS health, warnings FROM w"""


def progress(spark, sf):
    t = runlog.step_metrics(_steps(spark, sf), runlog.last_completions(_trace(spark, sf)))
    order = F.when(F.col("step_name") == "signup", 1).when(F.col("step_name") == "view", 2).when(F.col("step_name") == "click", 3).when(F.col("step_name") == "purchase", 4).otherwise(5)
    state = F.when(F.col("last_event") == "step_failed", "failed").when(F.col("duration_ms") < 20, "running").when(F.col("duration_ms") < 30, "pending").otherwise("succeeded")
    return runlog.run_progress(t.select("run_id", F.lit("running").alias("run_status"), "step_name", order.alias("step_order"), state.alias("status")))


_PROGRESS = f"""WITH {TRACE_SQL}, {_LAST}, sn AS (SELECT DISTINCT run_id, step_name FROM trace WHERE event_type = 'step_started'),
m AS (SELECT coalesce(sn.run_id, last.run_id) AS run_id, coalesce(sn.step_name, last.step_name) AS step_name, duration_ms, event_type AS last_event FROM sn FULL JOIN last ON last.run_id = sn.run_id AND last.step_name = sn.step_name),
p AS (SELECT run_id, step_name, CASE step_name WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'purchase' THEN 4 ELSE 5 END AS o, CASE WHEN last_event = 'step_failed' THEN 'failed' WHEN duration_ms < 20 THEN 'running' WHEN duration_ms < 30 THEN 'pending' ELSE 'succeeded' END AS status FROM m)
SELECT run_id, count(*) AS total, count_if(status = 'succeeded') AS completed, count_if(status = 'failed') AS failed, count_if(status = 'running') AS running, round_even(count_if(status = 'succeeded') / count(*) * 100, 0)::INT AS percent,
 coalesce(first(step_name ORDER BY o) FILTER (status = 'running'), first(step_name ORDER BY o) FILTER (status = 'pending')) AS current_step FROM p GROUP BY run_id"""


def activity(spark, sf):
    return runlog.recent_activity(_trace(spark, sf)).select("run_id", "rank", "step_name", "event_type", "level", "message")


_ACTIVITY = f"""WITH {TRACE_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY ts DESC, pos DESC) AS rank FROM trace)
SELECT run_id, rank, step_name, event_type, CASE WHEN event_type = 'step_failed' THEN 'error' ELSE 'info' END AS level, CASE event_type WHEN 'step_started' THEN '开始 ' || step_name || '。' WHEN 'step_failed' THEN step_name || ' 失败。bad' ELSE '完成 ' || step_name || '。' END AS message FROM r WHERE rank <= 24"""


def trace_export(spark, sf):
    """Trace lines of every run from JSON text, some of them damaged."""
    e = _trace(spark, sf)
    line = F.to_json(F.struct(F.concat(F.lit("u"), F.col("run_id").cast("string")).alias("run_id"), "event_type", "step_name"))
    lines = e.select(F.when(F.col("pos") % 10 == 0, F.substring(line, 1, 12)).otherwise(line).alias("value"))
    one = runlog.trace_of_run(lines, "u7").groupBy("run_id", "event_type").agg(F.count(F.lit(1)).alias("n")).withColumn("asked", F.lit("u7"))
    every = runlog.trace_of_run(lines).groupBy("run_id", "event_type").agg(F.count(F.lit(1)).alias("n")).withColumn("asked", F.lit("all"))
    return every.unionByName(one)


# --- model scoring -----------------------------------------------------------------
def _model(text: str) -> str:
    """A deterministic stand-in: length based score, with the failures models have."""
    n = len(text)
    if n % 7 == 0:
        return "not json"
    if n % 7 == 1:
        return "[]"
    if n % 7 == 2:
        return '```json\n{"score": %d}\n```' % (n % 101)
    if n % 7 == 3:
        return "{}"
    if n % 7 == 4:
        raise RuntimeError("down")
    return '[{"score": %d}]' % (n % 101)


def scored(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    rules = docs.select("id", F.lit(-1).alias("score"))
    return scoring.with_fallback(scoring.score_items(docs, "text", _model, ("score",)), "score INT", rules)


_SCORED = """SELECT doc_id::VARCHAR AS id, CASE WHEN n % 7 IN (2, 5, 6) THEN n % 101 ELSE -1 END AS score, CASE WHEN n % 7 IN (2, 5, 6) THEN 'model' ELSE 'rule_fallback' END AS decision_source,
 CASE n % 7 WHEN 0 THEN 'invalid_json' WHEN 1 THEN 'item_count_mismatch' WHEN 3 THEN 'schema_error' WHEN 4 THEN 'transport_error' END AS error_type FROM (SELECT doc_id, length(text) AS n FROM documents)"""


def _grounded(answer, prompt):
    """An answer is audited against its prompt: the score has to be that of the text's length."""
    return answer["score"] % 5 != 0 or len(prompt) % 2 == 0


def resumed(spark, sf):
    """Scores with an audit, made in two goes over one folder of answers: the second finds the calls of the first."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "text", "doc_id")
    folder = _folder(spark, "answers")
    score = lambda rows: scoring.score_items(rows, "text", _model, ("score",), audit=_grounded, answers=folder, concurrency=4)
    score(docs.where("doc_id % 2 = 0")).write.format("noop").mode("overwrite").save()
    known = scoring.saved_answers(spark, folder).count()
    made = scoring.with_fallback(score(docs), "score INT", docs.select("id", F.lit(-1).alias("score")))
    return made.withColumn("kept_before", F.lit(known > 0))


_RESUMED = """SELECT doc_id::VARCHAR AS id, CASE WHEN good THEN n % 101 ELSE -1 END AS score, CASE WHEN good THEN 'model' ELSE 'rule_fallback' END AS decision_source,
 CASE WHEN good THEN NULL WHEN n % 7 = 0 THEN 'invalid_json' WHEN n % 7 = 1 THEN 'item_count_mismatch' WHEN n % 7 = 3 THEN 'schema_error' WHEN n % 7 = 4 THEN 'transport_error' ELSE 'audit_failure' END AS error_type, true AS kept_before
 FROM (SELECT doc_id, length(text) AS n, length(text) % 7 IN (2, 5, 6) AND ((length(text) % 101) % 5 <> 0 OR length(text) % 2 = 0) AS good FROM documents)"""


def model_calls(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    log = scoring.call_log(scoring.score_items(docs, "text", _model, ("score",)), "run-1", "relevance")
    return log.groupBy("run_id", "step_name", "attempt", "success").agg(F.count(F.lit(1)).alias("n"))


_CALLS = "WITH d AS (SELECT length(text) AS n FROM documents) SELECT 'run-1' AS run_id, 'relevance' AS step_name, 1 AS attempt, n % 7 <> 4 AS success, count(*) AS n FROM d GROUP BY ALL UNION ALL SELECT 'run-1', 'relevance', 2, n % 7 <> 4, count(*) FROM d WHERE n % 7 IN (0, 1, 3, 4) GROUP BY ALL"


# --- tables ------------------------------------------------------------------------
def _folder(spark, name):
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _rows(spark, sf):
    return inputs.structured(spark, sf).select("report_date", "id", "topic")


def stage_write(spark, sf):
    """Write all dates, overwrite the late ones, read back: early dates stay."""
    path = _folder(spark, "stage")
    tables.write_stage(_rows(spark, sf), path)
    tables.write_stage(_rows(spark, sf).where("report_date >= '2024-01-20'").withColumn("topic", F.lit("rewritten")), path)
    return spark.read.parquet(path).select(F.date_format("report_date", "yyyy-MM-dd").alias("report_date"), "id", "topic")


_STAGE = f"WITH {STRUCTURED_SQL} SELECT strftime(report_date, '%Y-%m-%d') AS report_date, id, CASE WHEN report_date >= DATE '2024-01-20' THEN 'rewritten' ELSE topic END AS topic FROM structured"


def snapshots(spark, sf):
    path = _folder(spark, "snapshot")
    tables.write_snapshot(_rows(spark, sf), path, "run-1")
    tables.write_snapshot(_rows(spark, sf).limit(0), path, "run-2")
    return tables.read_snapshot(spark, path, "run-1").select("run_id", "id", "topic")


def replay(spark, sf):
    base = _folder(spark, "runs")
    tables.write_snapshot(_rows(spark, sf), f"{base}/validated", "parent")
    df, steps = tables.replay_input(spark, base, "parent", "validated")
    return df.select("id", F.lit(",".join(steps)).alias("steps"))


def publish(spark, sf):
    """A good publish, then one whose check fails: readers stay with the first version."""
    target = _folder(spark, "published")
    tables.publish(_rows(spark, sf), target, "1")

    def refuse(df):
        raise ValueError("rejected")

    try:
        tables.publish(_rows(spark, sf).withColumn("topic", F.lit("bad")), target, "2", refuse)
    except ValueError:
        pass
    return tables.published(spark, target).select("id", "topic")


# --- streams -----------------------------------------------------------------------
def stream_ingest(spark, sf):
    """Clean items of the new dates as a stream of three batches with a restart; known entries aren't appended.

    Keys of history are entered in the index once; after that no batch reads history.
    """
    source, target, offsets = _folder(spark, "landed"), _folder(spark, "stream-history"), _folder(spark, "offsets")
    items = inputs.clean(spark, sf).where(F.col("report_date") >= memory_plans.CUT).drop("canonical_url", "title_fingerprint", "content_hash")
    last = items.agg(F.max("pos")).first()[0] or 0
    parts = items.withColumn("part", F.floor(3 * F.col("pos") / (last + 1)) + 1)
    index = KeyIndex(spark, _folder(spark, "keys"), buckets=16)
    index.add(memory.claims(memory_plans.known_history(spark, sf)), "history")
    entries = lambda batch: memory.to_entries(extract.structure(batch)).drop("report_date")
    schema = items.schema
    for part in (1, 2, 3):  # each starts anew from where the one before stopped
        parts.where(F.col("part") == part).drop("part").write.parquet(f"{source}/{part}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(source)
        ingest(stream, entries, index, target, offsets).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(target).select("pos", "topic_key", "memory_item_id")


def stream_health(spark, sf):
    """Events read as a stream and rolled up per hour and step; an hour is written once, when the watermark has passed it."""
    out = _folder(spark, "stream-health")
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    kind = F.when(F.col("event_type") == "error", "step_failed").otherwise("step_finished")
    trace = stream.select(F.col("ts").cast("timestamp").alias("timestamp"), F.col("event_type").alias("step_name"), kind.alias("event_type"), F.floor("value").alias("duration_ms"))
    write = lambda batch, number: batch.write.mode("overwrite").parquet(f"{out}/batch={number}")
    query = windowed_health(trace).writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", _folder(spark, "offsets")).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(out).select(F.date_format("window_start", "yyyy-MM-dd HH").alias("hour"), "step_name", "events", "failures", "duration_ms")


# Hours that the watermark, an hour behind the last event, has passed.
_HEALTH_STREAM = """SELECT strftime(ts, '%Y-%m-%d %H') AS hour, event_type AS step_name, count(*) AS events, count_if(event_type = 'error') AS failures, sum(floor(value))::BIGINT AS duration_ms FROM events
GROUP BY 1, 2, date_trunc('hour', ts) HAVING date_trunc('hour', ts) + INTERVAL 2 HOUR <= (SELECT max(ts) FROM events)"""

PLANS = {
    "j9_price_lookup": (priced_calls, f"WITH {CALLS_SQL} SELECT item_id, cost_usd FROM priced"),
    "ag6_call_rollup": (call_rollup, _ROLLUP),
    "ag6_error_types": (errors, _ERRORS),
    "ag7_source_rollup": (source_rollup, _SOURCES),
    "ag8_source_status": (source_status, f"WITH {_STATUS} SELECT run_id, source, items, attempts, duration_ms, status FROM st"),
    "ag9_last_completions": (completions, f"WITH {TRACE_SQL}, {_LAST} SELECT run_id, step_name, event_type, duration_ms FROM last"),
    "ag9_step_metrics": (step_metrics, _STEPS),
    "ag10_run_durations": (durations, "SELECT user_id AS run_id, round_even((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000.0, 0)::BIGINT AS duration_ms FROM events GROUP BY user_id"),
    "ag10_stage_counts": (stage_counts, _COUNTS),
    "ag11_run_health": (health, _HEALTH),
    "ag12_run_progress": (progress, _PROGRESS),
    "w8_recent_activity": (activity, _ACTIVITY),
    "snk6_trace_export": (trace_export, "WITH t AS (SELECT 'u' || user_id AS run_id, CASE WHEN event_type = 'error' THEN 'step_failed' WHEN event_id % 2 = 0 THEN 'step_started' ELSE 'step_finished' END AS event_type, count(*) AS n FROM events WHERE event_id % 10 <> 0 GROUP BY ALL) SELECT *, 'all' AS asked FROM t UNION ALL SELECT *, 'u7' FROM t WHERE run_id = 'u7'"),
    "cl16_model_scoring": (scored, _SCORED),
    "cl16_call_log": (model_calls, _CALLS),
    "cl16_resumed_scoring": (resumed, _RESUMED),
    "snk1_stage_write": (stage_write, _STAGE),
    "snk2_snapshot": (snapshots, f"WITH {STRUCTURED_SQL} SELECT 'run-1' AS run_id, id, topic FROM structured"),
    "snk3_replay": (replay, f"WITH {STRUCTURED_SQL} SELECT id, 'analyze' AS steps FROM structured"),
    "snk5_publish": (publish, f"WITH {STRUCTURED_SQL} SELECT id, topic FROM structured"),
    "st1_stream_ingest": (stream_ingest, memory_plans.APPEND_NEW_SQL),
    "st2_stream_health": (stream_health, _HEALTH_STREAM),
}
__all__ = ["PLANS", "squeeze_sql"]
