"""Cost, health and progress over call, source, step and trace logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayline import lexicon
from dayline.functions.values import token_cost
from dayline.operators.groups import top_per_group


def price_calls(calls: DataFrame, prices: DataFrame) -> DataFrame:
    """Cost per call: price of (provider, model), else the first price of the model, else 0.

    The price list is a configured dimension: its size is fixed by the configuration.
    """
    key = lambda c: F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))
    table = prices.select(key("provider").alias("k_provider"), key("model").alias("k_model"), F.col("pos").alias("p"), "input_price", "output_price", "unit_tokens")
    value = F.struct("input_price", "output_price", "unit_tokens")
    exact = table.groupBy("k_provider", "k_model").agg(F.min_by(value, "p").alias("exact"))
    by_model = table.groupBy("k_model").agg(F.min_by(value, "p").alias("by_model"))
    out = calls.withColumns({"k_provider": key("provider"), "k_model": key("model")}).join(exact, ["k_provider", "k_model"], "left").join(by_model, "k_model", "left")
    price = F.coalesce("exact", "by_model")
    return out.withColumn("cost_usd", token_cost(F.col("prompt_tokens"), F.col("completion_tokens"), price["input_price"], price["output_price"], price["unit_tokens"])).drop("k_provider", "k_model", "exact", "by_model")


def call_rollup(calls: DataFrame) -> DataFrame:
    """Calls per run and step with run totals (step 'all'); calls without a step stay under a null step."""
    money = F.sum(F.col("cost_usd").cast("decimal(20,10)")).cast("double")
    return calls.rollup("run_id", "step_name").agg(
        F.count(F.lit(1)).alias("call_count"), F.bool_and("success").alias("success"), F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"),
        F.sum("total_tokens").alias("total_tokens"), money.alias("cost_usd"), F.sum("elapsed_ms").alias("elapsed_ms"), F.count("error").alias("error_count"), F.grouping_id().alias("_level"),
    ).where("_level < 3").withColumn("step_name", F.when(F.col("_level") == 1, "all").otherwise(F.col("step_name"))).drop("_level")


def error_histogram(errors: DataFrame) -> DataFrame:
    """Error types per run and kind (business error or fallback), with the items they touched."""
    return errors.where(F.trim("error_type") != "").groupBy("run_id", "kind", F.trim("error_type").alias("error_type")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce("item_id", F.lit("")) != "").alias("with_item"))


def source_status(requests: DataFrame) -> DataFrame:
    """Status per run and source from its item counts and error rows.

    ``requests``: run_id, source, items, attempts, duration_ms, failed, error_category
    (null, 'repo', 'rate_limit', or a request category).
    """
    c = F.col
    agg = requests.groupBy("run_id", "source").agg(
        F.sum("items").alias("items"), F.sum("attempts").alias("attempts"), F.sum("duration_ms").alias("duration_ms"), F.bool_or("failed").alias("failed"),
        F.count_if(c("error_category") == "repo").alias("repo_errors"), F.count_if(c("error_category") == "rate_limit").alias("rate_limits"), F.count_if(c("error_category") == "rate_limited").alias("throttled"),
    )
    status = (
        F.when(c("failed"), F.when(c("throttled") > 0, "rate_limited").otherwise("failed"))
        .when(c("items") <= 0, F.when((c("rate_limits") > 0) & (c("repo_errors") == 0), "rate_limited").otherwise("empty"))
        .when((c("repo_errors") > 0) | (c("rate_limits") > 0), "partial")
        .otherwise("succeeded")
    )
    return agg.withColumn("status", status)


def source_rollup(statuses: DataFrame) -> DataFrame:
    return statuses.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("status") == s).alias(s) for s in lexicon.SOURCE_STATUSES], F.sum("items").alias("items"), F.sum("attempts").alias("attempts"), F.sum("duration_ms").alias("duration_ms")
    )


def last_completions(trace: DataFrame) -> DataFrame:
    """Last completion event of each step; one aggregate instead of a sort per run."""
    done = trace.where(F.col("event_type").isin("step_finished", "step_failed") & (F.coalesce("step_name", F.lit("")) != ""))
    last = F.max(F.struct("timestamp", "pos", "event_type", "duration_ms"))
    return done.groupBy("run_id", "step_name").agg(last.alias("e")).select("run_id", "step_name", "e.timestamp", "e.event_type", "e.duration_ms")


def step_metrics(steps: DataFrame, completions: DataFrame) -> DataFrame:
    """Manifest steps with their completion event; steps known from one side only stay."""
    events = completions.select("run_id", "step_name", F.col("duration_ms"), F.col("event_type").alias("last_event"))
    return steps.join(events, ["run_id", "step_name"], "full_outer")


def run_durations(runs: DataFrame) -> DataFrame:
    span = F.unix_micros("finished_at") - F.unix_micros("started_at")
    return runs.withColumn("duration_ms", F.greatest(F.lit(0), F.bround(span / 1000.0).cast("bigint")))


def stage_counts(**stages: DataFrame) -> DataFrame:
    """Row counts per run and stage table."""
    out = None
    for name, df in stages.items():
        counted = df.groupBy("run_id").agg(F.count(F.lit(1)).alias("n")).select("run_id", F.lit(name).alias("stage"), "n")
        out = counted if out is None else out.unionByName(counted)
    return out


def run_health(runs: DataFrame, sources: DataFrame, calls: DataFrame, errors: DataFrame, quality: DataFrame) -> DataFrame:
    """Health per run: failed, warning (with texts), healthy, or the run's own status.

    All inputs are one row per run: rolled-up sources (failed, partial, rate_limited),
    calls (error_count), errors (business_errors, fallbacks) and quality (quality_status).
    """
    out = runs.select("run_id", "status").join(sources.select("run_id", "failed", "partial", "rate_limited"), "run_id", "left")
    out = out.join(calls.select("run_id", "error_count"), "run_id", "left").join(errors.select("run_id", "business_errors", "fallbacks"), "run_id", "left").join(quality.select("run_id", "quality_status"), "run_id", "left")
    out = out.fillna(0, ["failed", "partial", "rate_limited", "error_count", "business_errors", "fallbacks"])
    say = lambda c, text: F.when(F.col(c) > 0, F.concat(F.col(c).cast("string"), F.lit(f" {text}")))
    warnings = F.array_compact(
        F.array(
            say("failed", "source(s) failed"), say("partial", "source(s) partially succeeded"), say("rate_limited", "source(s) were rate limited"), say("error_count", "LLM error(s) recorded"),
            say("business_errors", "LLM business error(s) recorded"), say("fallbacks", "LLM fallback(s) used"),
            F.when(~F.coalesce("quality_status", F.lit("")).isin("", "ok", "succeeded"), F.concat(F.lit("clean quality status is "), F.col("quality_status"))),
        )
    )
    status = F.coalesce("status", F.lit("unknown"))
    health = F.when(status == "failed", "failed").when(F.size("_w") > 0, "warning").when(status == "succeeded", "healthy").otherwise(status)
    return out.withColumn("_w", warnings).select("run_id", status.alias("status"), health.alias("health"), F.array_join("_w", "; ").alias("warnings"))


def run_progress(steps: DataFrame) -> DataFrame:
    """Completed, failed and running steps, percent and the current step per run.

    ``steps``: run_id, run_status, step_name, step_order, status.
    """
    c = F.col
    state = lambda s: F.count_if(c("status") == s)
    first = lambda s: F.min_by("step_name", F.when(c("status") == s, c("step_order")))
    agg = steps.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total"), state("succeeded").alias("completed"), state("failed").alias("failed"), state("running").alias("running"),
        first("running").alias("_running"), first("pending").alias("_pending"), F.max("run_status").alias("run_status"),
    )
    # min_by ignores rows whose ordering is null only when another row has one.
    has = lambda s: c(s) > 0
    pending = c("total") - c("completed") - c("failed") - c("running")
    current = F.when(has("running"), c("_running")).when(c("run_status").isin("succeeded", "failed"), F.lit(None)).when(pending > 0, c("_pending"))
    return agg.select("run_id", "total", "completed", "failed", "running", F.bround(c("completed") / c("total") * 100).cast("int").alias("percent"), current.alias("current_step"))


def recent_activity(trace: DataFrame, k: int = 24) -> DataFrame:
    """The last ``k`` step events of each run, newest first, with level and message."""
    shown = trace.where(F.col("event_type").isin("step_started", "step_finished", "step_failed"))
    last = top_per_group(shown, ["run_id"], [F.col("timestamp").desc(), F.col("pos").desc()], k)
    step = F.coalesce("step_name", F.lit("pipeline"))
    message = F.when(F.col("event_type") == "step_started", F.concat(F.lit("开始 "), step, F.lit("。"))).when(F.col("event_type") == "step_failed", F.trim(F.concat(step, F.lit(" 失败。"), F.coalesce("error_message", F.lit(""))))).otherwise(F.concat(F.lit("完成 "), step, F.lit("。")))
    return last.select("run_id", "rank", "timestamp", F.col("step_name"), "event_type", F.when(F.col("event_type") == "step_failed", "error").otherwise("info").alias("level"), F.substring(message, 1, 280).alias("message"))


def trace_of_run(lines: DataFrame, run_id: str | None = None) -> DataFrame:
    """Trace rows of one run (or all) from JSON lines; malformed lines are dropped."""
    ok = lines.where(F.try_parse_json("value").isNotNull() & F.ltrim("value").startswith("{"))
    rows = ok.select("value", F.get_json_object("value", "$.run_id").alias("run_id"), F.get_json_object("value", "$.event_type").alias("event_type"), F.get_json_object("value", "$.step_name").alias("step_name"), F.get_json_object("value", "$.timestamp").alias("timestamp"))
    return rows if run_id is None else rows.where(F.col("run_id") == run_id)
