"""Consistency findings over items, insights and the history table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayline import lexicon
from dayline.functions.text import contains_any, squeeze
from dayline.operators.audit import check_level_references
from dayline.operators.groups import lookup
from dayline.operators.trends import dominant_scope, top_topics


def _findings(df: DataFrame, carry: list[str], checks: list[tuple[str, Column, Column | str]]) -> DataFrame:
    rules = [F.when(bad, F.struct(F.lit(severity).alias("severity"), (F.lit(m) if isinstance(m, str) else m).alias("message"))) for severity, bad, m in checks]
    return df.select(*carry, F.explode(F.array_compact(F.array(*rules))).alias("f")).select(*carry, "f.severity", "f.message")


def item_findings(items: DataFrame) -> DataFrame:
    """Risk and opportunity labels against an item's own text."""
    risk, chance, event, mood = (F.col(c) for c in ("risk_level", "opportunity_level", "event_type", "sentiment"))
    raised = lambda c: c.isin("medium", "high")
    evidence = F.lower(F.array_join("evidence", " "))
    body = F.lower(F.concat_ws(" ", "title", "summary", F.array_join("key_points", " "), F.array_join("evidence", " "), "event_type", "impact_scope"))
    none = F.size("evidence") == 0
    no_risk = ~contains_any(body, lexicon.RISK_WORDS)
    checks = [
        ("error", raised(risk) & none, F.concat(risk, F.lit(" risk has no evidence"))),
        ("error", raised(chance) & none, F.concat(chance, F.lit(" opportunity has no evidence"))),
        ("warning", (risk == "high") & no_risk, "high risk has no obvious risk signal"),
        ("warning", (risk == "medium") & no_risk, "medium risk has no obvious risk signal"),
        ("warning", (chance == "high") & ~contains_any(body, lexicon.OPPORTUNITY_WORDS), "high opportunity has no obvious opportunity signal"),
        ("warning", (event == "security") & (risk == "low"), "security event is marked low risk"),
        ("warning", (event == "policy") & (risk == "low"), "policy event is marked low risk"),
        ("warning", (risk == "high") & (mood == "positive"), "high risk paired with positive sentiment"),
        ("warning", (risk == "high") & (chance == "high") & (mood != "mixed"), "high risk and high opportunity should usually be mixed"),
        ("warning", raised(risk) & ~contains_any(evidence, lexicon.RISK_WORDS), "risk evidence has no obvious risk term"),
    ]
    return _findings(items, ["report_date", "id"], checks)


def level_findings(insights: DataFrame, items: DataFrame, level: str, name: str) -> DataFrame:
    """Report insights against the level of the items they cite."""
    where = ["report_date", "section", "section_index"]
    bare = _findings(insights.where(F.size("item_ids") == 0), where, [("error", F.lit(True), "missing evidence_item_ids")])
    checked = check_level_references(insights, items, level)
    return bare.unionByName(
        _findings(
            checked, where,
            [
                ("error", F.col("outcome") == "unknown", F.concat(F.lit("unknown evidence item "), F.col("item_id"))),
                ("error", F.col("outcome") == "blocked", F.concat("insight_level", F.lit(" insight references "), "item_id", F.lit(" with "), "item_level", F.lit(f" {name}"))),
            ],
        )
    )


def trend_findings(insights: DataFrame, items: DataFrame) -> DataFrame:
    """Trend insights against their evidence.

    ``insights``: report_date, section_index, title, summary, scope, trend_state,
    item_ids, historical_context_used.
    """
    where = ["report_date", "section_index"]
    topic_of = lambda c: F.lower(F.trim(c))
    bare = _findings(insights.where(F.size("item_ids") == 0), where, [("error", F.lit(True), "missing evidence_item_ids")])
    rows = insights.select(*where, F.posexplode("item_ids").alias("at", "id"))
    facts = items.select("report_date", "id", "pos", "topic", topic_of(F.col("topic")).alias("topic_key"), "impact_scope", "importance_score")
    joined = lookup(rows, facts, ["report_date", "id"], "left")
    unknown = _findings(joined, where, [("error", F.col("topic").isNull(), F.concat(F.lit("unknown evidence item "), F.col("id")))])
    known = joined.where("topic IS NOT NULL")
    topics = known.groupBy(*where, "topic_key").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first_at"))
    lead = topics.groupBy(*where).agg(
        F.max_by("topic_key", F.struct("n", (-F.col("first_at")).alias("early"))).alias("topic_key"), F.max("n").alias("dominant"), F.sum("n").alias("evidence_count"), F.count(F.lit(1)).alias("topic_n")
    )
    weakest = known.groupBy(*where).agg(F.min("importance_score").alias("evidence_score"))
    scope = dominant_scope(known.withColumn("pos", F.col("at")), where)
    per_topic = facts.groupBy("report_date", "topic_key").agg(F.count(F.lit(1)).alias("topic_items"), F.max("importance_score").alias("topic_score"), F.min_by("topic", "pos").alias("topic_name"))
    wide = insights.join(lead, where).join(weakest, where).join(scope, where)
    wide = wide.join(per_topic, ["report_date", "topic_key"], "left")
    used, state = F.col("historical_context_used"), F.col("trend_state")
    named = F.contains(F.lower(F.concat_ws(" ", "title", "summary")), squeeze(F.lower(F.col("topic_name"))))
    checks = [
        ("error", ~state.isin(*lexicon.TREND_STATES), F.concat(F.lit("invalid trend_state "), state)),
        ("warning", F.col("topic_n") > 1, "evidence spans multiple topics"),
        ("warning", F.col("dominant") < F.col("evidence_count"), F.concat(F.lit("not all evidence belongs to dominant topic "), F.col("topic_key"))),
        ("warning", F.col("scope") != F.col("dominant_scope"), F.concat(F.lit("scope "), F.col("scope"), F.lit(" differs from evidence scope "), F.col("dominant_scope"))),
        ("warning", ~named, F.concat(F.lit("title/summary does not clearly name topic "), F.col("topic_name"))),
        ("warning", (F.col("topic_items") == 1) & (F.col("topic_score") < 70), F.concat(F.lit("single weak item used as trend evidence for "), F.col("topic_name"))),
        ("error", (state == "reversing") & ~used, "reversing requires historical context or memory signals"),
        ("warning", state.isin("continuing", "cooling_down") & ~used, F.concat(state, F.lit(" requires historical context or memory signals"))),
        ("warning", (state == "heating_up") & ~used & (F.col("evidence_count") == 1) & (F.col("evidence_score") < 75), "heating_up is weakly supported by a single low-score item"),
    ]
    wanted = top_topics(items.withColumn("topic", topic_of(F.col("topic"))), 3).select("report_date", F.col("topic").alias("topic_key"))
    missed = wanted.join(lead.select("report_date", "topic_key").distinct(), ["report_date", "topic_key"], "left_anti")
    uncovered = missed.select("report_date", F.lit(0).alias("section_index"), F.lit("warning").alias("severity"), F.concat(F.lit("top topic "), "topic_key", F.lit(" is not covered by trend_insights")).alias("message"))
    return bare.unionByName(unknown).unionByName(_findings(wide, where, checks)).unionByName(uncovered)


def memory_findings(index: DataFrame, items: DataFrame) -> DataFrame:
    """History table against current topics and its own keys.

    ``index``: raw_topic, pos, topic and the entry columns as read from the index.
    """
    key = lambda c: F.lower(F.trim(c))
    current = items.select(key(F.col("topic")).alias("t")).distinct()
    missing = current.join(index.select(key(F.col("raw_topic")).alias("t")).distinct(), "t", "left_anti").select(
        F.col("t").alias("topic"), F.lit(-1).alias("pos"), F.lit("warning").alias("severity"), F.concat(F.lit("current topic "), "t", F.lit(" is missing from memory")).alias("message")
    )
    topic = key(F.coalesce("topic", F.lit("")))
    checks = [("warning", (topic != "") & (topic != key(F.col("raw_topic"))), F.concat(F.lit("topic key contains entry topic "), F.col("topic")))]
    checks += [("warning", F.col(c).isNull(), f"missing {c}") for c in ("id", "title", "published_at", "summary", "importance_score")]
    return missing.unionByName(_findings(index.withColumn("_t", F.col("raw_topic")), ["_t", "pos"], checks).withColumnRenamed("_t", "topic"))
