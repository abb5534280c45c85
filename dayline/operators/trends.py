"""Topic trend signals and states per report date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayline import lexicon
from dayline.functions.text import label
from dayline.functions.topics import topic_key
from dayline.functions.values import direction, level_rank
from dayline.operators.groups import top_per_group

DAY_TOPIC = ["report_date", "topic_key"]


def topic_counts(items: DataFrame) -> DataFrame:
    """Items per topic, with the first position as the tie-break of 'most common'."""
    return items.groupBy("report_date", "topic").agg(F.count(F.lit(1)).alias("item_count"), F.min("pos").alias("first_pos"))


def top_topics(items: DataFrame, k: int = 3) -> DataFrame:
    order = [F.col("item_count").desc(), F.col("first_pos")]
    return top_per_group(topic_counts(items), ["report_date"], order, k)


def executive_summary(items: DataFrame) -> DataFrame:
    """Items, topics, leading topic, mean score and high-risk count per report date."""
    numbers = items.groupBy("report_date", "topic").agg(
        F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"), F.sum("importance_score").alias("score"), F.count_if(F.col("risk_level") == "high").alias("high")
    )
    lead = F.max_by("topic", F.struct("n", (-F.col("first_pos")).alias("early")))
    return numbers.groupBy("report_date").agg(
        F.sum("n").alias("item_count"), F.count(F.lit(1)).alias("topic_count"), lead.alias("top_topic"), F.max("n").alias("top_topic_count"),
        F.bround(F.sum("score") / F.sum("n"), 1).alias("mean_score"), F.sum("high").alias("high_risk_count"),
    )


def histogram(df: DataFrame, keys: list[str], column: str, out: str) -> DataFrame:
    """Counts of an enumerated column as text ``value=n`` in value order.

    The value domain is a fixed enumeration, so the gathered list is bounded.
    """
    counts = df.where(F.col(column) != "").groupBy(*keys, column).count()
    pairs = F.sort_array(F.collect_list(F.struct(column, "count")))
    return counts.groupBy(*keys).agg(F.array_join(F.transform(pairs, lambda p: F.concat(p[column], F.lit("="), p["count"])), ",").alias(out))


def _enum_counts(column: str, values, out: str) -> list[Column]:
    return [F.count_if(F.col(column) == v).alias(f"_{out}_{v}") for v in values]


def _enum_text(values, out: str) -> Column:
    parts = [F.when(F.col(f"_{out}_{v}") > 0, F.concat(F.lit(f"{v}="), F.col(f"_{out}_{v}"))) for v in sorted(values)]
    return F.array_join(F.array_compact(F.array(*parts)), ",").alias(out)


def current_signals(items: DataFrame) -> DataFrame:
    """Current side of the trend signals; enumerations are counted in the one aggregate."""
    keyed = items.withColumn("topic_key", topic_key(F.col("topic")))
    agg = keyed.groupBy(*DAY_TOPIC).agg(
        F.min_by("topic", "pos").alias("topic"), F.min("pos").alias("first_pos"), F.count(F.lit(1)).alias("current_count"), F.max("importance_score").alias("current_peak"),
        F.sum("importance_score").alias("_score"), F.max(level_rank(F.col("risk_level"))).alias("current_risk"), F.max(level_rank(F.col("opportunity_level"))).alias("current_opportunity"),
        *_enum_counts("event_type", lexicon.EVENT_TYPES, "current_event_types"), *_enum_counts("risk_level", lexicon.LEVELS, "current_risk_levels"),
        *_enum_counts("opportunity_level", lexicon.LEVELS, "current_opportunity_levels"),
    )
    return agg.select(
        *DAY_TOPIC, "topic", "first_pos", "current_count", "current_peak", F.bround(F.col("_score") / F.col("current_count"), 1).alias("current_mean"), "current_risk", "current_opportunity",
        _enum_text(lexicon.EVENT_TYPES, "current_event_types"), _enum_text(lexicon.LEVELS, "current_risk_levels"), _enum_text(lexicon.LEVELS, "current_opportunity_levels"),
    )


def topic_entities(items: DataFrame, limit: int = 10) -> DataFrame:
    """First ``limit`` distinct entities per topic, in order of appearance."""
    rows = items.withColumn("topic_key", topic_key(F.col("topic"))).select(*DAY_TOPIC, "pos", F.posexplode("entities").alias("at", "entity"))
    first = rows.groupBy(*DAY_TOPIC, F.lower(F.trim("entity")).alias("entity_key")).agg(F.min(F.struct("pos", "at", "entity")).alias("e")).where("entity_key <> ''")
    kept = top_per_group(first, DAY_TOPIC, [F.col("e")], limit)
    listed = F.sort_array(F.collect_list(F.struct("rank", F.col("e.entity").alias("entity"))))
    return kept.groupBy(*DAY_TOPIC).agg(F.array_join(F.transform(listed, lambda v: v["entity"]), "|").alias("current_entities"))


def history_signals(retrieved: DataFrame) -> DataFrame:
    agg = retrieved.groupBy(*DAY_TOPIC).agg(
        F.count(F.lit(1)).alias("history_count"), F.max(F.coalesce("importance_score", F.lit(0))).alias("history_peak"),
        F.max(level_rank(F.col("risk_level"))).alias("history_risk"), F.max(level_rank(F.col("opportunity_level"))).alias("history_opportunity"),
        *_enum_counts("risk_level", lexicon.LEVELS, "history_risk_levels"), *_enum_counts("opportunity_level", lexicon.LEVELS, "history_opportunity_levels"),
    )
    return agg.select(*DAY_TOPIC, "history_count", "history_peak", "history_risk", "history_opportunity", _enum_text(lexicon.LEVELS, "history_risk_levels"), _enum_text(lexicon.LEVELS, "history_opportunity_levels"))


def relationship_signals(relationships: DataFrame) -> DataFrame:
    keyed = relationships.withColumn("topic_key", topic_key(F.col("topic")))
    agg = keyed.groupBy(*DAY_TOPIC).agg(
        F.count(F.lit(1)).alias("relationship_count"), F.round(F.max("confidence"), 3).alias("confidence_peak"), *_enum_counts("relationship", lexicon.RELATIONSHIP_RANK, "soft_relationships")
    )
    return agg.select(*DAY_TOPIC, "relationship_count", "confidence_peak", _enum_text(lexicon.RELATIONSHIP_RANK, "soft_relationships"))


def matched_ids(relationships: DataFrame) -> DataFrame:
    """Distinct matched history ids per topic in order of appearance, one row each."""
    rows = relationships.withColumn("topic_key", topic_key(F.col("topic"))).select(*DAY_TOPIC, "pos", F.posexplode("matched_memory_item_ids").alias("at", "memory_item_id"))
    return rows.groupBy(*DAY_TOPIC, "memory_item_id").agg(F.min(F.struct("pos", "at")).alias("first_seen"))


def trend_state(signals: DataFrame) -> Column:
    """State of a topic from its joined signals; the first matching rule decides."""
    c = F.col
    has_history = c("history_count") > 0
    reversal = has_history & (((c("current_risk") >= 3) & (c("history_risk") <= 1)) | ((c("current_opportunity") <= 1) & (c("history_opportunity") >= 3)))
    heating = (c("current_count") >= 2) | F.when(has_history, c("current_peak") >= c("history_peak") + 10).otherwise(c("current_peak") >= 85)
    cooling = (c("history_count") >= 2) & (c("current_count") == 1) & (c("history_peak") >= c("current_peak") + 15)
    related = c("related_count") > 0
    return (
        F.when(~has_history & (c("relationship_count") == 0), "new")
        .when(reversal, "reversing")
        .when(heating, "heating_up")
        .when(cooling, "cooling_down")
        .when(related | has_history, "continuing")
        .otherwise("new")
    )


def trend_signals(items: DataFrame, retrieved: DataFrame, relationships: DataFrame | None = None) -> DataFrame:
    """All trend signals per report date and topic with the suggested state.

    Every input is aggregated to (date, topic) first, so the joins are between small frames.
    """
    out = current_signals(items).join(history_signals(retrieved), DAY_TOPIC, "left")
    if relationships is not None:
        related = relationships.withColumn("topic_key", topic_key(F.col("topic"))).groupBy(*DAY_TOPIC).agg(F.count_if(F.col("relationship") != "new").alias("related_count"))
        out = out.join(relationship_signals(relationships), DAY_TOPIC, "left").join(related, DAY_TOPIC, "left")
    else:
        out = out.withColumns({"relationship_count": F.lit(0), "related_count": F.lit(0), "confidence_peak": F.lit(0.0), "soft_relationships": F.lit("")})
    out = out.fillna(0, ["history_count", "history_peak", "history_risk", "history_opportunity", "relationship_count", "related_count", "confidence_peak"]).fillna("", ["history_risk_levels", "history_opportunity_levels", "soft_relationships"])
    return out.withColumns(
        {
            "risk_direction": direction(F.col("current_risk"), F.col("history_risk")),
            "opportunity_direction": direction(F.col("current_opportunity"), F.col("history_opportunity")),
            "trend_state": trend_state(out),
        }
    )


def trend_insights(items: DataFrame, signals: DataFrame, comparisons: DataFrame | None = None, k: int = 3, has_history: bool = False) -> DataFrame:
    """Insight rows for the most common topics with up to three evidence items each."""
    leading = top_topics(items, k).select("report_date", "topic", F.col("rank").alias("section_index"), "item_count")
    named = leading.withColumn("topic_key", topic_key(F.col("topic"))).join(signals.select(*DAY_TOPIC, "trend_state", "current_peak"), DAY_TOPIC)
    of_topic = items.join(leading.select("report_date", "topic"), ["report_date", "topic"], "left_semi")
    first = top_per_group(of_topic, ["report_date", "topic"], [F.col("pos")], 3).groupBy("report_date", "topic").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "id"))), lambda e: e["id"]), ",").alias("evidence_item_ids"), F.min_by("impact_scope", "rank").alias("scope")
    )
    out = named.join(first, ["report_date", "topic"])
    used = F.lit(has_history)
    if comparisons is not None:
        evidence = comparisons.groupBy("report_date", "topic").agg(F.count(F.lit(1)).alias("_adopted"))
        out = out.join(evidence, ["report_date", "topic"], "left")
        used = used | (F.coalesce("_adopted", F.lit(0)) > 0)
    title = F.concat_ws(" ", "topic", label(F.col("trend_state"), lexicon.TREND_TITLES))
    return out.select("report_date", "section_index", "topic", title.alias("title"), "scope", "trend_state", "item_count", F.col("current_peak").alias("peak_score"), "evidence_item_ids", used.alias("historical_context_used"))


def dominant_scope(evidence: DataFrame, keys: list[str]) -> DataFrame:
    """The only scope of a group, else the scope of its most important item."""
    return evidence.groupBy(*keys).agg(
        F.min("impact_scope").alias("_low"), F.max("impact_scope").alias("_high"), F.max_by("impact_scope", F.struct("importance_score", (-F.col("pos")).alias("early"))).alias("_best")
    ).select(*keys, F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(F.col("_best")).alias("dominant_scope"))
