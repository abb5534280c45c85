"""Report sections as long tables: rankings, insights, comparisons, references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayline import lexicon
from dayline.functions.text import label
from dayline.functions.topics import topic_key
from dayline.operators.groups import SLICE_ROWS, lookup, number_rows, top_per_group

def by_score() -> list[Column]:
    """Importance first; equal scores keep input order."""
    return [F.col("importance_score").desc(), F.col("pos")]


def top_events(items: DataFrame, k: int = 5, deep: int = 3) -> DataFrame:
    ranked = top_per_group(items, ["report_date"], by_score(), k)
    return ranked.withColumn("is_deep_dive", F.col("rank") <= deep)


def importance_chart(items: DataFrame, k: int = 10) -> DataFrame:
    """Chart points of the ``k`` most important items, ascending; later input wins ties."""
    ranked = top_per_group(items, ["report_date"], [F.col("importance_score").desc(), F.col("pos").desc()], k, "_r")
    size = F.least(F.lit(k), F.col("_n"))
    counts = items.groupBy("report_date").agg(F.count(F.lit(1)).alias("_n"))
    return ranked.join(counts, "report_date").select("report_date", (size - F.col("_r") + 1).alias("chart_index"), F.col("id").alias("item_id"), F.col("importance_score").alias("value"))


def references(items: DataFrame) -> DataFrame:
    """Reference number of every item: importance order, numbered slice by slice."""
    width = F.lit(SLICE_ROWS)
    slices = [-F.col("importance_score"), F.floor(F.col("pos") / width)]
    return number_rows(items, ["report_date"], by_score(), slices, "reference_number")


def reference_index(numbered: DataFrame) -> DataFrame:
    """(report_date, key) -> number for item ids, raw ids and evidence source ids; the last writer wins."""
    keys = F.concat(F.array(F.col("id"), F.regexp_replace("id", "^structured-", "raw-")), F.transform("evidence_sources", lambda s: s["source_item_id"]))
    return numbered.select("report_date", F.explode(keys).alias("key"), "reference_number").groupBy("report_date", "key").agg(F.max("reference_number").alias("reference_number"))


def citations(claims: DataFrame, index: DataFrame) -> DataFrame:
    """Citation text per claim: distinct numbers of its sources in source order.

    ``claims(report_date, claim_id, sources ARRAY<STRING>)``; a claim's sources are one row's list.
    """
    rows = claims.select("report_date", "claim_id", F.posexplode("sources").alias("at", "key"))
    found = lookup(rows, index, ["report_date", "key"], "inner")
    listed = F.transform(F.sort_array(F.collect_list(F.struct("at", "reference_number"))), lambda v: v["reference_number"].cast("string"))
    text = F.concat(F.lit(" ["), F.array_join(F.array_distinct(listed), ", "), F.lit("]"))
    return claims.select("report_date", "claim_id").join(found.groupBy("report_date", "claim_id").agg(text.alias("citation")), ["report_date", "claim_id"], "left").fillna("", ["citation"])


def judgement_table(items: DataFrame) -> DataFrame:
    """Final report rows: number, identity, judgement texts and link."""
    levels = lexicon.LEVEL_LABELS
    cell = lambda c: F.replace(c, F.lit("|"), F.lit("\\|"))
    say = lambda first, second: F.concat(first, F.lit("："), second)
    return references(items).select(
        "report_date", "reference_number", cell(F.col("title")).alias("title"), cell(F.col("source")).alias("source"), cell(F.col("topic")).alias("topic"), "event_type",
        cell(say(F.col("importance_score").cast("string"), F.col("importance_rationale"))).alias("importance_judgement"),
        cell(say(label(F.col("risk_level"), levels), F.col("risk_rationale"))).alias("risk_judgement"),
        cell(say(label(F.col("opportunity_level"), levels), F.col("opportunity_rationale"))).alias("opportunity_judgement"), "url",
    )


def level_insights(items: DataFrame, level: str, k: int = 3, fallback: bool = False) -> DataFrame:
    """Top items with a medium or high level; with ``fallback`` the single best item of a date that has none."""
    raised = F.col(level).isin("medium", "high")
    picked = top_per_group(items.where(raised), ["report_date"], by_score(), k)
    if fallback:
        best = top_per_group(items, ["report_date"], by_score(), 1)
        picked = picked.unionByName(best.join(picked.select("report_date").distinct(), "report_date", "left_anti"))
    return picked


def risk_insights(items: DataFrame, k: int = 3) -> DataFrame:
    return level_insights(items, "risk_level", k, fallback=True)


def opportunity_insights(items: DataFrame, k: int = 3) -> DataFrame:
    return level_insights(items, "opportunity_level", k)


# --- historical comparison -------------------------------------------------------
def _lower_set(c: Column) -> Column:
    return F.array_distinct(F.transform(F.coalesce(c, F.array().cast("array<string>")), F.lower))


def relation_strength(relation: Column, confidence: Column, shared: Column, same_event: Column) -> Column:
    base = F.when(confidence > 0, F.bround(F.least(F.lit(1.0), confidence) * 100)).otherwise(
        F.when(relation == "likely_duplicate", 86).when(relation == "continuing", 76).when(relation == "related_context", 62).when(relation == "background", 45).otherwise(40)
    )
    raised = base.cast("int") + F.when(shared, 8).otherwise(0) + F.when(same_event, 6).otherwise(0)
    raised = F.when(relation == "background", F.least(raised, F.lit(59))).otherwise(raised)
    return F.greatest(F.lit(0), F.least(F.lit(100), raised))


def clamp_weak(relation: Column, strength: Column) -> Column:
    return F.when(relation.isin("background", "related_context"), F.least(strength, F.lit(59))).otherwise(strength)


def relevance_reason(relation: Column, shared_names: Column, same_event: Column) -> Column:
    title = F.when(F.coalesce("h_title", F.lit("")) == "", F.lit("该历史事件")).otherwise(F.col("h_title"))
    return (
        F.when(F.size(shared_names) > 0, F.concat(F.lit("历史事件「"), title, F.lit("」与今日事件共享 "), F.array_join(F.slice(shared_names, 1, 3), ", "), F.lit(" 等主体，且关系类型为 "), relation, F.lit("。")))
        .when(same_event, F.concat(F.lit("历史事件「"), title, F.lit("」与今日事件同属 "), F.col("event_type"), F.lit("，可用于观察同类事件的延续性。")))
        .otherwise(F.concat(F.lit("历史事件「"), title, F.lit("」与今日事件同属 "), F.col("topic"), F.lit("，只能作为主题背景参照，不能替代今日事实判断。")))
    )


def impact_sentence(relation: Column, strength: Column) -> Column:
    return (
        F.when(relation.isin("continuing", "likely_duplicate") & (strength >= 70), "这提高了将今日事件视为延续或升温信号的可信度，但结论仍需回到今日证据。")
        .when(relation == "related_context", "这说明今日事件有可比历史背景，适合辅助判断趋势方向和风险机会变化。")
        .otherwise("这主要提供背景参照，今日新闻价值仍应由当日事实、证据质量和评分决定。")
    )


def historical_comparisons(items: DataFrame, relationships: DataFrame, retrieved: DataFrame, read_ids: DataFrame | None = None, k: int = 5, salts: int = 16) -> DataFrame:
    """Best related history per item, else the best background entry of its topic; ``k`` per date.

    Only an item's own best entry counts, so items are first cut to the ``k`` most
    important ones that have any history at all; no later item can enter the result.
    """
    history = retrieved.select(
        "report_date", "topic_key", "memory_item_id", "rank", F.col("title").alias("h_title"), F.col("entities").alias("h_entities"), F.col("event_type").alias("h_event"), F.col("published_at").alias("h_published")
    )
    known = history.select("report_date", "memory_item_id").distinct()
    matched = relationships.select("report_date", F.col("item_id").alias("id"), "relationship", "confidence", F.posexplode("matched_memory_item_ids").alias("at", "memory_item_id"))
    matched = matched.join(known, ["report_date", "memory_item_id"], "left_semi")
    adopted = matched.groupBy("report_date", "id").agg(F.min(F.struct("at", "memory_item_id", "relationship", "confidence")).alias("m"))
    with_topic = history.select("report_date", "topic_key").distinct().withColumn("has_history", F.lit(True))
    base = items.withColumn("topic_key", topic_key(F.col("topic"))).select("report_date", "id", "pos", "title", "topic", "topic_key", "entities", "event_type", "importance_score")
    base = base.join(adopted, ["report_date", "id"], "left")
    base = lookup(base, with_topic, ["report_date", "topic_key"], "left").where("m IS NOT NULL OR has_history").drop("has_history")
    chosen = top_per_group(base, ["report_date"], by_score(), k, "section_index")
    # From here on there are at most k rows per date and 10 history rows per topic.
    pairs = chosen.join(history, ["report_date", "topic_key"], "left")
    if read_ids is not None:
        pairs = pairs.join(read_ids.select("report_date", "memory_item_id").distinct().withColumn("is_read", F.lit(1)), ["report_date", "memory_item_id"], "left")
    else:
        pairs = pairs.withColumn("is_read", F.lit(0))
    common = F.size(F.array_intersect(_lower_set(F.col("entities")), _lower_set(F.col("h_entities"))))
    place = F.struct(
        F.coalesce(F.col("m.memory_item_id") == F.col("memory_item_id"), F.lit(False)).cast("int").alias("is_match"), common.alias("common"), F.coalesce("is_read", F.lit(0)).alias("is_read"), F.col("h_published").alias("when"), (-F.col("rank")).alias("early")
    )
    best = top_per_group(pairs, ["report_date", "id"], [place.desc(), F.col("memory_item_id")], 1, "_b").drop("_b")
    is_match = F.coalesce(F.col("m.memory_item_id") == F.col("memory_item_id"), F.lit(False))
    relation = F.when(is_match, F.col("m.relationship")).otherwise("background")
    sure = F.when(is_match, F.col("m.confidence")).otherwise(0.45)
    names = F.filter("entities", lambda e: F.array_contains(_lower_set(F.col("h_entities")), F.lower(e)))
    same_event = F.coalesce("h_event", F.lit("")) == F.col("event_type")
    out = best.withColumns({"relation_type": relation, "relevance_strength": relation_strength(relation, sure, F.size(names) > 0, same_event), "rationale": relevance_reason(relation, names, same_event)})
    return out.select(
        "report_date", "section_index", F.col("id").alias("current_item_id"), F.col("title").alias("current_title"), "topic", "memory_item_id", F.col("h_title").alias("historical_title"),
        F.col("h_published").alias("historical_published_at"), "relation_type", "relevance_strength", "rationale", impact_sentence(F.col("relation_type"), F.col("relevance_strength")).alias("impact_on_today"),
    )


def historical_evidence(comparisons: DataFrame, k: int = 3) -> DataFrame:
    """Up to ``k`` distinct adopted history entries per topic in section order."""
    first = comparisons.groupBy("report_date", "topic", F.coalesce("memory_item_id", "historical_title").alias("evidence_key")).agg(F.min("section_index").alias("section_index"), F.min_by("historical_title", "section_index").alias("historical_title"))
    return top_per_group(first, ["report_date", "topic"], [F.col("section_index")], k)


def check_adopted(adopted: DataFrame, candidates: DataFrame, items: DataFrame) -> DataFrame:
    """Adopted comparisons with a reject reason when item or evidence is not a candidate; weak ones are clamped."""
    current = items.select("report_date", F.col("id").alias("current_item_id"), F.lit(True).alias("is_current")).distinct()
    key = lambda df: df.withColumns({"k_id": F.lower(F.trim(F.coalesce("memory_item_id", F.lit("")))), "k_title": F.lower(F.trim("historical_title"))})
    known = key(candidates).select("report_date", "current_item_id", "k_id", "k_title", F.lit(True).alias("is_candidate")).distinct()
    any_known = candidates.select("report_date").distinct().withColumn("has_candidates", F.lit(True))
    out = key(adopted).join(current, ["report_date", "current_item_id"], "left").join(known, ["report_date", "current_item_id", "k_id", "k_title"], "left").join(any_known, "report_date", "left")
    reason = F.when(F.col("is_current").isNull(), "current_item_id_not_in_validated_items").when(F.col("has_candidates").isNotNull() & F.col("is_candidate").isNull(), "historical_evidence_not_in_candidate_context")
    return out.select("report_date", "current_item_id", "memory_item_id", "historical_title", "relation_type", clamp_weak(F.col("relation_type"), F.col("relevance_strength")).alias("relevance_strength"), reason.alias("reject_reason"))


def memory_usage(stages: DataFrame) -> DataFrame:
    """Usage counts per report date, a zero falling through to the next source of the number.

    ``stages`` has one row per date with the count columns named below.
    """
    first = lambda *names: F.coalesce(*[F.nullif(F.col(n), F.lit(0)) for n in names], F.lit(0))
    return stages.select(
        "report_date", first("dedupe_input_count", "relevant_count", "validated_count").alias("relevant_candidate_count"), F.coalesce("dedupe_filtered_count", F.lit(0)).alias("strong_duplicate_filtered_count"),
        first("metadata_included_count", "context_included_count").alias("retrieved_metadata_count"), first("fulltext_count", "read_id_count").alias("read_fulltext_count"), F.coalesce("adopted_count", F.lit(0)).alias("adopted_historical_evidence_count"),
    )
