"""The whole way from raw items to report rows, for all report dates in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayline.operators import clean, extract, memory, relevance, report, similarity, trends
from dayline.plans import inputs
from dayline.session import durable


def daily_report(spark: SparkSession, sf: str) -> DataFrame:
    """Top events per report date with topic, scores, trend state and history relation.

    Only items pass from step to step as tables: clean and deduplicated, relevant and
    structured, then compared with the history of the days before.
    """
    items = clean.dedupe(inputs.clean(spark, sf))
    relevant = relevance.relevance(items).where("is_ai_related")
    structured = durable(extract.structure(relevant))
    history = memory.to_entries(structured).drop("report_date")
    retrieved = durable(memory.retrieve(history, structured))
    pairs = similarity.score_pairs(similarity.candidate_pairs(structured, retrieved))
    relations = durable(similarity.item_relationships(structured, similarity.best_matches(pairs)))
    states = trends.trend_signals(structured, retrieved, relations).select("report_date", "topic", "current_count", "history_count", "trend_state")
    top = report.top_events(structured)
    related = relations.select("report_date", F.col("item_id").alias("id"), "relationship", "confidence")
    return (
        top.join(related, ["report_date", "id"], "left")
        .join(states, ["report_date", "topic"], "left")
        .select("report_date", "rank", "id", "title", "source", "topic", "event_type", "importance_score", "risk_level", "opportunity_level", "relationship", "confidence", "current_count", "history_count", "trend_state", "is_deep_dive")
    )
