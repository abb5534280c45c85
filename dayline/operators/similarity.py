"""Soft similarity of current items to the history of their topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayline.functions.once import once
from dayline.functions.similarity import entity_set, follows_up, jaccard, normal, novelty_of, overlap, specific_tokens, token_set
from dayline.functions.topics import topic_key
from dayline.operators.groups import top_per_group

SALTS = 16


def candidate_pairs(items: DataFrame, retrieved: DataFrame, salts: int = SALTS) -> DataFrame:
    """Items next to the retrieved history of their report date and topic.

    History is at most ``limit`` rows per date and topic, so pairs stay within
    ``limit`` times the items.  A topic may own a third of the items: rows are spread by
    a salt and the few history rows are repeated once per salt.
    """
    left = _features(items, "l").withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
    left = left.withColumnsRenamed({"id": "item_id"})
    right = _features(retrieved.withColumn("id", F.col("memory_item_id")), "r", "rank").withColumnsRenamed({"id": "memory_item_id", "rank": "history_rank"})
    right = right.drop("pos").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, ["report_date", "topic_key", "_salt"]).drop("_salt")


def _features(rows: DataFrame, side: str, *carry: str) -> DataFrame:
    """Normalised texts, token sets and entity set of each row: computed once, not once per pair."""
    both = F.concat_ws(" ", "title", "summary")
    rows = rows.select("report_date", topic_key(F.col("topic")).alias("topic_key"), "id", "pos", *carry, "title", "summary", "entities", "event_type")
    # The normalised text is held against each follow-up word: it is made before, and not for every word.
    return once(
        once(rows, {"_both": normal(both)}),
        {
            f"{side}_specific": specific_tokens(F.col("_both")), f"{side}_follows": follows_up(F.col("_both")),
            f"{side}_title_tokens": token_set(F.col("title")), f"{side}_summary_tokens": token_set(F.col("summary")), f"{side}_both_tokens": token_set(both),
            f"{side}_entities": entity_set(F.col("entities")), f"{side}_event": F.coalesce("event_type", F.lit("")),
        },
    ).drop("title", "summary", "entities", "event_type", "_both")


def score_pairs(pairs: DataFrame) -> DataFrame:
    """Scores, relationship, confidence and signals of each pair.

    Texts are compared by their token sets, inside the JVM.
    """
    out = pairs
    for name in ("title", "summary", "both"):
        left, right = F.col(f"l_{name}_tokens"), F.col(f"r_{name}_tokens")
        score = jaccard(left, right)
        out = out.withColumn(f"{name}_similarity", score)
    out = once(out, {f"{n}_similarity": F.col(f"{n}_similarity") for n in ("title", "summary", "both")})
    out = out.withColumnRenamed("both_similarity", "combined_similarity")
    title, summary, combined = F.col("title_similarity"), F.col("summary_similarity"), F.col("combined_similarity")
    out = out.withColumns(
        {
            "entity_overlap": overlap(F.col("l_entities"), F.col("r_entities")),
            "event_match": F.col("l_event") == F.col("r_event"),
            "text_similarity": F.greatest(title, summary, combined),
        }
    )
    out = once(out, {c: F.col(c) for c in ("entity_overlap", "event_match", "text_similarity")})
    out = out.withColumn("novelty_signal", novelty_of(F.col("l_specific"), F.col("r_specific"), F.col("l_follows"), F.col("text_similarity")))
    one = F.lit(1.0)
    # Pairs are blocked by topic, so the topic always agrees here.
    confidence = (
        F.lit(0.22)
        + F.least("entity_overlap", one) * 0.26
        + F.when(F.col("event_match"), 0.16).otherwise(0.0)
        + F.least("text_similarity", one) * 0.31
        + F.when(F.col("novelty_signal"), 0.05).otherwise(0.0)
    )
    out = once(out, {"_confidence": F.least(confidence, one), "novelty_signal": F.col("novelty_signal")})
    high = (title >= 0.72) | (summary >= 0.72) | (combined >= 0.78)
    medium = (title >= 0.42) | (summary >= 0.42) | (combined >= 0.50)
    shared, event, fresh, sure = F.col("entity_overlap"), F.col("event_match"), F.col("novelty_signal"), F.col("_confidence")
    relationship = (
        F.when((shared >= 0.5) & event & high & ~fresh, "likely_duplicate")
        .when((shared > 0) & (event | medium) & (fresh | (sure >= 0.55)), "continuing")
        .when(((shared > 0) | event | medium) & (sure >= 0.32), "related_context")
        .otherwise("new")
    )
    band = lambda c, name: F.when(c >= 0.72, f"high_{name}_similarity").when(c >= 0.42, f"medium_{name}_similarity")
    signals = F.array_compact(
        F.array(
            F.lit("same_topic"), F.when(shared > 0, "entity_overlap"), F.when(event, "event_type_match"), band(title, "title"), band(summary, "summary"),
            F.when(combined >= 0.50, "combined_text_similarity"), F.when(fresh, "novelty_signal"),
        )
    )
    return out.select(
        "report_date", "topic_key", "item_id", "pos", "memory_item_id", "history_rank",
        relationship.alias("relationship"), F.round("_confidence", 3).alias("confidence"), "_confidence", signals.alias("matched_signals"),
        *[F.round(c, 3).alias(c) for c in ("entity_overlap", "title_similarity", "summary_similarity", "combined_similarity")],
        "event_match", "novelty_signal",
    )


def relationship_rank(c: Column) -> Column:
    return F.when(c == "likely_duplicate", 3).when(c == "continuing", 2).when(c == "related_context", 1).otherwise(0)


def best_matches(scored: DataFrame, max_matches: int = 3) -> DataFrame:
    """Strongest matches per item; unrelated pairs never count."""
    related = scored.where("relationship <> 'new'")
    order = [relationship_rank(F.col("relationship")).desc(), F.col("confidence").desc(), F.col("history_rank")]
    return top_per_group(related, ["report_date", "item_id"], order, max(1, max_matches), "match_rank")


def item_relationships(items: DataFrame, matches: DataFrame) -> DataFrame:
    """One row per current item: best relationship, its confidence and the matched ids in order."""
    # At most ``max_matches`` rows per item are gathered here.
    per_item = matches.groupBy("report_date", "item_id").agg(
        F.min_by("relationship", "match_rank").alias("relationship"),
        F.min_by("confidence", "match_rank").alias("confidence"),
        F.sort_array(F.collect_list(F.struct("match_rank", "memory_item_id"))).alias("_m"),
    )
    base = items.select("report_date", F.col("id").alias("item_id"), "title", "topic", "pos")
    return base.join(per_item, ["report_date", "item_id"], "left").select(
        "report_date", "item_id", "title", "topic", "pos",
        F.coalesce("relationship", F.lit("new")).alias("relationship"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
        F.coalesce(F.transform("_m", lambda m: m["memory_item_id"]), F.array().cast("array<string>")).alias("matched_memory_item_ids"),
    )


def relationship_counts(relationships: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Counts per report date; ``pairs`` adds the number of candidates compared."""
    count = lambda name: F.count_if(F.col("relationship") == name).alias(name)
    out = relationships.groupBy("report_date").agg(
        F.count(F.lit(1)).alias("item_count"), F.count_if(F.col("relationship") != "new").alias("matched_item_count"),
        F.sum(F.size("matched_memory_item_ids")).alias("match_count"), *[count(n) for n in ("new", "related_context", "continuing", "likely_duplicate")],
    )
    if pairs is None:
        return out
    compared = pairs.groupBy("report_date").agg(F.count(F.lit(1)).alias("candidate_count"))
    return out.join(compared, "report_date", "left").withColumn("candidate_count", F.coalesce("candidate_count", F.lit(0)))
