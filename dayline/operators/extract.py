"""Structured fields from clean items by keyword rules."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayline import lexicon
from dayline.functions.once import let, once
from dayline.functions.text import contains_any, first_filled, first_sentence


def lowered_body() -> Column:
    return F.lower(F.concat_ws(" ", "title", "summary", "content"))


def topic_of(body: Column, rules: dict = lexicon.TOPIC_WORDS, default: str = lexicon.TOPICS[-1]) -> Column:
    """First topic with a keyword anywhere in the text (no word boundaries)."""
    out = F.when(F.lit(False), "")
    for topic, words in rules.items():
        out = out.when(contains_any(body, words), topic)
    return out.otherwise(default)


def event_type_of(body: Column, source_type: Column) -> Column:
    out = F.when(F.lit(False), "")
    for event, words in lexicon.EVENT_WORDS.items():
        out = out.when(contains_any(body, words), event)
    released = contains_any(body, lexicon.RELEASE_WORDS)
    return (
        out.when(released & (F.contains(body, F.lit("model")) | (source_type == "release")), "model_release")
        .when(released, "product_launch")
        .otherwise("market")
    )


def impact_scope_of(body: Column, event: Column) -> Column:
    out = F.when(event == "policy", "policy").when(event == "funding", "capital").when(event == "security", "security")
    for scope, words in lexicon.SCOPE_WORDS.items():
        out = out.when(contains_any(body, words), scope)
    return out.otherwise("ecosystem")


def risk_level_of(body: Column, event: Column) -> Column:
    return (
        F.when(event.isin("controversy", "security") | contains_any(body, lexicon.HIGH_RISK_WORDS), "high")
        .when((event == "policy") | contains_any(body, lexicon.MEDIUM_RISK_WORDS), "medium")
        .otherwise("low")
    )


def opportunity_level_of(body: Column, event: Column) -> Column:
    return (
        F.when(
            event.isin("model_release", "product_launch", "partnership") | contains_any(body, lexicon.HIGH_OPPORTUNITY_WORDS),
            "high",
        )
        .when(event.isin("research", "market"), "medium")
        .otherwise("low")
    )


def sentiment_of(body: Column, risk: Column, opportunity: Column) -> Column:
    return (
        F.when((risk == "high") & (opportunity == "high"), "mixed")
        .when(risk == "high", "negative")
        .when(contains_any(body, lexicon.MIXED_SENTIMENT_WORDS), "mixed")
        .when(opportunity == "high", "positive")
        .otherwise("neutral")
    )


def importance_of(body: Column, source_type: Column, event: Column, risk: Column) -> Column:
    bonus = lambda condition, points: F.when(condition, points).otherwise(0)
    total = (
        F.lit(50)
        + bonus(source_type.isin("blog", "release", "research"), 8)
        + bonus(event.isin("model_release", "product_launch"), 14)
        + bonus(event.isin("policy", "security"), 12)
        + bonus(event == "partnership", 8)
        + bonus(contains_any(body, lexicon.BIG_NAME_WORDS), 10)
        + bonus(contains_any(body, lexicon.MOMENTUM_WORDS), 6)
        + F.when(risk == "high", 8).when(risk == "medium", 4).otherwise(0)
    )
    return F.least(total, F.lit(100)).cast("int")


def entities_of(raw: Column, names=lexicon.ENTITY_NAMES) -> Column:
    """Known names standing as whole words, case-sensitive, in list order.

    Only a text that contains the name pays for the boundary check.
    """
    found = F.array_compact(F.array(*[F.when(F.contains(raw, F.lit(n)) & raw.rlike(rf"(?U)\b{re.escape(n)}\b"), n) for n in names]))
    return let(found, lambda names: F.when(F.size(names) > 0, names).otherwise(F.array(F.lit(lexicon.DEFAULT_ENTITY))))


# The first sentences of an item's texts, computed once and used by several fields.
SENTENCES = {"title": "_s_title", "summary": "_s_summary", "content": "_s_content"}


def with_sentences(items: DataFrame) -> DataFrame:
    return items.withColumns({name: first_sentence(F.col(field)) for field, name in SENTENCES.items()})


def key_points() -> Column:
    points = F.array(F.col("_s_summary"), F.col("_s_content"), F.col("title"))
    return F.slice(F.array_distinct(F.filter(points, lambda p: p != "")), 1, 3)


def evidence_source() -> Column:
    """Quote of the first filled field of content, summary, title as a one-element list."""
    quotes = [(f, F.col(SENTENCES[f])) for f in ("content", "summary", "title")]
    source = F.when(F.lit(False), F.struct(F.lit("").alias("source_item_id"), F.lit("").alias("evidence_field"), F.lit("").alias("evidence_quote"), F.lit("").alias("claim")))
    claim = first_filled(F.col("summary"), F.col("_s_content"), F.col("title"))
    for field, quote in quotes:
        source = source.when(
            quote != "",
            F.struct(
                F.col("id").alias("source_item_id"),
                F.lit(field).alias("evidence_field"),
                quote.alias("evidence_quote"),
                claim.alias("claim"),
            ),
        )
    return F.array_compact(F.array(source))


def evidence_hint(evidence: Column) -> Column:
    text = F.lower(F.array_join(evidence, " "))
    out = F.when(F.trim(text) == "", lexicon.NO_EVIDENCE_HINT)
    for words, hint in lexicon.EVIDENCE_HINTS:
        out = out.when(contains_any(text, words), hint)
    return out.otherwise(lexicon.DEFAULT_EVIDENCE_HINT)


def _phrase(code: Column, phrases: dict[str, str], default: str) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in phrases.items() for x in kv])[code], F.lit(default))


def rationales(items: DataFrame) -> DataFrame:
    """Three rationale texts by score band or level, with the evidence hint."""
    event = _phrase(F.col("event_type"), lexicon.EVENT_PHRASES, "事件")
    scope = _phrase(F.col("impact_scope"), lexicon.SCOPE_PHRASES, "相关方向")
    hint, topic, score = F.col("_hint"), F.col("topic"), F.col("importance_score")
    text = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    risk, chance = F.col("risk_level"), F.col("opportunity_level")
    return (
        items.withColumn("_hint", evidence_hint(F.col("evidence")))
        .withColumns(
            {
                "importance_rationale": F.when(score >= 85, text(topic, " 的", event, "直接影响", scope, "，", hint))
                .when(score >= 70, text(topic, " 的", event, "已显示明确", scope, "影响，", hint))
                .when(score >= 50, text(topic, " 的", event, "具备跟踪价值，但影响范围仍需验证"))
                .otherwise(text("当前证据有限，", topic, " 相关影响仍不清晰")),
                "risk_rationale": F.when(risk == "high", text(event, "涉及", scope, "高风险，", hint))
                .when(risk == "medium", text(event, "仍有", scope, "不确定性，", hint))
                .when(risk == "unknown", F.lit("未知：来源未给出足够风险信息，需等待进一步披露"))
                .otherwise(text("低：材料未显示突出风险，主要证据集中在", scope, "进展")),
                "opportunity_rationale": F.when(chance == "high", text(event, "强化", scope, "机会，", hint))
                .when(chance == "medium", text(event, "可能带来", scope, "机会，但落地效果待观察"))
                .when(chance == "unknown", F.lit("未知：来源未给出足够机会信号，需等待更多采用或商业化证据"))
                .otherwise(text("低：新闻重点不在机会扩张，", scope, "增量有限")),
            }
        )
        .drop("_hint")
    )


def structure(items: DataFrame) -> DataFrame:
    """Clean items to structured items; projections only, no shuffle."""
    body, kind = F.col("_body"), F.col("source_type")
    out = with_sentences(items).withColumn("_body", lowered_body())
    out = once(
        out,
        {
            "_body": body,
            "event_type": event_type_of(body, kind),
            "topic": topic_of(body),
            "entities": let(F.concat_ws(" ", "title", "summary", "content"), lambda raw: entities_of(raw)),
            "key_points": key_points(),
            "evidence": F.array(first_filled(F.col("_s_content"), F.col("summary"), F.col("title"))),
            "evidence_sources": evidence_source(),
        },
    )
    event = F.col("event_type")
    out = once(
        out,
        {
            "_body": body,
            "impact_scope": impact_scope_of(body, event),
            "risk_level": risk_level_of(body, event),
            "opportunity_level": opportunity_level_of(body, event),
        },
    )
    risk, chance = F.col("risk_level"), F.col("opportunity_level")
    out = once(out, {"sentiment": sentiment_of(body, risk, chance), "importance_score": importance_of(body, kind, event, risk)}).drop("_body")
    return rationales(out).withColumns(
        {
            "summary": first_filled(F.col("summary"), F.col("_s_content"), F.col("title")),
            "id": F.replace(F.col("id"), F.lit("raw-"), F.lit("structured-")),
        }
    ).drop(*SENTENCES.values())
