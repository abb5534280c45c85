"""Rule-based relevance over fixed vocabularies."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayline import lexicon
from dayline.functions.once import once
from dayline.functions.text import ellipsis, strip

def _literals(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _split_terms(terms) -> tuple[list[str], list[str], list[str]]:
    """Single ASCII words, ASCII phrases and terms in other scripts."""
    terms = list(dict.fromkeys(t.lower() for t in terms))
    words = [t for t in terms if t.isascii() and t.isalnum()]
    phrases = [t for t in terms if t.isascii() and not t.isalnum()]
    return words, phrases, [t for t in terms if not t.isascii()]


def _leading_word(phrase: str) -> str:
    return re.match(r"[^a-z0-9]*([a-z0-9]*)", phrase).group(1)


def vocabulary_words(body: Column, terms) -> Column:
    """Words of the vocabulary, or leading words of its phrases, that are tokens of ``body``."""
    words, phrases, _ = _split_terms(terms)
    return F.array_intersect(
        _literals(dict.fromkeys(words + [_leading_word(p) for p in phrases])), F.regexp_extract_all(body, F.lit("([a-z0-9]+)"), 1)
    )


def matched_terms(body: Column, found_words: Column, terms) -> Column:
    """All vocabulary terms standing alone in ``body`` (no letter or digit of a-z0-9 next to them).

    A single word stands alone exactly when it is a token, so words come from one hashed
    intersection (``vocabulary_words``).  A phrase is searched only when its leading word is
    a token, and only a substring hit pays for the boundary check.
    """
    words, phrases, wide = _split_terms(terms)
    alone = lambda t: F.contains(body, t) & F.regexp_like(
        body, F.concat(F.lit(r"(?<![a-z0-9])\Q"), t, F.lit(r"\E(?![a-z0-9])"))
    )
    pairs = F.array(*[F.struct(F.lit(_leading_word(p)).alias("lead"), F.lit(p).alias("term")) for p in phrases])
    possible = F.filter(pairs, lambda p: ((p["lead"] == "") | F.array_contains(found_words, p["lead"])) & alone(p["term"]))
    parts = [F.array_intersect(_literals(words), found_words)]
    if phrases:
        parts.append(F.transform(possible, lambda p: p["term"]))
    if wide:
        parts.append(F.when(body.rlike("[㐀-鿿]"), F.filter(_literals(wide), alone)).otherwise(_literals([])))
    return F.concat(*parts)


def relevance(
    items: DataFrame,
    families: dict[str, tuple[str, ...]] = lexicon.RELEVANCE_FAMILIES,
    negated_patterns: tuple[str, ...] = lexicon.NEGATED_CONTEXT_PATTERNS,
    threshold: int = lexicon.RELEVANCE_THRESHOLD,
    negated_guard: str | None = lexicon.NEGATED_CONTEXT_GUARD,
) -> DataFrame:
    """Assess each item: category, score, matched terms and evidence of its best signal."""
    body = F.lower(F.concat_ws(" ", "title", "summary", "content"))
    everything = [t for terms in families.values() for t in terms]
    words = once(items.withColumn("_body", body), {"_words": vocabulary_words(F.col("_body"), everything)})
    negated = F.lit(False)
    for pattern in negated_patterns:
        negated = negated | F.col("_body").rlike(pattern)
    if negated_guard:
        negated = F.col("_body").rlike(negated_guard) & negated
    hits = once(words, {"_hits": matched_terms(F.col("_body"), F.col("_words"), everything), "_negated": negated}).drop("_words", "_body")
    # Families are small intersections with the few terms that hit at all.
    for family, terms in families.items():
        hits = hits.withColumn(f"_{family}", F.array_intersect(_literals(terms), F.col("_hits")))

    has = lambda family: F.size(f"_{family}") > 0
    terms = lambda *names: F.array_distinct(F.concat(*[F.col(f"_{n}") for n in names]))
    signal = lambda score, category, *names: F.struct(
        (F.lit(score) if isinstance(score, int) else score).alias("score"),
        F.lit(category).alias("category"),
        terms(*names).alias("terms"),
    )
    consumer = has("negative") & ~has("strong_product")
    doubtful = has("negative") | F.col("_negated")
    infra = F.when(
        has("infra") & has("workload") & ~F.col("_negated"),
        signal(88, "AI infrastructure", "infra", "workload", "tech_entity"),
    ).when(
        has("infra") & (has("weak") | has("direct") | has("workload")),
        signal(58, "AI-adjacent infrastructure", "infra", "weak"),
    )
    policy = F.when(
        has("policy") & has("policy_target") & ~F.col("_negated"),
        signal(86, "AI policy and governance", "policy", "policy_target", "direct"),
    ).when(has("policy"), signal(42, "general policy", "policy", "weak"))
    research = F.when(
        has("research") & has("tech_research"), signal(87, "AI research", "research", "tech_research")
    ).when(has("research") & has("weak"), signal(56, "AI-used research", "research", "weak"))
    product = F.when(
        has("product") & (has("tech_entity") | has("strong_product")),
        signal(
            F.when(consumer, 62).otherwise(86),
            "AI product",
            "product",
            "tech_entity",
            "capability",
            "strong_product",
            "negative",
        ),
    ).when(
        has("product") & (has("weak") | has("direct")),
        signal(55, "AI-adjacent product", "product", "weak", "direct", "negative"),
    )
    business = F.when(
        has("business") & has("business_target"), signal(80, "AI business", "business", "business_target")
    )
    fallback = (
        F.when(
            has("tech_entity"),
            signal(F.when(doubtful, 58).otherwise(72), "direct AI mention", "tech_entity", "negative"),
        )
        .when(has("weak"), signal(45, "weak AI mention", "weak", "negative"))
        .otherwise(signal(F.when(has("negative"), 20).otherwise(30), "out of scope", "negative"))
    )
    # Highest score wins; on a tie the earlier family does.
    best = F.reduce(
        F.array_compact(F.array(infra, policy, research, product, business)),
        F.lit(None).cast("struct<score:int,category:string,terms:array<string>>"),
        lambda acc, s: F.when(acc.isNull() | (s["score"] > acc["score"]), s).otherwise(acc),
    )
    carry = [c for c in items.columns]
    scored = once(hits, {"_best": F.coalesce(best, fallback)})
    return scored.select(
        *carry,
        F.col("_best.score").alias("relevance_score"),
        F.col("_best.category").alias("relevance_category"),
        F.col("_best.terms").alias("matched_terms"),
        (F.col("_best.score") >= threshold).alias("is_ai_related"),
        evidence_lines(F.col("_best.terms")).alias("relevance_evidence"),
        F.lit("rule_based").alias("decision_source"),
    )


def evidence_lines(terms: Column, limit: int = 220) -> Column:
    """Up to two of title, summary and content that mention a term; without terms the first two."""
    candidates = F.filter(F.array(strip(F.col("title")), strip(F.col("summary")), strip(F.col("content"))), lambda v: v != "")
    mentions = F.filter(
        candidates,
        lambda v: (F.size(terms) == 0) | F.exists(terms, lambda t: F.contains(F.lower(v), F.lower(t))),
    )
    fallback = F.slice(F.filter(F.array(strip(F.col("summary")), strip(F.col("title"))), lambda v: v != ""), 1, 1)
    chosen = F.when(F.size(mentions) > 0, F.slice(mentions, 1, 2)).otherwise(fallback)
    return F.transform(chosen, lambda v: ellipsis(v, limit))


def relevance_gate(items: DataFrame, assessments: DataFrame, threshold: int = lexicon.RELEVANCE_THRESHOLD) -> DataFrame:
    """Items whose assessment passes; a semi join, so assessments never widen the items."""
    passed = assessments.where(F.col("is_ai_related") & (F.col("relevance_score") >= threshold)).select("id")
    return items.join(passed, "id", "left_semi")
