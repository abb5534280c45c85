"""Similarity column functions; everything but the sequence ratio stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dayline import lexicon
from dayline.functions.text import SPACE, contains_any, squeeze


def normal(c: Column) -> Column:
    return squeeze(F.lower(c))


def token_set(c: Column) -> Column:
    """Distinct word and single CJK tokens without stop words."""
    tokens = F.regexp_extract_all(normal(c), F.lit(f"({lexicon.TOKEN_PATTERN})"), 1)
    return F.array_except(F.array_distinct(tokens), F.array(*[F.lit(w) for w in lexicon.STOP_WORDS]))


def jaccard(left: Column, right: Column) -> Column:
    """Jaccard of two distinct arrays; 0 when either is empty."""
    both = F.size(F.array_intersect(left, right))
    return F.when((F.size(left) == 0) | (F.size(right) == 0), F.lit(0.0)).otherwise(
        both / (F.size(left) + F.size(right) - both)
    )


def entity_set(values: Column) -> Column:
    names = F.array_distinct(F.transform(F.coalesce(values, F.array().cast("array<string>")), normal))
    return F.filter(names, lambda v: (v != "") & ~v.isin(*lexicon.GENERIC_ENTITIES))


def overlap(left: Column, right: Column) -> Column:
    """Overlap coefficient of two distinct arrays."""
    return F.when((F.size(left) == 0) | (F.size(right) == 0), F.lit(0.0)).otherwise(
        F.size(F.array_intersect(left, right)) / F.least(F.size(left), F.size(right))
    )


def specific_tokens(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(f"({lexicon.SPECIFIC_TOKEN_PATTERN})"), 1))


def follows_up(c: Column) -> Column:
    """Whether a text has a follow-up word."""
    return contains_any(c, lexicon.NOVELTY_WORDS)


def novelty_of(current: Column, historical: Column, follows: Column, text_similarity: Column) -> Column:
    """New specific tokens, or a follow-up word while the texts differ; from what each text gives once."""
    fresh = F.size(F.array_except(current, historical)) > 0
    return fresh | ((text_similarity < 0.72) & follows)


def novelty(current: Column, historical: Column, text_similarity: Column) -> Column:
    """``novelty_of`` two texts."""
    return novelty_of(specific_tokens(current), specific_tokens(historical), follows_up(current), text_similarity)


__all__ = ["SPACE", "entity_set", "follows_up", "jaccard", "normal", "novelty", "novelty_of", "overlap", "specific_tokens", "token_set"]
