"""Topic aliases to canonical labels and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dayline import lexicon
from dayline.functions.text import squeeze


def plain_key(c: Column) -> Column:
    return squeeze(F.translate(F.lower(F.coalesce(c, F.lit(""))), "_-", "  "))


def alias_pairs(aliases: dict = lexicon.TOPIC_ALIASES) -> list[tuple[str, str]]:
    pairs = {topic.lower(): topic for topic in lexicon.TOPICS}
    pairs.update({alias: topic for topic, names in aliases.items() for alias in names})
    return list(pairs.items())


def topic_label(c: Column, aliases: dict = lexicon.TOPIC_ALIASES) -> Column:
    """Canonical label of a known alias, else null."""
    mapping = F.create_map(*[F.lit(x) for pair in alias_pairs(aliases) for x in pair])
    return mapping[plain_key(c)]


def topic_key(c: Column, aliases: dict = lexicon.TOPIC_ALIASES) -> Column:
    """Lower-case canonical key; an unknown topic keeps its plain form."""
    return F.lower(F.coalesce(topic_label(c, aliases), plain_key(c)))
