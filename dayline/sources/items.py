"""Shared steps of all readers: the raw item shape, windows, caps, unions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayline.functions.text import contains_any, strip
from dayline.operators.groups import top_per_group


def stable_id(source_name: Column, *candidates: Column) -> Column:
    """``raw-<source>-<16 hex>`` from the first filled of external id, URL, title."""
    first = F.coalesce(*[F.when(c != "", c) for c in candidates], F.lit(""))
    return F.concat(F.lit("raw-"), source_name, F.lit("-"), F.substring(F.sha1(first), 1, 16))


def raw_items(
    entries: DataFrame, fetched_via: str, source_type: str = "news", language: str = "en", carry: tuple[str, ...] = ()
) -> DataFrame:
    """Raw items from parsed entries.

    Entries carry source_name, source_url, pos, title, url, published_at, summary, content,
    external_id and optionally source, source_type, language and a ``metadata`` map.  Columns in ``carry`` stay.
    """
    has = set(entries.columns)
    pick = lambda name, default: F.col(name) if name in has else F.lit(default)
    external = F.coalesce(F.when(F.col("external_id") != "", F.col("external_id")), F.col("url"))
    base = F.create_map(
        F.lit("source_name"), F.col("source_name"), F.lit("source_url"), F.coalesce(F.when(F.col("source_url") != "", F.col("source_url")), F.col("url")),
        F.lit("external_id"), external, F.lit("fetched_via"), F.lit(fetched_via),
    )
    extra = F.col("metadata") if "metadata" in has else F.create_map().cast("map<string,string>")
    merged = F.map_concat(F.map_filter(base, lambda k, v: ~F.array_contains(F.map_keys(extra), k)), extra)
    # Where all three are empty, the content stays as it is.
    content = F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in ("content", "summary", "title")], F.col("content"))
    return entries.select(
        "source_name", "pos", stable_id(F.col("source_name"), F.coalesce("external_id", F.lit("")), F.col("url"), F.col("title")).alias("id"), "title",
        (F.col("source") if "source" in has else F.col("source_name")).alias("source"), "url", "published_at", pick("source_type", source_type).alias("source_type"),
        pick("language", language).alias("language"), "summary", content.alias("content"), merged.alias("metadata"), *carry,
    )


def within_window(items: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Keep items of the look-back window; an item without a date stays."""
    published = F.col("published_at")
    return items.where(published.isNull() | (published >= as_of - F.make_dt_interval(F.lit(days))))


def with_keywords(items: DataFrame, keywords: list[str]) -> DataFrame:
    """Keep items whose title or summary contains a keyword (plain substring)."""
    words = [k.lower() for k in keywords if k.strip()]
    if not words:
        return items
    return items.where(contains_any(F.lower(F.concat(strip(F.col("title")), F.lit(" "), strip(F.col("summary")))), words))


def interleave(items: DataFrame, group: str, group_order: str, pos: str, max_items: int, within: tuple[str, ...] = ()) -> DataFrame:
    """Fair merge: the first of every group, then the second, up to ``max_items``.

    No group can contribute more than ``max_items``, so groups are cut before the merge.
    """
    turn = top_per_group(items, [*within, group], [F.col(pos)], max_items, "turn")
    if within:
        return top_per_group(turn, list(within), [F.col("turn"), F.col(group_order)], max_items, "merged_pos")
    return turn.orderBy("turn", group_order).limit(max_items)
