"""All landed sources in one job: each by its own settings, failures as rows beside the items, a status per source.

A source that fails stops no other: what it landed becomes rows with a ``failure``, in the
same table as the items of the others, so every body is parsed once.  Only when nothing at all was
collected does the write fail, after its own count of what it wrote.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from dayline.functions.text import strip
from dayline.operators.groups import lookup, top_per_group
from dayline.sources import payloads as readers
from dayline.sources.items import raw_items
from dayline.sources.tables import publish

#: One row per source: how its payloads are read, and what of them is wanted.
SETTINGS = "source_name STRING, adapter STRING, enabled BOOLEAN, max_items INT, look_back_days INT, keywords ARRAY<STRING>"
#: Readers by adapter, how their items were fetched, and of what type they are.
ADAPTERS = {
    "feed": (readers.feed_rows, "rss", "news"),
    "releases": (readers.release_rows, "github_releases", "release"),
}


class NothingCollected(ValueError):
    """Every enabled source failed or had no items."""


def wanted(as_of: Column) -> Column:
    """Whether an entry is inside its source's window (without a date: yes) and holds one of its keywords (none: yes)."""
    published, days = F.col("published_at"), F.col("look_back_days")
    recent = published.isNull() | days.isNull() | (published >= as_of - F.make_dt_interval(days))
    words = F.filter(F.transform(F.coalesce("keywords", F.array().cast("array<string>")), F.lower), lambda k: strip(k) != "")
    said = F.lower(F.concat(strip(F.col("title")), F.lit(" "), strip(F.coalesce("summary", F.lit("")))))
    return recent & ((F.size(words) == 0) | F.exists(words, lambda k: F.contains(said, k)))


def collect(payloads: DataFrame, settings: DataFrame, as_of: Column, untitled: bool = False) -> DataFrame:
    """Items of all enabled sources and their failed payloads, told apart by ``failure``.

    Of each source the first ``max_items`` wanted entries are kept, in the order of fetch time, address and
    place in the feed.  Entries without a title are wanted only if ``untitled``.  ``settings`` has a row per source; an
    empty one, or none enabled, is an error.
    """
    enabled = settings.where(F.coalesce("enabled", F.lit(True)))
    most = enabled.agg(F.max("max_items").alias("n"), F.count(F.lit(1)).alias("sources")).first()
    if not most["sources"]:
        raise ValueError("no enabled sources configured")
    mine = lookup(payloads, enabled.select("source_name", "adapter"), ["source_name"], "inner")
    made = None
    for adapter, (reader, via, kind) in ADAPTERS.items():
        rows = reader(mine.where(F.col("adapter") == adapter), untitled)
        items = raw_items(rows, via, kind, carry=("source_url", "fetched_at", "status", "failure", "detail"))
        items = items.withColumn("adapter", F.lit(adapter))
        made = items if made is None else made.unionByName(items)
    rules = enabled.select("source_name", "max_items", "look_back_days", "keywords")
    ruled = lookup(made, rules, ["source_name"], "inner")
    ruled = ruled.where(F.col("failure").isNotNull() | wanted(as_of)).drop("look_back_days", "keywords")
    good, bad = ruled.where("failure IS NULL"), ruled.where("failure IS NOT NULL").drop("max_items")
    if most["n"] is not None:
        order = [F.col(c) for c in ("fetched_at", "source_url", "pos")]
        good = top_per_group(good, ["source_name"], order, most["n"], "_place")
        good = good.where(F.coalesce(F.col("_place") <= F.col("max_items"), F.lit(True))).drop("_place")
    return good.drop("max_items").unionByName(bad)


def errors(collected: DataFrame) -> DataFrame:
    """One row per payload that was not read: where, why, what it said."""
    return collected.where("failure IS NOT NULL").select("source_name", "adapter", "source_url", "status", "failure", "detail")


def items(collected: DataFrame) -> DataFrame:
    """The items alone."""
    return collected.where("failure IS NULL").drop("fetched_at", "status", "failure", "detail", "adapter")


def source_status(collected: DataFrame, payloads: DataFrame, settings: DataFrame) -> DataFrame:
    """``(source_name, adapter, status, items, attempts, failures)`` of each enabled source.

    With items: ``succeeded``, or ``partial`` if a payload failed too.  Without: ``empty`` where all that landed
    was read, or nothing landed; otherwise ``rate_limited`` where a limit was met (for repositories: by every failed one),
    ``failed`` where nothing else was read, ``empty`` for repositories.
    """
    limited = (F.col("failure") == "rate_limited") | ((F.col("adapter") == "releases") & (F.col("status") == 403))
    counts = collected.groupBy("source_name").agg(
        F.count_if(F.col("failure").isNull()).alias("items"), F.count_if(F.col("failure").isNotNull()).alias("failures"),
        F.count_if(limited).alias("_limited"),
    )
    landed = payloads.groupBy("source_name").agg(F.count(F.lit(1)).alias("attempts"))
    rows = settings.where(F.coalesce("enabled", F.lit(True))).select("source_name", "adapter")
    rows = rows.join(counts, "source_name", "left").join(landed, "source_name", "left").fillna(0, ["items", "failures", "_limited", "attempts"])
    releases = F.col("adapter") == "releases"
    status = (
        F.when((F.col("items") > 0) & (F.col("failures") > 0), "partial")
        .when(F.col("items") > 0, "succeeded")
        .when(F.col("failures") == 0, "empty")
        .when(F.when(releases, F.col("_limited") == F.col("failures")).otherwise(F.col("_limited") > 0), "rate_limited")
        .when(~releases & (F.col("failures") == F.col("attempts")), "failed")
        .otherwise("empty")
    )
    return rows.select("source_name", "adapter", status.alias("status"), "items", "attempts", "failures")


def adapter_counts(collected: DataFrame) -> DataFrame:
    """Items and failed payloads by adapter."""
    bad = F.col("failure").isNotNull()
    return collected.groupBy("adapter").agg(F.count_if(~bad).alias("items"), F.count_if(bad).alias("failures"))


def write_collected(collected: DataFrame, target: str, version: str) -> None:
    """Publish items and failures together; if the write counted no item, readers keep the version before.

    The count is observed while the rows are written, so nothing is read again.
    """
    seen = Observation()
    observed = collected.observe(seen, F.count_if(F.col("failure").isNull()).alias("items"))

    def some_items(written: DataFrame) -> None:
        if seen.get["items"]:
            return
        told = written.select("source_name", "failure", "detail").orderBy("source_name", "failure").limit(20).collect()
        said = "; ".join(f"{r['source_name']}: {r['failure']} {r['detail']}".strip() for r in told)
        raise NothingCollected(f"all enabled sources failed or returned no items: {said}")

    publish(observed, target, version, check=some_items)
