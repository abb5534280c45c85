"""Landed payloads to raw items: JSON arrays, feeds, papers, releases, stories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayline import schemas
from dayline.functions.once import once
from dayline.functions.text import markup_to_text, strip
from dayline.functions.urls import url_host
from dayline.functions.values import epoch_timestamp, feed_timestamp

_RSS = (
    "channel STRUCT<item: ARRAY<STRUCT<title: STRING, link: STRING, guid: STRING, pubDate: STRING, updated: STRING, date: STRING, "
    "description: STRING, summary: STRING, encoded: STRING>>>"
)
_ATOM = (
    "entry ARRAY<STRUCT<title: STRING, link: ARRAY<STRUCT<_href: STRING, _rel: STRING, _type: STRING, _title: STRING>>, id: STRING, published: STRING, "
    "updated: STRING, created: STRING, summary: STRING, content: STRING, author: ARRAY<STRUCT<name: STRING>>, category: ARRAY<STRUCT<_term: STRING>>, "
    "primary_category: STRUCT<_term: STRING>>>"
)
_CORRUPT = "_corrupt_record"
_XML = {"ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
#: What an entry and what a failed payload carry through a reader, beside their own fields.
ORIGIN = ("source_name", "source_url", "fetched_at", "status", "failure", "detail")


def read_item_arrays(spark: SparkSession, path: str) -> DataFrame:
    """Raw items from files that each hold one JSON array of objects; anything else fails the read."""
    return spark.read.schema(schemas.RAW_ITEM).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed payloads; a file without the columns of a payload is an error."""
    return spark.read.schema(schemas.PAYLOAD).parquet(path)


def _text(c) -> Column:
    return strip(F.col(c) if isinstance(c, str) else c)


def _first_time(*cols: str) -> Column:
    return F.coalesce(*[feed_timestamp(F.col(c)) for c in cols])


def transport_error() -> Column:
    """Why a payload has nothing to parse: what the server said, or an empty body; else null."""
    return (
        F.when(F.col("status") == 429, "rate_limited")
        .when(F.col("status") >= 400, "http_error")
        .when(F.col("body").isNull() | (strip(F.col("body")) == ""), "empty_body")
    )


def _opened(payloads: DataFrame, parsed: Column, corrupt: Column, entries: Column) -> DataFrame:
    """One row per entry, and one for each payload that cannot be read: the reason in ``failure``, the start of the body in ``detail``.

    A payload that parses and has no entries is no error and has no rows.  Every body is parsed once.
    """
    failed = transport_error()
    rows = payloads.withColumn("failure", failed).withColumn("_x", F.when(F.col("failure").isNull(), parsed))
    broken = F.col("failure").isNull() & (F.col("_x").isNull() | corrupt)
    rows = rows.withColumn("failure", F.when(broken, "invalid_payload").otherwise(F.col("failure")))
    said = F.when(F.col("failure") == "invalid_payload", F.substring("body", 1, 80))
    code = F.when(F.col("status") >= 400, F.concat(F.lit("status "), F.col("status").cast("string")))
    rows = rows.withColumn("detail", F.coalesce(code, said, F.when(F.col("failure").isNotNull(), F.lit(""))))
    good = F.when(F.col("failure").isNull(), entries)
    rows = rows.select(*ORIGIN, F.posexplode_outer(good).alias("pos", "e"))
    return rows.where("failure IS NOT NULL OR pos IS NOT NULL").select(*ORIGIN, "pos", "e.*")


def _readable(rows: DataFrame, *required: str) -> DataFrame:
    """Failed payloads, and entries that have what every entry needs."""
    needed = " AND ".join(f"{c} <> ''" for c in required)
    return rows.where(f"failure IS NOT NULL OR ({needed})")


def _needed(untitled: bool, title: str = "title") -> tuple[str, ...]:
    """What every entry needs: a link and, unless ``untitled``, a title."""
    return ("url",) if untitled else (title, "url")


def _entries_only(rows: DataFrame) -> DataFrame:
    return rows.where("failure IS NULL").drop("fetched_at", "status", "failure", "detail")


def _feed(payloads: DataFrame, schema: str, entries: str) -> DataFrame:
    parsed = F.from_xml("body", f"{schema}, {_CORRUPT} STRING", _XML)
    return _opened(payloads, parsed, F.col(f"_x.{_CORRUPT}").isNotNull(), F.col(f"_x.{entries}"))


def rss_rows(payloads: DataFrame, untitled: bool = False) -> DataFrame:
    """Entries of RSS payloads in feed order with their origin, and failed payloads; a missing date falls back to the fetch time.

    An entry without a title is left out, with ``untitled`` it stays.
    """
    rows = _feed(payloads, _RSS, "channel.item")
    rows = once(rows, {
        "title": _text("title"), "url": _text("link"), "guid": _text("guid"),
        "summary": markup_to_text(F.coalesce("summary", "description", F.lit(""))), "body": markup_to_text(F.coalesce("encoded", F.lit(""))),
        "published_at": F.coalesce(_first_time("pubDate", "updated", "date"), "fetched_at"),
    })
    guid = F.col("guid")
    return _readable(rows, *_needed(untitled)).select(
        *ORIGIN, "pos", "title", "url", "published_at", "summary",
        F.when(F.col("body") != "", F.col("body")).otherwise(F.col("summary")).alias("content"), F.when(guid != "", guid).otherwise(F.col("url")).alias("external_id"),
        F.create_map(F.lit("content_source"), F.lit("rss_feed")).alias("metadata"),
    )


def rss_entries(payloads: DataFrame, untitled: bool = False) -> DataFrame:
    """Entries of the readable RSS payloads."""
    return _entries_only(rss_rows(payloads, untitled))


def _alternate() -> Column:
    plain = F.filter("link", lambda v: F.coalesce(v["_rel"], F.lit("alternate")) == "alternate")
    return F.coalesce(F.get(plain, F.lit(0))["_href"], F.get("link", F.lit(0))["_href"], F.lit(""))


def atom_rows(payloads: DataFrame, untitled: bool = False) -> DataFrame:
    """Entries of Atom payloads in feed order with their origin, and failed payloads; without a title only if ``untitled``."""
    rows = _readable(_atom_rows(payloads), *_needed(untitled))
    return rows.select(
        *ORIGIN, "pos", "title", "url", "published_at", "summary", F.when(F.col("text") != "", F.col("text")).otherwise(F.col("summary")).alias("content"),
        F.when(F.col("external_id") != "", F.col("external_id")).otherwise(F.col("url")).alias("external_id"), F.create_map(F.lit("content_source"), F.lit("rss_feed")).alias("metadata"),
    )


def atom_entries(payloads: DataFrame, untitled: bool = False) -> DataFrame:
    """Entries of the readable Atom payloads."""
    return _entries_only(atom_rows(payloads, untitled))


def _atom_rows(payloads: DataFrame) -> DataFrame:
    rows = _feed(payloads, _ATOM, "entry")
    return once(rows, {
        "title": _text("title"), "url": _text(_alternate()), "external_id": _text("id"),
        "published_at": F.coalesce(_first_time("published", "updated", "created"), "fetched_at"), "summary": markup_to_text(F.coalesce("summary", F.lit(""))),
        "text": markup_to_text(F.coalesce("content", F.lit(""))),
    })


def is_atom() -> Column:
    """Whether a body's root element is that of Atom."""
    return F.coalesce(F.col("body"), F.lit("")).rlike(r"(?s)^\s*(<\?xml.*?\?>)?\s*(<!--.*?-->\s*)*<([A-Za-z]+:)?feed[\s>]")


def feed_rows(payloads: DataFrame, untitled: bool = False) -> DataFrame:
    """RSS and Atom payloads together, told apart by their root element, and those that cannot be read."""
    return rss_rows(payloads.where(~is_atom()), untitled).unionByName(atom_rows(payloads.where(is_atom()), untitled))


def feed_entries(payloads: DataFrame, untitled: bool = False) -> DataFrame:
    """Entries of the readable RSS and Atom payloads."""
    return _entries_only(feed_rows(payloads, untitled))


def paper_entries(payloads: DataFrame, untitled: bool = False) -> DataFrame:
    """Paper listings: authors, distinct categories, primary category and PDF link of each entry; without a title only if ``untitled``."""
    rows = _atom_rows(payloads).where("failure IS NULL")
    rows = rows.withColumn("url", F.when(F.col("url") != "", F.col("url")).otherwise(F.col("external_id")))
    filled = lambda values: F.filter(F.coalesce(values, F.array().cast("array<string>")), lambda v: strip(v) != "")
    terms = F.array_distinct(filled(F.transform("category", lambda c: strip(c["_term"]))))
    lower = lambda c: F.lower(strip(c))
    pdf = F.filter("link", lambda v: (strip(v["_href"]) != "") & ((lower(v["_title"]) == "pdf") | F.contains(lower(v["_type"]), F.lit("pdf")) | F.contains(v["_href"], F.lit("/pdf/"))))
    out = _readable(rows, *_needed(untitled)).withColumns(
        {"authors": filled(F.transform("author", lambda a: strip(a["name"]))), "categories": terms, "pdf_url": F.coalesce(F.get(pdf, F.lit(0))["_href"], F.lit(""))}
    )
    primary = F.coalesce(F.nullif(strip(F.col("primary_category._term")), F.lit("")), F.get("categories", F.lit(0)), F.lit(""))
    return out.select(
        "source_name", "source_url", "pos", "title", "url", "published_at", "summary", F.col("summary").alias("content"),
        F.when(F.col("external_id") != "", F.col("external_id")).otherwise(F.col("url")).alias("external_id"), "authors", "categories", primary.alias("primary_category"), "pdf_url",
        F.create_map(F.lit("content_source"), F.lit("arxiv_summary"), F.lit("content_chars"), F.length("summary").cast("string")).alias("metadata"),
    )


_RELEASES = "ARRAY<STRUCT<id: STRING, name: STRING, tag_name: STRING, html_url: STRING, published_at: STRING, body: STRING>>"


def release_rows(payloads: DataFrame, untitled: bool = False) -> DataFrame:
    """Releases of every readable repository (``source_name`` is the repository) with their origin, and failed payloads.

    A release without a name or tag is left out, with ``untitled`` it stays under the repository's name.
    """
    parsed = F.when(F.ltrim("body").startswith("["), F.from_json("body", _RELEASES))
    rows = _opened(payloads, F.struct(parsed.alias("list")), F.col("_x.list").isNull(), F.col("_x.list"))
    name = F.when(_text("name") != "", _text("name")).otherwise(_text("tag_name"))
    rows = once(rows, {
        "label": name, "url": _text("html_url"), "text": markup_to_text(F.coalesce("body", F.lit(""))),
        "published_at": F.coalesce(feed_timestamp(F.col("published_at")), "fetched_at"),
    })
    return _readable(rows, *_needed(untitled, "label")).select(
        *ORIGIN, "pos", F.concat_ws(" ", "source_name", F.nullif("label", F.lit(""))).alias("title"), "url", "published_at",
        F.substring("text", 1, 500).alias("summary"), F.col("text").alias("content"), F.when(_text("id") != "", _text("id")).otherwise(F.concat_ws(":", "source_name", "label")).alias("external_id"),
        F.create_map(F.lit("repo"), F.col("source_name"), F.lit("tag_name"), _text("tag_name"), F.lit("content_source"), F.lit("github_release_body"), F.lit("content_chars"), F.length("text").cast("string")).alias("metadata"),
    )


def release_entries(payloads: DataFrame) -> DataFrame:
    """Releases of every readable repository."""
    return _entries_only(release_rows(payloads))


def release_errors(payloads: DataFrame) -> DataFrame:
    """Repositories that were not read, as ``rate_limited`` (also by 403) or ``repo_error``."""
    limited = F.col("status").isin(403, 429)
    failed = release_rows(payloads).where("failure IS NOT NULL")
    return failed.select("source_name", F.when(limited, "rate_limited").otherwise("repo_error").alias("category"), "status")


_STORY = "id BIGINT, type STRING, title STRING, text STRING, url STRING, time BIGINT, score BIGINT, descendants BIGINT"
STORY_LABELS = {"ask_hn": "Ask HN discussion", "show_hn": "Show HN submission", "internal_discussion": "Hacker News discussion", "external_link": "Hacker News linked story"}
STORY_HOSTS = ("news.ycombinator.com", "www.news.ycombinator.com")


#: Ids of a page of a ranked list.
STORY_PAGE = 500


def ranked_pages(ranked: DataFrame, size: int = STORY_PAGE) -> DataFrame:
    """``ranked(list_name, list_order, at, story_id)`` as landed: pages of ``size`` ids, so that no value grows with its list."""
    paged = ranked.withColumn("page", F.floor(F.col("at") / size))
    ids = F.sort_array(F.collect_list(F.struct("at", "story_id")))
    return paged.groupBy("list_name", "list_order", "page").agg(F.to_json(F.transform(ids, lambda e: e["story_id"])).alias("body"))


def story_entries(
    lists: DataFrame, stories: DataFrame, max_items: int, keywords: list[str] | None = None, include_discussions: bool = True,
    as_of: Column | None = None, look_back_days: int | None = None, size: int = STORY_PAGE,
) -> DataFrame:
    """Stories of ranked lists.

    ``lists``: list_name, list_order, page, body (JSON array of ``size`` ids, fewer on the last page); ``stories``:
    body (JSON object).  The first five times ``max_items`` ids of each list are read, an id counts
    in the first list that names it, and of the matches the first ``max_items`` are kept.  A story older than
    ``look_back_days`` before ``as_of`` is no match; one without a time is.
    """
    most = max_items * 5
    pages = lists.where(F.col("page") * size < most)
    offered = pages.select("list_name", "list_order", "page", F.posexplode(F.from_json("body", "ARRAY<BIGINT>")).alias("on_page", "story_id"))
    offered = offered.withColumn("at", F.col("page") * size + F.col("on_page")).where(F.col("at") < most)
    first = offered.groupBy("story_id").agg(F.min(F.struct("list_order", "at", "list_name")).alias("p"))
    parsed = stories.select(F.from_json("body", _STORY).alias("s")).select("s.*").where("type = 'story'")
    rows = first.join(parsed, first["story_id"] == parsed["id"])
    rows = rows.withColumns({"title": _text("title"), "text": markup_to_text(F.coalesce("text", F.lit(""))), "link": _text("url")}).where("title <> ''")
    if as_of is not None and look_back_days is not None:
        told = epoch_timestamp(F.col("time"))
        rows = rows.where(told.isNull() | (told >= as_of - F.make_dt_interval(F.lit(look_back_days))))
    if keywords:
        body = F.lower(F.concat_ws(" ", "title", "text"))
        rows = rows.where(F.exists(F.array(*[F.lit(k.lower()) for k in keywords]), lambda k: F.contains(body, k)))
    title = F.lower("title")
    kind = F.when(title.startswith("ask hn:"), "ask_hn").when(title.startswith("show hn:"), "show_hn").when(F.col("link") == "", "internal_discussion").otherwise("external_link")
    link = F.when(F.col("link") != "", F.col("link")).otherwise(F.concat(F.lit("https://news.ycombinator.com/item?id="), F.col("story_id").cast("string")))
    rows = rows.withColumns({"kind": kind, "url": link}).withColumn("is_external", ~url_host(F.col("url")).isin(*STORY_HOSTS))
    if not include_discussions:
        rows = rows.where("is_external")
    label = F.create_map(*[F.lit(x) for kv in STORY_LABELS.items() for x in kv])[F.col("kind")]
    number = lambda c: F.coalesce(c, F.lit(0)).cast("string")
    head = F.concat(label, F.lit(" with score "), number("score"), F.lit(" and "), number("descendants"), F.lit(" comments."))
    summary = F.when(F.col("text") != "", F.concat_ws(" ", head, "text")).otherwise(head)
    rows = rows.withColumn("summary", summary)
    kept = rows.orderBy("p").limit(max_items)
    return kept.select(
        F.col("p.list_name").alias("source_name"), F.lit("").alias("source_url"), F.col("p.list_order").alias("list_order"), F.col("p.at").alias("pos"), "title", "url",
        epoch_timestamp(F.col("time")).alias("published_at"), "summary", F.when(F.col("text") != "", F.col("text")).otherwise(F.col("summary")).alias("content"),
        F.col("story_id").cast("string").alias("external_id"), "kind", "is_external",
        F.create_map(F.lit("hn_story_kind"), F.col("kind"), F.lit("is_external_link"), F.col("is_external").cast("string"), F.lit("content_source"), F.lit("hackernews_summary")).alias("metadata"),
    )
