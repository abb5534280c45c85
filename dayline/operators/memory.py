"""The history table: matching, retrieval, budgets, selection and appends."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayline import schemas
from dayline.functions.once import once
from dayline.functions.text import safe_record_id, strip, truncate_marked
from dayline.functions.topics import topic_key, topic_label
from dayline.operators.components import first_fit
from dayline.operators.groups import explode_keys, lookup, top_per_group
from dayline.operators.key_index import KeyIndex
from dayline.session import durable

ENTRY_KEYS = ("id", "memory_item_id", "validated_item_id", "source_item_id", "url", "content_hash")


# --- reading ---------------------------------------------------------------------
def read_index(documents: DataFrame, body: str = "body") -> DataFrame:
    """Flatten index documents, current or legacy form, to one row per history entry.

    Topic names are canonicalised, so alias spellings of one topic merge; anything that
    is not a list of objects is skipped.
    """
    topics = F.coalesce(F.get_json_object(body, "$.topics"), F.col(body))
    rows = documents.select(F.explode(F.from_json(topics, "MAP<STRING,STRING>")).alias("raw_topic", "entries"))
    rows = rows.select(
        "raw_topic", topic_key(F.col("raw_topic")).alias("topic_key"), F.posexplode(F.from_json("entries", "ARRAY<STRING>")).alias("pos", "entry")
    )
    rows = rows.where((F.col("topic_key") != "") & F.ltrim("entry").startswith("{"))
    parsed = rows.withColumn("e", F.from_json("entry", schemas.MEMORY_ENTRY))
    own = F.when(strip(F.col("e.topic")) != "", F.col("e.topic")).otherwise(F.col("topic_key"))
    return parsed.select("topic_key", F.coalesce(topic_label(own), F.col("topic_key")).alias("topic"), "raw_topic", "pos", F.col("e").dropFields("topic").alias("e")).select(
        "topic_key", "topic", "raw_topic", "pos", "e.*"
    )


def entry_keys(history: DataFrame, carry: tuple[str, ...] = ("memory_item_id",)) -> DataFrame:
    """(field, value) identity keys of history; source and validated ids also count as ids."""
    fields = ("id", "url", "content_hash", "memory_item_id", "validated_item_id", "id", "id")
    columns = ("id", "url", "content_hash", "memory_item_id", "validated_item_id", "source_item_id", "validated_item_id")
    return explode_keys(history, carry, fields, [F.col(c) for c in columns])


def item_keys(items: DataFrame, carry: tuple[str, ...] = ("id",)) -> DataFrame:
    fields = ("id", "url", "content_hash")
    renamed = items.select(*[F.col(c).alias(f"_{c}") for c in carry], *[F.col(f).alias(f) for f in fields])
    return explode_keys(renamed, [f"_{c}" for c in carry], fields, [F.col(f) for f in fields]).withColumnsRenamed({f"_{c}": c for c in carry})


# --- strong duplicates -----------------------------------------------------------
def strong_matches(items: DataFrame, history: DataFrame) -> DataFrame:
    """Matched keys per item with the number of history entries behind each key.

    Item-by-entry pairs are not written out: a key shared by many items and many entries
    would multiply.  ``matched_entries`` holds the other half, joined by (field, value).
    """
    known = entry_keys(history).groupBy("field", "value").agg(
        F.count_distinct("memory_item_id").alias("entry_count"), F.min("memory_item_id").alias("first_entry")
    )
    return lookup(item_keys(items), known, ["field", "value"], "inner").select(
        F.col("id").alias("item_id"), "field", "value", "entry_count", "first_entry"
    )


def matched_entries(items: DataFrame, history: DataFrame) -> DataFrame:
    """History entries reached by any item, one row per entry and matching key."""
    wanted = item_keys(items).select("field", "value").distinct()
    return lookup(entry_keys(history).distinct(), wanted, ["field", "value"], "left_semi")


def drop_known(items: DataFrame, history: DataFrame) -> DataFrame:
    """Anti join: items that share no strong key with history."""
    matched = strong_matches(items, history).select(F.col("item_id").alias("id")).distinct()
    return items.join(matched, "id", "left_anti")


# --- retrieval -------------------------------------------------------------------
def exclude_current(history: DataFrame, current: DataFrame) -> DataFrame:
    """Drop history entries that carry a key of a current item of the same report date."""
    keys = F.array_distinct(F.array(*[F.col(c).cast("string") for c in ENTRY_KEYS]))
    mine = history.select("report_date", "memory_item_id", F.explode(keys).alias("value")).where("value <> ''")
    taken = item_keys(current, ("report_date",)).select("report_date", "value").distinct()
    gone = lookup(mine, taken, ["report_date", "value"], "left_semi").select("report_date", "memory_item_id").distinct()
    return history.join(gone, ["report_date", "memory_item_id"], "left_anti")


def retrieve(
    history: DataFrame, current: DataFrame, window_days: int = 7, limit: int = 10, as_of: Column | None = None
) -> DataFrame:
    """Newest ``limit`` entries per report date and topic of the ``window_days`` before an instant.

    ``as_of`` is that instant as an expression over ``report_date``, by default the end of the
    report date, so entries of the day itself are offered.  History is first cut to the range
    that any report date may read, which prunes its scan; entries then meet instants by topic and
    day, as narrow rows, and only the chosen ones get their other columns.
    """
    if window_days < 0 or limit < 1:
        raise ValueError("window_days must not be negative and limit must be positive")
    instant = F.date_add("report_date", 1).cast("timestamp") if as_of is None else as_of
    # The pairs of dates and topics are distinct values, not rows: small at any scale.
    asked = current.select("report_date", topic_key(F.col("topic")).alias("topic_key")).distinct()
    asked = asked.withColumn("_as_of", instant).withColumn("_day", F.to_date("_as_of"))
    first, last = asked.agg(F.min("_as_of"), F.max("_as_of")).first()
    at = F.col("published_at")
    if first is None or window_days == 0:
        recent = history.limit(0)
    else:
        recent = history.where((at >= F.lit(first - timedelta(days=window_days))) & (at < F.lit(last)))
    days = F.sequence(F.to_date(at), F.date_add(F.to_date(at), window_days))
    narrow = recent.select("pos", "published_at", topic_key(F.col("topic")).alias("topic_key"), *ENTRY_KEYS, F.explode(days).alias("_day"))
    offered = lookup(narrow, asked, ["topic_key", "_day"], "inner")
    offered = offered.where((at < F.col("_as_of")) & (at >= F.col("_as_of") - F.make_dt_interval(F.lit(window_days))))
    fresh = exclude_current(offered, current)
    order = [at.desc(), F.col("pos"), F.col("memory_item_id")]
    chosen = top_per_group(fresh, ["report_date", "topic_key"], order, limit)
    chosen = chosen.select("report_date", "topic_key", "memory_item_id", "pos", "rank")
    return chosen.join(recent.drop("report_date", "topic_key", "rank"), ["memory_item_id", "pos"])


def topics_in_order(items: DataFrame, configured: list[str] | None = None) -> DataFrame:
    """Canonical topics per report date, in order of first appearance (or of the given list)."""
    if configured:
        source = items.select("report_date").distinct().select("report_date", F.posexplode(F.array(*map(F.lit, configured))).alias("pos", "topic"))
    else:
        source = items.select("report_date", "pos", "topic")
    named = source.withColumn("topic", F.coalesce(topic_label(F.col("topic")), strip(F.col("topic")))).where("topic <> ''")
    return named.groupBy("report_date", F.lower("topic").alias("topic_key")).agg(
        F.min_by("topic", "pos").alias("topic"), F.min("pos").alias("first_pos")
    )


# --- budgets ---------------------------------------------------------------------
def iso_time(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


#: Opens the lines of a topic (fixed value).
CONTEXT_HEADER = "Historical context for topic: "
#: Characters of a line whose fields are all empty, and of a catalog record likewise: the least a row can cost.
LEAST_LINE = len("1. [] () importance=: ")


def context_lines(retrieved: DataFrame) -> DataFrame:
    """The text line of each retrieved entry and the header of its topic; null fields are empty."""
    shown = lambda c: F.coalesce(c, F.lit(""))
    line = F.concat(
        F.col("rank").cast("string"), F.lit(". ["), shown(iso_time(F.col("published_at"))), F.lit("] "), shown(F.col("title")), F.lit(" ("),
        shown(F.col("source")), F.lit(") importance="), shown(F.col("importance_score").cast("string")), F.lit(": "), shown(F.col("summary")),
    )
    header = F.concat(F.lit(CONTEXT_HEADER), F.lower(strip(shown(F.col("topic")))))
    return retrieved.withColumns({"line": line, "header": header})


def _prefix(df: DataFrame, keys: list[str], order: list[Column], cost: Column, budget: int, least_cost: int) -> DataFrame:
    """Rows of each group while the running cost stays inside the budget.

    A row costs at least ``least_cost``, so rows ranked beyond budget / least_cost cannot
    fit; dropping them first bounds the running window and changes nothing.
    """
    fits = top_per_group(df, keys, order, budget // least_cost + 1, "_order")
    running = Window.partitionBy(*keys).orderBy("_order").rowsBetween(Window.unboundedPreceding, 0)
    return fits.withColumn("used_chars", F.sum(cost).over(running)).where(F.col("used_chars") <= budget).drop("_order")


def metadata_context(retrieved: DataFrame, topics: DataFrame, max_chars: int = 16000) -> DataFrame:
    """Prefix of the retrieved entries that fits the context budget, in topic order."""
    if max_chars <= 0:
        return context_lines(retrieved).withColumn("used_chars", F.lit(0)).limit(0)
    ordered = context_lines(lookup(retrieved, topics.select("report_date", "topic_key", "first_pos"), ["report_date", "topic_key"], "inner"))
    # Every later topic pays two line breaks; an entry pays its line and a line break.
    lead = ordered.groupBy("report_date").agg(F.min(F.struct("first_pos", "topic_key")).alias("_lead"))
    ordered = lookup(ordered, lead, ["report_date"], "inner").withColumn("_first", F.col("_lead.topic_key") == F.col("topic_key")).drop("_lead")
    cost = F.when(
        F.col("rank") == 1, F.when(F.col("_first"), 0).otherwise(2) + F.length("header") + 1 + F.length("line")
    ).otherwise(1 + F.length("line"))
    order = [F.col("first_pos"), F.col("topic_key"), F.col("rank")]
    return _prefix(ordered, ["report_date"], order, cost, max_chars, LEAST_LINE).drop("_first")


CATALOG_FIELDS = ("memory_item_id", "topic", "title", "source", "url", "published_at", "summary", "entities", "event_type", "importance_score", "risk_level", "opportunity_level")


#: Characters of the keys of a record with their quotes, colons and commas.
LEAST_RECORD = sum(len(name) + 6 for name in CATALOG_FIELDS)


def catalog(retrieved: DataFrame) -> DataFrame:
    """Full-text candidates: the first occurrence of each history id per report date."""
    known = retrieved.where(strip(F.coalesce("memory_item_id", F.lit(""))) != "")
    return top_per_group(known, ["report_date", "memory_item_id"], [F.col("topic_key"), F.col("rank")], 1, "_n").drop("_n")


def available(candidates: DataFrame, stored: DataFrame) -> DataFrame:
    """Candidates whose full record is stored."""
    return candidates.join(stored.select("memory_item_id").distinct(), "memory_item_id", "left_semi")


def selector_catalog(candidates: DataFrame, max_chars: int = 16000) -> DataFrame:
    """Prefix of the catalog whose JSON text fits the budget; 0 means no limit."""
    record = F.struct(*[iso_time(F.col(c)).alias(c) if c == "published_at" else F.col(c) for c in CATALOG_FIELDS])
    compact = F.length(F.to_json(record, {"ignoreNullFields": "false"}))
    # A blank after every ':' and ',' as in the default JSON text form.
    blanks = 2 * len(CATALOG_FIELDS) - 1 + F.greatest(F.size("entities") - 1, F.lit(0))
    sized = candidates.withColumn("json_chars", compact + blanks)
    if max_chars == 0:
        return sized
    # Brackets cost two in all and each separator two: n records cost their sizes plus 2n.
    order = [F.col("topic_key"), F.col("rank"), F.col("memory_item_id")]
    return _prefix(sized, ["report_date"], order, F.col("json_chars") + 2, max_chars, LEAST_RECORD)


# --- full-text selection ---------------------------------------------------------
def heuristic_selection(candidates: DataFrame, relationships: DataFrame, limit: int = 5) -> DataFrame:
    """Matched ids by relationship strength, then candidates by importance and recency."""
    kind = F.col("relationship")
    strength = F.when(kind == "likely_duplicate", 4).when(kind == "continuing", 3).when(kind == "related_context", 2).when(kind == "new", 1).otherwise(0)
    matched = relationships.select(
        "report_date", F.posexplode("matched_memory_item_ids").alias("at", "memory_item_id"), strength.alias("strength"), "confidence", "pos"
    )
    matched = matched.join(candidates.select("report_date", "memory_item_id").distinct(), ["report_date", "memory_item_id"], "left_semi")
    zero = F.lit(0).cast("bigint")
    tier1 = matched.select(
        "report_date", "memory_item_id",
        F.struct(F.lit(1).alias("tier"), (-F.col("strength")).cast("double").alias("a"), (-F.col("confidence")).alias("b"), F.col("pos").cast("bigint").alias("c"), F.col("at").cast("bigint").alias("d")).alias("place"),
    )
    tier2 = candidates.select(
        "report_date", "memory_item_id",
        F.struct(F.lit(2).alias("tier"), (-F.coalesce("importance_score", F.lit(0))).cast("double").alias("a"), (-F.unix_micros("published_at")).cast("double").alias("b"), zero.alias("c"), F.col("rank").cast("bigint").alias("d")).alias("place"),
    )
    best = tier1.unionByName(tier2).groupBy("report_date", "memory_item_id").agg(F.min("place").alias("place"))
    return top_per_group(best, ["report_date"], [F.col("place"), F.col("memory_item_id")], limit).select(
        "report_date", "memory_item_id", F.col("place.tier").alias("tier"), "rank"
    )


def validate_selection(requested: DataFrame, candidates: DataFrame, limit: int = 5) -> DataFrame:
    """Label each requested id: selected (first ``limit`` known ids), overflow or invalid."""
    asked = requested.withColumn("memory_item_id", strip(F.col("memory_item_id"))).where("memory_item_id <> ''")
    asked = asked.groupBy("report_date", "memory_item_id").agg(F.min("pos").alias("pos"))
    known = candidates.select("report_date", "memory_item_id").distinct().withColumn("known", F.lit(True))
    marked = asked.join(known, ["report_date", "memory_item_id"], "left").withColumn("known", F.coalesce("known", F.lit(False)))
    chosen = top_per_group(marked.where("known"), ["report_date"], [F.col("pos")], limit).select("report_date", "memory_item_id", "rank")
    return marked.join(chosen, ["report_date", "memory_item_id"], "left").select(
        "report_date", "memory_item_id", "pos",
        F.when(~F.col("known"), "invalid").when(F.col("rank").isNotNull(), "selected").otherwise("overflow").alias("outcome"),
    )


def fulltext(record: Column, limit: int = 2000) -> dict[str, Column]:
    """Text of a stored record (a VARIANT): relevant, then clean content, then summary, then title."""
    at = lambda path: F.try_variant_get(record, path, "string")
    options = (
        ("relevant.content", at("$.relevant.content")),
        ("clean.content", at("$.clean.content")),
        ("validated.summary", at("$.validated.summary")),
        ("validated.title", at("$.validated.title")),
    )
    filled = lambda c: strip(c) != ""
    label, body = F.when(F.lit(False), ""), F.when(F.lit(False), "")
    for name, value in options:
        label, body = label.when(filled(value), name), body.when(filled(value), strip(value))
    body = body.otherwise("")
    text, cut = truncate_marked(body, limit)
    return {
        "content_source": label.otherwise("none"),
        "content_excerpt": text,
        "content_original_chars": F.length(body),
        "content_chars": F.length(text),
        "truncated": cut,
    }


def read_fulltext(selected: DataFrame, candidates: DataFrame, stored: DataFrame, limit: int = 2000) -> DataFrame:
    """Stored record of each selected id, or the reason it was skipped."""
    listed = candidates.select("report_date", "memory_item_id", F.lit(True).alias("listed"), F.coalesce("memory_item_path", F.lit("")).alias("path"))
    rows = selected.select("report_date", "memory_item_id", "rank").join(listed.dropDuplicates(["report_date", "memory_item_id"]), ["report_date", "memory_item_id"], "left")
    rows = lookup(rows, stored.select("memory_item_id", F.col("payload"), F.lit(True).alias("stored")), ["memory_item_id"], "left")
    rows = once(rows, {"_record": F.try_parse_json("payload")})
    shape = F.when(F.col("_record").isNull(), "invalid_json").when(~F.ltrim("payload").startswith("{"), "invalid_shape")
    reason = (
        F.when(F.col("listed").isNull(), "not_in_catalog")
        .when(F.col("path") == "", "missing_path")
        .when(F.col("stored").isNull(), "missing_file")
        .otherwise(shape)
    )
    out = rows.withColumn("skip_reason", reason)
    usable = F.when(F.col("skip_reason").isNull(), F.col("_record"))
    parts = fulltext(usable, limit)
    return out.select("report_date", "memory_item_id", "rank", "skip_reason", *[F.when(F.col("skip_reason").isNull(), c).alias(n) for n, c in parts.items()])


# --- source documents ------------------------------------------------------------
def structured_keys(items: DataFrame) -> DataFrame:
    """(id, place, value): keys to look a source up by, in order of preference."""
    own = F.array(F.col("id"), F.col("url"), F.col("content_hash"))
    raw = F.when(F.col("id").startswith("structured-"), F.array(F.regexp_replace("id", "^structured-", "raw-"))).otherwise(F.array().cast("array<string>"))
    keys = F.concat(F.transform("evidence_sources", lambda s: s["source_item_id"]), own, raw)
    return items.select("id", F.posexplode(keys).alias("place", "value")).where("value <> ''")


def source_of(items: DataFrame, sources: DataFrame) -> DataFrame:
    """Source item each structured item came from, by its first matching key.

    The two key tables are joined on hashed values and reduced to one id per item
    before any text column is touched.
    """
    first = item_keys(sources, ("id", "pos")).groupBy("value").agg(F.min(F.struct("pos", "id")).alias("s"))
    found = lookup(structured_keys(items), first, ["value"], "inner")
    return found.groupBy("id").agg(F.min(F.struct("place", F.col("s.id").alias("source_id"))).alias("m")).select(
        F.col("id").alias("item_id"), F.col("m.source_id").alias("source_item_id"), F.col("m.place").alias("key_place")
    )


def source_documents(items: DataFrame, sources: DataFrame) -> DataFrame:
    """Full source text next to each item, without truncation."""
    links = source_of(items, sources)
    wide = sources.select(F.col("id").alias("source_item_id"), "title", "source", "url", "published_at", "summary", "content", "content_hash")
    return lookup(links.select("item_id", "source_item_id"), wide, ["source_item_id"], "inner")


# --- writing ---------------------------------------------------------------------
LIGHT_METADATA = ("source_name", "source_family", "content_source", "fetched_via", "canonical_url", "full_content_url", "content_chars", "content_truncated")


def to_entries(items: DataFrame, sources: DataFrame | None = None, run_id: str | None = None, run_date: str | None = None) -> DataFrame:
    """History entries of structured items, with the light metadata whitelist."""
    if sources is not None:
        meta = source_of(items, sources).join(sources.select(F.col("id").alias("source_item_id"), F.col("metadata").alias("_source_meta")), "source_item_id", "left")
        items = items.drop("metadata").join(meta.select(F.col("item_id").alias("id"), "_source_meta"), "id", "left")
    else:
        items = items.withColumn("_source_meta", F.col("metadata") if "metadata" in items.columns else F.create_map().cast("map<string,string>"))
    kept = F.map_filter(F.coalesce("_source_meta", F.create_map().cast("map<string,string>")), lambda k, v: k.isin(*LIGHT_METADATA) & v.isNotNull())
    own = F.create_map(F.lit("run_id"), F.lit(run_id), F.lit("run_date"), F.lit(run_date), F.lit("source_type"), F.col("source_type"), F.lit("language"), F.col("language"))
    first_source = F.get(F.filter(F.transform("evidence_sources", lambda s: s["source_item_id"]), lambda s: s != ""), F.lit(0))
    raw_id = F.when(F.col("id").startswith("structured-"), F.regexp_replace("id", "^structured-", "raw-"))
    key = safe_record_id(F.col("id"))
    carried = [c for c in ("report_date", "pos") if c in items.columns]
    return items.select(
        *carried,
        key.alias("memory_item_id"), key.alias("id"), F.col("id").alias("validated_item_id"), F.coalesce(first_source, raw_id).alias("source_item_id"),
        "topic", topic_key(F.col("topic")).alias("topic_key"), "title", "source", "url", "published_at", "content_hash", "summary", "entities",
        "event_type", "importance_score", "importance_rationale", "risk_level", "risk_rationale", "opportunity_level", "opportunity_rationale",
        F.concat(F.lit("items/"), key, F.lit(".json")).alias("memory_item_path"),
        F.map_filter(F.map_concat(own, kept), lambda k, v: v.isNotNull()).alias("metadata"),
    )


#: Fields of the stored record: of an item as it was collected, and as it was validated.
SOURCE_FIELDS = ("id", "title", "source", "url", "published_at", "source_type", "language", "summary", "content", "metadata", "content_hash")
VALIDATED_FIELDS = (
    "id", "title", "source", "url", "published_at", "source_type", "language", "topic", "entities", "event_type", "summary", "key_points",
    "sentiment", "impact_scope", "importance_score", "importance_rationale", "risk_level", "risk_rationale", "opportunity_level",
    "opportunity_rationale", "evidence", "evidence_sources", "content_hash",
)


def _fields(names: tuple[str, ...]) -> Column:
    return F.struct(*[iso_time(F.col(n)).alias(n) if n == "published_at" else F.col(n) for n in names])


def records(
    items: DataFrame, sources: DataFrame, relevant: DataFrame | None = None, run_id: str | None = None, run_date: str | None = None,
    created_at: Column | None = None, artifact_paths: dict[str, str] | None = None,
) -> DataFrame:
    """Full stored record per item as a VARIANT, with the keys that are looked up by as columns of their own.

    A record has the item as validated, as cleaned and as relevant (null where it has none), the metadata of
    both sources apart and merged, that of the relevant one winning, and where the run's files lie.
    """
    links = source_of(items, sources).select(F.col("item_id").alias("id"), "source_item_id")
    wide = items.join(links, "id", "left")
    for name, rows in (("clean", sources), ("relevant", relevant)):
        if rows is None:
            wide = wide.withColumn(name, F.lit(None).cast(wide.schema["clean"].dataType))
            continue
        body = rows.select(F.col("id").alias("source_item_id"), _fields(SOURCE_FIELDS).alias(name))
        wide = lookup(wide, body, ["source_item_id"], "left")
    none = F.create_map().cast("map<string,string>")
    meta = {name: F.coalesce(F.col(f"{name}.metadata"), none) for name in ("clean", "relevant")}
    merged = F.map_concat(F.map_filter(meta["clean"], lambda k, v: ~F.map_contains_key(meta["relevant"], k)), meta["relevant"])
    paths = F.create_map(*[F.lit(x) for pair in sorted((artifact_paths or {}).items()) for x in pair]).cast("map<string,string>")
    key = safe_record_id(F.col("id"))
    made = iso_time(created_at) if created_at is not None else F.lit(None).cast("string")
    record = F.struct(
        F.lit(1).alias("schema_version"), key.alias("memory_item_id"), F.lit(run_id).cast("string").alias("run_id"),
        F.lit(run_date).cast("string").alias("run_date"), made.alias("created_at"), "topic", _fields(VALIDATED_FIELDS).alias("validated"),
        "clean", "relevant", merged.alias("metadata"), F.struct(*[m.alias(n) for n, m in meta.items()]).alias("source_metadata"),
        paths.alias("source_artifact_paths"),
    )
    return wide.select(
        key.alias("memory_item_id"), topic_key(F.col("topic")).alias("topic_key"), F.lit(run_id).cast("string").alias("run_id"),
        F.lit(run_date).cast("string").alias("run_date"), F.to_variant_object(record).alias("record"),
    )


def to_payloads(items: DataFrame, sources: DataFrame, relevant: DataFrame | None = None, **run) -> DataFrame:
    """``records`` as JSON text."""
    return records(items, sources, relevant, **run).select("memory_item_id", F.to_json("record").alias("payload"))


def record_metadata(stored: DataFrame) -> DataFrame:
    """``(memory_item_id, key, value)``: the merged metadata of each stored record, one row per entry."""
    rows = stored.select("memory_item_id", F.variant_get("record", "$.metadata", "variant").alias("metadata"))
    each = stored.sparkSession.tvf.variant_explode(F.col("metadata").outer())
    return rows.lateralJoin(each).select("memory_item_id", "key", F.try_variant_get("value", "$", "string").alias("value"))


def claims(entries: DataFrame, *carry: str) -> DataFrame:
    """``(*carry, value)``: each strong key of each entry, within its topic."""
    keys = F.array_distinct(F.array(*[F.col(c).cast("string") for c in ENTRY_KEYS]))
    rows = entries.select(*carry, F.explode(keys).alias("_v"), "topic_key").where("_v <> ''")
    return rows.select(*carry, F.concat_ws("\x1f", "topic_key", "_v").alias("value"))


def appendable(entries: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Entries to add: no key shared, within the topic, with history or a kept earlier entry."""
    mine = claims(entries, "pos")
    if history is not None:
        clash = lookup(mine, claims(history).distinct(), ["value"], "left_semi").select("pos").distinct()
        mine = mine.join(clash, "pos", "left_anti")
    return entries.join(first_fit(mine), "pos", "left_semi")


def appendable_by_index(entries: DataFrame, index: KeyIndex, batch_id: int | str) -> DataFrame:
    """As ``appendable``, against an index of history's keys instead of history; a batch does not meet its own keys."""
    mine = durable(claims(entries, "pos"))
    clash = index.known(mine, but_of=batch_id).select("pos").distinct()
    return entries.join(first_fit(mine.join(clash, "pos", "left_anti")), "pos", "left_semi")


def history_before(history: DataFrame, started_at: Column) -> DataFrame:
    """Snapshot-consistent read: only rows added before the (parent) run started."""
    return history.where(F.col("added_at") < started_at)


def may_write(run_mode: str, report_exists: bool) -> tuple[bool, str | None]:
    """Only a fresh run with a finished report appends; otherwise the reason it does not."""
    if run_mode != "fresh":
        return False, "non_fresh_run"
    return (True, None) if report_exists else (False, "daily_report_missing")


# --- reporting -------------------------------------------------------------------
def memory_report(**stages: DataFrame) -> DataFrame:
    """Stage metrics as one long table ``(report_date, stage, metric, value)``.

    Each keyword is a stage name with a frame of ``report_date`` and numeric columns.
    """
    out = None
    for stage, df in stages.items():
        metrics = [c for c in df.columns if c != "report_date"]
        long = df.select("report_date", *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(["report_date"], metrics, "metric", "value")
        long = long.select("report_date", F.lit(stage).alias("stage"), "metric", "value")
        out = long if out is None else out.unionByName(long)
    return out


def unadopted(read: DataFrame, adopted: DataFrame) -> DataFrame:
    """Full texts that were read but not used as final historical evidence."""
    return read.select("report_date", "memory_item_id").distinct().join(
        adopted.select("report_date", "memory_item_id").distinct(), ["report_date", "memory_item_id"], "left_anti"
    ).withColumn("reason", F.lit("read_but_not_used_as_final_historical_evidence"))
