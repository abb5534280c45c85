"""History matching, retrieval, budgets, similarity and appends over documents."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from dayline import lexicon
from dayline.operators import memory, similarity
from dayline.operators.key_index import KeyIndex
from dayline.plans import inputs
from dayline.plans.inputs import RETRIEVED_SQL, STRUCTURED_SQL, sql_list
from dayline.session import checkpoint_folder
from dayline.sources import tables

DAY = lambda c="report_date": F.date_format(c, "yyyy-MM-dd").alias("report_date")
DAY_SQL = "strftime(report_date, '%Y-%m-%d') AS report_date"
CUT = "2024-01-16"  # the run date that splits what is known from what is new


retrieved = inputs.retrieved


# --- index -------------------------------------------------------------------------
def index_documents(spark, sf):
    """History written as index documents of fifty items, every other one in the legacy form."""
    h = inputs.history(spark, sf)
    entry = F.struct("memory_item_id", "id", "validated_item_id", "source_item_id", "title", "source", "url", "content_hash", "event_type", "importance_score", "risk_level", "opportunity_level")
    alias = F.when(F.col("pos") % 2 == 0, F.upper("topic")).otherwise(F.translate(F.lower("topic"), " ", "_"))
    lists = h.groupBy(F.floor(F.col("pos") / 50).alias("doc"), alias.alias("name")).agg(F.collect_list(entry).alias("entries"))
    topics = lists.groupBy("doc").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("name", "entries")))).alias("topics"))
    return topics.select("doc", F.when(F.col("doc") % 2 == 0, F.concat(F.lit('{"schema_version":2,"topics":'), "topics", F.lit("}"))).otherwise(F.col("topics")).alias("body"))


def read_index(spark, sf):
    return memory.read_index(index_documents(spark, sf)).select("topic_key", "topic", "id", "url", "importance_score")


def strong_keys(spark, sf):
    return memory.entry_keys(inputs.history(spark, sf)).select("memory_item_id", "field", "value").distinct()


_ENTRY_KEYS = """entry_keys AS (SELECT DISTINCT id AS memory_item_id, unnest(['id', 'url', 'content_hash', 'memory_item_id', 'validated_item_id', 'id']) AS field, unnest([id, url, content_hash, id, id, raw_id]) AS value FROM {src})"""


def known_history(spark, sf):
    return inputs.history(spark, sf).where(F.col("published_at") < CUT)


def _new(spark, sf):
    return inputs.clean(spark, sf).where(F.col("report_date") >= CUT)


_SPLIT = f"{STRUCTURED_SQL}, known AS (SELECT * FROM structured WHERE published_at < TIMESTAMP '{CUT}'), fresh_items AS (SELECT * FROM clean WHERE report_date >= DATE '{CUT}'), {_ENTRY_KEYS.format(src='known')}, item_keys AS (SELECT id, unnest(['id', 'url', 'content_hash']) AS field, unnest([id, url, content_hash]) AS value FROM fresh_items)"


def strong_matches(spark, sf):
    return memory.strong_matches(_new(spark, sf), known_history(spark, sf))


def matched_entries(spark, sf):
    return memory.matched_entries(_new(spark, sf), known_history(spark, sf))


def drop_known(spark, sf):
    return memory.drop_known(_new(spark, sf), known_history(spark, sf)).select("pos", "id")


# --- retrieval ---------------------------------------------------------------------
def retrieve(spark, sf):
    return inputs.retrieved_history(spark, sf).select(DAY(), "topic_key", "memory_item_id", "rank")


def exclude(spark, sf):
    """History copied to the next day's report date, minus entries that share a key with that day."""
    h = inputs.history(spark, sf).withColumn("report_date", F.date_add(F.to_date("published_at"), 1))
    return memory.exclude_current(h, inputs.structured(spark, sf)).select(DAY(), "memory_item_id")


_EXCLUDE = f"""WITH {STRUCTURED_SQL}, h AS (SELECT * REPLACE ((published_at::DATE + 1)::DATE AS report_date) FROM structured),
k AS (SELECT DISTINCT report_date, unnest([id, url, content_hash]) AS k FROM structured)
SELECT {DAY_SQL}, id AS memory_item_id FROM h WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.report_date = h.report_date AND k.k IN (h.id, h.raw_id, h.url, h.content_hash))"""


def recent(spark, sf):
    """Newest ten history entries per topic, whatever the date."""
    from dayline.operators.groups import top_per_group

    return top_per_group(inputs.history(spark, sf), ["topic_key"], [F.col("published_at").desc(), F.col("pos")], 10).select("topic_key", "memory_item_id", "rank")


def topics(spark, sf):
    return memory.topics_in_order(inputs.structured(spark, sf)).select(DAY(), "topic_key", "topic", "first_pos")


# --- budgets -----------------------------------------------------------------------
def context(spark, sf):
    items = inputs.structured(spark, sf)
    return memory.metadata_context(retrieved(spark, sf), memory.topics_in_order(items), 6000).select(DAY(), "topic_key", "rank", "memory_item_id", "used_chars")


_CONTEXT = f"""WITH {RETRIEVED_SQL},
tp AS (SELECT report_date, topic, min(pos) AS first_pos FROM structured GROUP BY ALL),
l AS (SELECT r.*, first_pos, first_pos = min(first_pos) OVER (PARTITION BY r.report_date) AS lead,
  length(rank || '. [' || strftime(published_at, '%Y-%m-%dT%H:%M:%S+00:00') || '] ' || title || ' (' || source || ') importance=' || importance_score || ': ' || summary) AS n,
  length('Historical context for topic: ' || topic_key) AS h FROM retrieved r JOIN tp ON tp.report_date = r.report_date AND tp.topic = r.topic),
c AS (SELECT *, sum(CASE WHEN rank = 1 THEN CASE WHEN lead THEN 0 ELSE 2 END + h + 1 + n ELSE 1 + n END) OVER (PARTITION BY report_date ORDER BY first_pos, rank ROWS UNBOUNDED PRECEDING) AS used_chars FROM l)
SELECT {DAY_SQL}, topic_key, rank, memory_item_id, used_chars FROM c WHERE used_chars <= 6000"""


def catalog(spark, sf):
    return memory.catalog(retrieved(spark, sf)).select(DAY(), "memory_item_id", "topic_key")


def selector(spark, sf):
    return memory.selector_catalog(memory.catalog(retrieved(spark, sf)), 8000).select(DAY(), "memory_item_id", "json_chars", "used_chars")


_SELECTOR = f"""WITH {RETRIEVED_SQL},
j AS (SELECT *, length(to_json({{'memory_item_id': id, 'topic': topic, 'title': title, 'source': source, 'url': url, 'published_at': strftime(published_at, '%Y-%m-%dT%H:%M:%S+00:00'), 'summary': summary,
  'entities': entities, 'event_type': event_type, 'importance_score': importance_score, 'risk_level': risk_level, 'opportunity_level': opportunity_level}})::VARCHAR) + 23 + greatest(len(entities) - 1, 0) AS json_chars FROM retrieved),
c AS (SELECT *, sum(json_chars + 2) OVER (PARTITION BY report_date ORDER BY topic_key, rank ROWS UNBOUNDED PRECEDING) AS used_chars FROM j)
SELECT {DAY_SQL}, id AS memory_item_id, json_chars, used_chars FROM c WHERE used_chars <= 8000"""


# --- similarity --------------------------------------------------------------------
def pairs(spark, sf):
    return similarity.candidate_pairs(inputs.structured(spark, sf), retrieved(spark, sf))


def pair_keys(spark, sf):
    return pairs(spark, sf).select(DAY(), "item_id", "memory_item_id")


def scored(spark, sf):
    return inputs.stage(spark, sf, "scored", score)


def score(spark, sf):
    return similarity.score_pairs(pairs(spark, sf))


def relationships(spark, sf):
    matches = similarity.best_matches(scored(spark, sf))
    return similarity.item_relationships(inputs.structured(spark, sf), matches)


_TOK = f"list_filter(list_distinct(regexp_extract_all(lower(%s), '[a-z0-9]+|[㐀-鿿]')), lambda t: NOT list_contains({sql_list(lexicon.STOP_WORDS)}, t))"
_SPEC = "list_distinct(regexp_extract_all(lower(%s), '(?:gpt|claude|gemini|llama|mistral|opus|sonnet|haiku|codex)?[0-9]+(?:\\.[0-9]+)*[a-z]*|\\$?[0-9]+(?:\\.[0-9]+)?(?:b|m|bn|million|billion|%%)?'))"
_JAC = "CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0::DOUBLE ELSE len(list_intersect({a}, {b})) / (len({a}) + len({b}) - len(list_intersect({a}, {b})))::DOUBLE END"
_ENT = "list_filter(list_distinct(list_transform(%s, lambda e: lower(e))), lambda e: e NOT IN ('ai industry', 'artificial intelligence', 'ai', ''))"
SCORED_SQL = f"""{RETRIEVED_SQL},
toks AS (SELECT id, {_TOK % 'title'} AS t, {_TOK % 'summary'} AS s, {_TOK % "(title || ' ' || summary)"} AS c, {_SPEC % "(title || ' ' || summary)"} AS spec, {_ENT % 'entities'} AS e, lower(title || ' ' || summary) AS body FROM structured),
pr AS (SELECT i.report_date, i.id AS item_id, i.pos, i.title AS item_title, i.topic, r.id AS memory_item_id, r.rank AS history_rank, i.event_type = r.event_type AS event_match FROM structured i JOIN retrieved r ON r.report_date = i.report_date AND r.topic = i.topic),
sim AS (SELECT pr.*, {_JAC.format(a='a.t', b='b.t')} AS ts, {_JAC.format(a='a.s', b='b.s')} AS ss, {_JAC.format(a='a.c', b='b.c')} AS cs,
  CASE WHEN len(a.e) = 0 OR len(b.e) = 0 THEN 0::DOUBLE ELSE len(list_intersect(a.e, b.e)) / least(len(a.e), len(b.e))::DOUBLE END AS ov,
  len(list_filter(a.spec, lambda x: NOT list_contains(b.spec, x))) > 0 AS fresh_token, len(list_filter({sql_list(lexicon.NOVELTY_WORDS)}, lambda w: contains(a.body, w))) > 0 AS marker
  FROM pr JOIN toks a ON a.id = item_id JOIN toks b ON b.id = memory_item_id),
nov AS (SELECT *, fresh_token OR (greatest(ts, ss, cs) < 0.72 AND marker) AS novelty FROM sim),
conf AS (SELECT *, least(1::DOUBLE, 0.22::DOUBLE + least(ov, 1) * 0.26::DOUBLE + CASE WHEN event_match THEN 0.16::DOUBLE ELSE 0 END + least(greatest(ts, ss, cs), 1) * 0.31::DOUBLE + CASE WHEN novelty THEN 0.05::DOUBLE ELSE 0 END) AS conf,
  ts >= 0.72 OR ss >= 0.72 OR cs >= 0.78 AS high, ts >= 0.42 OR ss >= 0.42 OR cs >= 0.50 AS medium FROM nov),
scored AS (SELECT *, CASE WHEN ov >= 0.5 AND event_match AND high AND NOT novelty THEN 'likely_duplicate' WHEN ov > 0 AND (event_match OR medium) AND (novelty OR conf >= 0.55) THEN 'continuing'
  WHEN (ov > 0 OR event_match OR medium) AND conf >= 0.32 THEN 'related_context' ELSE 'new' END AS relationship, round(conf, 3) AS confidence FROM conf),
matched AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY report_date, item_id ORDER BY CASE relationship WHEN 'likely_duplicate' THEN 3 WHEN 'continuing' THEN 2 ELSE 1 END DESC, confidence DESC, history_rank) AS match_rank
  FROM scored WHERE relationship <> 'new') WHERE match_rank <= 3),
rel AS (SELECT s.report_date, s.id AS item_id, s.topic, s.pos, coalesce(min(m.relationship) FILTER (match_rank = 1), 'new') AS relationship, coalesce(min(m.confidence) FILTER (match_rank = 1), 0) AS confidence,
  coalesce(list(m.memory_item_id ORDER BY match_rank) FILTER (m.memory_item_id IS NOT NULL), []) AS ids FROM structured s LEFT JOIN matched m ON m.item_id = s.id AND m.report_date = s.report_date GROUP BY s.report_date, s.id, s.topic, s.pos)"""


def scores(spark, sf):
    return score(spark, sf).select(DAY(), "item_id", "memory_item_id", "relationship", "confidence", "entity_overlap", "title_similarity", "summary_similarity", "combined_similarity", "event_match", "novelty_signal", F.array_join("matched_signals", ",").alias("signals"))


_SCORES = f"""WITH {SCORED_SQL} SELECT {DAY_SQL}, item_id, memory_item_id, relationship, confidence, round(ov, 3) AS entity_overlap, round(ts, 3) AS title_similarity, round(ss, 3) AS summary_similarity, round(cs, 3) AS combined_similarity,
 event_match, novelty AS novelty_signal, array_to_string(list_filter(['same_topic', CASE WHEN ov > 0 THEN 'entity_overlap' END, CASE WHEN event_match THEN 'event_type_match' END,
 CASE WHEN ts >= 0.72 THEN 'high_title_similarity' WHEN ts >= 0.42 THEN 'medium_title_similarity' END, CASE WHEN ss >= 0.72 THEN 'high_summary_similarity' WHEN ss >= 0.42 THEN 'medium_summary_similarity' END,
 CASE WHEN cs >= 0.50 THEN 'combined_text_similarity' END, CASE WHEN novelty THEN 'novelty_signal' END], lambda x: x IS NOT NULL), ',') AS signals FROM scored"""


def best(spark, sf):
    return similarity.best_matches(scored(spark, sf)).select(DAY(), "item_id", "memory_item_id", "match_rank", "relationship", "confidence")


def item_rows(spark, sf):
    return relationships(spark, sf).select(DAY(), "item_id", "topic", "relationship", "confidence", F.array_join("matched_memory_item_ids", ",").alias("ids"))


def counts(spark, sf):
    return similarity.relationship_counts(relationships(spark, sf), pairs(spark, sf)).withColumn("report_date", DAY())


_COUNTS = f"""WITH {SCORED_SQL}, c AS (SELECT report_date, count(*) AS candidate_count FROM pr GROUP BY 1)
SELECT strftime(rel.report_date, '%Y-%m-%d') AS report_date, count(*) AS item_count, count_if(relationship <> 'new') AS matched_item_count, sum(len(ids)) AS match_count, count_if(relationship = 'new') AS "new", count_if(relationship = 'related_context') AS related_context,
 count_if(relationship = 'continuing') AS continuing, count_if(relationship = 'likely_duplicate') AS likely_duplicate, coalesce(min(candidate_count), 0) AS candidate_count FROM rel LEFT JOIN c ON c.report_date = rel.report_date GROUP BY rel.report_date"""


# --- full texts --------------------------------------------------------------------
def heuristic(spark, sf):
    return memory.heuristic_selection(memory.catalog(retrieved(spark, sf)), relationships(spark, sf)).select(DAY(), "memory_item_id", "tier", "rank")


HEURISTIC_SQL = f"""{SCORED_SQL},
m1 AS (SELECT report_date, unnest(ids) AS id, unnest(range(len(ids))) AS i, relationship, confidence, pos FROM rel),
places AS (SELECT report_date, id, 1 AS tier, -CASE relationship WHEN 'likely_duplicate' THEN 4 WHEN 'continuing' THEN 3 WHEN 'related_context' THEN 2 ELSE 1 END::DOUBLE AS a, -confidence::DOUBLE AS b, pos AS c, i AS d FROM m1
  UNION ALL SELECT report_date, id, 2, -importance_score::DOUBLE, -epoch_us(published_at)::DOUBLE, 0, rank FROM retrieved),
firsts AS (SELECT *, row_number() OVER (PARTITION BY report_date, id ORDER BY tier, a, b, c, d) AS n FROM places),
chosen AS (SELECT *, row_number() OVER (PARTITION BY report_date ORDER BY tier, a, b, c, d, id) AS pick FROM firsts WHERE n = 1)"""


def requested(spark, sf):
    r = memory.catalog(retrieved(spark, sf)).select("report_date", "memory_item_id", "pos")
    current = inputs.structured(spark, sf).select("report_date", F.col("id").alias("memory_item_id"), "pos")
    return r.unionByName(current)


def selection(spark, sf):
    return memory.validate_selection(requested(spark, sf), memory.catalog(retrieved(spark, sf))).select(DAY(), "memory_item_id", "outcome")


SELECTION_SQL = f"""{RETRIEVED_SQL},
req AS (SELECT report_date, id, min(pos) AS pos FROM (SELECT report_date, id, pos FROM retrieved UNION ALL SELECT report_date, id, pos FROM structured) GROUP BY ALL),
lab AS (SELECT req.*, r.id IS NOT NULL AS known FROM req LEFT JOIN (SELECT DISTINCT report_date, id FROM retrieved) r ON r.report_date = req.report_date AND r.id = req.id),
sel AS (SELECT *, CASE WHEN NOT known THEN 'invalid' WHEN row_number() OVER (PARTITION BY report_date, known ORDER BY pos) <= 5 THEN 'selected' ELSE 'overflow' END AS outcome,
  row_number() OVER (PARTITION BY report_date, known ORDER BY pos) AS place FROM lab)"""


def _stored(spark, sf):
    """Stored records; some are damaged and some are missing, as on a real disk."""
    p = memory.to_payloads(inputs.structured(spark, sf), inputs.clean(spark, sf))
    n = F.substring_index("memory_item_id", "-", -1).cast("bigint")
    return p.where(n % 7 != 0).withColumn("payload", F.when(n % 5 == 0, F.lit("{broken")).when(n % 5 == 1, F.lit("[1]")).otherwise(F.col("payload")))


def available(spark, sf):
    return memory.available(memory.catalog(retrieved(spark, sf)), _stored(spark, sf)).select(DAY(), "memory_item_id")


def read_fulltext(spark, sf):
    candidates = memory.catalog(retrieved(spark, sf)).withColumn("memory_item_path", F.when(F.col("pos") % 11 == 0, "").otherwise(F.col("memory_item_path")))
    chosen = memory.validate_selection(requested(spark, sf), candidates, 40).where("outcome <> 'overflow'").withColumn("rank", F.col("pos"))
    return memory.read_fulltext(chosen, candidates, _stored(spark, sf), 2000).select(DAY(), "memory_item_id", "skip_reason", "content_source", "content_original_chars", "content_chars", "truncated", F.md5("content_excerpt").alias("excerpt_md5"))


_READ = f"""WITH {SELECTION_SQL.replace('<= 5', '<= 40')},
t AS (SELECT sel.report_date, sel.id, CASE WHEN outcome = 'invalid' THEN 'not_in_catalog' WHEN sel.pos % 11 = 0 THEN 'missing_path' WHEN sel.pos % 7 = 0 THEN 'missing_file' WHEN sel.pos % 5 = 0 THEN 'invalid_json' WHEN sel.pos % 5 = 1 THEN 'invalid_shape' END AS skip_reason,
  CASE WHEN s.content <> '' THEN s.content WHEN s.summary <> '' THEN s.summary ELSE s.title END AS body, CASE WHEN s.content <> '' THEN 'clean.content' WHEN s.summary <> '' THEN 'validated.summary' ELSE 'validated.title' END AS src
  FROM sel JOIN structured s ON s.id = sel.id WHERE outcome <> 'overflow'),
x AS (SELECT *, CASE WHEN length(body) > 2000 THEN body[:1988] || chr(10) || '[truncated]' ELSE body END AS ex, skip_reason IS NULL AS ok FROM t)
SELECT {DAY_SQL}, id AS memory_item_id, skip_reason, CASE WHEN ok THEN src END AS content_source, CASE WHEN ok THEN length(body) END AS content_original_chars, CASE WHEN ok THEN length(ex) END AS content_chars, CASE WHEN ok THEN length(body) > 2000 END AS truncated, CASE WHEN ok THEN md5(ex) END AS excerpt_md5 FROM x"""


def _relevant(clean_items):
    """A third of the cleaned items as relevant ones: half with a text of their own, all with more metadata."""
    rows = clean_items.where(F.col("pos") % 3 == 0)
    content = F.when(F.col("pos") % 6 == 0, F.concat(F.lit("kept "), "content")).otherwise("  ")
    more = F.create_map(F.lit("fetched_via"), F.lit("relevance"), F.lit("score"), F.col("pos").cast("string"))
    kept = F.map_filter("metadata", lambda k, v: k != "fetched_via")
    return rows.withColumns({"content": content, "metadata": F.map_concat(kept, more)})


def _records(spark, sf):
    """Records whose texts end at each place in turn: relevant, clean, summary, title."""
    cleaned = inputs.clean(spark, sf)
    n = F.col("pos")
    items = inputs.structured(spark, sf).withColumn("summary", F.when(n % 8 == 1, "").otherwise(F.col("summary")))
    sources = cleaned.withColumn("content", F.when(n % 4 == 1, "").otherwise(F.col("content")))
    return memory.records(items, sources, _relevant(cleaned), run_id="run-1", run_date="2024-01-31", artifact_paths={"clean": "b.json", "audit": "a.json"})


def fulltext(spark, sf):
    p = _records(spark, sf)
    parts = memory.fulltext(F.col("record"), 1500)
    return p.select("memory_item_id", *[(F.md5(c) if n == "content_excerpt" else c).alias(n) for n, c in parts.items()])


_FULLTEXT = f"""WITH {STRUCTURED_SQL},
t AS (SELECT id, CASE WHEN pos % 6 = 0 THEN 'relevant.content' WHEN pos % 4 <> 1 AND content <> '' THEN 'clean.content' WHEN pos % 8 <> 1 AND summary <> '' THEN 'validated.summary' ELSE 'validated.title' END AS src,
  CASE WHEN pos % 6 = 0 THEN trim('kept ' || content) WHEN pos % 4 <> 1 AND content <> '' THEN content WHEN pos % 8 <> 1 AND summary <> '' THEN summary ELSE title END AS body FROM structured)
SELECT id AS memory_item_id, src AS content_source, md5(CASE WHEN length(body) > 1500 THEN body[:1488] || chr(10) || '[truncated]' ELSE body END) AS content_excerpt,
 length(body) AS content_original_chars, least(length(body), 1500) AS content_chars, length(body) > 1500 AS truncated FROM t"""


def full_records(spark, sf):
    """Every field of the stored records, read back from them."""
    of = lambda path, kind="string": F.variant_get("record", path, kind)
    listed = lambda path: F.array_join(of(path, "array<string>"), "|")
    fields = {
        "run": F.concat_ws("/", of("$.run_id"), of("$.run_date"), of("$.schema_version")), "paths": F.concat_ws("/", of("$.source_artifact_paths.audit"), of("$.source_artifact_paths.clean")),
        "topic": of("$.topic"), "v_id": of("$.validated.id"), "v_time": of("$.validated.published_at"), "v_kind": F.concat_ws("/", of("$.validated.source_type"), of("$.validated.language"), of("$.validated.event_type"), of("$.validated.sentiment"), of("$.validated.impact_scope")),
        "v_levels": F.concat_ws("/", of("$.validated.importance_score"), of("$.validated.risk_level"), of("$.validated.opportunity_level")), "v_entities": listed("$.validated.entities"), "v_evidence": F.md5(listed("$.validated.evidence")),
        "v_why": F.md5(F.concat_ws("|", of("$.validated.importance_rationale"), of("$.validated.risk_rationale"), of("$.validated.opportunity_rationale"))), "v_quote": F.md5(of("$.validated.evidence_sources[0].evidence_quote")), "v_hash": of("$.validated.content_hash"),
        "clean_id": of("$.clean.id"), "clean_time": of("$.clean.published_at"), "clean_md5": F.md5(of("$.clean.content")), "relevant_id": of("$.relevant.id"), "relevant_md5": F.md5(of("$.relevant.content")),
        "via": F.concat_ws("/", of("$.metadata.fetched_via"), of("$.source_metadata.clean.fetched_via"), of("$.source_metadata.relevant.fetched_via"), of("$.metadata.score")),
    }
    return _records(spark, sf).select("memory_item_id", "topic_key", *[c.alias(n) for n, c in fields.items()])


_ISO = "strftime(published_at, '%Y-%m-%dT%H:%M:%S+00:00')"
_RECORDS = f"""WITH {STRUCTURED_SQL} SELECT id AS memory_item_id, lower(topic) AS topic_key, 'run-1/2024-01-31/1' AS run, 'a.json/b.json' AS paths, topic, id AS v_id, {_ISO} AS v_time,
 source_type || '/' || language || '/' || event_type || '/' || sentiment || '/' || impact_scope AS v_kind, importance_score || '/' || risk_level || '/' || opportunity_level AS v_levels,
 array_to_string(entities, '|') AS v_entities, md5(evidence) AS v_evidence, md5(importance_rationale || '|' || risk_rationale || '|' || opportunity_rationale) AS v_why, md5(evidence) AS v_quote, content_hash AS v_hash,
 raw_id AS clean_id, {_ISO} AS clean_time, md5(CASE WHEN pos % 4 = 1 THEN '' ELSE content END) AS clean_md5, CASE WHEN pos % 3 = 0 THEN raw_id END AS relevant_id,
 CASE WHEN pos % 6 = 0 THEN md5('kept ' || content) WHEN pos % 3 = 0 THEN md5('  ') END AS relevant_md5,
 CASE WHEN pos % 3 = 0 THEN 'relevance/' || fetched_via || '/relevance/' || pos ELSE fetched_via || '/' || fetched_via END AS via FROM structured"""


def stored_metadata(spark, sf):
    rows = memory.record_metadata(_records(spark, sf))
    return rows.where(F.col("key").isin("fetched_via", "score", "source_family", "content_source"))


_STORED_METADATA = f"""WITH {STRUCTURED_SQL} SELECT id AS memory_item_id, unnest(['fetched_via', 'source_family', 'content_source']) AS key, unnest([CASE WHEN pos % 3 = 0 THEN 'relevance' ELSE fetched_via END, source_family, content_source]) AS value FROM structured
UNION ALL SELECT id, 'score', pos::VARCHAR FROM structured WHERE pos % 3 = 0"""


# --- sources and writes ------------------------------------------------------------
def source_links(spark, sf):
    return memory.source_of(inputs.structured(spark, sf), inputs.clean(spark, sf)).select("item_id", "source_item_id", "key_place")


def source_docs(spark, sf):
    return memory.source_documents(inputs.structured(spark, sf), inputs.clean(spark, sf)).select("item_id", "source_item_id", "source", "url", F.md5("content").alias("content_md5"))


def append(spark, sf):
    entries = memory.to_entries(inputs.structured(spark, sf))
    return memory.appendable(entries).select("pos", "topic_key", "memory_item_id")


def _append_sql(known: str = "") -> str:
    return f"""WITH RECURSIVE {STRUCTURED_SQL},
ent AS (SELECT pos, id, lower(topic) AS topic_key, list_transform(list_distinct([id, raw_id, url, content_hash]), lambda k: lower(topic) || '|' || k) AS keys FROM structured {known}),
ordered AS (SELECT *, row_number() OVER (PARTITION BY topic_key ORDER BY pos) AS n FROM ent),
walk(topic_key, n, pos, id, kept, bag) AS (SELECT DISTINCT topic_key, 0::BIGINT, -1::BIGINT, '', false, []::VARCHAR[] FROM ent
  UNION ALL SELECT o.topic_key, o.n, o.pos, o.id, NOT list_has_any(w.bag, o.keys), CASE WHEN list_has_any(w.bag, o.keys) THEN w.bag ELSE list_concat(w.bag, o.keys) END FROM walk w JOIN ordered o ON o.topic_key = w.topic_key AND o.n = w.n + 1)
SELECT pos, topic_key, id AS memory_item_id FROM walk WHERE kept"""


def append_to_history(spark, sf):
    """Guarded write: entries of the new dates that history does not know, appended and read back."""
    ok, reason = memory.may_write("fresh", True)
    assert ok, reason
    entries = memory.to_entries(inputs.structured(spark, sf).where(F.col("report_date") >= CUT))
    path = f"{checkpoint_folder(spark)}/history-{uuid.uuid4().hex}"
    tables.append_history(memory.appendable(entries, known_history(spark, sf)).select("pos", "topic_key", "memory_item_id"), path, "run-1")
    return spark.read.parquet(path).select("pos", "topic_key", "memory_item_id")


def append_by_index(spark, sf):
    """The same entries, with the keys of history looked up in their index."""
    entries = memory.to_entries(inputs.structured(spark, sf).where(F.col("report_date") >= CUT))
    index = KeyIndex(spark, f"{checkpoint_folder(spark)}/keys-{uuid.uuid4().hex}", buckets=16)
    index.add(memory.claims(known_history(spark, sf)), "history")
    return memory.appendable_by_index(entries, index, "run-1").select("pos", "topic_key", "memory_item_id")


APPEND_NEW_SQL = _append_sql(
    f"s WHERE report_date >= DATE '{CUT}' AND NOT EXISTS (SELECT 1 FROM structured k WHERE k.published_at < TIMESTAMP '{CUT}' AND k.topic = s.topic AND list_has_any([k.id, k.raw_id, k.url, k.content_hash], [s.id, s.raw_id, s.url, s.content_hash]))"
)


def entries(spark, sf):
    e = memory.to_entries(inputs.structured(spark, sf), inputs.clean(spark, sf), "run-1", "2024-01-31")
    return e.select("memory_item_id", "validated_item_id", "source_item_id", "topic_key", "memory_item_path", F.array_join(F.transform(F.sort_array(F.map_entries("metadata")), lambda kv: F.concat_ws("=", kv["key"], kv["value"])), ",").alias("metadata"))


_ENTRIES = f"""WITH {STRUCTURED_SQL} SELECT id AS memory_item_id, id AS validated_item_id, raw_id AS source_item_id, lower(topic) AS topic_key, 'items/' || id || '.json' AS memory_item_path,
 'content_source=' || content_source || ',fetched_via=' || fetched_via || ',language=' || language || ',run_date=2024-01-31,run_id=run-1,source_family=' || source_family || ',source_type=' || source_type AS metadata FROM structured"""


def snapshot_read(spark, sf):
    h = inputs.history(spark, sf).withColumn("added_at", F.col("published_at"))
    return memory.history_before(h, F.lit(CUT).cast("timestamp")).select("memory_item_id", "topic_key")


def stage_report(spark, sf):
    """What each step did with history on each date: deduplicate, retrieve, compare, select, adopt, write."""
    items = inputs.structured(spark, sf)
    got = retrieved(spark, sf)
    counted = lambda df, name: df.groupBy("report_date").agg(F.count(F.lit(1)).alias(name))
    retrieval = got.groupBy("report_date").agg(F.count(F.lit(1)).alias("retrieved_count"), F.count_distinct("topic_key").alias("topic_count"))
    soft = similarity.relationship_counts(relationships(spark, sf)).select("report_date", "matched_item_count", "match_count")
    outcome = lambda name: F.count_if(F.col("outcome") == name).alias(f"{name}_count")
    chosen = memory.validate_selection(requested(spark, sf), memory.catalog(got)).groupBy("report_date").agg(
        F.count(F.lit(1)).alias("requested_count"), outcome("selected"), outcome("invalid"), outcome("overflow")
    )
    adopted = counted(similarity.best_matches(scored(spark, sf), 1), "adopted_count")
    written = counted(memory.appendable(memory.to_entries(items)), "written_count")
    return memory.memory_report(
        strong_dedupe=counted(items, "input_count"), context_retrieval=retrieval, soft_similarity=soft, fulltext_selection=chosen, adoption=adopted, write=written
    ).withColumn("report_date", DAY())


_STAGES = f"""WITH {SCORED_SQL}, {SELECTION_SQL[len(RETRIEVED_SQL) + 2:]},
written AS (SELECT s.report_date, count(*) AS n FROM ({_append_sql()}) w JOIN structured s ON s.pos = w.pos GROUP BY s.report_date),
so AS MATERIALIZED (SELECT report_date, outcome FROM sel)
SELECT {DAY_SQL}, 'strong_dedupe' AS stage, 'input_count' AS metric, count(*)::DOUBLE AS value FROM structured GROUP BY structured.report_date
UNION ALL SELECT {DAY_SQL}, 'context_retrieval', 'retrieved_count', count(*) FROM retrieved GROUP BY retrieved.report_date
UNION ALL SELECT {DAY_SQL}, 'context_retrieval', 'topic_count', count(DISTINCT topic_key) FROM retrieved GROUP BY retrieved.report_date
UNION ALL SELECT {DAY_SQL}, 'soft_similarity', 'matched_item_count', count_if(relationship <> 'new') FROM rel GROUP BY rel.report_date
UNION ALL SELECT {DAY_SQL}, 'soft_similarity', 'match_count', sum(len(ids)) FROM rel GROUP BY rel.report_date
UNION ALL SELECT {DAY_SQL}, 'fulltext_selection', 'requested_count', count(*) FROM so GROUP BY so.report_date
UNION ALL SELECT {DAY_SQL}, 'fulltext_selection', 'selected_count', count_if(outcome = 'selected') FROM so GROUP BY so.report_date
UNION ALL SELECT {DAY_SQL}, 'fulltext_selection', 'invalid_count', count_if(outcome = 'invalid') FROM so GROUP BY so.report_date
UNION ALL SELECT {DAY_SQL}, 'fulltext_selection', 'overflow_count', count_if(outcome = 'overflow') FROM so GROUP BY so.report_date
UNION ALL SELECT {DAY_SQL}, 'adoption', 'adopted_count', count(*) FROM matched WHERE match_rank = 1 GROUP BY matched.report_date
UNION ALL SELECT {DAY_SQL}, 'write', 'written_count', n FROM written"""


def not_adopted(spark, sf):
    read = memory.validate_selection(requested(spark, sf), memory.catalog(retrieved(spark, sf))).where("outcome = 'selected'")
    adopted = similarity.best_matches(scored(spark, sf), 1)
    return memory.unadopted(read, adopted).select(DAY(), "memory_item_id", "reason")


_NOT_ADOPTED = f"""WITH {SCORED_SQL}, {SELECTION_SQL[len(RETRIEVED_SQL) + 2:]}
SELECT {DAY_SQL}, id AS memory_item_id, 'read_but_not_used_as_final_historical_evidence' AS reason FROM sel WHERE outcome = 'selected' AND NOT EXISTS (SELECT 1 FROM matched m WHERE m.match_rank = 1 AND m.report_date = sel.report_date AND m.memory_item_id = sel.id)"""

PLANS = {
    "mem2_read_index": (read_index, f"WITH {STRUCTURED_SQL} SELECT lower(topic) AS topic_key, topic, id, url, importance_score FROM structured"),
    "mem3_strong_keys": (strong_keys, f"WITH {STRUCTURED_SQL}, {_ENTRY_KEYS.format(src='structured')} SELECT * FROM entry_keys"),
    "j1_strong_matches": (strong_matches, f"WITH {_SPLIT} SELECT i.id AS item_id, i.field, i.value, count(DISTINCT memory_item_id) AS entry_count, min(memory_item_id) AS first_entry FROM item_keys i JOIN entry_keys e ON e.field = i.field AND e.value = i.value GROUP BY i.id, i.field, i.value"),
    "j1_matched_entries": (matched_entries, f"WITH {_SPLIT} SELECT * FROM entry_keys e WHERE EXISTS (SELECT 1 FROM item_keys i WHERE i.field = e.field AND i.value = e.value)"),
    "j2_drop_known": (drop_known, f"WITH {_SPLIT} SELECT pos, id FROM fresh_items f WHERE id NOT IN (SELECT i.id FROM item_keys i JOIN entry_keys e ON e.field = i.field AND e.value = i.value)"),
    "mem1_retrieve": (retrieve, f"WITH {RETRIEVED_SQL} SELECT {DAY_SQL}, topic_key, memory_item_id, rank FROM retrieved"),
    "pf8_exclude_current": (exclude, _EXCLUDE),
    "w2_recent_history": (recent, f"WITH {STRUCTURED_SQL} SELECT * FROM (SELECT lower(topic) AS topic_key, id AS memory_item_id, row_number() OVER (PARTITION BY topic ORDER BY published_at DESC, pos) AS rank FROM structured) WHERE rank <= 10"),
    "mem10_topic_list": (topics, f"WITH {STRUCTURED_SQL} SELECT {DAY_SQL}, lower(topic) AS topic_key, topic, min(pos) AS first_pos FROM structured GROUP BY structured.report_date, topic"),
    "w3_context_budget": (context, _CONTEXT),
    "mem4_catalog": (catalog, f"WITH {RETRIEVED_SQL} SELECT {DAY_SQL}, memory_item_id, topic_key FROM retrieved"),
    "w4_selector_catalog": (selector, _SELECTOR),
    "j4_candidate_pairs": (pair_keys, f"WITH {SCORED_SQL} SELECT {DAY_SQL}, item_id, memory_item_id FROM pr"),
    "cl13_relationship": (scores, _SCORES),
    "w1_best_matches": (best, f"WITH {SCORED_SQL} SELECT {DAY_SQL}, item_id, memory_item_id, match_rank, relationship, confidence FROM matched"),
    "j4_item_relationships": (item_rows, f"WITH {SCORED_SQL} SELECT {DAY_SQL}, item_id, topic, relationship, confidence, array_to_string(ids, ',') AS ids FROM rel"),
    "ag5_relationship_counts": (counts, _COUNTS),
    "w6_heuristic_selection": (heuristic, f"WITH {HEURISTIC_SQL} SELECT {DAY_SQL}, id AS memory_item_id, tier, pick AS rank FROM chosen WHERE pick <= 5"),
    "w5_validate_selection": (selection, f"WITH {SELECTION_SQL} SELECT {DAY_SQL}, id AS memory_item_id, outcome FROM sel"),
    "pf7_available": (available, f"WITH {RETRIEVED_SQL} SELECT {DAY_SQL}, memory_item_id FROM retrieved WHERE pos % 7 <> 0"),
    "j12_read_fulltext": (read_fulltext, _READ),
    "mem5_fulltext": (fulltext, _FULLTEXT),
    "j3_source_links": (source_links, f"WITH {STRUCTURED_SQL} SELECT id AS item_id, raw_id AS source_item_id, 0 AS key_place FROM structured"),
    "an8_source_documents": (source_docs, f"WITH {STRUCTURED_SQL} SELECT s.id AS item_id, c.id AS source_item_id, c.source, c.url, md5(c.content) AS content_md5 FROM structured s JOIN clean c ON c.id = s.raw_id"),
    "mem6_append": (append, _append_sql()),
    "mem6_key_index": (append_by_index, APPEND_NEW_SQL),
    "snk4_history_append": (append_to_history, APPEND_NEW_SQL),
    "mem7_entries": (entries, _ENTRIES),
    "mem7_records": (full_records, _RECORDS),
    "mem7_record_metadata": (stored_metadata, _STORED_METADATA),
    "mem8_snapshot_read": (snapshot_read, f"WITH {STRUCTURED_SQL} SELECT id AS memory_item_id, lower(topic) AS topic_key FROM structured WHERE published_at < TIMESTAMP '{CUT}'"),
    "mem9_stage_report": (stage_report, _STAGES),
    "mem9_unadopted": (not_adopted, _NOT_ADOPTED),
}
