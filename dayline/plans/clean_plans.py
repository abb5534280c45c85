"""Cleaning, duplicate groups, relevance and extraction over documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayline import lexicon
from dayline.operators import clean, extract, relevance
from dayline.operators.components import extend_components
from dayline.operators.groups import lookup
from dayline.plans import inputs
from dayline.plans.inputs import CLEAN_SQL, RAW_SQL, STRUCTURED_SQL, quote, sql_list
from dayline.session import durable


def required(spark, sf):
    return clean.require_fields(inputs.raw(spark, sf)).select("id", F.md5("title").alias("title_md5"), "url", "summary")


_REQUIRED = f"WITH {RAW_SQL} SELECT id, md5(trim(title)) AS title_md5, url, summary FROM raw WHERE trim(title) <> '' AND source <> '' AND url <> '' AND (summary <> '' OR content <> '')"


def report_date(spark, sf):
    return clean.on_report_date(inputs.raw(spark, sf), "Asia/Shanghai").select("id", F.date_format("report_date", "yyyy-MM-dd").alias("report_date"))


_REPORT_DATE = f"WITH {RAW_SQL} SELECT id, strftime(report_date, '%Y-%m-%d') AS report_date FROM raw WHERE (published_at + INTERVAL 8 HOUR)::DATE = report_date"


def groups(spark, sf):
    return clean.duplicate_groups(inputs.clean(spark, sf), scope=()).select("pos", F.col("group_key").alias("component"))


def grown(spark, sf):
    """The same groups, by items that arrive in three parts: each part only meets the roots of what it touches."""
    keyed = durable(clean.group_nodes(inputs.clean(spark, sf), scope=()))
    roots = None
    for part in range(3):
        arrived = keyed.where(F.pmod(F.col("pos"), F.lit(3)) == part)
        roots = extend_components(roots, arrived.select(F.col("_u").alias("a"), F.col("_t").alias("b")))
    g = clean.grown_groups(keyed, roots)
    low = g.groupBy("group_key").agg(F.min("pos").alias("component"))
    return lookup(g.select("group_key", "pos"), low, ["group_key"], "inner").select("pos", "component")


# Transitive closure by recursion over shared keys: an independent form of the components.
_EDGES = """keyed AS (SELECT pos, 'u' || canonical_url AS k FROM clean UNION ALL SELECT pos, 't' || title_fingerprint FROM clean WHERE title_fingerprint <> ''),
firsts AS (SELECT pos, min(pos) OVER (PARTITION BY k{scope}) AS head FROM keyed{join}),
edges AS (SELECT DISTINCT pos AS a, head AS b FROM firsts UNION SELECT DISTINCT head, pos FROM firsts),
reach(node, low) AS (SELECT pos, pos FROM clean UNION SELECT e.b, r.low FROM reach r JOIN edges e ON e.a = r.node),
comp AS (SELECT node AS pos, min(low) AS component FROM reach GROUP BY node)"""
_ALL_EDGES = _EDGES.format(scope="", join="")
DAY_EDGES = _EDGES.format(scope=", report_date", join=" JOIN (SELECT pos, report_date FROM clean) USING (pos)")
_GROUPS = f"WITH RECURSIVE {CLEAN_SQL}, {_ALL_EDGES} SELECT pos, component FROM comp"


def survivors(spark, sf):
    return clean.dedupe(inputs.clean(spark, sf), scope=()).select("pos", "id")


QUALITY = """qual AS (SELECT c.*, component, CASE WHEN source_family = 'aggregator' THEN 0 WHEN fetched_via IN ('rss', 'arxiv_api', 'github_releases', 'hackernews_api') THEN 2 ELSE 1 END AS origin,
  row_number() OVER (PARTITION BY component ORDER BY CASE WHEN source_family = 'aggregator' THEN 0 WHEN fetched_via IN ('rss', 'arxiv_api', 'github_releases', 'hackernews_api') THEN 2 ELSE 1 END DESC,
    (content_source = 'article_html')::INT DESC, (full_content_error = '')::INT DESC, length(content) DESC, length(summary) DESC, pos) AS place FROM clean c JOIN comp USING (pos))"""
_SURVIVORS = f"WITH RECURSIVE {CLEAN_SQL}, {_ALL_EDGES}, {QUALITY} SELECT pos, id FROM qual WHERE place = 1"


def audit(spark, sf):
    return clean.duplicate_audit(clean.duplicate_groups(inputs.clean(spark, sf), scope=()))


_AUDIT = f"""WITH RECURSIVE {CLEAN_SQL}, {_ALL_EDGES}, {QUALITY},
dup AS (SELECT component, array_to_string(list_filter([CASE WHEN count(DISTINCT canonical_url) < count(*) THEN 'canonical_url' END, CASE WHEN count(DISTINCT title_fingerprint) < count(*) THEN 'title_fingerprint' END,
  CASE WHEN count(DISTINCT content_hash) < count(*) THEN 'content_hash' END], lambda x: x IS NOT NULL), ',') AS reasons FROM qual GROUP BY component HAVING count(*) > 1)
SELECT k.id AS kept_id, k.url AS kept_url, reasons, d.id AS discarded_id, d.url AS discarded_url, d.source AS discarded_source
FROM dup JOIN qual k ON k.component = dup.component AND k.place = 1 JOIN qual d ON d.component = dup.component AND d.place > 1"""


def group_sizes(spark, sf):
    return clean.duplicate_summary(clean.duplicate_groups(inputs.clean(spark, sf), scope=())).drop("group_key")


_SIZES = f"""WITH RECURSIVE {CLEAN_SQL}, {_ALL_EDGES}, {QUALITY}
SELECT min(CASE WHEN place = 1 THEN pos END) AS kept_pos, count(*) AS group_size, count(*) - 1 AS discarded_count,
  array_to_string(list_filter([CASE WHEN count(DISTINCT canonical_url) < count(*) THEN 'canonical_url' END, CASE WHEN count(DISTINCT title_fingerprint) < count(*) THEN 'title_fingerprint' END,
  CASE WHEN count(DISTINCT content_hash) < count(*) THEN 'content_hash' END], lambda x: x IS NOT NULL), ',') AS reasons
FROM qual GROUP BY component HAVING count(*) > 1"""


def quality(spark, sf):
    raw = inputs.raw(spark, sf)
    out = clean.clean_quality(clean.clean_counts(raw), clean.dedupe(inputs.clean(spark, sf)))
    return out.withColumn("report_date", F.date_format("report_date", "yyyy-MM-dd"))


_CLEANED_DAYS = f"{CLEAN_SQL}, {DAY_EDGES}, {QUALITY}, kept AS (SELECT * FROM qual WHERE place = 1)"
_QUALITY_SQL = f"""WITH RECURSIVE {_CLEANED_DAYS},
n AS (SELECT report_date, count(*) AS raw_count, count_if(NOT ok) AS filtered_incomplete_count, count_if(ok AND NOT on_day) AS filtered_non_report_date_count, count_if(ok AND on_day) AS candidate_count
  FROM (SELECT report_date, trim(title) <> '' AND source <> '' AND url <> '' AND (summary <> '' OR content <> '') AS ok, published_at::DATE = report_date AS on_day FROM raw) GROUP BY report_date),
b AS (SELECT report_date, count(*) AS cleaned_count, count_if(full_content_error <> '') AS full_content_error_count, count_if(content_source <> 'article_html') AS fallback_content_count,
  count_if(length(content) < 200) AS short_content_count, count_if(source_family = 'aggregator') AS aggregator_count FROM kept GROUP BY report_date),
j AS (SELECT n.*, coalesce(cleaned_count, 0) AS cleaned_count, coalesce(full_content_error_count, 0) AS full_content_error_count, coalesce(fallback_content_count, 0) AS fallback_content_count,
  coalesce(short_content_count, 0) AS short_content_count, coalesce(aggregator_count, 0) AS aggregator_count, candidate_count - coalesce(cleaned_count, 0) AS duplicate_count FROM n LEFT JOIN b USING (report_date)),
w AS (SELECT *, array_to_string(list_filter([CASE WHEN fallback_content_count > cleaned_count * 0.5 THEN 'high_fallback_content_ratio' END, CASE WHEN short_content_count > cleaned_count * 0.5 THEN 'high_short_content_ratio' END,
  CASE WHEN duplicate_count > candidate_count * 0.5 THEN 'high_duplicate_ratio' END], lambda x: x IS NOT NULL), ',') AS warning_reasons FROM j)
SELECT * REPLACE (strftime(report_date, '%Y-%m-%d') AS report_date), CASE WHEN warning_reasons = '' THEN 'ok' ELSE 'warning' END AS status FROM w"""


def fetch_errors(spark, sf):
    return clean.fetch_error_histogram(inputs.clean(spark, sf)).select(F.date_format("report_date", "yyyy-MM-dd").alias("report_date"), "error", F.col("count").alias("n"))


def corpus(spark, sf):
    return clean.corpus_summary(inputs.clean(spark, sf)).select(F.coalesce("source", F.lit("all")).alias("source"), F.coalesce("content_source", F.lit("all")).alias("content_source"), "items", "min_chars", "max_chars", F.round("mean_chars", 0).alias("mean_chars"), "long_items", "truncated_items")


_CORPUS = f"""WITH {CLEAN_SQL} SELECT coalesce(source, 'all') AS source, coalesce(content_source, 'all') AS content_source, count(*) AS items, min(length(content)) AS min_chars, max(length(content)) AS max_chars,
 round(round(avg(length(content)), 1), 0) AS mean_chars, count_if(length(content) > 1000) AS long_items, 0 AS truncated_items FROM clean GROUP BY ROLLUP (source, content_source)"""


def input_order(spark, sf):
    """Duplicates removed, then back in input order at the sink: the order is the ``pos`` column."""
    kept = clean.dedupe(inputs.clean(spark, sf), scope=())
    return kept.select("pos", "source").orderBy("pos")


# --- relevance ---------------------------------------------------------------------
HITTING = {
    "direct": ("the", "der", "il"), "weak": ("the", "und", "les"), "negative": ("game", "und", "es"), "infra": ("of", "gpu", "on the"), "workload": ("in", "aux", "model training"),
    "tech_entity": ("that", "nicht", "pour"), "policy": ("with", "elle", "policy"), "policy_target": ("as", "ai act"), "research": ("or", "paper", "dans"), "tech_research": ("you", "est", "benchmark"),
    "product": ("this", "launch", "sich"), "capability": ("agent",), "strong_product": ("from", "api", "una"), "business": ("by", "qui"), "business_target": ("were", "que"),
}


def relevance_sql(families, tail: str) -> str:
    everything = {t.lower() for terms in families.values() for t in terms}
    hits = f"list_filter({sql_list(sorted(everything))}, lambda t: contains(body, t) AND regexp_matches(body, '(^|[^a-z0-9])' || regexp_escape(t) || '([^a-z0-9]|$)'))"
    fam = ", ".join(f"list_filter({sql_list(dict.fromkeys(terms))}, lambda t: list_contains(hits, t)) AS f_{name}" for name, terms in families.items())
    neg = " OR ".join(f"regexp_matches(body, {quote(p)})" for p in lexicon.NEGATED_CONTEXT_PATTERNS)
    has = lambda n: f"len(f_{n}) > 0"
    union = lambda *names: "list_concat(" + ", ".join(f"f_{n}" for n in names) + ")" if len(names) > 1 else f"f_{names[0]}"
    rows = [
        (1, f"{has('infra')} AND {has('workload')} AND NOT neg", "88", "AI infrastructure", union("infra", "workload", "tech_entity")),
        (1, f"{has('infra')} AND ({has('weak')} OR {has('direct')} OR {has('workload')})", "58", "AI-adjacent infrastructure", union("infra", "weak")),
        (2, f"{has('policy')} AND {has('policy_target')} AND NOT neg", "86", "AI policy and governance", union("policy", "policy_target", "direct")),
        (2, has("policy"), "42", "general policy", union("policy", "weak")),
        (3, f"{has('research')} AND {has('tech_research')}", "87", "AI research", union("research", "tech_research")),
        (3, f"{has('research')} AND {has('weak')}", "56", "AI-used research", union("research", "weak")),
        (4, f"{has('product')} AND ({has('tech_entity')} OR {has('strong_product')})", f"CASE WHEN {has('negative')} AND NOT {has('strong_product')} THEN 62 ELSE 86 END", "AI product", union("product", "tech_entity", "capability", "strong_product", "negative")),
        (4, f"{has('product')} AND ({has('weak')} OR {has('direct')})", "55", "AI-adjacent product", union("product", "weak", "direct", "negative")),
        (5, f"{has('business')} AND {has('business_target')}", "80", "AI business", union("business", "business_target")),
    ]
    parts = []
    for family in range(1, 6):
        cases = [r for r in rows if r[0] == family]
        pick = lambda i: "CASE " + " ".join(f"WHEN {r[1]} THEN {quote(r[i]) if i == 3 else r[i]}" for r in cases) + " END"
        parts.append(f"SELECT id, {family} AS ord, {pick(2)} AS score, {pick(3)} AS category, {pick(4)} AS terms FROM fam")
    fallback = f"""SELECT id, 9 AS ord, CASE WHEN {has('tech_entity')} THEN CASE WHEN {has('negative')} OR neg THEN 58 ELSE 72 END WHEN {has('weak')} THEN 45 WHEN {has('negative')} THEN 20 ELSE 30 END AS score,
  CASE WHEN {has('tech_entity')} THEN 'direct AI mention' WHEN {has('weak')} THEN 'weak AI mention' ELSE 'out of scope' END AS category,
  CASE WHEN {has('tech_entity')} THEN {union('tech_entity', 'negative')} WHEN {has('weak')} THEN {union('weak', 'negative')} ELSE f_negative END AS terms FROM fam WHERE id NOT IN (SELECT id FROM sig WHERE score IS NOT NULL)"""
    return f"""WITH {CLEAN_SQL},
b AS (SELECT *, lower(title || ' ' || summary || ' ' || content) AS body FROM clean),
h AS (SELECT *, {hits} AS hits, {neg} AS neg FROM b), fam AS (SELECT *, {fam} FROM h),
sig AS ({' UNION ALL '.join(parts)}), alls AS (SELECT * FROM sig WHERE score IS NOT NULL UNION ALL {fallback}),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, ord) AS n FROM alls) WHERE n = 1),
out AS (SELECT c.*, best.score AS relevance_score, best.category AS relevance_category, terms FROM clean c JOIN best USING (id)) {tail}"""


def _scored(families):
    def plan(spark, sf):
        r = relevance.relevance(inputs.clean(spark, sf), families)
        return r.select("id", "relevance_score", "relevance_category", F.array_join(F.sort_array("matched_terms"), "|").alias("terms"), "is_ai_related")

    return plan


_SCORED_TAIL = "SELECT id, relevance_score, relevance_category, array_to_string(list_sort(list_distinct(terms)), '|') AS terms, relevance_score >= 70 AS is_ai_related FROM out"


def evidence(spark, sf):
    return relevance.relevance(inputs.clean(spark, sf)).select("id", F.size("relevance_evidence").alias("n"), F.md5(F.array_join("relevance_evidence", "|")).alias("evidence_md5"))


_EVIDENCE_TAIL = """, ev AS (SELECT id, title, summary, list_filter([title, summary, content], lambda v: v <> '' AND (len(terms) = 0 OR len(list_filter(terms, lambda t: contains(lower(v), t))) > 0)) AS m FROM out),
 ev2 AS (SELECT id, list_transform(CASE WHEN len(m) > 0 THEN m[:2] WHEN summary <> '' THEN [summary] ELSE [title] END, lambda v: CASE WHEN length(v) > 220 THEN v[:217] || '...' ELSE v END) AS e FROM ev)
 SELECT id, len(e) AS n, md5(array_to_string(e, '|')) AS evidence_md5 FROM ev2"""


def gate(spark, sf):
    items = inputs.clean(spark, sf)
    return relevance.relevance_gate(items, relevance.relevance(items)).select("pos", "id")


# --- extraction --------------------------------------------------------------------
def _fields(*names):
    def plan(spark, sf):
        return inputs.structured_items(spark, sf).select("id", *names)

    return plan


def _fields_sql(*names) -> str:
    return f"WITH {STRUCTURED_SQL} SELECT id, {', '.join(names)} FROM structured"


def entities(spark, sf):
    return inputs.structured_items(spark, sf).select("id", F.array_join("entities", "|").alias("entities"))


def key_points(spark, sf):
    s = inputs.structured_items(spark, sf)
    e = F.col("evidence_sources")[0]
    return s.select("id", F.md5(F.array_join("key_points", "|")).alias("points_md5"), F.md5(F.array_join("evidence", "|")).alias("evidence_md5"), e["source_item_id"].alias("source_item_id"), e["evidence_field"].alias("evidence_field"), F.md5(e["evidence_quote"]).alias("quote_md5"))


_POINTS = f"""WITH {STRUCTURED_SQL}, p AS (SELECT *, list_filter([first_summary, first_content, title], lambda v: v <> '') AS l FROM structured)
SELECT id, md5(array_to_string(list_filter(l, lambda v, i: list_position(l, v) = i)[:3], '|')) AS points_md5, md5(evidence) AS evidence_md5, raw_id AS source_item_id, evidence_field,
 md5(CASE evidence_field WHEN 'content' THEN first_content WHEN 'summary' THEN first_summary ELSE title END) AS quote_md5 FROM p"""


def structured(spark, sf):
    s = inputs.structured_items(spark, sf)
    return s.select("id", "source", "url", "topic", F.array_join("entities", "|").alias("entities"), "event_type", F.md5("summary").alias("summary_md5"), "sentiment", "impact_scope", "importance_score", "risk_level", "opportunity_level", "content_hash")


_STRUCTURED = f"WITH {STRUCTURED_SQL} SELECT id, source, url, topic, array_to_string(entities, '|') AS entities, event_type, md5(summary) AS summary_md5, sentiment, impact_scope, importance_score, risk_level, opportunity_level, content_hash FROM structured"

PLANS = {
    "pf1_required_fields": (required, _REQUIRED),
    "pf2_report_date": (report_date, _REPORT_DATE),
    "dd1_duplicate_groups": (groups, _GROUPS),
    "dd1_grown_groups": (grown, _GROUPS),
    "dd2_survivors": (survivors, _SURVIVORS),
    "dd3_duplicate_audit": (audit, _AUDIT),
    "dd3_group_summary": (group_sizes, _SIZES),
    "ag1_clean_quality": (quality, _QUALITY_SQL),
    "ag1_fetch_errors": (fetch_errors, f"WITH {CLEAN_SQL} SELECT strftime(report_date, '%Y-%m-%d') AS report_date, full_content_error AS error, count(*) AS n FROM clean WHERE full_content_error <> '' GROUP BY ALL"),
    "ag16_corpus_summary": (corpus, _CORPUS),
    "tk5_input_order": (input_order, f"WITH RECURSIVE {CLEAN_SQL}, {_ALL_EDGES}, {QUALITY} SELECT pos, source FROM qual WHERE place = 1 ORDER BY pos"),
    "cl1_relevance": (_scored(lexicon.RELEVANCE_FAMILIES), relevance_sql(lexicon.RELEVANCE_FAMILIES, _SCORED_TAIL)),
    "cl1_relevance_custom": (_scored(HITTING), relevance_sql(HITTING, _SCORED_TAIL)),
    "cl2_evidence_lines": (evidence, relevance_sql(lexicon.RELEVANCE_FAMILIES, _EVIDENCE_TAIL)),
    "pf4_relevance_gate": (gate, relevance_sql(lexicon.RELEVANCE_FAMILIES, "SELECT pos, id FROM out WHERE relevance_score >= 70")),
    "cl3_topic": (_fields("topic"), _fields_sql("topic")),
    "cl4_event_type": (_fields("event_type"), _fields_sql("event_type")),
    "cl5_impact_scope": (_fields("impact_scope"), _fields_sql("impact_scope")),
    "cl6_levels": (_fields("risk_level", "opportunity_level"), _fields_sql("risk_level", "opportunity_level")),
    "cl7_sentiment": (_fields("sentiment"), _fields_sql("sentiment")),
    "cl8_importance": (_fields("importance_score"), _fields_sql("importance_score")),
    "cl9_entities": (entities, f"WITH {STRUCTURED_SQL} SELECT id, array_to_string(entities, '|') AS entities FROM structured"),
    "cl10_key_points": (key_points, _POINTS),
    "cl11_rationales": (_fields("importance_rationale", "risk_rationale", "opportunity_rationale"), _fields_sql("importance_rationale", "risk_rationale", "opportunity_rationale")),
    "cl12_structure": (structured, _STRUCTURED),
}
__all__ = ["PLANS", "extract"]
