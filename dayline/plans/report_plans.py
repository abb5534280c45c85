"""Trend signals, rankings, insights and comparisons over the structured items."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayline import lexicon
from dayline.functions.values import direction, level_rank
from dayline.operators import memory, report, trends
from dayline.plans import clean_plans, inputs
from dayline.plans.daily import daily_report
from dayline.plans.inputs import CLEAN_SQL, RETRIEVED_SQL, STRUCTURED_SQL, table
from dayline.plans.memory_plans import DAY, DAY_SQL, SCORED_SQL, relationships


def _s(spark, sf):
    return inputs.structured(spark, sf)


def topic_distribution(spark, sf):
    return trends.topic_counts(_s(spark, sf)).select(DAY(), "topic", "item_count")


def summary(spark, sf):
    return trends.executive_summary(_s(spark, sf)).withColumn("report_date", DAY())


_SUMMARY = f"""WITH {STRUCTURED_SQL}, t AS (SELECT report_date, topic, count(*) AS n, min(pos) AS p FROM structured GROUP BY ALL),
lead AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY report_date ORDER BY n DESC, p) AS i FROM t) WHERE i = 1)
SELECT {DAY_SQL.replace('report_date,', 's.report_date,')}, count(*) AS item_count, count(DISTINCT s.topic) AS topic_count, min(lead.topic) AS top_topic, min(lead.n) AS top_topic_count, round_even(sum(importance_score)::DOUBLE / count(*), 1) AS mean_score, count_if(risk_level = 'high') AS high_risk_count
FROM structured s JOIN lead ON lead.report_date = s.report_date GROUP BY s.report_date"""


def signals(spark, sf):
    t = trends.trend_signals(_s(spark, sf), inputs.retrieved(spark, sf), relationships(spark, sf))
    return t.select(DAY(), "topic", "current_count", "current_peak", "current_mean", "current_event_types", "current_risk_levels", "current_opportunity_levels", "history_count", "history_peak", "history_risk_levels", "soft_relationships", "confidence_peak")


def matched(spark, sf):
    """History entries behind each topic's signals, in order of appearance."""
    rows = trends.matched_ids(relationships(spark, sf))
    return rows.select(DAY(), "topic_key", "memory_item_id", F.col("first_seen.pos").alias("pos"), F.col("first_seen.at").alias("at_match"))


_MATCHED = f"""WITH {SCORED_SQL}, e AS (SELECT report_date, topic, pos, unnest(ids) AS id, unnest(range(0, len(ids))) AS i FROM rel),
f AS (SELECT report_date, topic, id, min(pos * 100 + i) AS place FROM e GROUP BY ALL)
SELECT {DAY_SQL}, lower(topic) AS topic_key, id AS memory_item_id, place // 100 AS pos, place % 100 AS at_match FROM f"""


def _hist(col: str, values) -> str:
    parts = ", ".join(f"CASE WHEN count_if({col} = '{v}') > 0 THEN '{v}=' || count_if({col} = '{v}') END" for v in sorted(values))
    return f"array_to_string(list_filter([{parts}], lambda x: x IS NOT NULL), ',')"


_LEVELS = ("low", "medium", "high", "unknown")
_EVENTS = ("product_launch", "funding", "policy", "research", "controversy", "partnership", "market", "security", "model_release", "other")
_RANK = "max(CASE {c} WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 ELSE 0 END)"
SIGNALS_SQL = f"""{SCORED_SQL},
cur AS (SELECT report_date, topic, count(*) AS current_count, max(importance_score) AS current_peak, round_even(sum(importance_score)::DOUBLE / count(*), 1) AS current_mean, {_hist('event_type', _EVENTS)} AS current_event_types, {_hist('risk_level', _LEVELS)} AS current_risk_levels, {_hist('opportunity_level', _LEVELS)} AS current_opportunity_levels,
  {_RANK.format(c='risk_level')} AS cr, {_RANK.format(c='opportunity_level')} AS co, min(pos) AS first_pos FROM structured GROUP BY report_date, topic),
his AS (SELECT report_date, topic, count(*) AS history_count, max(importance_score) AS history_peak, {_hist('risk_level', _LEVELS)} AS history_risk_levels, {_RANK.format(c='risk_level')} AS hr, {_RANK.format(c='opportunity_level')} AS ho FROM retrieved GROUP BY report_date, topic),
rls AS (SELECT report_date, topic, {_hist('relationship', ('new', 'related_context', 'continuing', 'likely_duplicate'))} AS soft_relationships, round(max(confidence), 3) AS confidence_peak, count(*) AS rn, count_if(relationship <> 'new') AS related FROM rel GROUP BY report_date, topic),
sg0 AS (SELECT cur.*, coalesce(history_count, 0) AS history_count, coalesce(history_peak, 0) AS history_peak, coalesce(history_risk_levels, '') AS history_risk_levels, coalesce(hr, 0) AS hr, coalesce(ho, 0) AS ho, soft_relationships, confidence_peak, rn, related
  FROM cur LEFT JOIN his ON his.report_date = cur.report_date AND his.topic = cur.topic LEFT JOIN rls ON rls.report_date = cur.report_date AND rls.topic = cur.topic),
sg AS (SELECT *, CASE WHEN history_count = 0 AND rn = 0 THEN 'new' WHEN history_count > 0 AND ((cr >= 3 AND hr <= 1) OR (co <= 1 AND ho >= 3)) THEN 'reversing'
  WHEN current_count >= 2 OR (history_count > 0 AND current_peak >= history_peak + 10) OR (history_count = 0 AND current_peak >= 85) THEN 'heating_up'
  WHEN history_count >= 2 AND current_count = 1 AND history_peak >= current_peak + 15 THEN 'cooling_down' WHEN related > 0 OR history_count > 0 THEN 'continuing' ELSE 'new' END AS trend_state FROM sg0)"""


def states(spark, sf):
    t = trends.trend_signals(_s(spark, sf), inputs.retrieved(spark, sf), relationships(spark, sf))
    return t.select(DAY(), "topic", "trend_state")


def directions(spark, sf):
    t = trends.trend_signals(_s(spark, sf), inputs.retrieved(spark, sf), relationships(spark, sf))
    return t.select(DAY(), "topic", "risk_direction", "opportunity_direction")


_DIR = "CASE WHEN {h} <= 0 THEN 'no_historical_baseline' WHEN {c} - {h} >= 2 THEN 'much_higher' WHEN {c} > {h} THEN 'higher' WHEN {c} - {h} <= -2 THEN 'much_lower' WHEN {c} < {h} THEN 'lower' ELSE 'stable' END"


def event_trends(spark, sf):
    """Event types per day against the seven days before, levels from the event values."""
    e = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    # Value bands as levels; both sides are reduced to (day, type) before they meet.
    level = F.when(F.col("value") >= 50, "high").when(F.col("value") >= 20, "medium").otherwise("low")
    daily = e.groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("peak"), F.max(level_rank(level)).alias("rank"))
    past = daily.select(F.explode(F.sequence(F.date_add("day", 1), F.date_add("day", 7))).alias("day"), "event_type", "n", "peak", "rank")
    history = past.groupBy("day", "event_type").agg(F.sum("n").alias("history_n"), F.max("peak").alias("history_peak"), F.max("rank").alias("history_rank"))
    out = daily.join(history, ["day", "event_type"], "left").fillna(0)
    return out.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "event_type", "n", "peak", "history_n", "history_peak", direction(F.col("rank"), F.col("history_rank")).alias("direction"))


_EVENT_TRENDS = f"""WITH d AS (SELECT ts::DATE AS day, event_type, count(*) AS n, max(value) AS peak, max(CASE WHEN value >= 50 THEN 3 WHEN value >= 20 THEN 2 ELSE 1 END) AS c FROM events GROUP BY ALL),
j AS (SELECT d.day, d.event_type, d.n, d.peak, d.c, coalesce(sum(h.n), 0) AS history_n, coalesce(max(h.peak), 0) AS history_peak, coalesce(max(h.c), 0) AS h FROM d LEFT JOIN d h ON h.event_type = d.event_type AND h.day BETWEEN d.day - 7 AND d.day - 1 GROUP BY ALL)
SELECT strftime(day, '%Y-%m-%d') AS day, event_type, n, peak, history_n, history_peak, {_DIR.format(c='c', h='h')} AS direction FROM j"""


def entities(spark, sf):
    return trends.topic_entities(_s(spark, sf)).select(DAY(), "topic_key", "current_entities")


_ENTITIES = f"""WITH {STRUCTURED_SQL}, e AS (SELECT report_date, topic, pos, unnest(entities) AS entity, unnest(range(len(entities))) AS i FROM structured),
f AS (SELECT report_date, topic, lower(entity) AS k, min(pos * 1000 + i) AS p, arg_min(entity, pos * 1000 + i) AS entity FROM e GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY report_date, topic ORDER BY p) AS n FROM f)
SELECT {DAY_SQL}, lower(topic) AS topic_key, string_agg(entity, '|' ORDER BY n) AS current_entities FROM r WHERE n <= 10 GROUP BY r.report_date, topic"""


def dominant(spark, sf):
    return trends.dominant_scope(_s(spark, sf), ["report_date", "topic"]).select(DAY(), "topic", "dominant_scope")


_DOMINANT = f"WITH {STRUCTURED_SQL} SELECT {DAY_SQL}, topic, CASE WHEN count(DISTINCT impact_scope) = 1 THEN min(impact_scope) ELSE first(impact_scope ORDER BY importance_score DESC, pos) END AS dominant_scope FROM structured GROUP BY structured.report_date, topic"


def top_events(spark, sf):
    return report.top_events(_s(spark, sf)).select(DAY(), "id", "rank", "is_deep_dive")


def chart(spark, sf):
    return report.importance_chart(_s(spark, sf)).withColumn("report_date", DAY())


def top_topics(spark, sf):
    return trends.top_topics(_s(spark, sf), 3).select(DAY(), "topic", "item_count", "rank")


def risks(spark, sf):
    return report.risk_insights(_s(spark, sf)).select(DAY(), "id", "risk_level", "rank")


def opportunities(spark, sf):
    return report.opportunity_insights(_s(spark, sf)).select(DAY(), "id", "opportunity_level", "rank")


_RISKS = f"""WITH {STRUCTURED_SQL}, r AS (SELECT *, risk_level IN ('medium', 'high') AS ok, row_number() OVER (PARTITION BY report_date, risk_level IN ('medium', 'high') ORDER BY importance_score DESC, pos) AS rank, max((risk_level IN ('medium', 'high'))::INT) OVER (PARTITION BY report_date) AS has_some FROM structured)
SELECT {DAY_SQL}, id, risk_level, rank FROM r WHERE (ok AND rank <= 3) OR (has_some = 0 AND rank = 1)"""


def labelled_risks(spark, sf):
    """Labelled documents per language as risk insights, by quality then id."""
    d = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    items = d.select(F.col("lang").alias("report_date"), F.col("doc_id").alias("pos"), F.col("doc_id").alias("id"), F.col("quality").alias("importance_score"), F.when(F.col("toxic") == 1, "high").otherwise("low").alias("risk_level"))
    return report.level_insights(items, "risk_level", 3, fallback=True).select("report_date", "id", "risk_level", "rank")


_LABELLED = """WITH d AS (SELECT lang AS report_date, l.doc_id AS id, quality, CASE WHEN toxic = 1 THEN 'high' ELSE 'low' END AS risk_level FROM labels l JOIN documents USING (doc_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY report_date, risk_level ORDER BY quality DESC, id) AS rank, max((risk_level = 'high')::INT) OVER (PARTITION BY report_date) AS has_some FROM d)
SELECT report_date, id, risk_level, rank FROM r WHERE (risk_level = 'high' AND rank <= 3) OR (has_some = 0 AND rank = 1)"""


def references(spark, sf):
    return report.references(_s(spark, sf)).select(DAY(), "id", "reference_number")


_REF = f"{STRUCTURED_SQL}, refs AS (SELECT *, row_number() OVER (PARTITION BY report_date ORDER BY importance_score DESC, pos) AS reference_number FROM structured)"


def order_references(spark, sf):
    """Every order numbered inside its status by price: a full numbering of three hot groups."""
    from dayline.operators.groups import number_rows

    o = table(spark, sf, "orders")
    price = F.floor(F.col("o_totalprice") / 1000)
    out = number_rows(o, ["o_orderstatus"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], [-price], "n")
    return out.select("o_orderkey", "o_orderstatus", "n")


def citations(spark, sf):
    s = _s(spark, sf)
    index = report.reference_index(report.references(s))
    claims = s.groupBy("report_date", F.col("topic").alias("claim_id"), F.floor(F.col("pos") / 500).alias("part")).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", F.col("evidence_sources")[0]["source_item_id"].alias("k")))), lambda v: v["k"]).alias("sources"))
    claims = claims.select("report_date", F.concat_ws("#", "claim_id", "part").alias("claim_id"), "sources")
    return report.citations(claims, index).withColumn("report_date", DAY())


_CITE = f"WITH {_REF} SELECT {DAY_SQL}, topic || '#' || (pos // 500) AS claim_id, ' [' || string_agg(reference_number::VARCHAR, ', ' ORDER BY pos) || ']' AS citation FROM refs GROUP BY refs.report_date, topic, pos // 500"


def judgements(spark, sf):
    return report.judgement_table(_s(spark, sf)).withColumn("report_date", DAY())


_JUDGE = f"""WITH {_REF} SELECT {DAY_SQL}, reference_number, replace(title, '|', '\\|') AS title, replace(source, '|', '\\|') AS source, topic, event_type, importance_score || '：' || importance_rationale AS importance_judgement,
 CASE risk_level WHEN 'high' THEN '高' WHEN 'medium' THEN '中' ELSE '低' END || '：' || risk_rationale AS risk_judgement, CASE opportunity_level WHEN 'high' THEN '高' WHEN 'medium' THEN '中' ELSE '低' END || '：' || opportunity_rationale AS opportunity_judgement, url FROM refs"""


def _comparisons(spark, sf):
    return report.historical_comparisons(_s(spark, sf), relationships(spark, sf), inputs.retrieved(spark, sf))


def comparisons(spark, sf):
    return _comparisons(spark, sf).select(DAY(), "section_index", "current_item_id", "memory_item_id", "relation_type")


COMPARE_SQL = f"""{SCORED_SQL},
first_match AS (SELECT report_date, item_id, ids[1] AS match_id, relationship, confidence FROM rel WHERE len(ids) > 0),
has_h AS (SELECT DISTINCT report_date, topic FROM retrieved),
cand AS (SELECT s.*, m.match_id, m.relationship AS rel_type, m.confidence AS rel_conf FROM structured s LEFT JOIN first_match m ON m.item_id = s.id AND m.report_date = s.report_date WHERE m.match_id IS NOT NULL OR (s.report_date, s.topic) IN (SELECT (report_date, topic) FROM has_h)),
top5 AS (SELECT *, row_number() OVER (PARTITION BY report_date ORDER BY importance_score DESC, pos) AS section_index FROM cand QUALIFY section_index <= 5),
opt AS (SELECT t.*, r.id AS memory_item_id, r.title AS h_title, r.event_type AS h_event, list_transform(r.entities, lambda e: lower(e)) AS h_ent, row_number() OVER (PARTITION BY t.report_date, t.id ORDER BY (t.match_id IS NOT NULL AND r.id = t.match_id)::INT DESC,
  len(list_intersect(list_transform(t.entities, lambda e: lower(e)), list_transform(r.entities, lambda e: lower(e)))) DESC, r.published_at DESC, r.rank) AS n FROM top5 t JOIN retrieved r ON r.report_date = t.report_date AND r.topic = t.topic),
cmp0 AS (SELECT *, match_id IS NOT NULL AND memory_item_id = match_id AS is_match, len(list_filter(entities, lambda e: list_contains(h_ent, lower(e)))) > 0 AS shared FROM opt WHERE n = 1),
cmp AS (SELECT *, CASE WHEN is_match THEN rel_type ELSE 'background' END AS relation_type, least(CASE WHEN is_match THEN 100 ELSE 59 END, round_even((CASE WHEN is_match THEN rel_conf ELSE 0.45::DOUBLE END) * 100, 0)::INT + CASE WHEN shared THEN 8 ELSE 0 END + CASE WHEN h_event = event_type THEN 6 ELSE 0 END) AS relevance_strength FROM cmp0)"""


def strengths(spark, sf):
    return _comparisons(spark, sf).select(DAY(), "current_item_id", "memory_item_id", "relevance_strength")


def reasons(spark, sf):
    return _comparisons(spark, sf).select(DAY(), "current_item_id", F.md5("rationale").alias("rationale_md5"), "impact_on_today")


_REASONS = f"""WITH {COMPARE_SQL} SELECT {DAY_SQL}, id AS current_item_id,
 md5(CASE WHEN shared THEN '历史事件「' || h_title || '」与今日事件共享 ' || array_to_string(list_filter(entities, lambda e: list_contains(h_ent, lower(e)))[:3], ', ') || ' 等主体，且关系类型为 ' || relation_type || '。'
 WHEN h_event = event_type THEN '历史事件「' || h_title || '」与今日事件同属 ' || event_type || '，可用于观察同类事件的延续性。' ELSE '历史事件「' || h_title || '」与今日事件同属 ' || topic || '，只能作为主题背景参照，不能替代今日事实判断。' END) AS rationale_md5,
 CASE WHEN relation_type IN ('continuing', 'likely_duplicate') AND relevance_strength >= 70 THEN '这提高了将今日事件视为延续或升温信号的可信度，但结论仍需回到今日证据。' WHEN relation_type = 'related_context' THEN '这说明今日事件有可比历史背景，适合辅助判断趋势方向和风险机会变化。'
 ELSE '这主要提供背景参照，今日新闻价值仍应由当日事实、证据质量和评分决定。' END AS impact_on_today FROM cmp"""


def topic_evidence(spark, sf):
    return report.historical_evidence(_comparisons(spark, sf)).select(DAY(), "topic", "evidence_key", "rank")


_EVIDENCE = f"""WITH {COMPARE_SQL}, f AS (SELECT report_date, topic, memory_item_id, min(section_index) AS si FROM cmp GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY report_date, topic ORDER BY si) AS rank FROM f)
SELECT {DAY_SQL}, topic, memory_item_id AS evidence_key, rank FROM r WHERE rank <= 3"""


def adoption(spark, sf):
    """Adopted comparisons with some that cite unknown items or foreign evidence."""
    c = _comparisons(spark, sf)
    n = F.substring_index("current_item_id", "-", -1).cast("bigint")
    claimed = c.withColumns({"current_item_id": F.when(n % 5 == 0, F.concat("current_item_id", F.lit("x"))).otherwise(F.col("current_item_id")), "memory_item_id": F.when(n % 5 == 1, F.lit("ghost")).otherwise(F.col("memory_item_id"))})
    return report.check_adopted(claimed, c, _s(spark, sf)).select(DAY(), "current_item_id", "memory_item_id", "relevance_strength", "reject_reason")


_ADOPTION = f"""WITH {COMPARE_SQL} SELECT {DAY_SQL}, id || CASE WHEN pos % 5 = 0 THEN 'x' ELSE '' END AS current_item_id, CASE WHEN pos % 5 = 1 THEN 'ghost' ELSE memory_item_id END AS memory_item_id,
 CASE WHEN relation_type IN ('background', 'related_context') THEN least(relevance_strength, 59) ELSE relevance_strength END AS relevance_strength, CASE pos % 5 WHEN 0 THEN 'current_item_id_not_in_validated_items' WHEN 1 THEN 'historical_evidence_not_in_candidate_context' END AS reject_reason FROM cmp"""


def insights(spark, sf):
    s = _s(spark, sf)
    t = trends.trend_signals(s, inputs.retrieved(spark, sf), relationships(spark, sf))
    return trends.trend_insights(s, t, _comparisons(spark, sf)).select(DAY(), "section_index", "topic", "scope", "trend_state", "item_count", "peak_score", "evidence_item_ids", "historical_context_used")


_INSIGHTS = f"""WITH {SIGNALS_SQL}, {COMPARE_SQL[len(SCORED_SQL) + 2:]}, tops AS (SELECT *, row_number() OVER (PARTITION BY report_date ORDER BY current_count DESC, first_pos) AS si FROM sg QUALIFY si <= 3),
ev AS (SELECT report_date, topic, string_agg(id, ',' ORDER BY pos) AS ids, first(impact_scope ORDER BY pos) AS scope FROM (SELECT *, row_number() OVER (PARTITION BY report_date, topic ORDER BY pos) AS k FROM structured) WHERE k <= 3 GROUP BY ALL),
used AS (SELECT DISTINCT report_date, topic FROM cmp)
SELECT strftime(tops.report_date, '%Y-%m-%d') AS report_date, si AS section_index, tops.topic, ev.scope, trend_state, current_count AS item_count, current_peak AS peak_score, ev.ids AS evidence_item_ids, used.topic IS NOT NULL AS historical_context_used
FROM tops JOIN ev ON ev.report_date = tops.report_date AND ev.topic = tops.topic LEFT JOIN used ON used.report_date = tops.report_date AND used.topic = tops.topic"""


def usage(spark, sf):
    s = _s(spark, sf)
    counts = lambda df, name: df.groupBy("report_date").agg(F.count(F.lit(1)).alias(name))
    base = counts(s, "validated_count").join(counts(inputs.retrieved(spark, sf), "metadata_included_count"), "report_date", "left").join(counts(_comparisons(spark, sf), "adopted_count"), "report_date", "left")
    base = base.withColumns({"dedupe_input_count": F.lit(0), "relevant_count": F.lit(None).cast("int"), "dedupe_filtered_count": F.lit(None).cast("int"), "context_included_count": F.lit(7), "fulltext_count": F.lit(0), "read_id_count": F.lit(5)})
    return report.memory_usage(base).withColumn("report_date", DAY())


_USAGE = f"""WITH {COMPARE_SQL} SELECT strftime(s.report_date, '%Y-%m-%d') AS report_date, count(*) AS relevant_candidate_count, 0 AS strong_duplicate_filtered_count,
 coalesce((SELECT CASE WHEN count(*) = 0 THEN 7 ELSE count(*) END FROM retrieved r WHERE r.report_date = s.report_date), 7) AS retrieved_metadata_count, 5 AS read_fulltext_count,
 (SELECT count(*) FROM cmp WHERE cmp.report_date = s.report_date) AS adopted_historical_evidence_count FROM structured s GROUP BY s.report_date"""

def _daily_sql() -> str:
    """The whole way in SQL: one item of each group of a day, of those the relevant, then the report's parts."""
    head = clean_plans.relevance_sql(lexicon.RELEVANCE_FAMILIES, "").removeprefix("WITH ")
    tail = SIGNALS_SQL.removeprefix(CLEAN_SQL).replace("FROM clean)", "FROM kept)", 1)
    return f"""WITH RECURSIVE {head}, {clean_plans.DAY_EDGES}, {clean_plans.QUALITY},
kept AS (SELECT * FROM clean WHERE pos IN (SELECT pos FROM qual WHERE place = 1) AND id IN (SELECT id FROM out WHERE relevance_score >= 70)){tail},
top AS (SELECT *, row_number() OVER (PARTITION BY report_date ORDER BY importance_score DESC, pos) AS rank FROM structured)
SELECT top.report_date, rank, top.id, title, source, top.topic, event_type, importance_score, risk_level, opportunity_level,
  relationship, rel.confidence, current_count, history_count, trend_state, rank <= 3 AS is_deep_dive
FROM top JOIN rel ON rel.item_id = top.id AND rel.report_date = top.report_date
JOIN sg ON sg.report_date = top.report_date AND sg.topic = top.topic WHERE rank <= 5"""


PLANS = {
    "ag2_topic_distribution": (topic_distribution, f"WITH {STRUCTURED_SQL} SELECT {DAY_SQL}, topic, count(*) AS item_count FROM structured GROUP BY structured.report_date, topic"),
    "ag3_executive_summary": (summary, _SUMMARY),
    "ag4_matched_ids": (matched, _MATCHED),
    "ag4_trend_signals": (signals, f"WITH {SIGNALS_SQL} SELECT {DAY_SQL}, topic, current_count, current_peak, current_mean, current_event_types, current_risk_levels, current_opportunity_levels, history_count, history_peak, history_risk_levels, soft_relationships, confidence_peak FROM sg"),
    "ag4_topic_entities": (entities, _ENTITIES),
    "ag4_event_trends": (event_trends, _EVENT_TRENDS),
    "ag17_dominant_scope": (dominant, _DOMINANT),
    "cl14_trend_state": (states, f"WITH {SIGNALS_SQL} SELECT {DAY_SQL}, topic, trend_state FROM sg"),
    "cl15_directions": (directions, f"WITH {SIGNALS_SQL} SELECT {DAY_SQL}, topic, {_DIR.format(c='cr', h='hr')} AS risk_direction, {_DIR.format(c='co', h='ho')} AS opportunity_direction FROM sg"),
    "tk1_top_events": (top_events, f"WITH {_REF} SELECT {DAY_SQL}, id, reference_number AS rank, reference_number <= 3 AS is_deep_dive FROM refs WHERE reference_number <= 5"),
    "tk2_importance_chart": (chart, f"WITH {STRUCTURED_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY report_date ORDER BY importance_score DESC, pos DESC) AS n, count(*) OVER (PARTITION BY report_date) AS c FROM structured) SELECT {DAY_SQL}, least(10, c) - n + 1 AS chart_index, id AS item_id, importance_score AS value FROM r WHERE n <= 10"),
    "tk3_top_topics": (top_topics, f"WITH {STRUCTURED_SQL}, t AS (SELECT report_date, topic, count(*) AS item_count, min(pos) AS p FROM structured GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY report_date ORDER BY item_count DESC, p) AS rank FROM t) SELECT {DAY_SQL}, topic, item_count, rank FROM r WHERE rank <= 3"),
    "tk4_top_comparisons": (comparisons, f"WITH {COMPARE_SQL} SELECT {DAY_SQL}, section_index, id AS current_item_id, memory_item_id, relation_type FROM cmp"),
    "pf6_level_insights": (labelled_risks, _LABELLED),
    "an2_risk_insights": (risks, _RISKS),
    "an2_opportunity_insights": (opportunities, f"WITH {STRUCTURED_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY report_date ORDER BY importance_score DESC, pos) AS rank FROM structured WHERE opportunity_level IN ('medium', 'high')) SELECT {DAY_SQL}, id, opportunity_level, rank FROM r WHERE rank <= 3"),
    "w7_reference_numbers": (references, f"WITH {_REF} SELECT {DAY_SQL}, id, reference_number FROM refs"),
    "w7_order_numbers": (order_references, "SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders"),
    "j11_citations": (citations, _CITE),
    "an7_judgement_table": (judgements, _JUDGE),
    "an3_historical_comparison": (comparisons, f"WITH {COMPARE_SQL} SELECT {DAY_SQL}, section_index, id AS current_item_id, memory_item_id, relation_type FROM cmp"),
    "an4_relation_strength": (strengths, f"WITH {COMPARE_SQL} SELECT {DAY_SQL}, id AS current_item_id, memory_item_id, relevance_strength FROM cmp"),
    "an5_relevance_reason": (reasons, _REASONS),
    "an6_historical_evidence": (topic_evidence, _EVIDENCE),
    "j7_adoption_check": (adoption, _ADOPTION),
    "an1_trend_insights": (insights, _INSIGHTS),
    "ag15_memory_usage": (usage, _USAGE),
    "daily_report": (daily_report, _daily_sql()),
}
__all__ = ["PLANS", "RETRIEVED_SQL", "memory"]
