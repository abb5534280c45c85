"""Validation, evidence audits and consistency findings."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayline import lexicon
from dayline.operators import audit, consistency, report, trends, validation
from dayline.plans import inputs
from dayline.plans.inputs import CLEAN_SQL, RAW_SQL, STRUCTURED_SQL, any_word, sql_list, table
from dayline.plans.memory_plans import DAY, DAY_SQL, index_documents
from dayline.operators.memory import read_index


def _s(spark, sf):
    return inputs.structured(spark, sf)


def _damaged(spark, sf):
    """Structured items some of which break a rule, as model output does."""
    n = F.col("pos")
    return _s(spark, sf).withColumns(
        {
            "importance_score": F.when(n % 9 == 0, F.lit(120)).otherwise(F.col("importance_score")), "risk_level": F.when(n % 8 == 0, F.lit("severe")).otherwise(F.col("risk_level")),
            "topic": F.when(n % 7 == 0, F.lit("Quantum")).otherwise(F.col("topic")), "title": F.when(n % 11 == 0, F.lit(" ")).otherwise(F.col("title")),
            "risk_rationale": F.when(n % 5 == 0, F.lit("信息 不足")).when(n % 5 == 1, F.lit("短评")).otherwise(F.col("risk_rationale")),
        }
    )


def issues(spark, sf):
    return validation.issues(_damaged(spark, sf), validation.structured_rules()).select("item_id", "field", "code")


_ISSUES = f"""WITH {STRUCTURED_SQL} SELECT id AS item_id, 'importance_score' AS field, 'range' AS code FROM structured WHERE pos % 9 = 0 UNION ALL SELECT id, 'risk_level', 'enum' FROM structured WHERE pos % 8 = 0
 UNION ALL SELECT id, 'topic', 'enum' FROM structured WHERE pos % 7 = 0 UNION ALL SELECT id, 'title', 'missing' FROM structured WHERE pos % 11 = 0"""


def generic(spark, sf):
    return validation.issues(_damaged(spark, sf), validation.rationale_rules()).select("item_id", "field", "code")


_GENERIC = f"WITH {STRUCTURED_SQL}, r AS (SELECT id, unnest(['importance_rationale', 'risk_rationale', 'opportunity_rationale']) AS field, unnest([importance_rationale, CASE pos % 5 WHEN 0 THEN '信息 不足' WHEN 1 THEN '短评' ELSE risk_rationale END, opportunity_rationale]) AS v FROM structured) SELECT id AS item_id, field, 'generic_rationale' AS code FROM r WHERE length(replace(trim(v), ' ', '')) < 8 OR replace(trim(v), ' ', '') IN ({', '.join(repr(g) for g in lexicon.GENERIC_RATIONALES)})"


def verdict(spark, sf):
    d = _damaged(spark, sf)
    found = validation.issues(d, validation.structured_rules()).unionByName(validation.issues(d, validation.rationale_rules(), "warning"))
    return validation.validation_summary(found, d).withColumn("report_date", DAY())


_VERDICT = f"""WITH {STRUCTURED_SQL}, g AS (SELECT id, count_if(length(replace(trim(v), ' ', '')) < 8 OR replace(trim(v), ' ', '') IN ({', '.join(repr(x) for x in lexicon.GENERIC_RATIONALES)})) AS g FROM (SELECT id, unnest([importance_rationale, CASE pos % 5 WHEN 0 THEN '信息 不足' WHEN 1 THEN '短评' ELSE risk_rationale END, opportunity_rationale]) AS v FROM structured) GROUP BY id),
e AS (SELECT s.report_date, (pos % 9 = 0)::INT + (pos % 8 = 0)::INT + (pos % 7 = 0)::INT + (pos % 11 = 0)::INT AS e, g FROM structured s JOIN g USING (id))
SELECT {DAY_SQL}, count(*) AS total_items, sum(e + g) AS issue_count, sum(e) AS error_count, sum(e) = 0 AS is_valid FROM e GROUP BY e.report_date"""


def outside(spark, sf):
    return validation.outside_report_date(inputs.raw(spark, sf)).select("item_id")


def assessments(spark, sf):
    """Relevance records as validated rows: the check of structured and relevance records."""
    from dayline.operators.relevance import relevance

    r = relevance(inputs.clean(spark, sf)).withColumns({"relevance_score": F.when(F.col("pos") % 6 == 0, -1).otherwise(F.col("relevance_score")), "url": F.when(F.col("pos") % 10 == 0, "").otherwise(F.col("url"))})
    good, bad = validation.split_valid(r, validation.assessment_rules())
    return good.select(F.col("id").alias("item_id"), F.lit("ok").alias("code"), F.lit("").alias("field")).unionByName(bad.select("item_id", "code", "field"))


_ASSESS = f"""WITH {CLEAN_SQL} SELECT id AS item_id, 'ok' AS code, '' AS field FROM clean WHERE pos % 6 <> 0 AND pos % 10 <> 0 UNION ALL SELECT id, 'range', 'relevance_score' FROM clean WHERE pos % 6 = 0 UNION ALL SELECT id, 'missing', 'url' FROM clean WHERE pos % 10 = 0"""


# --- evidence ----------------------------------------------------------------------
def _claims(spark, sf):
    """Claims of the structured items, some with a foreign quote, field or source."""
    c = audit.claims_of(_s(spark, sf))
    n = F.substring_index("item_id", "-", -1).cast("bigint")
    return c.withColumns(
        {
            "evidence_quote": F.when(n % 6 == 0, F.concat("evidence_quote", F.lit(" zzz"))).otherwise(F.upper("evidence_quote")), "evidence_field": F.when(n % 6 == 1, F.lit("body")).otherwise(F.col("evidence_field")),
            "source_item_id": F.when(n % 6 == 2, F.lit("raw-none")).when(n % 6 == 3, F.col("item_id")).otherwise(F.col("source_item_id")),
        }
    )


_ST = "CASE WHEN pos % 6 = 2 THEN 'missing_source' WHEN pos % 6 = 1 THEN 'invalid_field' WHEN pos % 6 = 0 THEN 'missing_quote' ELSE 'supported' END"


def claim_audit(spark, sf):
    return audit.audit_claims(_claims(spark, sf), inputs.clean(spark, sf)).select("item_id", "status")


def item_audit(spark, sf):
    a = audit.audit_items(audit.audit_claims(_claims(spark, sf), inputs.clean(spark, sf)), _s(spark, sf))
    return a.select(DAY(), "item_id", "supported_evidence_count", "status")


def _insights(spark, sf):
    """The report sections as one long table of insights with their evidence."""
    s = _s(spark, sf)
    risk = report.risk_insights(s).select("report_date", F.lit("risk_insights").alias("section"), F.col("rank").alias("section_index"), "title", F.col("risk_level").alias("level"), F.array("id").alias("item_ids"), "evidence_sources", "pos")
    chance = report.opportunity_insights(s).select("report_date", F.lit("opportunity_insights").alias("section"), F.col("rank").alias("section_index"), "title", F.col("opportunity_level").alias("level"), F.array("id").alias("item_ids"), "evidence_sources", "pos")
    top = report.top_events(s).select("report_date", F.lit("top_events").alias("section"), F.col("rank").alias("section_index"), "title", F.lit("high").alias("level"), F.array("id").alias("item_ids"), "evidence_sources", "pos")
    out = risk.unionByName(chance).unionByName(top)
    n = F.col("pos")
    # Some cite another quote, some nothing, some an unknown item.
    wrong = F.transform("evidence_sources", lambda e: e.withField("evidence_quote", F.concat(e["evidence_quote"], F.lit(" zzz"))))
    return out.withColumns(
        {
            "sources": F.when(n % 4 == 0, wrong).when(n % 4 == 1, F.slice("evidence_sources", 1, 0)).otherwise(F.col("evidence_sources")),
            "item_ids": F.when(n % 5 == 0, F.array(F.lit("structured-none"))).otherwise(F.col("item_ids")),
        }
    ).drop("evidence_sources")


_INS = f"""{STRUCTURED_SQL}, r1 AS (SELECT *, risk_level IN ('medium', 'high') AS ok, row_number() OVER (PARTITION BY report_date, risk_level IN ('medium', 'high') ORDER BY importance_score DESC, pos) AS n, max((risk_level IN ('medium', 'high'))::INT) OVER (PARTITION BY report_date) AS any_ok FROM structured),
o1 AS (SELECT *, row_number() OVER (PARTITION BY report_date ORDER BY importance_score DESC, pos) AS n FROM structured WHERE opportunity_level IN ('medium', 'high')),
t1 AS (SELECT *, row_number() OVER (PARTITION BY report_date ORDER BY importance_score DESC, pos) AS n FROM structured),
ins AS (SELECT report_date, 'risk_insights' AS section, n AS section_index, risk_level AS level, risk_level AS item_level, id, pos FROM r1 WHERE (ok AND n <= 3) OR (any_ok = 0 AND n = 1)
  UNION ALL SELECT report_date, 'opportunity_insights', n, opportunity_level, risk_level, id, pos FROM o1 WHERE n <= 3 UNION ALL SELECT report_date, 'top_events', n, 'high', risk_level, id, pos FROM t1 WHERE n <= 5)"""


def insight_audit(spark, sf):
    return audit.audit_insights(_insights(spark, sf), _s(spark, sf)).select(DAY(), "section", "section_index", "status")


_INS_AUDIT = f"WITH {_INS} SELECT {DAY_SQL}, section, section_index, CASE WHEN pos % 5 = 0 OR pos % 4 = 0 THEN 'missing_quote' ELSE 'supported' END AS status FROM ins"


def insight_sources(spark, sf):
    return audit.supported_insight_sources(_insights(spark, sf), _s(spark, sf)).select(DAY(), "section", "section_index", "source_item_id", "evidence_field")


_INS_SOURCES = f"WITH {_INS} SELECT strftime(ins.report_date, '%Y-%m-%d') AS report_date, section, section_index, raw_id AS source_item_id, evidence_field FROM ins JOIN structured s ON s.id = ins.id WHERE ins.pos % 5 <> 0 AND ins.pos % 4 > 1"


def audit_totals(spark, sf):
    claims = audit.audit_claims(_claims(spark, sf), inputs.clean(spark, sf)).select("report_date", F.lit("structured_evidence").alias("audit_type"), "status")
    report_claims = audit.audit_insights(_insights(spark, sf), _s(spark, sf)).select("report_date", F.lit("analysis_evidence").alias("audit_type"), "status")
    return audit.audit_summary(claims.unionByName(report_claims)).withColumn("report_date", DAY())


_TOTALS = f"""WITH {_INS}, rec AS (SELECT report_date, 'structured_evidence' AS audit_type, {_ST} AS status FROM structured UNION ALL SELECT report_date, 'analysis_evidence', CASE WHEN pos % 5 = 0 OR pos % 4 = 0 THEN 'missing_quote' ELSE 'supported' END FROM ins)
SELECT {DAY_SQL}, coalesce(audit_type, 'all') AS audit_type, count(*) AS total_claims, count_if(status = 'supported') AS supported_claims, count_if(status <> 'supported') AS unsupported_claims FROM rec GROUP BY GROUPING SETS ((rec.report_date, audit_type), (rec.report_date))"""


def level_repair(spark, sf):
    return audit.repair_level_insights(_insights(spark, sf), _s(spark, sf), "risk_level").select(DAY(), "section", "section_index", "outcome")


_REPAIR = f"WITH {_INS} SELECT {DAY_SQL}, section, section_index, CASE WHEN pos % 5 = 0 OR pos % 4 = 1 OR (level IN ('medium', 'high') AND item_level NOT IN ('medium', 'high')) THEN 'removed' ELSE 'kept' END AS outcome FROM ins"


def level_findings(spark, sf):
    return consistency.level_findings(_insights(spark, sf), _s(spark, sf), "risk_level", "risk").select(DAY(), "section", "section_index", "severity", "message")


_LEVEL = f"""WITH {_INS} SELECT {DAY_SQL}, section, section_index, 'error' AS severity, CASE WHEN pos % 5 = 0 THEN 'unknown evidence item structured-none' ELSE level || ' insight references ' || id || ' with ' || item_level || ' risk' END AS message
 FROM ins WHERE pos % 5 = 0 OR (level IN ('medium', 'high') AND item_level NOT IN ('medium', 'high'))"""


def item_findings(spark, sf):
    return consistency.item_findings(_s(spark, sf)).select("id", "severity", "message")


_BODY = "lower(title || ' ' || summary || ' ' || array_to_string(points, ' ') || ' ' || evidence || ' ' || event_type || ' ' || impact_scope)"
_FINDINGS = f"""WITH {STRUCTURED_SQL}, p0 AS (SELECT *, list_filter([first_summary, first_content, title], lambda v: v <> '') AS l FROM structured), p AS (SELECT *, list_filter(l, lambda v, i: list_position(l, v) = i)[:3] AS points FROM p0),
b AS (SELECT *, {_BODY} AS body, lower(evidence) AS ev FROM p), f AS (SELECT id, unnest([
 CASE WHEN risk_level = 'high' AND NOT {any_word('body', lexicon.RISK_WORDS)} THEN 'high risk has no obvious risk signal' END, CASE WHEN risk_level = 'medium' AND NOT {any_word('body', lexicon.RISK_WORDS)} THEN 'medium risk has no obvious risk signal' END,
 CASE WHEN opportunity_level = 'high' AND NOT {any_word('body', lexicon.OPPORTUNITY_WORDS)} THEN 'high opportunity has no obvious opportunity signal' END, CASE WHEN event_type = 'security' AND risk_level = 'low' THEN 'security event is marked low risk' END,
 CASE WHEN event_type = 'policy' AND risk_level = 'low' THEN 'policy event is marked low risk' END, CASE WHEN risk_level = 'high' AND sentiment = 'positive' THEN 'high risk paired with positive sentiment' END,
 CASE WHEN risk_level = 'high' AND opportunity_level = 'high' AND sentiment <> 'mixed' THEN 'high risk and high opportunity should usually be mixed' END, CASE WHEN risk_level IN ('medium', 'high') AND NOT {any_word('ev', lexicon.RISK_WORDS)} THEN 'risk evidence has no obvious risk term' END]) AS message FROM b)
SELECT id, 'warning' AS severity, message FROM f WHERE message IS NOT NULL"""


def trend_findings(spark, sf):
    """Insights of the two most common topics per date, some citing unknown or foreign items."""
    s = _s(spark, sf)
    lead = trends.top_topics(s, 2)
    first = s.join(lead.select("report_date", "topic", F.col("rank").alias("section_index")), ["report_date", "topic"])
    from dayline.operators.groups import top_per_group

    rows = top_per_group(first, ["report_date", "topic"], [F.col("pos")], 3, "k").groupBy("report_date", "topic", "section_index").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "id"))), lambda v: v["id"]).alias("item_ids"))
    insights = rows.select("report_date", "section_index", F.col("topic").alias("title"), F.lit("").alias("summary"), F.lit("technology").alias("scope"), F.when(F.size("item_ids") == 3, "continuing").otherwise("heating_up").alias("trend_state"),
                           F.when(F.size("item_ids") == 2, F.concat("item_ids", F.array(F.lit("structured-none")))).otherwise(F.col("item_ids")).alias("item_ids"), F.lit(False).alias("historical_context_used"))
    return consistency.trend_findings(insights, s).select(DAY(), "section_index", "severity", "message")


_TRENDS = f"""WITH {STRUCTURED_SQL}, t AS (SELECT report_date, topic, count(*) AS n, min(pos) AS p FROM structured GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY report_date ORDER BY n DESC, p) AS si FROM t),
e AS (SELECT s.*, si, t.n AS topic_n, row_number() OVER (PARTITION BY s.report_date, s.topic ORDER BY s.pos) AS k FROM structured s JOIN r ON r.report_date = s.report_date AND r.topic = s.topic AND si <= 2 JOIN t ON t.report_date = s.report_date AND t.topic = s.topic),
g AS (SELECT report_date, topic, si, count(*) AS c, min(importance_score) AS low, any_value(topic_n) AS topic_n, max(importance_score) AS top, CASE WHEN count(DISTINCT impact_scope) = 1 THEN min(impact_scope) ELSE first(impact_scope ORDER BY importance_score DESC, pos) END AS dom FROM e WHERE k <= 3 GROUP BY ALL)
SELECT {DAY_SQL}, si AS section_index, 'error' AS severity, 'unknown evidence item structured-none' AS message FROM g WHERE c = 2
UNION ALL SELECT {DAY_SQL}, si, 'warning', 'scope technology differs from evidence scope ' || dom FROM g WHERE dom <> 'technology'
UNION ALL SELECT {DAY_SQL}, si, 'warning', 'continuing requires historical context or memory signals' FROM g WHERE c = 3
UNION ALL SELECT {DAY_SQL}, si, 'warning', 'single weak item used as trend evidence for ' || topic FROM g WHERE topic_n = 1 AND top < 70
UNION ALL SELECT {DAY_SQL}, si, 'warning', 'heating_up is weakly supported by a single low-score item' FROM g WHERE c = 1 AND low < 75
UNION ALL SELECT {DAY_SQL}, 0, 'warning', 'top topic ' || lower(topic) || ' is not covered by trend_insights' FROM r WHERE si = 3"""


def memory_findings(spark, sf):
    index = read_index(index_documents(spark, sf), "body")
    return consistency.memory_findings(index, _s(spark, sf)).groupBy("severity", "message").agg(F.count(F.lit(1)).alias("n"))


_MEMORY = f"""WITH {STRUCTURED_SQL} SELECT 'warning' AS severity, 'missing published_at' AS message, count(*) AS n FROM structured UNION ALL SELECT 'warning', 'missing summary', count(*) FROM structured
UNION ALL SELECT 'warning', 'current topic ' || lower(topic) || ' is missing from memory', 1 FROM structured GROUP BY topic HAVING count_if(pos % 2 = 0) = 0
UNION ALL SELECT 'warning', 'topic key contains entry topic ' || topic, count(*) FROM structured WHERE pos % 2 = 1 AND contains(topic, ' ') GROUP BY topic"""

PLANS = {
    "va1_schema_issues": (issues, _ISSUES),
    "va2_generic_rationales": (generic, _GENERIC),
    "ag13_validation_summary": (verdict, _VERDICT),
    "pf5_outside_report_date": (outside, f"WITH {RAW_SQL} SELECT id AS item_id FROM raw WHERE published_at::DATE <> report_date"),
    "va9_record_validation": (assessments, _ASSESS),
    "va3_evidence_audit": (item_audit, f"WITH {STRUCTURED_SQL} SELECT {DAY_SQL}, id AS item_id, ({_ST} = 'supported')::INT AS supported_evidence_count, CASE WHEN {_ST} = 'supported' THEN 'supported' ELSE 'missing_quote' END AS status FROM structured"),
    "j5_claim_containment": (claim_audit, f"WITH {STRUCTURED_SQL} SELECT id AS item_id, {_ST} AS status FROM structured"),
    "j6_insight_sources": (insight_sources, _INS_SOURCES),
    "va4_insight_audit": (insight_audit, _INS_AUDIT),
    "ag14_audit_summary": (audit_totals, _TOTALS),
    "j8_level_repair": (level_repair, _REPAIR),
    "va5_item_findings": (item_findings, _FINDINGS),
    "va6_level_findings": (level_findings, _LEVEL),
    "va7_trend_findings": (trend_findings, _TRENDS),
    "va8_memory_findings": (memory_findings, _MEMORY),
}
__all__ = ["PLANS", "sql_list"]
