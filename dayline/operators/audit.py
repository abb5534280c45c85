"""Evidence audits: every claim against the quoted text it cites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayline.functions.arrow import match_text
from dayline.operators.groups import lookup

FIELDS = ("title", "summary", "content")
SUPPORTED, MISSING_SOURCE, MISSING_QUOTE, INVALID_FIELD = "supported", "missing_source", "missing_quote", "invalid_field"


def raw_id(c: Column) -> Column:
    return F.regexp_replace(c, "^structured-", "raw-")


def quotable(sources: DataFrame, *carry: str) -> DataFrame:
    """Sources with their fields in the form quotes are compared in."""
    return sources.select(*carry, F.col("id").alias("source_item_id"), *[match_text(F.coalesce(F.col(f), F.lit(""))).alias(f"m_{f}") for f in FIELDS])


def claims_of(items: DataFrame) -> DataFrame:
    """One row per evidence source; items without any fall back to their plain evidence list."""
    explicit = items.where(F.size("evidence_sources") > 0).select(
        "report_date", F.col("id").alias("item_id"), F.posexplode("evidence_sources").alias("at", "s")
    ).select("report_date", "item_id", "at", F.lit(False).alias("legacy"), "s.source_item_id", "s.evidence_field", "s.evidence_quote", "s.claim")
    legacy = items.where(F.size("evidence_sources") == 0).select(
        "report_date", F.col("id").alias("item_id"), F.posexplode("evidence").alias("at", "evidence_quote"), F.col("summary").alias("claim")
    ).select("report_date", "item_id", "at", F.lit(True).alias("legacy"), raw_id(F.col("item_id")).alias("source_item_id"), F.lit("").alias("evidence_field"), "evidence_quote", "claim")
    return explicit.unionByName(legacy)


def audit_claims(claims: DataFrame, sources: DataFrame) -> DataFrame:
    """Status of each claim: is the quote in the named field of its source?

    Each source is normalised once, before the join, however many claims cite it.
    """
    normal = claims.withColumns({"m_quote": match_text(F.coalesce("evidence_quote", F.lit(""))), "cited_id": F.col("source_item_id")})
    texts = quotable(sources).withColumnRenamed("source_item_id", "cited_id").withColumn("found", F.lit(True))
    direct = lookup(normal, texts, ["cited_id"], "left")
    # A structured id that is no source id itself stands for its raw item.
    retry = direct.where(F.col("found").isNull() & F.col("source_item_id").startswith("structured-")).select(*normal.columns)
    again = lookup(retry.withColumn("cited_id", raw_id(F.col("source_item_id"))), texts, ["cited_id"], "left")
    settled = direct.where(F.col("found").isNotNull() | ~F.col("source_item_id").startswith("structured-")).unionByName(again)
    has = lambda f: (F.col("m_quote") != "") & F.contains(F.col(f"m_{f}"), F.col("m_quote"))
    field = F.trim("evidence_field")
    in_field = F.when(field == "title", has("title")).when(field == "summary", has("summary")).when(field == "content", has("content"))
    legacy_field = F.when(has("content"), "content").when(has("summary"), "summary").when(has("title"), "title")
    status = (
        F.when(F.col("found").isNull(), MISSING_SOURCE)
        .when(F.col("legacy"), F.when(legacy_field.isNotNull(), SUPPORTED).otherwise(MISSING_QUOTE))
        .when(~field.isin(*FIELDS), INVALID_FIELD)
        .when(in_field, SUPPORTED)
        .otherwise(MISSING_QUOTE)
    )
    matched = F.when(F.col("found").isNull(), "").when(F.col("legacy"), F.coalesce(legacy_field, F.lit(""))).when(field.isin(*FIELDS), field).otherwise("")
    return settled.select("report_date", "item_id", "at", "source_item_id", "evidence_field", "evidence_quote", "claim", status.alias("status"), matched.alias("matched_field"))


def audit_items(claim_audit: DataFrame, items: DataFrame) -> DataFrame:
    """Item verdicts: supported when at least one claim is."""
    counted = claim_audit.groupBy("report_date", "item_id").agg(F.count_if(F.col("status") == SUPPORTED).alias("supported_evidence_count"), F.count(F.lit(1)).alias("evidence_count"))
    base = items.select("report_date", F.col("id").alias("item_id"))
    return base.join(counted, ["report_date", "item_id"], "left").fillna(0).withColumn("status", F.when(F.col("supported_evidence_count") > 0, SUPPORTED).otherwise(MISSING_QUOTE))


# --- report claims ---------------------------------------------------------------
# Insights are one long table (report_date, section, section_index, title, item_ids,
# sources): the section is a column, so five report sections share one code path.
def insight_claims(insights: DataFrame) -> DataFrame:
    return insights.select("report_date", "section", "section_index", "item_ids", F.posexplode("sources").alias("at", "s")).select("report_date", "section", "section_index", "item_ids", "at", "s.*")


def supported_insight_sources(insights: DataFrame, items: DataFrame) -> DataFrame:
    """Explicit insight sources that equal an evidence source of a referenced item.

    Equality is on (item, source id with structured- read as raw-, field, normalised quote): one equi-join.
    """
    rows = insight_claims(insights).withColumn("item_id", F.explode("item_ids"))
    left = rows.select(
        "report_date", "section", "section_index", "at", "item_id", "source_item_id", "evidence_field", "evidence_quote", "claim",
        raw_id(F.col("source_item_id")).alias("k_source"), match_text("evidence_quote").alias("k_quote"),
    )
    # The source must be the item itself (structured or raw id).
    left = left.where((F.col("source_item_id") == F.col("item_id")) | (F.col("k_source") == raw_id(F.col("item_id"))))
    explicit = items.select("report_date", F.col("id").alias("item_id"), F.explode("evidence_sources").alias("s")).select(
        "report_date", "item_id", raw_id(F.col("s.source_item_id")).alias("k_source"), F.col("s.evidence_field").alias("evidence_field"), match_text("s.evidence_quote").alias("k_quote")
    ).distinct()
    keys = ["report_date", "item_id", "k_source", "evidence_field", "k_quote"]
    by_source = left.join(explicit, keys, "left_semi")
    plain = items.where(F.size("evidence_sources") == 0).select("report_date", F.col("id").alias("item_id"), F.explode("evidence").alias("q")).select("report_date", "item_id", match_text("q").alias("k_quote")).distinct()
    by_quote = left.join(plain, ["report_date", "item_id", "k_quote"], "left_semi")
    return by_source.unionByName(by_quote).dropDuplicates(["report_date", "section", "section_index", "at"]).drop("k_source", "k_quote")


def inherited_insight_sources(insights: DataFrame, items: DataFrame) -> DataFrame:
    """Insights without explicit sources inherit the evidence of the items they reference."""
    bare = insights.where(F.size("sources") == 0).select("report_date", "section", "section_index", F.posexplode("item_ids").alias("at", "item_id"))
    evidence = items.select(
        "report_date", F.col("id").alias("item_id"),
        F.when(F.size("evidence_sources") > 0, F.transform("evidence_sources", lambda s: F.struct(s["source_item_id"].alias("source_item_id"), s["evidence_field"].alias("evidence_field"), s["evidence_quote"].alias("evidence_quote"), s["claim"].alias("claim"))))
        .otherwise(F.transform(F.slice("evidence", 1, 1), lambda q: F.struct(F.col("id").alias("source_item_id"), F.lit("evidence").alias("evidence_field"), q.alias("evidence_quote"), F.col("summary").alias("claim")))).alias("e"),
    )
    return lookup(bare, evidence, ["report_date", "item_id"], "inner").select("report_date", "section", "section_index", "at", "item_id", F.explode("e").alias("s")).select("report_date", "section", "section_index", "at", "item_id", "s.*")


def audit_insights(insights: DataFrame, items: DataFrame) -> DataFrame:
    """Verdict per insight with its number of supported sources; unsupported ones are to be dropped."""
    explicit = supported_insight_sources(insights, items)
    found = explicit.unionByName(inherited_insight_sources(insights, items)).groupBy("report_date", "section", "section_index").agg(F.count(F.lit(1)).alias("supported_evidence_count"))
    return insights.select("report_date", "section", "section_index", "title").join(found, ["report_date", "section", "section_index"], "left").fillna(0, ["supported_evidence_count"]).withColumn(
        "status", F.when(F.col("supported_evidence_count") > 0, SUPPORTED).otherwise(MISSING_QUOTE)
    )


def audit_summary(records: DataFrame) -> DataFrame:
    """Claims per audit type with a total row (``records``: report_date, audit_type, status)."""
    return records.rollup("report_date", "audit_type").agg(
        F.count(F.lit(1)).alias("total_claims"), F.count_if(F.col("status") == SUPPORTED).alias("supported_claims"), F.count_if(F.col("status") != SUPPORTED).alias("unsupported_claims"), F.grouping_id().alias("_level"),
    ).where("_level < 3").withColumn("audit_type", F.when(F.col("_level") == 1, "all").otherwise(F.col("audit_type"))).drop("_level")


# --- level consistency -----------------------------------------------------------
def check_level_references(insights: DataFrame, items: DataFrame, level: str) -> DataFrame:
    """Outcome of each item an insight cites: kept, blocked (level too low) or unknown."""
    rows = insights.select("report_date", "section", "section_index", F.col("level").alias("insight_level"), F.explode("item_ids").alias("item_id"))
    levels = items.select("report_date", F.col("id").alias("item_id"), F.col(level).alias("item_level"))
    joined = lookup(rows, levels, ["report_date", "item_id"], "left")
    raised = lambda c: F.col(c).isin("medium", "high")
    return joined.withColumn("outcome", F.when(F.col("item_level").isNull(), "unknown").when(raised("insight_level") & ~raised("item_level"), "blocked").otherwise("kept"))


def repair_level_insights(insights: DataFrame, items: DataFrame, level: str) -> DataFrame:
    """Insights after dropping inconsistent references: kept as is, trimmed or removed, with the reason."""
    checked = check_level_references(insights, items, level)
    ids = checked.groupBy("report_date", "section", "section_index").agg(
        F.count_if(F.col("outcome") == "kept").alias("kept_items"), F.count_if(F.col("outcome") != "kept").alias("removed_items")
    )
    kept = checked.where("outcome = 'kept'").select("report_date", "section", "section_index", raw_id(F.col("item_id")).alias("k")).distinct()
    sources = insight_claims(insights).select("report_date", "section", "section_index", raw_id(F.col("source_item_id")).alias("k"))
    kept_sources = sources.join(kept, ["report_date", "section", "section_index", "k"], "left_semi").groupBy("report_date", "section", "section_index").agg(F.count(F.lit(1)).alias("kept_sources"))
    key = ["report_date", "section", "section_index"]
    out = insights.select(*key, "title", F.col("level")).join(ids, key, "left").join(kept_sources, key, "left").fillna(0, ["kept_items", "removed_items", "kept_sources"])
    gone = (F.col("kept_items") == 0) | (F.col("kept_sources") == 0)
    return out.withColumns(
        {
            "outcome": F.when(gone, "removed").when(F.col("removed_items") > 0, "trimmed").otherwise("kept"),
            "reason": F.when(gone, "no matching evidence items remain after level consistency repair").when(F.col("removed_items") > 0, "removed inconsistent or unknown evidence item references"),
        }
    )
