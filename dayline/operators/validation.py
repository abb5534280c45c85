"""Record validation: rule tables to issue rows, never exceptions inside executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayline import lexicon
from dayline.functions.text import strip
from dayline.functions.values import report_day

Rule = tuple[str, str, Column, str]  # field, code, violated, message


def _empty(name: str) -> Column:
    return strip(F.col(name)) == ""


def _not_in(name: str, allowed) -> Column:
    return ~F.coalesce(F.col(name), F.lit("")).isin(*allowed)


def structured_rules() -> list[Rule]:
    """Rules of a structured item: required texts, enumerations, score range, lists."""
    rules: list[Rule] = [
        (n, "missing", _empty(n), "value must not be empty")
        for n in ("id", "title", "source", "url", "topic", "summary", "importance_rationale", "risk_rationale", "opportunity_rationale", "content_hash")
    ]
    rules.append(("published_at", "missing", F.col("published_at").isNull(), "value is required"))
    domains = {
        "source_type": lexicon.SOURCE_TYPES, "language": lexicon.LANGUAGES, "topic": lexicon.TOPICS, "event_type": lexicon.EVENT_TYPES, "sentiment": lexicon.SENTIMENTS,
        "impact_scope": lexicon.IMPACT_SCOPES, "risk_level": lexicon.LEVELS, "opportunity_level": lexicon.LEVELS,
    }
    rules += [(n, "enum", _not_in(n, allowed), "value is outside its enumeration") for n, allowed in domains.items()]
    score = F.col("importance_score")
    rules.append(("importance_score", "range", score.isNull() | ~score.between(0, 100), "score must be between 0 and 100"))
    for n in ("entities", "key_points", "evidence"):
        rules.append((n, "blank_element", F.exists(F.coalesce(n, F.array().cast("array<string>")), lambda v: strip(v) == ""), "list elements must not be empty"))
    return rules


def rationale_rules() -> list[Rule]:
    """A rationale is generic when it is a stock phrase or shorter than 8 characters without blanks."""
    def generic(name: str) -> Column:
        text = F.replace(strip(F.col(name)), F.lit(" "), F.lit(""))
        return text.isin(*lexicon.GENERIC_RATIONALES) | (F.length(text) < 8)

    return [
        (n, "generic_rationale", generic(n), "rationale must explain the judgment with concrete, reader-facing evidence")
        for n in ("importance_rationale", "risk_rationale", "opportunity_rationale")
    ]


def assessment_rules() -> list[Rule]:
    score = F.col("relevance_score")
    rules: list[Rule] = [(n, "missing", _empty(n), "value must not be empty") for n in ("id", "title", "url", "content_hash", "relevance_category", "decision_source")]
    rules.append(("relevance_score", "range", score.isNull() | ~score.between(0, 100), "score must be between 0 and 100"))
    rules.append(("published_at", "missing", F.col("published_at").isNull(), "value is required"))
    return rules


def issues(items: DataFrame, rules: list[Rule], severity: str = "error") -> DataFrame:
    """One row per violated rule; a projection and an explode, no shuffle."""
    checks = [F.when(bad, F.struct(F.lit(field).alias("field"), F.lit(code).alias("code"), F.lit(message).alias("message"))) for field, code, bad, message in rules]
    carry = [c for c in ("report_date",) if c in items.columns]
    return items.select(*carry, F.col("id").alias("item_id"), F.lit(severity).alias("severity"), F.explode(F.array_compact(F.array(*checks))).alias("i")).select(*carry, "item_id", "severity", "i.*")


def split_valid(items: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """Valid rows and issue rows of the same input."""
    broken = F.lit(False)
    for _, _, bad, _ in rules:
        broken = broken | F.coalesce(bad, F.lit(True))
    return items.where(~broken), issues(items, rules)


def validation_summary(found: DataFrame, items: DataFrame) -> DataFrame:
    """Issue and error counts and validity per report date, including dates without issues."""
    counted = found.groupBy("report_date").agg(F.count(F.lit(1)).alias("issue_count"), F.count_if(F.col("severity") == "error").alias("error_count"))
    totals = items.groupBy("report_date").agg(F.count(F.lit(1)).alias("total_items"))
    return totals.join(counted, "report_date", "left").fillna(0).withColumn("is_valid", F.col("error_count") == 0)


def outside_report_date(items: DataFrame, timezone: str = "UTC") -> DataFrame:
    """Items to quarantine: published on another day than their report date."""
    return items.where(report_day(F.col("published_at"), timezone) != F.col("report_date")).select("report_date", F.col("id").alias("item_id"), "published_at")
