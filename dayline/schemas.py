"""Explicit schemas of the records the operators exchange (no inference anywhere)."""

from __future__ import annotations

RAW_ITEM = (
    "id STRING, title STRING, source STRING, url STRING, published_at TIMESTAMP, source_type STRING, "
    "language STRING, summary STRING, content STRING, metadata MAP<STRING,STRING>"
)
EVIDENCE = "STRUCT<source_item_id:STRING,evidence_field:STRING,evidence_quote:STRING,claim:STRING>"
STRUCTURED_ITEM = (
    "id STRING, title STRING, source STRING, url STRING, published_at TIMESTAMP, source_type STRING, "
    "language STRING, topic STRING, entities ARRAY<STRING>, event_type STRING, summary STRING, "
    "key_points ARRAY<STRING>, sentiment STRING, impact_scope STRING, importance_score INT, "
    "importance_rationale STRING, risk_level STRING, risk_rationale STRING, opportunity_level STRING, "
    f"opportunity_rationale STRING, evidence ARRAY<STRING>, evidence_sources ARRAY<{EVIDENCE}>, content_hash STRING"
)
PAYLOAD = (
    "source_name STRING, source_url STRING, fetched_at TIMESTAMP, status INT, content_type STRING, body STRING"
)
MEMORY_ENTRY = (
    "memory_item_id STRING, id STRING, validated_item_id STRING, source_item_id STRING, topic STRING, "
    "title STRING, source STRING, url STRING, published_at TIMESTAMP, content_hash STRING, summary STRING, "
    "entities ARRAY<STRING>, event_type STRING, importance_score INT, risk_level STRING, "
    "opportunity_level STRING, metadata MAP<STRING,STRING>"
)
MODEL_CALL = (
    "run_id STRING, step_name STRING, item_id STRING, attempt INT, model STRING, success BOOLEAN, "
    "prompt_tokens BIGINT, completion_tokens BIGINT, total_tokens BIGINT, cost_usd DOUBLE, elapsed_ms BIGINT, "
    "error STRING"
)
TRACE_EVENT = (
    "event_type STRING, timestamp TIMESTAMP, run_id STRING, step_name STRING, duration_ms BIGINT, "
    "metadata STRING, error STRUCT<type:STRING,message:STRING>"
)
PRICE = "provider STRING, model STRING, input_price DOUBLE, output_price DOUBLE, unit_tokens INT, currency STRING"
