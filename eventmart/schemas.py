"""Column names, types and the event contract shared by every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# The event names a producer may send.
EVENT_NAMES = (
    "user_invited",
    "user_signed_up",
    "session_started",
    "prompt_submitted",
    "ai_response_generated",
    "response_accepted",
    "response_rejected",
    "workflow_completed",
    "error_raised",
)

# These happen outside a product session.
SESSIONLESS_EVENTS = ("user_invited", "user_signed_up")

# Funnel stages in order.
FUNNEL_STAGES = (
    "session_started",
    "prompt_submitted",
    "ai_response_generated",
    "response_accepted",
    "workflow_completed",
)

# Top-level keys of an event object kept as string columns.
EVENT_KEYS = (
    "event_id",
    "event_ts",
    "received_ts",
    "account_id",
    "user_id",
    "session_id",
    "event_name",
)

# The properties contract, as (JSON key, column name, type).
TEXT, INTEGER, NUMBER, FLAG = "text", "integer", "number", "flag"
PROPERTIES = (
    ("workflow", "workflow", TEXT),
    ("model", "model", TEXT),
    ("prompt_tokens", "prompt_tokens", INTEGER),
    ("completion_tokens", "completion_tokens", INTEGER),
    ("latency_ms", "latency_ms", INTEGER),
    ("cost_usd", "cost_usd", NUMBER),
    ("accepted", "accepted", FLAG),
    ("duration_ms", "duration_ms", INTEGER),
    ("prompt_length_chars", "prompt_length_chars", INTEGER),
    ("device", "device", TEXT),
    ("error_code", "error_code", TEXT),
    ("reason", "rejected_reason_text", TEXT),
    ("invite_channel", "invite_channel", TEXT),
)
SPARK_TYPE = {TEXT: "string", INTEGER: "int", NUMBER: "double", FLAG: "boolean"}
METRICS = tuple(column for _, column, kind in PROPERTIES if kind in (INTEGER, NUMBER))

LATE_AFTER_SECONDS = 3600

ACCOUNTS = T.StructType(
    [
        T.StructField("account_id", T.StringType()),
        T.StructField("account_name", T.StringType()),
        T.StructField("plan", T.StringType()),
        T.StructField("industry", T.StringType()),
        T.StructField("seat_limit", T.IntegerType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

USERS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("role", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

# One row per physical line; ``ingest_reason`` is null for a usable event.
BRONZE_COLUMNS = (
    *EVENT_KEYS,
    "properties",
    "has_wide_misfit",
    "raw_line",
    "ingest_reason",
    "source_file",
    "line_number",
    "ingested_at",
)

# Table schemas as DDL, in the column order users see.
CLASSIFIED = (
    "event_id string, event_ts timestamp_ntz, event_ts_raw string, received_ts timestamp_ntz, "
    "account_id string, user_id string, session_id string, event_name string, "
    + ", ".join(f"{column} {SPARK_TYPE[kind]}" for _, column, kind in PROPERTIES)
    + ", raw_payload string, source_file string, line_number bigint, "
    "ingested_at timestamp_ntz, user_home_account_id string, rejection_reason string"
)


def column_names(ddl: str) -> list[str]:
    return [column.split()[0] for column in ddl.split(", ")]


CLASSIFIED_COLUMNS = column_names(CLASSIFIED)

AI_INTERACTIONS = (
    "interaction_id string, event_ts timestamp_ntz, event_date date, account_id string, "
    "user_id string, session_id string, workflow string, model string, prompt_tokens int, "
    "completion_tokens int, total_tokens int, latency_ms int, cost_usd double, "
    "cost_usd_estimated double, is_cost_estimated boolean, accepted boolean, is_late boolean"
)

SESSIONS = (
    "session_id string, account_id string, user_id string, started_at timestamp_ntz, "
    "ended_at timestamp_ntz, session_date date, workflow string, event_count bigint, "
    "prompts_submitted bigint, ai_responses bigint, responses_accepted bigint, "
    "responses_rejected bigint, workflows_completed bigint, errors_raised bigint, "
    "total_tokens bigint, cost_usd double, has_session_started boolean, "
    "has_prompt_submitted boolean, has_ai_response boolean, has_response_accepted boolean, "
    "has_workflow_completed boolean, duration_seconds bigint"
)
