"""Dimensions, facts and the daily rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.scalar import (
    count_event,
    for_event,
    masked_email,
    money_sum,
    ratio,
    seconds_between,
)

AI_CALL = "ai_response_generated"


def dim_accounts(accounts: DataFrame) -> DataFrame:
    return accounts.select(
        "account_id",
        "account_name",
        "plan",
        "industry",
        "seat_limit",
        F.col("created_at").alias("account_created_at"),
    )


def dim_users(users: DataFrame, accounts: DataFrame) -> DataFrame:
    """Users with their account's name; the full e-mail address stays in the raw layer."""
    names = accounts.select("account_id", "account_name")
    return users.join(names, "account_id", "left").select(
        "user_id",
        "account_id",
        "account_name",
        masked_email(F.col("email")).alias("email_masked"),
        "role",
        "status",
        F.col("created_at").alias("user_created_at"),
    )


def ai_calls(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_name") == AI_CALL)


def model_rates(calls: DataFrame) -> DataFrame:
    """Observed cost per token of each model, over its calls with a known cost."""
    return (
        calls.filter(F.col("cost_usd").isNotNull() & (F.col("total_tokens") > 0))
        .groupBy("model")
        .agg(ratio(money_sum(F.col("cost_usd")), F.sum("total_tokens")).alias("usd_per_token"))
    )


def fact_ai_interactions(events: DataFrame, rates: DataFrame) -> DataFrame:
    """One row per AI call, a missing cost estimated from the model's observed rate.

    ``rates`` is ``model_rates`` of the calls, best as a written table: Spark then knows
    its size, broadcasts it if that is small and else splits a hot model's calls.
    """
    calls = ai_calls(events)
    imputed = F.round(F.col("usd_per_token") * F.col("total_tokens"), 6)
    return calls.join(rates, "model", "left").select(
        F.col("event_id").alias("interaction_id"),
        "event_ts",
        "event_date",
        "account_id",
        "user_id",
        "session_id",
        "workflow",
        "model",
        "prompt_tokens",
        "completion_tokens",
        "total_tokens",
        "latency_ms",
        "cost_usd",
        F.coalesce(F.col("cost_usd"), imputed).alias("cost_usd_estimated"),
        F.col("cost_usd").isNull().alias("is_cost_estimated"),
        "accepted",
        "is_late",
    )


def session_counts() -> list[Column]:
    """What is counted and added up per session; every buffer is of fixed width."""
    name = F.col("event_name")
    return [
        F.min("event_ts").alias("started_at"),
        F.max("event_ts").alias("ended_at"),
        F.count("*").alias("event_count"),
        count_event(name, "prompt_submitted").alias("prompts_submitted"),
        count_event(name, AI_CALL).alias("ai_responses"),
        count_event(name, "response_accepted").alias("responses_accepted"),
        count_event(name, "response_rejected").alias("responses_rejected"),
        count_event(name, "workflow_completed").alias("workflows_completed"),
        count_event(name, "error_raised").alias("errors_raised"),
        F.sum("total_tokens").alias("total_tokens"),
        money_sum(F.col("cost_usd")).alias("cost_usd"),
        F.bool_or(name == "session_started").alias("has_session_started"),
        F.bool_or(name == "prompt_submitted").alias("has_prompt_submitted"),
        F.bool_or(name == AI_CALL).alias("has_ai_response"),
        F.bool_or(name == "response_accepted").alias("has_response_accepted"),
        F.bool_or(name == "workflow_completed").alias("has_workflow_completed"),
    ]


def session_origin() -> list[Column]:
    """The account and user of a session's earliest event, and its workflow."""
    owner = F.min_by(F.struct("account_id", "user_id"), F.struct("event_ts", "event_id"))
    return [owner.alias("owner"), F.max("workflow").alias("workflow")]


def fact_sessions(events: DataFrame) -> DataFrame:
    """One row per session, owned by the account and user of its earliest event.

    The counts are a hash aggregate. Owner and workflow are strings, whose aggregate has to
    sort; it has a few narrow columns and joins the counts where both have been shuffled.
    """
    inside = events.filter(F.col("session_id").isNotNull())
    counts = inside.groupBy("session_id").agg(*session_counts())
    origin = inside.groupBy("session_id").agg(*session_origin())
    return session_columns(counts.join(origin, "session_id"))


def session_columns(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        "session_id",
        "owner.account_id",
        "owner.user_id",
        "started_at",
        "ended_at",
        F.to_date("started_at").alias("session_date"),
        "workflow",
        "event_count",
        "prompts_submitted",
        "ai_responses",
        "responses_accepted",
        "responses_rejected",
        "workflows_completed",
        "errors_raised",
        "total_tokens",
        "cost_usd",
        "has_session_started",
        "has_prompt_submitted",
        "has_ai_response",
        "has_response_accepted",
        "has_workflow_completed",
        seconds_between(F.col("started_at"), F.col("ended_at")).alias("duration_seconds"),
    )


def account_days(events: DataFrame) -> DataFrame:
    """Event counts and sums per account and day, with distinct users and sessions.

    Events are first summed per user and session, which collapses them before the shuffle
    and spreads a hot account; the distinct counts then run on those far fewer rows.
    """
    name = F.col("event_name")
    counts = (
        "events",
        "prompts_submitted",
        "ai_interactions",
        "responses_accepted",
        "responses_rejected",
        "workflows_completed",
        "errors_raised",
    )
    per_session = events.groupBy("event_date", "account_id", "user_id", "session_id").agg(
        F.count("*").alias("events"),
        count_event(name, "prompt_submitted").alias("prompts_submitted"),
        count_event(name, AI_CALL).alias("ai_interactions"),
        count_event(name, "response_accepted").alias("responses_accepted"),
        count_event(name, "response_rejected").alias("responses_rejected"),
        count_event(name, "workflow_completed").alias("workflows_completed"),
        count_event(name, "error_raised").alias("errors_raised"),
        F.sum(for_event(name, AI_CALL, F.col("total_tokens"))).alias("ai_total_tokens"),
        money_sum(for_event(name, AI_CALL, F.col("cost_usd"))).alias("ai_cost_usd"),
        F.count_if((name == AI_CALL) & F.col("cost_usd").isNull()).alias("uncosted_interactions"),
    )
    return per_session.groupBy("event_date", "account_id").agg(
        F.count_distinct("user_id").alias("active_users"),
        F.count_distinct("session_id").alias("sessions"),
        *(F.sum(column).alias(column) for column in counts),
        F.sum("ai_total_tokens").alias("ai_total_tokens"),
        F.coalesce(money_sum(F.col("ai_cost_usd")), F.lit(0.0)).alias("ai_cost_usd"),
        F.sum("uncosted_interactions").alias("uncosted_interactions"),
    )


def daily_account_metrics(
    events: DataFrame, interactions: DataFrame, accounts: DataFrame
) -> DataFrame:
    """One row per day and account with at least one valid event."""
    estimated = interactions.groupBy("event_date", "account_id").agg(
        money_sum(F.col("cost_usd_estimated")).alias("estimated")
    )
    names = accounts.select("account_id", "account_name", "plan")
    return (
        account_days(events)
        .join(estimated, ["event_date", "account_id"], "left")
        .join(names, "account_id", "left")
        .select(
            "event_date",
            "account_id",
            "account_name",
            "plan",
            "active_users",
            "sessions",
            "events",
            "prompts_submitted",
            "ai_interactions",
            "responses_accepted",
            "responses_rejected",
            "workflows_completed",
            "errors_raised",
            "ai_total_tokens",
            "ai_cost_usd",
            "uncosted_interactions",
            F.round(F.coalesce("estimated", F.lit(0.0)), 6).alias("ai_cost_usd_estimated"),
        )
    )
