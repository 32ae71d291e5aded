"""The queries behind the dashboard: headline numbers, series and the rejection views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.functions.scalar import money_sum, percent, reason_bucket


def kpi_summary(
    events: DataFrame, sessions: DataFrame, interactions: DataFrame, daily: DataFrame
) -> DataFrame:
    """One row of headline numbers; completion needs no earlier funnel stage but the start."""
    started = F.col("has_session_started")
    parts = [
        events.agg(F.count_distinct("user_id").alias("users")),
        sessions.agg(
            F.count("*").alias("sessions"),
            percent(
                F.count_if(started & F.col("has_workflow_completed")), F.count_if(started), 1
            ).alias("completion"),
        ),
        interactions.agg(F.count("*").alias("interactions")),
        daily.agg(F.round(money_sum(F.col("ai_cost_usd_estimated")), 2).alias("cost")),
    ]
    # Every part is one row.
    joined = reduce(lambda left, right: left.crossJoin(F.broadcast(right)), parts)
    return joined.select("users", "sessions", "interactions", "cost", "completion")


def daily_cost_series(daily: DataFrame) -> DataFrame:
    """Estimated cost per day and account, days without AI calls included."""
    return daily.select("event_date", "account_name", "ai_cost_usd_estimated").orderBy(
        "event_date", F.col("account_name").asc_nulls_last()
    )


def latency_long(latency: DataFrame) -> DataFrame:
    """The latency report with one row per model and metric."""
    wide = latency.select(
        "model",
        F.col("median_latency_ms").alias("median_ms"),
        F.col("p95_latency_ms").alias("p95_ms"),
    )
    return wide.unpivot("model", ["median_ms", "p95_ms"], "metric", "ms")


def reject_reason_counts(rejected: DataFrame) -> DataFrame:
    return (
        rejected.groupBy(reason_bucket(F.col("rejection_reason")).alias("reason"))
        .agg(F.count("*").alias("row_count"))
        .orderBy(F.desc("row_count"), "reason")
    )


def reject_listing(rejected: DataFrame) -> DataFrame:
    """Every rejected row in input order."""
    return rejected.select(
        "rejection_stage", "rejection_reason", "event_id", "source_file", "line_number"
    ).orderBy("source_file", "line_number")
