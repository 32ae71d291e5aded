"""The analytic reports. Each takes the marts it reads and returns an ordered DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventmart.functions.scalar import count_event, money_sum, percent, ratio
from eventmart.operators.quantiles import histogram_quantiles
from eventmart.plans import monitoring
from eventmart.schemas import FUNNEL_STAGES

MIN_EVENTS_FOR_ERROR_RATE = 10


def daily_active_users(daily: DataFrame) -> DataFrame:
    return daily.select("event_date", "account_id", "account_name", "active_users").orderBy(
        "event_date", "account_id"
    )


def ai_by_workflow_model(interactions: DataFrame) -> DataFrame:
    return (
        interactions.groupBy("workflow", "model")
        .agg(F.count("*").alias("ai_interactions"))
        .orderBy(
            F.desc("ai_interactions"),
            F.col("workflow").asc_nulls_last(),
            F.col("model").asc_nulls_last(),
        )
    )


def latency_by_model(interactions: DataFrame) -> DataFrame:
    """Median and 95th percentile of the latency, interpolated and exact."""
    histogram = interactions.groupBy("model", "latency_ms").agg(F.count("*").alias("calls"))
    return (
        histogram_quantiles(
            histogram,
            "model",
            "latency_ms",
            "calls",
            {"median": 0.5, "p95": 0.95},
            F.sum("calls").alias("interactions"),
        )
        .select(
            "model",
            "interactions",
            F.round("median").alias("median_latency_ms"),
            F.round("p95").alias("p95_latency_ms"),
        )
        .orderBy(F.desc("interactions"), F.col("model").asc_nulls_last())
    )


def daily_cost_by_account(daily: DataFrame) -> DataFrame:
    """Reported and estimated cost of the days with AI calls."""
    return (
        daily.filter(F.col("ai_interactions") > 0)
        .select(
            "event_date",
            "account_id",
            "account_name",
            F.round("ai_cost_usd", 4).alias("ai_cost_usd"),
            F.round("ai_cost_usd_estimated", 4).alias("ai_cost_usd_estimated"),
            "ai_interactions",
            "uncosted_interactions",
        )
        .orderBy("event_date", F.desc("ai_cost_usd"), "account_id")
    )


def funnel_stages(sessions: DataFrame) -> DataFrame:
    """``(stage_order, stage, sessions)``: started sessions that reached each stage.

    A stage counts only with all stages before it; their order in time does not matter.
    One pass over the sessions, then one row turned into five.
    """
    flags = {
        "session_started": "has_session_started",
        "prompt_submitted": "has_prompt_submitted",
        "ai_response_generated": "has_ai_response",
        "response_accepted": "has_response_accepted",
        "workflow_completed": "has_workflow_completed",
    }
    reached = F.lit(True)
    counts, rows = [], []
    for order, stage in enumerate(FUNNEL_STAGES, start=1):
        reached = reached & F.col(flags[stage])
        counts.append(F.count_if(reached).alias(stage))
        rows.append(
            F.struct(
                F.lit(order).alias("stage_order"),
                F.lit(stage).alias("stage"),
                F.col(stage).alias("sessions"),
            )
        )
    started = sessions.filter(F.col("has_session_started"))
    return started.agg(*counts).select(F.inline(F.array(*rows)))


def session_funnel(sessions: DataFrame) -> DataFrame:
    """The funnel with each stage's share of the first; the window sees its five rows only."""
    first = F.first_value("sessions").over(Window.orderBy("stage_order"))
    return (
        funnel_stages(sessions)
        .withColumn("pct_of_started", percent(F.col("sessions"), first, 1))
        .orderBy("stage_order")
    )


def ordered_funnel_stages(events: DataFrame) -> DataFrame:
    """``(stage_order, stage, sessions)`` with the stages in the order of time.

    A session is at a stage if events of all stages up to it follow each other strictly;
    events of one time follow each other by their id. The earliest chain decides: the next
    stage's first event after it. Each step joins the events of one stage with one row per
    session and takes minima with map-side partials, so a session of very many events is
    spread over tasks and never held.
    """
    moments = events.filter(F.col("session_id").isNotNull()).select(
        "session_id", "event_name", F.struct("event_ts", "event_id").alias("moment")
    )
    chains, chain = [], None
    for order, stage in enumerate(FUNNEL_STAGES, start=1):
        rows = moments.filter(F.col("event_name") == stage).drop("event_name")
        if chain is not None:
            rows = rows.join(chain, "session_id").filter(F.col("moment") > F.col("reached"))
        chain = rows.groupBy("session_id").agg(F.min("moment").alias("reached"))
        chains.append(
            chain.agg(F.count("*").alias("sessions")).select(
                F.lit(order).alias("stage_order"), F.lit(stage).alias("stage"), "sessions"
            )
        )
    return reduce(DataFrame.unionByName, chains)


def ordered_session_funnel(events: DataFrame) -> DataFrame:
    """The funnel of stages in order, with each stage's share of the first."""
    first = F.first_value("sessions").over(Window.orderBy("stage_order"))
    return (
        ordered_funnel_stages(events)
        .withColumn("pct_of_started", percent(F.col("sessions"), first, 1))
        .orderBy("stage_order")
    )


def rejected_by_account(events: DataFrame, accounts: DataFrame) -> DataFrame:
    """Share of rejections among the explicit accept and reject decisions of an account."""
    name = F.col("event_name")
    decided = (
        events.filter(name.isin("response_rejected", "response_accepted"))
        .groupBy("account_id")
        .agg(
            count_event(name, "response_rejected").alias("rejected_responses"),
            count_event(name, "response_accepted").alias("accepted_responses"),
            F.count("*").alias("decisions"),
        )
    )
    return (
        decided.join(accounts.select("account_id", "account_name"), "account_id", "left")
        .select(
            "account_id",
            "account_name",
            "rejected_responses",
            "accepted_responses",
            percent(F.col("rejected_responses"), F.col("decisions"), 1).alias("rejection_rate_pct"),
        )
        .orderBy(F.desc("rejected_responses"), "account_id")
    )


def user_error_rates(events: DataFrame) -> DataFrame:
    """Events, errors and error rate of every user with enough events to judge."""
    return (
        events.groupBy("user_id", "account_id")
        .agg(
            F.count("*").alias("events"),
            count_event(F.col("event_name"), "error_raised").alias("errors"),
        )
        .filter(F.col("events") >= MIN_EVENTS_FOR_ERROR_RATE)
        .withColumn("error_rate", ratio(F.col("errors"), F.col("events")))
    )


def error_rate_cutoff(rates: DataFrame) -> DataFrame:
    """One row: mean plus two population standard deviations of the users' rates."""
    return rates.agg(
        (F.avg("error_rate") + F.lit(2.0) * F.stddev_pop("error_rate")).alias("cutoff")
    )


def high_error_users(events: DataFrame) -> DataFrame:
    rates = user_error_rates(events)
    return (
        rates.crossJoin(F.broadcast(error_rate_cutoff(rates)))
        .filter(F.col("error_rate") > F.col("cutoff"))
        .orderBy(F.desc("error_rate"), "user_id", "account_id")
        .select(
            "user_id",
            "account_id",
            "events",
            "errors",
            F.round(F.lit(100.0) * F.col("error_rate"), 2).alias("error_rate_pct"),
            F.round(F.lit(100.0) * F.col("cutoff"), 2).alias("threshold_pct"),
        )
    )


def boundary_days(daily: DataFrame) -> DataFrame:
    """One row: the first and the last day of the whole table."""
    return daily.agg(F.min("event_date").alias("first_day"), F.max("event_date").alias("last_day"))


def boundary_day_events(daily: DataFrame) -> DataFrame:
    """Events of each account on the first day, on the last day and altogether."""
    on_first = F.when(F.col("event_date") == F.col("first_day"), F.col("events"))
    on_last = F.when(F.col("event_date") == F.col("last_day"), F.col("events"))
    return (
        daily.crossJoin(F.broadcast(boundary_days(daily)))
        .groupBy("account_id", "account_name")
        .agg(
            F.sum(on_first).alias("first_day_events"),
            F.sum(on_last).alias("last_day_events"),
            F.sum("events").alias("total_events"),
        )
    )


def usage_growth(daily: DataFrame) -> DataFrame:
    """Last day against first day, for accounts active on both."""
    growth = F.col("last_day_events") - F.col("first_day_events")
    return (
        boundary_day_events(daily)
        .filter(F.col("first_day_events").isNotNull() & F.col("last_day_events").isNotNull())
        .select(
            "*",
            growth.alias("absolute_growth"),
            percent(growth, F.col("first_day_events"), 1).alias("growth_pct"),
        )
        .orderBy(F.desc_nulls_last("growth_pct"), "account_id")
    )


def acceptance_by_model(interactions: DataFrame) -> DataFrame:
    """Acceptance over the calls that carry a flag, with mean cost and median latency."""
    histogram = interactions.groupBy("model", "latency_ms").agg(
        F.count("*").alias("calls"),
        F.count("accepted").alias("flagged"),
        F.count_if("accepted").alias("accepted"),
        money_sum(F.col("cost_usd_estimated")).alias("cost"),
        F.count("cost_usd_estimated").alias("costed"),
    )
    return (
        histogram_quantiles(
            histogram,
            "model",
            "latency_ms",
            "calls",
            {"median": 0.5},
            F.sum("calls").alias("ai_calls"),
            F.sum("flagged").alias("flagged_calls"),
            F.sum("accepted").alias("accepted_calls"),
            ratio(money_sum(F.col("cost")), F.sum("costed")).alias("mean_cost"),
        )
        .select(
            "model",
            "ai_calls",
            "flagged_calls",
            "accepted_calls",
            percent(F.col("accepted_calls"), F.col("flagged_calls"), 1).alias(
                "acceptance_rate_pct"
            ),
            F.round("mean_cost", 4).alias("avg_cost_usd"),
            F.round("median").alias("median_latency_ms"),
        )
        .orderBy(F.desc_nulls_last("acceptance_rate_pct"), F.col("model").asc_nulls_last())
    )


# Report name -> function and the tables it reads.
REPORTS = {
    "daily_active_users": (daily_active_users, ("daily_account_metrics",)),
    "ai_by_workflow_model": (ai_by_workflow_model, ("fact_ai_interactions",)),
    "latency_by_model": (latency_by_model, ("fact_ai_interactions",)),
    "daily_cost_by_account": (daily_cost_by_account, ("daily_account_metrics",)),
    "session_funnel": (session_funnel, ("fact_sessions",)),
    "rejected_by_account": (rejected_by_account, ("stg_events", "dim_accounts")),
    "high_error_users": (high_error_users, ("stg_events",)),
    "usage_growth": (usage_growth, ("daily_account_metrics",)),
    "acceptance_by_model": (acceptance_by_model, ("fact_ai_interactions",)),
    "ordered_session_funnel": (ordered_session_funnel, ("stg_events",)),
    "volume_anomalies": (monitoring.volume_anomalies, ("stg_events", "rejected_events")),
    "cost_anomalies": (monitoring.cost_anomalies, ("fact_ai_interactions",)),
}
