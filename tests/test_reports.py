"""Marts and reports on small hand-made inputs, with the cases the fixture does not have."""

import random
from datetime import date, datetime, timedelta
from statistics import mean, pstdev

import pytest
from conftest import rows
from pyspark.sql import functions as F

from eventmart.functions import scalar
from eventmart.operators import marts, quality, quantiles
from eventmart.operators.quantiles import histogram_quantiles
from eventmart.plans import consumers, reports
from eventmart.schemas import AI_INTERACTIONS, SESSIONS

CLEAN = (
    "event_id string, event_ts timestamp_ntz, event_date date, account_id string, "
    "user_id string, session_id string, event_name string, workflow string, model string, "
    "prompt_tokens int, completion_tokens int, total_tokens int, latency_ms int, "
    "cost_usd double, accepted boolean, is_late boolean"
)
START = datetime(2025, 3, 1, 10)


def clean(spark, *events):
    """Clean events; each a dict of the columns that matter."""
    made = []
    for number, event in enumerate(events):
        row = {
            "event_id": f"e{number}",
            "event_ts": START,
            "account_id": "nord",
            "user_id": "mia",
            "session_id": "visit-1",
            "event_name": "session_started",
            **event,
        }
        row["event_date"] = row["event_ts"].date()
        tokens = (row.get("prompt_tokens"), row.get("completion_tokens"))
        row["total_tokens"] = None if None in tokens else sum(tokens)
        made.append(tuple(row.get(column.split()[0]) for column in CLEAN.split(", ")))
    return spark.createDataFrame(made, CLEAN)


def call(model="m1", tokens=(10, 10), **columns):
    return {
        "event_name": "ai_response_generated",
        "model": model,
        "prompt_tokens": tokens[0],
        "completion_tokens": tokens[1],
        **columns,
    }


def interactions(events):
    return marts.fact_ai_interactions(events, marts.model_rates(marts.ai_calls(events)))


ACCOUNTS = [("nord", "Nordlicht", "pro"), ("sued", "Beta", "starter")]


def accounts(spark):
    return spark.createDataFrame(ACCOUNTS, "account_id string, account_name string, plan string")


def test_cost_estimates(spark):
    events = clean(
        spark,
        call(cost_usd=0.4),
        call(cost_usd=0.2),
        call(),
        call(tokens=(5, None)),
        call(tokens=(0, 0), cost_usd=9.0),
        call(model="never_costed"),
        call(model=None, cost_usd=1.0),
        call(model=None),
    )
    found = interactions(events).orderBy("interaction_id")
    assert rows(found.select("cost_usd_estimated", "is_cost_estimated")) == [
        (0.4, False),
        (0.2, False),
        (0.3, True),
        (None, True),  # a token count is missing
        (9.0, False),  # no tokens: not part of the rate
        (None, True),  # no call of this model has a cost
        (1.0, False),
        (None, True),  # a missing model matches no rate
    ]


def test_session_owner_and_midnight(spark):
    late = datetime(2025, 3, 1, 23, 59, 30)
    events = clean(
        spark,
        {"event_id": "b", "event_ts": late, "user_id": "tom", "workflow": "w1"},
        {"event_id": "a", "event_ts": late, "user_id": "mia", "workflow": "w2"},
        {"event_id": "0", "event_ts": late + timedelta(minutes=1), "user_id": "lea"},
        {"event_id": "x", "session_id": None},
    )
    session = marts.fact_sessions(events)
    assert rows(
        session.select(
            "user_id", "session_date", "duration_seconds", "event_count", "workflow",
            "total_tokens", "cost_usd",
        )
    ) == [("mia", date(2025, 3, 1), 60, 3, "w2", None, None)]


def test_daily_rollup_counts_distinct_users_and_sessions(spark):
    events = clean(
        spark,
        {},
        {"session_id": "visit-2"},
        {"session_id": None, "event_name": "user_invited"},
        {"user_id": "tom"},
        {"account_id": "sued", "session_id": None},
        {"event_ts": START + timedelta(days=1)},
        call(cost_usd=0.1),
        call(cost_usd=0.2),
        call(),
    )
    daily = marts.daily_account_metrics(events, interactions(events), accounts(spark))
    found = daily.orderBy("event_date", "account_id").select(
        "account_name", "active_users", "sessions", "events", "ai_interactions",
        "ai_total_tokens", "ai_cost_usd", "uncosted_interactions", "ai_cost_usd_estimated",
    )
    assert rows(found) == [
        ("Nordlicht", 2, 2, 7, 3, 60, 0.3, 1, 0.45),
        ("Beta", 1, 0, 1, 0, None, 0.0, 0, 0.0),
        ("Nordlicht", 1, 1, 1, 0, None, 0.0, 0, 0.0),
    ]


def test_money_adds_up_the_same_in_any_order(spark):
    cents = [(n / 100,) for n in range(1, 1000)]
    shuffled = random.Random(3).sample(cents, len(cents))
    sums = {
        spark.createDataFrame(amounts, "cost double")
        .repartition(parts)
        .agg(scalar.money_sum(F.col("cost")))
        .first()[0]
        for amounts, parts in ((cents, 1), (shuffled, 5))
    }
    assert sums == {4995.0}
    big = spark.createDataFrame([(1e30,), (0.5,), (None,)], "cost double")
    assert big.agg(scalar.money_sum(F.col("cost"))).first()[0] == pytest.approx(1e30)
    none = spark.createDataFrame([(None,)], "cost double")
    assert none.agg(scalar.money_sum(F.col("cost"))).first()[0] is None


@pytest.mark.parametrize("width", [1, 8, 1 << 16])
def test_quantiles_against_brute_force(spark, monkeypatch, width):
    monkeypatch.setattr(quantiles, "PART_WIDTH", width)
    pick = random.Random(5)
    values = [
        (group, pick.choice([None, *range(40)]) if group != "empty" else None)
        for group in ["a"] * 200 + ["b"] * 7 + ["one"] + ["empty"] * 3
    ]
    values.append(("pair", 10))
    values.append(("pair", 20))
    values += [(None, n) for n in (-2147483648, -9, -8, 0, 2147483647)]
    histogram = (
        spark.createDataFrame(values, "g string, v int").groupBy("g", "v").agg(F.count("*").alias("n"))
    )
    found = histogram_quantiles(
        histogram, "g", "v", "n", {"median": 0.5, "p95": 0.95}, F.sum("n").alias("all")
    )

    def expected(numbers, quantile):
        if not numbers:
            return None
        numbers = sorted(numbers)
        place = quantile * (len(numbers) - 1)
        low = int(place)
        high = min(low + 1, len(numbers) - 1)
        return numbers[low] + (numbers[high] - numbers[low]) * (place - low)

    for group, median, p95, total in rows(found.select("g", "median", "p95", "all")):
        numbers = [v for g, v in values if g == group and v is not None]
        assert total == sum(g == group for g, _ in values)
        for result, quantile in ((median, 0.5), (p95, 0.95)):
            wanted = expected(numbers, quantile)
            assert result == (wanted if wanted is None else pytest.approx(wanted))


def test_quantiles_rank_the_parts_they_need(spark):
    """A group of very many values: all but a few are gone before the values are sorted."""
    histogram = spark.range(2_000_000).selectExpr("'hot' AS g", "CAST(id * 7 AS INT) AS v", "1L AS n")
    found = histogram_quantiles(histogram, "g", "v", "n", {"median": 0.5, "p95": 0.95})
    ((group, median, p95),) = rows(found)
    assert (group, median, p95) == ("hot", 6999996.5, pytest.approx(13299993.35))
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    ranking = [line for line in plan if "Window [" in line and "_value#" in line]
    assert len(ranking) == 1 and "windowspecdefinition(_held#" in ranking[0]


def test_reports_without_any_event(spark):
    sessions = spark.createDataFrame([], SESSIONS)
    calls = spark.createDataFrame([], AI_INTERACTIONS)
    events = spark.createDataFrame([], CLEAN)
    daily = marts.daily_account_metrics(events, calls, accounts(spark))
    assert rows(reports.session_funnel(sessions).select("sessions", "pct_of_started")) == [
        (0, None)
    ] * 5
    for report in (
        reports.daily_active_users(daily),
        reports.ai_by_workflow_model(calls),
        reports.latency_by_model(calls),
        reports.daily_cost_by_account(daily),
        reports.rejected_by_account(events, accounts(spark)),
        reports.high_error_users(events),
        reports.usage_growth(daily),
        reports.acceptance_by_model(calls),
    ):
        assert rows(report) == []
    assert rows(consumers.kpi_summary(events, sessions, calls, daily)) == [(0, 0, 0, None, None)]


def test_model_without_flags_or_latency(spark):
    events = clean(spark, call(cost_usd=0.5), call(model="m2", accepted=True, latency_ms=5))
    assert rows(reports.acceptance_by_model(interactions(events))) == [
        ("m2", 1, 1, 1, 100.0, None, 5.0),
        ("m1", 1, 0, 0, None, 0.5, None),
    ]
    assert sorted(rows(reports.latency_by_model(interactions(events)))) == [
        ("m1", 1, None, None),
        ("m2", 1, 5.0, 5.0),
    ]


def user_events(user, good, errors):
    ok = [{"user_id": user, "event_name": "prompt_submitted"}] * good
    return ok + [{"user_id": user, "event_name": "error_raised"}] * errors


def test_high_error_users(spark):
    plan = {f"calm{n}": (10, 0) for n in range(8)}
    plan |= {"wild": (2, 8), "few": (0, 9), "eleven": (10, 1)}
    events = clean(spark, *(e for user, (g, b) in plan.items() for e in user_events(user, g, b)))
    rates = [b / (g + b) for g, b in plan.values() if g + b >= 10]
    cutoff = mean(rates) + 2 * pstdev(rates)
    assert rows(reports.high_error_users(events)) == [
        ("wild", "nord", 10, 8, 80.0, round(100 * cutoff, 2))
    ]


def test_error_rate_at_the_cutoff_is_not_flagged(spark):
    events = clean(spark, *(e for user in "abc" for e in user_events(user, 5, 5)))
    assert rows(reports.high_error_users(events)) == []


def test_growth_uses_the_boundary_days_of_all_accounts(spark):
    day = timedelta(days=1)
    events = clean(
        spark,
        {},
        {"event_ts": START + 2 * day},
        {"event_ts": START + 2 * day},
        {"event_ts": START + 2 * day},
        {"event_ts": START + day, "account_id": "sued"},
        {"event_ts": START + 2 * day, "account_id": "sued"},
    )
    daily = marts.daily_account_metrics(events, interactions(events), accounts(spark))
    assert rows(reports.usage_growth(daily)) == [("nord", "Nordlicht", 1, 3, 4, 2, 200.0)]


def test_masked_email(spark):
    emails = ["a@b.example", "a@b@c", "nobody", None, ""]
    df = spark.createDataFrame([(email,) for email in emails], "email string")
    masked = [row[0] for row in rows(df.select(scalar.masked_email(F.col("email"))))]
    assert masked == ["***@b.example", "***@b", "***@", None, "***@"]


def test_reason_bucket(spark):
    df = spark.createDataFrame([("malformed_json: x (char 3)",), ("unknown_user",)], "r string")
    assert rows(df.select(scalar.reason_bucket(F.col("r")))) == [
        ("malformed_json",), ("unknown_user",),
    ]


def test_quality_checks_find_violations(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", -1, "y"), (None, None, "x"), (None, 2, "z"), ("b", 2, None)],
        "k string, n int, parent string",
    )
    parents = spark.createDataFrame([("x",), (None,)], "key string")
    assert rows(quality.unique(df, "k")) == [("a", 2)]
    assert sorted(rows(quality.unique_combination(df, ["parent"]))) == [("x", 2)]
    assert quality.not_null(df, "k").count() == 2
    assert rows(quality.non_negative(df, "n")) == [("a", -1, "y")]
    assert sorted(rows(quality.relationships(df, "parent", parents, "key"))) == [("y", 1), ("z", 1)]
    assert rows(quality.row_checks(df, "t", ["k", "n"], ["n"])) == [
        ("not_null", "t", "k", 2), ("not_null", "t", "n", 1), ("non_negative", "t", "n", 1),
    ]


def test_reconciliation_reports_a_lost_row(spark):
    layers = [spark.range(n) for n in (10, 2, 9, 3)]
    assert rows(quality.reconciliation(*layers)) == []
    assert quality.reconciliation_summary(*layers).first()["reconciled"]
    layers[2] = spark.range(8)
    assert rows(quality.reconciliation(*layers)) == [(10, 2, 8, 3)]
