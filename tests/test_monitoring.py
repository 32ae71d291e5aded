"""Alerts and the ordered funnel on small inputs worked out by hand."""

import random
from datetime import date, datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

from eventmart.plans import monitoring, reports
from eventmart.schemas import FUNNEL_STAGES

START = date(2025, 3, 1)


def days(values):
    return [(START + timedelta(days=i), value) for i, value in enumerate(values) if value is not None]


def signals(spark, **series):
    made = [("volume", key, day, value) for key, values in series.items() for day, value in days(values)]
    return spark.createDataFrame(made, "signal string, key string, day date, value long")


def test_a_day_beyond_the_week_before_is_an_anomaly(spark):
    found = monitoring.signal_anomalies(
        signals(spark, steady=[100, 102, 98, 101, 99, 100, 100, 103, 160, 100], flat=[10] * 10,
                small=[1, 1, 1, 1, 1, 1, 1, 15, 1, 1], gone=[200] * 8 + [None, None])
    )
    flagged = sorted(map(tuple, found.filter("is_anomaly").select("key", "day", "value").collect()))
    assert flagged == [("gone", START + timedelta(days=8), 0), ("steady", START + timedelta(days=8), 160)]
    # The first week has no full baseline; days without a value are zeros.
    assert found.count() == 4 * 3
    day = found.filter("key = 'gone'").filter(F.col("day") == START + timedelta(days=9)).first()
    assert (day.value, day.baseline, day.is_anomaly) == (0, round(1200 / 7, 3), False)


def test_signals_of_a_warehouse(warehouse):
    found = rows(monitoring.daily_signals(warehouse.table("stg_events"), warehouse.table("rejected_events")))
    monday = date(2025, 3, 10)
    total = warehouse.table("stg_events").filter("source_file LIKE '%03-10%'").count()
    total += warehouse.table("rejected_events").filter("source_file LIKE '%03-10%'").count()
    rates = {key: value for signal, key, day, value in found if signal == "reject_rate" and day == monday}
    assert rates["malformed_json"] % (1_000_000 // total) <= total
    assert rates["duplicate_event_id"] >= 1_000_000 // total
    volumes = {key: value for signal, key, day, value in found if signal == "volume" and day == monday}
    assert sum(volumes.values()) <= total and "session_started" in volumes
    assert rows(warehouse.report("volume_anomalies")) == []
    assert rows(warehouse.report("cost_anomalies")) == []


def costs(spark, **series):
    made = [(key, "m", day, value) for key, values in series.items() for day, value in days(values)]
    return spark.createDataFrame(made, "account_id string, model string, day date, value long")


def test_cost_baselines(spark):
    usual = [1_000_000 + 1000 * (i % 5) for i in range(20)]
    wild = list(usual)
    wild[9], wild[15] = 9_000_000, 1_200_000
    found = monitoring.cost_baselines(
        costs(spark, usual=usual, wild=wild, late=[None] * 12 + [50_000] * 8, rare=[70_000] + [None] * 18 + [70_000])
    )
    flagged = rows(found.filter("is_anomaly").select("account_id", "event_date").orderBy("account_id", "event_date"))
    # A wild day moves the median of the days after it too little to hide the next one.
    assert flagged == [("rare", START + timedelta(days=19)), ("wild", START + timedelta(days=9)),
                       ("wild", START + timedelta(days=15))]
    late = rows(found.filter("account_id = 'late'").select("event_date", "median_usd", "deviation_usd"))
    assert late == [(START + timedelta(days=19), 0.05, 0.0)]
    # 1.000 to 1.004, the seven days before: median 1.001, distances 0 to 0.003.
    seventh = found.filter("account_id = 'usual'").orderBy("event_date").first()
    assert (seventh.event_date, seventh.median_usd, seventh.deviation_usd) == (START + timedelta(days=7), 1.001, 0.001)


EVENT = "event_id string, event_ts timestamp_ntz, session_id string, event_name string"


def strict_stage(events):
    """How many stages one session reaches in order."""
    reached, last = 0, None
    for moment, name in sorted(((ts, i), name) for i, ts, _, name in events):
        if reached < len(FUNNEL_STAGES) and name == FUNNEL_STAGES[reached] and (last is None or moment > last):
            reached, last = reached + 1, moment
    return reached


def test_funnel_in_order(spark):
    """Random sessions with ties in time, one of them with a third of all events."""
    draw = random.Random(6)
    noon = datetime(2025, 3, 1, 12)
    events = []
    for number in range(3000):
        session = draw.choice(["hot", None, *(f"s{i}" for i in range(60))]) if number % 3 else "hot"
        moment = noon + timedelta(seconds=draw.randrange(30))
        events.append((f"e{draw.randrange(10**6):06d}{number}", moment, session, draw.choice([*FUNNEL_STAGES, "error_raised"])))
    for session, order in (("forward", range(5)), ("backward", range(4, -1, -1))):
        events += [(f"{session}{i}", noon + timedelta(seconds=i), session, FUNNEL_STAGES[k]) for i, k in enumerate(order)]
    # At one moment the ids decide.
    events += [("a", noon, "tie", FUNNEL_STAGES[1]), ("b", noon, "tie", FUNNEL_STAGES[0]), ("c", noon, "tie", FUNNEL_STAGES[1])]
    sessions = {}
    for event in events:
        if event[2]:
            sessions.setdefault(event[2], []).append(event)
    reached = [strict_stage(part) for part in sessions.values()]
    table = spark.createDataFrame(events, EVENT).repartition(7)
    found = rows(reports.ordered_session_funnel(table))
    started = sum(r >= 1 for r in reached)
    assert found == [
        (k, FUNNEL_STAGES[k - 1], n := sum(r >= k for r in reached), round(100 * n / started, 1))
        for k in range(1, 6)
    ]
    assert strict_stage(sessions["backward"]) == 1 and strict_stage(sessions["tie"]) == 2
    assert [row[2] for row in rows(reports.ordered_session_funnel(table.limit(0)))] == [0] * 5
