"""The fixture through the whole pipeline; the expected values are worked out by hand.

Model tern-2 has one call with a cost, 0.08 for 400 tokens, so its call of 200 tokens
without one is estimated at 0.04.
"""

import json
from datetime import date

import pytest
from conftest import (
    DAY_FILE,
    INGESTED_AT,
    NEXT_FILE,
    event_line,
    fixture_lines,
    next_lines,
    rows,
    write_raw,
)
from pyspark.sql import functions as F

from eventmart import Warehouse
from eventmart.plans import consumers
from eventmart.plans.warehouse import ChecksFailed

MONDAY, TUESDAY = date(2025, 3, 10), date(2025, 3, 11)


def test_table_counts(warehouse):
    counts = dict(rows(warehouse.table_counts()))
    expected = {
        "raw_events": 25, "raw_ingest_rejections": 2, "raw_accounts": 3, "raw_users": 4,
        "stg_events": 13, "rejected_events": 14, "fact_sessions": 4, "fact_ai_interactions": 3,
    }
    assert {name: counts[name] for name in expected} == expected


def test_refused_lines_keep_their_place(warehouse):
    found = warehouse.table("raw_ingest_rejections").orderBy("line_number")
    assert rows(found) == [
        (DAY_FILE, 1, '{"event_id": "cut off', "malformed_json", INGESTED_AT),
        (DAY_FILE, 13, '"just text"', "not_a_json_object: got str", INGESTED_AT),
    ]


def test_payload_is_kept_as_sent(warehouse):
    event = warehouse.table("raw_events").filter("event_id = 'n17'").first()
    assert event["event_ts"] == "2025-13-45T00:00:00Z"
    assert event["raw_payload"] == fixture_lines()[19]


def test_clean_events(warehouse):
    found = rows(warehouse.table("stg_events").select("event_id"))
    assert sorted(int(r[0][1:]) for r in found) == [*range(1, 11), 21, 22, 23]


def test_every_reason(warehouse):
    rejected = warehouse.table("rejected_events")
    assert rejected.select("source_file").distinct().collect() == [(DAY_FILE,)]
    assert dict(rows(rejected.select("line_number", "rejection_reason"))) == {
        1: "malformed_json",
        8: "duplicate_event_id",
        13: "not_a_json_object: got str",
        14: "unknown_event_name",
        15: "unknown_user",
        16: "unknown_account",
        17: "user_account_mismatch",
        18: "invalid_property_type",
        19: "negative_metric_value",
        20: "unparseable_event_ts",
        21: "missing_session_id",
        22: "missing_event_id",
        23: "missing_account_id",
        24: "missing_user_id",
    }
    refused = rejected.filter("event_id = 'n15'").first()
    assert json.loads(refused["raw_data"])["properties"]["latency_ms"] == "slow"


def test_late_event(warehouse):
    late = warehouse.table("stg_events").filter("is_late").first()
    # From 23:50 to 06:00.
    assert (late["event_id"], late["event_date"], late["lateness_seconds"]) == ("n23", MONDAY, 22200)


def test_cost_is_estimated(warehouse):
    call = warehouse.table("fact_ai_interactions").filter("is_cost_estimated").first()
    assert (call["interaction_id"], call["cost_usd"]) == ("n5", None)
    assert call["cost_usd_estimated"] == pytest.approx(0.04)


def test_sessions(warehouse):
    found = warehouse.table("fact_sessions").orderBy("session_id").select(
        "session_id", "account_id", "user_id", "workflow", "event_count", "total_tokens",
        "cost_usd", "duration_seconds", "has_session_started", "has_prompt_submitted",
        "has_ai_response", "has_response_accepted", "has_workflow_completed",
    )
    yes, no = True, False
    assert rows(found) == [
        ("visit-1", "nord", "mia", "drafting", 7, 600, 0.08, 300, yes, yes, yes, yes, yes),
        ("visit-2", "sued", "lea", None, 2, None, None, 60, yes, no, no, no, no),
        ("visit-3", "nord", "tom", "search", 2, 100, 0.5, 5, no, yes, yes, no, no),
        ("visit-4", "nord", "tom", "search", 1, None, None, 0, no, yes, no, no, no),
    ]


def test_daily_rollup(warehouse):
    found = warehouse.table("daily_account_metrics").orderBy("event_date", "account_id")
    assert rows(found) == [
        (MONDAY, "nord", "Nordlicht", "growth", 2, 2, 9, 2, 2, 1, 1, 1, 0, 600, 0.08, 1, 0.12),
        (MONDAY, "sued", "Suedwind", "starter", 1, 1, 2, 0, 0, 0, 0, 0, 1, None, 0.0, 0, 0.0),
        (TUESDAY, "nord", "Nordlicht", "growth", 1, 1, 2, 1, 1, 0, 0, 0, 0, 100, 0.5, 0, 0.5),
    ]


def test_dimensions(warehouse):
    users = warehouse.table("dim_users").orderBy("user_id")
    assert rows(users.select("user_id", "account_name", "email_masked")) == [
        ("lea", "Suedwind", "***@suedwind.example"),
        ("mia", "Nordlicht", "***@nordlicht.example"),
        ("ole", 'Westkai "Pier" Ltd, London', "***@westkai.example"),
        ("tom", "Nordlicht", "***@nordlicht.example"),
    ]
    accounts = warehouse.table("dim_accounts").orderBy("account_id")
    assert rows(accounts.select("account_id", "seat_limit")) == [
        ("nord", 40), ("sued", 12), ("west", 7),
    ]


@pytest.mark.parametrize(
    ("report", "expected"),
    [
        (
            "daily_active_users",
            [
                (MONDAY, "nord", "Nordlicht", 2),
                (MONDAY, "sued", "Suedwind", 1),
                (TUESDAY, "nord", "Nordlicht", 1),
            ],
        ),
        ("ai_by_workflow_model", [("drafting", "tern-2", 2), ("search", "gull", 1)]),
        # Of 400 and 800: the middle 600, and 95 % of the way 780.
        ("latency_by_model", [("gull", 1, 1200.0, 1200.0), ("tern-2", 2, 600.0, 780.0)]),
        # Only visits 1 and 2 began with a start, and visit 2 went no further.
        (
            "session_funnel",
            [
                (1, "session_started", 2, 100.0),
                (2, "prompt_submitted", 1, 50.0),
                (3, "ai_response_generated", 1, 50.0),
                (4, "response_accepted", 1, 50.0),
                (5, "workflow_completed", 1, 50.0),
            ],
        ),
        # One response rejected, one accepted.
        ("rejected_by_account", [("nord", "Nordlicht", 1, 1, 50.0)]),
        ("high_error_users", []),
    ],
)
def test_reports(warehouse, report, expected):
    assert sorted(rows(warehouse.report(report))) == sorted(expected)


def test_kpis(warehouse):
    tables = ("stg_events", "fact_sessions", "fact_ai_interactions", "daily_account_metrics")
    # Three users, four sessions, three calls, 0.08 + 0.04 + 0.5; one of two funnels complete.
    assert rows(consumers.kpi_summary(*map(warehouse.table, tables))) == [(3, 4, 3, 0.62, 50.0)]


def test_all_checks_pass(warehouse):
    checks = rows(warehouse.checks())
    assert len(checks) == 41
    assert [check for check in checks if check[3]] == []


def test_a_date_filter_reads_its_folders_only(warehouse):
    tuesday = warehouse.table("stg_events").filter(F.col("event_date") == TUESDAY)
    assert sorted(r[0] for r in rows(tuesday.select("event_id"))) == ["n21", "n22"]
    plan = tuesday._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: ")[1].split("]")[0]


def test_views(warehouse, spark):
    warehouse.create_views()
    assert spark.sql("SELECT count(*) FROM stg_events").first()[0] == 13
    assert spark.sql("SELECT max(sessions) FROM report_session_funnel").first()[0] == 2


def files_below(folder):
    return {path.relative_to(folder).parts[0] for path in folder.iterdir()}


def test_rebuild_leaves_nothing_old(spark, tmp_path):
    """A file loses its refused events and a day, in a session that overwrites partitions."""
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    raw = {DAY_FILE: fixture_lines(), NEXT_FILE: next_lines()}
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        warehouse.ingest(write_raw(tmp_path / "raw", raw), INGESTED_AT)
        warehouse.build()
        warehouse.ingest(
            write_raw(tmp_path / "again", {DAY_FILE: fixture_lines()[1:3], NEXT_FILE: []}),
            INGESTED_AT,
        )
        warehouse.build()
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert warehouse.table("stg_events").count() == 2
    assert warehouse.table("rejected_events").count() == 0
    assert rows(warehouse.table("fact_sessions").select("session_id")) == [("visit-1",)]
    assert warehouse.table("fact_ai_interactions").count() == 0
    assert files_below(tmp_path) == {"raw", "again", "warehouse"}


def test_days_of_a_broken_clock_share_a_folder(spark, tmp_path):
    days = ["1970-01-01", "1999-12-31", "2000-01-01", "2099-12-31", "2100-01-01", "9999-12-31"]
    lines = [
        event_line(f"d{i}", "ai_response_generated", day=day, session_id=f"s{i}")
        for i, day in enumerate(days)
    ]
    lines += [event_line(f"r{i}", "no_such_event", day=f"20{i + 10}-01-01") for i in range(20)]
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    warehouse.ingest(write_raw(tmp_path / "raw", {DAY_FILE: lines}), INGESTED_AT)
    warehouse.build(check=False)  # the calls have no model
    root = tmp_path / "warehouse"
    own = {"event_date=2000-01-01", "event_date=2099-12-31"}
    shared = "event_date=__HIVE_DEFAULT_PARTITION__"
    assert files_below(root / "staging/events_classified/outcome=clean") == {shared, *own}
    assert files_below(root / "staging/events_classified/outcome=rejected") == {shared}
    for name, date in (("fact_ai_interactions", "event_date"), ("fact_sessions", "session_date")):
        folders = [f for f in files_below(root / "marts" / name) if f.startswith(date)]
        assert len(folders) == 3
        found = warehouse.table(name).selectExpr(f"CAST({date} AS string)")
        assert sorted(r[0] for r in rows(found)) == days
    events = warehouse.table("stg_events")
    assert sorted(r[0] for r in rows(events.selectExpr("CAST(event_date AS string)"))) == days
    assert rows(events.filter("event_date = DATE'2100-01-01'").select("event_id")) == [("d4",)]
    assert warehouse.table("rejected_events").count() == 20


def test_chosen_metadata(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    raw_dir = write_raw(tmp_path / "raw", {DAY_FILE: fixture_lines()})
    first = warehouse.ingest(raw_dir, INGESTED_AT)
    only_lines = warehouse.ingest(raw_dir, INGESTED_AT, accounts=None, users=None)
    assert only_lines == {**first, "accounts_loaded": 0, "users_loaded": 0}
    assert warehouse.table("raw_accounts").count() == first["accounts_loaded"]
    header, *people = (tmp_path / "raw" / "users.csv").read_text().splitlines()
    names = ["more users 50%.csv", "a+b.csv"]
    for name, person in zip(names, people):
        (tmp_path / "raw" / name).write_text(f"{header}\n{person.replace(',', 'x,', 1)}\n")
    added = warehouse.ingest(raw_dir, pattern=None, accounts=None, users="*[%+]*.csv")
    assert added == {"events_loaded": 0, "lines_rejected": 0, "accounts_loaded": 0, "users_loaded": 2}
    found = warehouse.table("raw_users")
    assert found.count() == first["users_loaded"] + 2
    assert {r[0] for r in rows(found.select("source_file"))} == {"users.csv", *names}
    (tmp_path / "raw" / names[0]).write_text(header + "\n")
    assert warehouse.ingest(raw_dir, pattern=None, accounts=None, users=names[0])["users_loaded"] == 0
    assert {r[0] for r in rows(warehouse.table("raw_users").select("source_file"))} == {"users.csv", "a+b.csv"}
    with pytest.raises(FileNotFoundError):
        warehouse.ingest(raw_dir, pattern=None, accounts=None, users="absent.csv")


def test_line_breaks_in_metadata(spark, tmp_path):
    raw_dir = write_raw(tmp_path / "raw", {DAY_FILE: fixture_lines()})
    accounts = tmp_path / "raw" / "accounts.csv"
    header, first, *others = accounts.read_text().splitlines()
    name = first.split(",")[1]
    accounts.write_text("\n".join([header, first.replace(name, '"two\nlines"'), *others]) + "\n")
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    warehouse.ingest(raw_dir, INGESTED_AT, line_breaks=True)
    assert "two\nlines" in {r[0] for r in rows(warehouse.table("raw_accounts").select("account_name"))}


def test_one_day_into_a_filled_warehouse(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    raw_dir = write_raw(tmp_path / "raw", {DAY_FILE: fixture_lines(), NEXT_FILE: next_lines()})
    warehouse.ingest(raw_dir, INGESTED_AT, pattern=DAY_FILE)
    assert warehouse.table("raw_events").count() == 22
    warehouse.ingest(raw_dir, INGESTED_AT, pattern=NEXT_FILE)
    assert warehouse.table("raw_events").count() == 25


def test_contract_from_a_file(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    raw_dir = write_raw(tmp_path / "raw", {DAY_FILE: fixture_lines()})
    warehouse.ingest(raw_dir, INGESTED_AT)
    names = [row[0] for row in rows(warehouse.table("expected_event_names"))]
    contract = tmp_path / "names.csv"
    contract.write_text("\n".join(["event_name", *names, "cursor_moved"]) + "\n")
    warehouse.ingest(raw_dir, INGESTED_AT, event_names=str(contract))
    warehouse.build()
    assert warehouse.table("stg_events").filter("event_id = 'n11'").count() == 1
    assert len(warehouse.event_names()) == 10


def test_a_violated_check_stops_the_build(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    warehouse.ingest(write_raw(tmp_path / "raw", {DAY_FILE: fixture_lines()}), INGESTED_AT)
    write = warehouse._write

    def write_twice(df, name):
        write(df.unionAll(df) if name == "marts/dim_users" else df, name)

    monkeypatch.setattr(warehouse, "_write", write_twice)
    with pytest.raises(ChecksFailed, match="dim_users"):
        warehouse.build()
    warehouse.build(check=False)


def test_huge_amounts_do_not_stop_the_build(spark, tmp_path):
    """Two amounts of 6e19 in one session: more than the decimals that sums use can hold."""
    calls = [
        event_line(f"h{n}", "ai_response_generated", properties={
            "model": "tern-2", "prompt_tokens": 1, "completion_tokens": 1, "cost_usd": 6e19,
        })
        for n in range(2)
    ]
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    warehouse.ingest(write_raw(tmp_path / "raw", {DAY_FILE: calls}), INGESTED_AT)
    warehouse.build(check=False)
    assert rows(warehouse.table("fact_sessions").select("cost_usd")) == [(1.2e20,)]
    assert rows(warehouse.table("daily_account_metrics").select("ai_cost_usd")) == [(1.2e20,)]
    assert warehouse.report("acceptance_by_model").count() == 1


def test_second_build_gives_the_same(warehouse):
    before = sorted(rows(warehouse.table("fact_sessions").select(F.to_json(F.struct("*")))))
    warehouse.build()
    after = sorted(rows(warehouse.table("fact_sessions").select(F.to_json(F.struct("*")))))
    assert before == after
