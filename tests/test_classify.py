"""Validation rules, types and duplicates on small inputs, and the same under forced skew."""

import json
import random
from datetime import datetime

import pytest
from conftest import INGESTED_AT, event_line, rows
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventmart.functions import scalar
from eventmart.operators import classify, marts
from eventmart.session import materialize
from eventmart.sources import bronze, jsonl

ACCOUNTS = [("nord",), ("sued",)]
USERS = [("mia", "nord"), ("tom", "nord"), ("lea", "sued"), ("ole", None)]


def owners(spark):
    return (
        spark.createDataFrame(ACCOUNTS, "account_id string"),
        spark.createDataFrame(USERS, "user_id string, account_id string"),
    )


def raw(spark, lines):
    numbered = [(line, "f", number) for number, line in enumerate(lines, start=1)]
    df = spark.createDataFrame(numbered, "value string, source_file string, line_number long")
    return bronze.raw_events(jsonl.parse_lines(df, INGESTED_AT))


def classified(spark, lines):
    return classify.classify_events(raw(spark, lines), *owners(spark))


def reasons(spark, lines):
    return [
        row[0]
        for row in rows(classified(spark, lines).orderBy("line_number").select("rejection_reason"))
    ]


def call(event_id="e", **properties):
    return event_line(event_id, "ai_response_generated", properties=properties)


def test_identity_rules(spark):
    lines = [
        event_line("", "session_started"),
        event_line("a", "session_started", account_id=""),
        event_line("b", "session_started", account_id=None),
        event_line("c", "session_started", user_id=None),
        event_line("d", "session_started", session_id=""),
        event_line("e", "user_invited", session_id=None),
        event_line("f", None),
        event_line("g", "session_started", event_ts=None),
        event_line("h", "session_started", user_id="ole"),
        event_line("i", "session_started", user_id=None, account_id=None, event_ts="x"),
    ]
    assert reasons(spark, lines) == [
        "missing_event_id",
        "unknown_account",
        "missing_account_id",
        "missing_user_id",
        None,
        None,
        "unknown_event_name",
        "unparseable_event_ts",
        None,
        "unparseable_event_ts",
    ]


@pytest.mark.parametrize(
    ("literal", "integer_fits", "number_fits"),
    [
        ("1", True, True),
        ("null", True, True),
        ("3000000000", True, True),
        ("9223372036854775807", True, True),
        ("9223372036854775808", True, True),
        ("18446744073709551615", True, True),
        ("18446744073709551616", False, True),
        ("9223372036854775808.0", False, True),
        ("1000000000000000000.0", False, True),
        ("99999999999999999999999", False, True),
        ("1.0", False, True),
        ("0.018", False, True),
        ("1e3", False, True),
        ('"1"', False, False),
        ("true", False, False),
        ("[1]", False, False),
        ("{}", False, False),
    ],
)
def test_number_contract(spark, literal, integer_fits, number_fits):
    lines = [
        call("a").replace("{}", '{"latency_ms":%s}' % literal),
        call("b").replace("{}", '{"cost_usd":%s}' % literal),
    ]
    expected = [None if fits else "invalid_property_type" for fits in (integer_fits, number_fits)]
    assert reasons(spark, lines) == expected


def test_flag_contract(spark):
    lines = [call(str(n), accepted=value) for n, value in enumerate((True, None, "true", 1))]
    assert reasons(spark, lines) == [None, None] + ["invalid_property_type"] * 2


def test_integer_beyond_32_bits_is_null_not_rejected(spark):
    event = classified(spark, [call(prompt_tokens=3000000000, completion_tokens=1)]).first()
    assert event["rejection_reason"] is None
    assert event["prompt_tokens"] is None


@pytest.mark.parametrize("properties", ['"text"', "[1,2]", "7", "null"])
def test_properties_that_are_no_object(spark, properties):
    event = classified(spark, [call().replace("{}", properties)]).first()
    assert event["rejection_reason"] is None and event["workflow"] is None


@pytest.mark.parametrize(
    "metric", ["prompt_tokens", "completion_tokens", "latency_ms", "cost_usd", "duration_ms",
               "prompt_length_chars"]
)
def test_negative_metrics(spark, metric):
    assert reasons(spark, [call(**{metric: -1})]) == ["negative_metric_value"]


def test_timestamps(spark):
    cases = {
        "2025-03-01T10:00:00Z": "2025-03-01 10:00:00",
        "2025-03-01 10:00:00": "2025-03-01 10:00:00",
        "2025-03-01T10:00:00.250Z": "2025-03-01 10:00:00.250000",
        "2025-03-01T10:00:00+02:00": "2025-03-01 08:00:00",
        " 2025-03-01 ": None,
        "2025-3-1": "2025-03-01 00:00:00",
        "2026": None,
        "2026-08": None,
        "T10:00:00": None,
        "10:00:00": None,
        "2025-03-01 99:99:99": None,
        "2026-02-30": None,
        "epoch": None,
        "": None,
    }
    df = spark.createDataFrame([(text,) for text in cases], "text string")
    parsed = df.select("text", scalar.lenient_timestamp(F.col("text")))
    assert {text: None if ts is None else str(ts) for text, ts in rows(parsed)} == cases


def test_lateness_boundaries(spark):
    received = {
        "a": "2025-03-10T09:00:00Z",
        "b": "2025-03-10T09:00:01Z",
        "c": "2025-03-10T07:59:00Z",
        "d": "soon",
        "e": None,
        "f": "2025-03-10T08:00:01.100Z",
    }
    lines = [
        event_line(key, "session_started", received_ts=value) for key, value in received.items()
    ]
    events = classify.stg_events(classified(spark, lines)).orderBy("event_id")
    assert rows(events.select("lateness_seconds", "is_late")) == [
        (3600, False), (3601, True), (-60, False), (None, None), (None, None), (1, False),
    ]


def test_sub_second_lateness_counts_boundaries(spark):
    line = event_line(
        "a", "session_started", event_ts="2025-03-01T10:00:00.900Z",
        received_ts="2025-03-01T10:00:01.100Z",
    )
    event = classify.stg_events(classified(spark, [line])).first()
    assert event["lateness_seconds"] == 1


def test_only_valid_copies_compete(spark):
    lines = [
        event_line("a", "session_started", account_id=None, received_ts="2020-01-01T00:00:00Z"),
        event_line("a", "session_started", received_ts="2025-03-01T10:00:05Z"),
        event_line("a", "session_started", received_ts="2025-03-01T10:00:04Z"),
        event_line("a", "session_started", received_ts=None),
        event_line("a", "session_started", received_ts="2025-03-01T10:00:04Z"),
    ]
    assert reasons(spark, lines) == [
        "missing_account_id", "duplicate_event_id", None, "duplicate_event_id",
        "duplicate_event_id",
    ]


def random_lines(count, seed):
    """Events with every defect, one event sent over and over, one dominant user."""
    pick = random.Random(seed)
    lines = []
    for _ in range(count):
        event_id = "hot" if pick.random() < 0.35 else pick.choice([None, ""] + [f"e{n}" for n in range(300)])
        lines.append(
            event_line(
                event_id,
                pick.choice(["session_started", "ai_response_generated", "user_invited", "odd"]),
                f"{pick.randrange(24):02d}:{pick.randrange(60):02d}:00",
                user_id=pick.choice(["mia"] * 6 + ["tom", "lea", "user_9", None]),
                account_id=pick.choice(["nord"] * 6 + ["sued", "acct_X", None]),
                session_id=pick.choice(["visit-1", "visit-1", "visit-2", None]),
                received_ts=pick.choice(
                    [None, "bad"] + [f"2025-03-02T0{n}:00:00Z" for n in range(9)]
                ),
                properties=pick.choice(
                    [{}, {"model": "m", "prompt_tokens": 3, "completion_tokens": 4,
                          "cost_usd": 0.1}, {"latency_ms": "x"}, {"duration_ms": -1}]
                ),
            )
        )
    return lines


def brute_force(events):
    """Duplicate marks by a plain loop over validated rows."""
    first = {}
    for row in events:
        if row["rejection_reason"] is None:
            key = (row["received_ts"] is None, str(row["received_ts"]), row["line_number"])
            first[row["event_id"]] = min(first.get(row["event_id"], key), key)
    kept = {}
    for row in events:
        reason = row["rejection_reason"]
        if reason is None and first[row["event_id"]][2] != row["line_number"]:
            reason = "duplicate_event_id"
        kept[row["line_number"]] = reason
    return kept


FORCED_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_defects(spark, seed):
    """Every row accounted for once, unique ids, and the same result without broadcasts."""
    lines = random_lines(1500, seed)
    events = raw(spark, lines)
    accounts, users = owners(spark)
    validated = classify.validate_events(events, accounts, users)
    expected = brute_force(validated.collect())
    found = dict(rows(classified(spark, lines).select("line_number", "rejection_reason")))
    assert found == expected

    before = {key: spark.conf.get(key, None) for key in FORCED_SKEW}
    for key, value in FORCED_SKEW.items():
        spark.conf.set(key, value)
    try:
        merged = classified(spark, lines).select("line_number", "rejection_reason")
        assert dict(rows(merged)) == expected
        clean = classify.stg_events(classified(spark, lines))
        assert clean.count() == clean.select("event_id").distinct().count()
        calls = marts.ai_calls(clean)
        rates = marts.model_rates(calls)
        assert marts.fact_ai_interactions(clean, rates).count() == calls.count()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_keys_are_split(spark, monkeypatch):
    """One event id, user and account with a third of all rows, and no side to broadcast."""
    lines = [event_line(f"e{n}", "session_started") for n in range(400)]
    events = raw(spark, lines).drop("event_id", "user_id", "account_id", "line_number")
    number = F.row_number().over(Window.orderBy("n")).cast("long")
    many = events.crossJoin(spark.range(60).withColumnRenamed("id", "n"))
    many = many.select("*", number.alias("line_number")).drop("n")
    hot = F.col("line_number") % 3 == 0
    keyed = many.select(
        "*",
        *(
            F.when(hot, name).otherwise(F.concat(F.lit(f"{name}_"), F.col("line_number"))).alias(key)
            for key, name in (("event_id", "e"), ("user_id", "u"), ("account_id", "a"))
        ),
    )
    keyed = materialize(keyed, "hot").repartition(8)
    ids = materialize(spark.range(0, 24001), "ids")
    all_ids = F.when(F.col("id") == 0, "").otherwise(F.concat(F.lit("_"), F.col("id")))
    accounts = ids.select(F.concat(F.lit("a"), all_ids).alias("account_id"))
    users = ids.select(
        F.concat(F.lit("u"), all_ids).alias("user_id"),
        F.concat(F.lit("a"), all_ids).alias("account_id"),
    )
    before = {key: spark.conf.get(key, None) for key in FORCED_SKEW}
    for key, value in FORCED_SKEW.items():
        spark.conf.set(key, value)
    plans = []

    def final_plan(df):
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]

    def written(df, *names, **options):  # references are joined before the events are written
        plans.append(final_plan(df))
        return materialize(df, *names, **options)

    monkeypatch.setattr(classify, "materialize", written)
    try:
        found = classify.classify_events(keyed, accounts, users)
        counts = rows(found.groupBy("rejection_reason").count())
        assert dict(counts) == {None: 16001, "duplicate_event_id": 7999}
        plans.append(final_plan(found))
        assert sum(plan.count("SortMergeJoin(skew=true)") for plan in plans) == 3
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_payload_survives(spark):
    line = call(workflow="w")
    rejected = classify.rejected_events(
        spark.createDataFrame(
            [("f", 2, "{bad", "malformed_json", INGESTED_AT)],
            "source_file string, line_number long, raw_line string, rejection_reason string, "
            "ingested_at timestamp_ntz",
        ),
        classified(spark, [line.replace('"event_id": "e", ', "")]),
    ).orderBy("line_number")
    first, second = rejected.collect()
    assert first["rejection_reason"] == "missing_event_id"
    assert json.loads(first["raw_data"])["properties"] == {"workflow": "w"}
    assert (second["rejection_stage"], second["raw_data"]) == ("ingest", "{bad")


def test_last_of_repeated_keys_counts(spark):
    """A 19-digit value beside a repeated key must not hide which one is last."""
    lines = [
        call("a").replace("{}", '{"prompt_tokens":1.0,"prompt_tokens":9223372036854775808}'),
        call("b").replace("{}", '{"prompt_tokens":9223372036854775808,"prompt_tokens":1.0}'),
    ]
    assert reasons(spark, lines) == [None, "invalid_property_type"]


@pytest.mark.parametrize(
    ("text", "accepted"),
    [
        ("2025-03-10", True),
        (" 2025-03-10T08:00:00Z", True),
        ("2025-03-10T08:00", True),
        ("2025-03-10 08:00:00.123456", True),
        ("2025-03-10T08:00:00+02:00", True),
        ("2025-03-10T08", False),
        ("2025-03-10 08", False),
        (" 2025-03-10 ", False),
        ("2025-03", False),
        ("2025", False),
        ("08:00:00", False),
        ("2025/03/10", True),
        ("2025/3/1T08:00:00Z", True),
        ("2025-03-10 08:00:00 Europe/Berlin", True),
        ("2025-03/10", False),
        ("2025/02/30", False),
        ("12025-03-10", False),
        ("2025-02-30", False),
        ("", False),
    ],
)
def test_timestamp_forms(spark, text, accepted):
    found = spark.createDataFrame([(text,)], "t string").select(
        scalar.lenient_timestamp(F.col("t")).isNotNull()
    )
    assert found.first()[0] is accepted


def test_slashes_part_a_date_as_hyphens_do(spark):
    texts = [("2025/03/10",), ("2025/3/1 08:00:00+02:00",)]
    found = spark.createDataFrame(texts, "t string").select(scalar.lenient_timestamp(F.col("t")))
    assert rows(found) == [(datetime(2025, 3, 10),), (datetime(2025, 3, 1, 6),)]


def test_rows_without_a_valid_id_do_not_meet_in_the_duplicate_join(spark):
    """A third of all rows with null and empty ids, joined without a broadcast."""
    lines = [
        event_line((None, "", f"id{n}")[n % 3], "session_started") for n in range(300)
    ] + [event_line("id2", "session_started")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = classified(spark, lines).groupBy("rejection_reason").count()
        assert dict(rows(found)) == {None: 100, "missing_event_id": 200, "duplicate_event_id": 1}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
