"""Reading lines, the JSON gate, replacing files, and metadata."""

import json

import pytest
from conftest import (
    ACCOUNT_ROWS,
    DAY_FILE,
    INGESTED_AT,
    event_line,
    fixture_lines,
    rows,
    write_raw,
)
from pyspark.sql import functions as F

from eventmart import Warehouse
from eventmart.schemas import ACCOUNTS, USERS
from eventmart.sources import bronze, jsonl, metadata

MALFORMED = [
    "{bad",
    '{"a":1} x',
    '{"a":1},{"b":2}',
    '{"a":1}] x',
    '{"a":1}} x',
    '{"a":1}]}x',
    '{"a":1}]',
    '{"a":1},',
    '{"a":1,}',
    '{"a":NaN}',
    "1],[2",
    '{"a":1},"w":2',
    "1 2",
    "01",
    "{'a':1}",
    '{"a":"tab\there"}',
]
OTHER_KINDS = [
    ("[1]", "list"),
    (' ["a"]', "list"),
    ('"s"', "str"),
    ("7", "int"),
    ("-0", "int"),
    ("99999999999999999999999", "int"),
    ("1.5", "float"),
    ("1.0", "float"),
    ("1e3", "float"),
    ("true", "bool"),
    ("false", "bool"),
    ("null", "NoneType"),
]


def parse(spark, lines):
    numbered = [(line, "f", number) for number, line in enumerate(lines, start=1)]
    df = spark.createDataFrame(numbered, "value string, source_file string, line_number long")
    return jsonl.parse_lines(df, INGESTED_AT).orderBy("line_number")


def test_malformed_lines(spark):
    reasons = parse(spark, MALFORMED).select("ingest_reason", "event_id", "raw_line")
    assert rows(reasons) == [("malformed_json", None, line) for line in MALFORMED]


def test_json_that_is_no_object(spark):
    reasons = parse(spark, [line for line, _ in OTHER_KINDS]).select("ingest_reason")
    assert rows(reasons) == [(f"not_a_json_object: got {kind}",) for _, kind in OTHER_KINDS]


def test_objects(spark):
    lines = ["{}", '  {"event_id":"a"} ', '{"event_id":"a","event_id":"b"}\t', '{"event_id":null}']
    parsed = parse(spark, lines).select("ingest_reason", "event_id")
    assert rows(parsed) == [(None, None), (None, "a"), (None, "b"), (None, None)]


def test_promoted_values(spark):
    line = json.dumps(
        {"event_id": 7, "account_id": "", "user_id": True, "properties": {"b": 1, "a": [1.5]}}
    )
    event = parse(spark, [line]).select("*", F.to_json("properties").alias("text")).first()
    assert (event["event_id"], event["account_id"], event["user_id"]) == ("7", "", "true")
    assert event["session_id"] is None
    assert json.loads(event["text"]) == {"b": 1, "a": [1.5]}
    assert event["raw_line"] == line
    no_properties = parse(spark, ['{"properties":null}', "{}"])
    assert rows(no_properties.select(F.col("properties").isNull())) == [(True,), (True,)]


def test_blank_lines_are_numbered_but_not_kept(spark, tmp_path):
    (tmp_path / "events_1.jsonl").write_bytes(
        '{"event_id":"a"}\r\n\r\n   \t\r\n　 \x1c\r\n{"event_id":"b"}'.encode()
    )
    lines = jsonl.read_lines(spark, str(tmp_path))
    assert rows(lines.agg(F.max("line_number"))) == [(5,)]
    parsed = jsonl.parse_lines(lines, INGESTED_AT).orderBy("line_number")
    assert rows(parsed.select("event_id", "line_number", "source_file")) == [
        ("a", 1, "events_1.jsonl"),
        ("b", 5, "events_1.jsonl"),
    ]


def test_only_event_files_are_read(spark, tmp_path):
    for name in ("events_1.jsonl", "events_2.jsonl", "other.jsonl", "events_3.json"):
        (tmp_path / name).write_text('{"event_id":"x"}\n')
    files = jsonl.read_lines(spark, str(tmp_path)).select("source_file").distinct()
    assert sorted(rows(files)) == [("events_1.jsonl",), ("events_2.jsonl",)]


def test_no_event_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        jsonl.read_lines(spark, str(tmp_path))


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_line_numbers_over_many_splits(spark, tmp_path, threshold):
    """Files cut into many splits and small files packed into one, with both joins."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    sizes = {"events_a.jsonl": 5000, "events_b.jsonl": 1, "events_c.jsonl": 700}
    for name, size in sizes.items():
        (tmp_path / name).write_text("".join(f"{n} {'x' * (n % 97)}\n" for n in range(1, size + 1)))
    (tmp_path / "events_d.jsonl").write_text("")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        lines = jsonl.read_lines(spark, str(tmp_path))
        parts = lines.select(F.spark_partition_id()).distinct().count()
        assert threshold == "-1" or parts > 5
        wrong = lines.filter(
            F.substring_index("value", " ", 1).cast("long") != F.col("line_number")
        )
        assert wrong.count() == 0
        counts = dict(rows(lines.groupBy("source_file").count()))
        assert counts == sizes
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["events_a b.jsonl", "events_50%.jsonl", "events_a+b.jsonl"])
def test_file_names_are_spelled_as_in_the_file_system(spark, tmp_path, name):
    first, _ = ingested(spark, tmp_path, {name: ["{bad", event_line("a", "x")]})
    assert rows(first.ingest_stats()) == [(name, 1, 1, 0)]
    assert rows(first.table("raw_events").select("source_file", "line_number")) == [(name, 2)]
    again, _ = ingested(spark, tmp_path, {name: []}, "empty")
    assert rows(again.ingest_stats()) == [(name, 0, 0, 0)]


def test_large_events_are_not_malformed(spark):
    """Beyond what VARIANT holds: long text, many digits, deep nesting."""
    large = [
        json.dumps({"event_id": "a", "properties": {"note": "x" * 25_000_000, "latency_ms": 5}}),
        '{"event_id": "b", "properties": {"n": %s, "model": "m"}}' % ("9" * 1200),
        '{"event_id": "c", "properties": %s1%s}' % ('{"d":' * 1500, "}" * 1500),
    ]
    properties = F.col("properties")
    found = parse(spark, large).select(
        "ingest_reason", "event_id", F.try_variant_get(properties, "$.latency_ms", "int"),
        F.try_variant_get(properties, "$.model", "string"),
    )
    assert rows(found) == [
        (None, "a", 5, None), (None, "b", None, "m"), (None, "c", None, None),
    ]


DIGITS, DEEP = "9" * 1200, 1500


@pytest.mark.parametrize(
    ("line", "reason"),
    [
        ('{"event_id": "d", "n": %s} x' % DIGITS, "malformed_json"),
        ('{"event_id": "d", "n": %sx}' % DIGITS, "malformed_json"),
        ('{"event_id": "e", "n": ' + "[" * 250, "malformed_json"),
        ('{"event_id": "e", "n": %s%s}' % ("[" * 250, "]" * 249), "malformed_json"),
        ("[" * DEEP, "malformed_json"),
        ("[" * DEEP + "1" + "]" * DEEP + "]", "malformed_json"),
        (DIGITS + ',"_mark":"1"', "malformed_json"),
        (DIGITS + ",2", "malformed_json"),
        (DIGITS + '],"a":[2', "malformed_json"),
        (DIGITS + '},{"a":2', "malformed_json"),
        ('"%s' % ("x" * 9_000_000), "malformed_json"),
        ("-0" + DIGITS, "malformed_json"),
        ("[" * DEEP + "1" + "]" * DEEP, "not_a_json_object: got list"),
        (f" [{DIGITS}, 2] ", "not_a_json_object: got list"),
        (DIGITS, "not_a_json_object: got int"),
        (f"-{DIGITS}.5e-3", "not_a_json_object: got float"),
        ('"%s"' % ("x" * 25_000_000), "not_a_json_object: got str"),
        ('{"properties": {"model": %s1%s}}' % ('{"d":' * DEEP, "}" * DEEP), "json_beyond_limits"),
    ],
)
def test_reasons_beyond_the_limits_of_variant(spark, line, reason):
    assert rows(parse(spark, [line, "{}"]).select("ingest_reason")) == [(reason,), (None,)]


def ingested(spark, folder, files, name="raw"):
    warehouse = Warehouse(spark, str(folder / "warehouse"))
    stats = warehouse.ingest(write_raw(folder / name, files), INGESTED_AT)
    return warehouse, stats


def test_counts_and_repeated_ingest(spark, tmp_path):
    for _ in range(2):
        warehouse, stats = ingested(spark, tmp_path, {DAY_FILE: fixture_lines()})
        assert stats == {
            "events_loaded": 22,
            "lines_rejected": 2,
            "accounts_loaded": 3,
            "users_loaded": 4,
        }
        assert warehouse.table("raw_events").count() == 22
        assert warehouse.table("raw_ingest_rejections").count() == 2


def test_new_version_of_a_file_replaces_all_of_it(spark, tmp_path):
    first = {"events_1.jsonl": ["{bad", event_line("a", "x")], "events_2.jsonl": ["[]"]}
    warehouse, _ = ingested(spark, tmp_path, first)
    assert warehouse.table("raw_ingest_rejections").count() == 2
    # Next delivery: file 1 without its bad line; file 2 is no longer there and is kept.
    warehouse, _ = ingested(spark, tmp_path, {"events_1.jsonl": [event_line("a", "x")]}, "second")
    assert sorted(rows(warehouse.ingest_stats())) == [
        ("events_1.jsonl", 1, 0, 0),
        ("events_2.jsonl", 0, 1, 0),
    ]
    # And file 1 has become empty.
    warehouse, _ = ingested(spark, tmp_path, {"events_1.jsonl": []}, "third")
    assert sorted(rows(warehouse.ingest_stats())) == [
        ("events_1.jsonl", 0, 0, 0),
        ("events_2.jsonl", 0, 1, 0),
    ]
    assert warehouse.table("raw_events").count() == 0


def test_metadata_types_and_line_ends(spark, tmp_path):
    write_raw(tmp_path, {})
    users = metadata.read_metadata(spark, f"{tmp_path}/users.csv", USERS, INGESTED_AT)
    last = users.orderBy("user_id").collect()[-1]
    assert (last["user_id"], last["status"]) == ("tom", "active")
    assert str(last["created_at"]) == "2024-11-07 00:00:00"
    assert last["source_file"] == "users.csv"


def test_quotes_and_line_breaks_in_metadata(spark, tmp_path):
    path = tmp_path / "accounts.csv"
    head = "account_id,account_name,plan,industry,seat_limit,created_at\n"
    path.write_text(head + 'q,"A ""B"" C, D",p,i,1,2025-01-01T00:00:00Z\n')
    read = metadata.read_metadata(spark, str(path), ACCOUNTS, INGESTED_AT)
    assert rows(read.select("account_name")) == [('A "B" C, D',)]
    path.write_text(head + 'q,"two\nlines",p,i,1,2025-01-01T00:00:00Z\n')
    read = metadata.read_metadata(spark, str(path), ACCOUNTS, INGESTED_AT, line_breaks=True)
    assert rows(read.select("account_name")) == [("two\nlines",)]


def test_metadata_that_became_empty(spark, tmp_path):
    first, stats = ingested(spark, tmp_path, {DAY_FILE: fixture_lines()})
    assert stats["accounts_loaded"] == 3
    raw_dir = write_raw(tmp_path / "later", {DAY_FILE: []}, accounts=ACCOUNT_ROWS[:1])
    assert first.ingest(raw_dir, INGESTED_AT)["accounts_loaded"] == 0
    assert first.table("raw_accounts").count() == 0 and first.table("raw_users").count() == 4


def test_metadata_with_other_columns_fails(spark, tmp_path):
    write_raw(tmp_path, {}, users=["id,account_id,email,role,status,created_at"] + ["a"] * 1)
    with pytest.raises(Exception):
        metadata.read_metadata(spark, f"{tmp_path}/users.csv", USERS, INGESTED_AT).collect()


def test_repeated_metadata_key_stops_the_build(spark, tmp_path):
    accounts = [
        "account_id,account_name,plan,industry,seat_limit,created_at",
        "nord,Nordlicht,growth,logistics,40,2024-11-05T00:00:00Z",
        "nord,Again,growth,logistics,40,2024-11-05T00:00:00Z",
    ]
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    warehouse.ingest(write_raw(tmp_path / "raw", {DAY_FILE: fixture_lines()}, accounts))
    with pytest.raises(ValueError, match="nord"):
        warehouse.build()


def test_bronze_keeps_json_types(spark, tmp_path):
    """VARIANT at rest: 1 and 1.0 stay different, key order and number format may not."""
    parsed = parse(spark, ['{"properties":{"a":1,"b":1.0,"c":"1","d":null}}'])
    bronze.replace_by_file(parsed, str(tmp_path / "bronze"))
    stored = bronze.read_bronze(spark, str(tmp_path / "bronze"))
    types = stored.select(
        *(F.schema_of_variant(F.try_variant_get("properties", f"$.{k}", "variant")) for k in "abcde")
    )
    assert rows(types) == [("BIGINT", "DECIMAL(1,0)", "STRING", "VOID", None)]
