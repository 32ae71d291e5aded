"""Changed files into the built marts against a build of all files; files as they arrive."""

import random

import pytest
from conftest import INGESTED_AT, event_line, rows, write_raw
from pyspark.sql import functions as F

from eventmart import Warehouse
from eventmart.plans import erasure
from eventmart.plans.warehouse import BUILT_TABLES
from eventmart.streaming import costs, ingest


@pytest.fixture(autouse=True)
def few_tasks(spark):
    """The tables are tiny, and the jobs many."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


DAYS = [f"2025-03-{day:02d}" for day in range(10, 16)]


def random_day(draw, day, count):
    """Lines of a day with copies of other days' ids, sessions that cross days, and defects."""
    names = ["session_started", "prompt_submitted", "ai_response_generated", "response_accepted"]
    lines = []
    for _ in range(count):
        user, account = draw.choice([("mia", "nord"), ("tom", "nord"), ("lea", "sued")])
        name = draw.choices([*names, "no_such_event"], weights=[2, 3, 6, 2, 1])[0]
        properties = {"workflow": draw.choice(["a", "b"])}
        if name == "ai_response_generated":
            properties |= {"model": draw.choice(["m", "n"]), "latency_ms": draw.randrange(900),
                           "prompt_tokens": draw.randrange(90), "completion_tokens": 10,
                           "cost_usd": draw.choice([None, 0.25, 0.5, draw.randrange(99) / 64])}
        clock = f"{draw.randrange(24):02d}:{draw.randrange(60):02d}:00"
        lines.append(
            event_line(
                f"e{draw.randrange(150)}", name, clock, day=draw.choice([day, day, draw.choice(DAYS)]),
                user_id=user, account_id=draw.choice([account, account, account, None]),
                session_id=f"s{draw.randrange(12)}", properties=properties,
                received_ts=f"{day}T{draw.randrange(24):02d}:30:00Z",
            )
        )
        if draw.random() < 0.1:
            lines.append(draw.choice(["{bad", "[1]", "", "7"]))
    return lines


def contents(warehouse):
    return {
        name: sorted(map(repr, rows(warehouse.table(name).drop("ingested_at"))))
        for name in BUILT_TABLES
    }


def data_files(folder):
    return {path for path in folder.rglob("*.parquet")}


def test_refresh_equals_a_build(spark, tmp_path):
    draw = random.Random(7)
    files = {f"events_{day}.jsonl": random_day(draw, day, 40) for day in DAYS[:4]}
    raw_dir = write_raw(tmp_path / "raw", files)
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    warehouse.ingest(raw_dir, INGESTED_AT)
    assert warehouse.refresh(check=False) is None  # the first build
    assert warehouse.refresh(check=False) == 0
    names = list(files)
    late = [event_line("late", "prompt_submitted", "23:59:00", day="2099-12-31", session_id="s1"),
            event_line("old", "ai_response_generated", day="1980-01-01", session_id="s2",
                       properties={"model": "m", "prompt_tokens": 5, "completion_tokens": 5})]
    changes = [
        {f"events_{DAYS[4]}.jsonl": random_day(draw, DAYS[4], 40), f"events_{DAYS[5]}.jsonl": late,
         names[1]: random_day(draw, DAYS[1], 30)},
        {names[2]: [], names[0]: files[names[0]][5:], f"events_{DAYS[5]}.jsonl": []},
    ]
    for change in changes:
        for name, lines in change.items():
            (tmp_path / "raw" / name).write_text("".join(line + "\n" for line in lines))
        files |= change
        assert warehouse.ingest_changed(raw_dir, INGESTED_AT) == len(change)
        assert warehouse.ingest_changed(raw_dir, INGESTED_AT) == 0
        assert warehouse.refresh(check=False) == len(change)
        fresh = Warehouse(spark, str(tmp_path / f"fresh-{len(data_files(tmp_path))}"))
        fresh.ingest(raw_dir, INGESTED_AT)
        fresh.build(check=False)
        expected = contents(fresh)
        for name, found in contents(warehouse).items():
            assert found == expected[name], (change.keys(), name)


def test_refresh_writes_the_folders_it_needs(spark, tmp_path):
    lines = {
        day: [event_line(f"{day}-{i}", "prompt_submitted", day=day, session_id=f"{day}-{i % 2}")
              for i in range(4)] for day in DAYS
    }
    raw_dir = write_raw(tmp_path / "raw", {f"events_{day}.jsonl": lines[day] for day in DAYS})
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    warehouse.ingest(raw_dir, INGESTED_AT)
    warehouse.build()
    before = data_files(tmp_path / "warehouse")
    more = [*lines[DAYS[2]], event_line("x", "prompt_submitted", day=DAYS[2], session_id=f"{DAYS[2]}-0")]
    write_raw(tmp_path / "raw", {f"events_{DAYS[2]}.jsonl": more})
    warehouse.ingest_changed(raw_dir, INGESTED_AT)
    assert warehouse.refresh() == 1
    replaced = {p.parent.name for p in before - data_files(tmp_path / "warehouse") if "=" in p.parent.name}
    assert replaced == {f"event_date={DAYS[2]}", f"session_date={DAYS[2]}",
                        f"source_file=events_{DAYS[2]}.jsonl"}


def test_other_inputs_and_broken_builds_lead_to_a_build(spark, tmp_path, monkeypatch):
    raw_dir = write_raw(tmp_path / "raw", {"events_a.jsonl": [event_line("a", "prompt_submitted")]})
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    warehouse.ingest(raw_dir, INGESTED_AT)
    warehouse.build()
    users = tmp_path / "raw" / "users.csv"
    users.write_text(users.read_text().replace("tom,nord", "tom,sued"))
    warehouse.ingest(raw_dir, INGESTED_AT, pattern=None, accounts=None)
    assert warehouse.refresh() is None
    assert warehouse.refresh() == 0
    (tmp_path / "raw" / "events_b.jsonl").write_text(event_line("b", "prompt_submitted") + "\n")
    warehouse.ingest_changed(raw_dir, INGESTED_AT)
    with monkeypatch.context() as patched:
        patched.setattr("eventmart.operators.marts.fact_sessions", lambda _: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            warehouse.refresh()
    assert warehouse.refresh() is None
    assert warehouse.table("stg_events").count() == 2


def bronze_rows(warehouse):
    found = warehouse.spark.read.parquet(warehouse.path("raw/lines"))
    return sorted(map(repr, rows(found.withColumn("properties", F.to_json("properties")))))


def test_stream_leaves_what_a_batch_leaves(spark, tmp_path, monkeypatch):
    draw = random.Random(3)
    names = [f"events_{day}.jsonl" for day in DAYS[:4]] + ["events_a b [1]{x}50%.jsonl"]
    files = {name: random_day(draw, DAYS[i], 15) for i, name in enumerate(names)}
    files["events_empty.jsonl"] = []
    raw_dir = write_raw(tmp_path / "raw", dict(list(files.items())[:2]))
    streamed = Warehouse(spark, str(tmp_path / "streamed"))
    choices = {"files_per_batch": 1, "clock": lambda: INGESTED_AT}
    ingest.ingest_available(streamed, raw_dir, **choices)
    assert streamed.table("raw_events").count() > 0
    write_raw(tmp_path / "raw", files)
    recorded = []
    record = Warehouse._record

    def crash_once(self, *given):
        recorded.append(given)
        if len(recorded) == 2:
            raise RuntimeError("lost")
        record(self, *given)

    with monkeypatch.context() as patched:
        patched.setattr(Warehouse, "_record", crash_once)
        with pytest.raises(Exception, match="lost"):
            ingest.ingest_available(streamed, raw_dir, **choices)
    ingest.ingest_available(streamed, raw_dir, **choices)
    batch = Warehouse(spark, str(tmp_path / "batch"))
    batch.ingest(raw_dir, INGESTED_AT, accounts=None, users=None)
    assert bronze_rows(streamed) == bronze_rows(batch)
    listed = [sorted(map(repr, rows(w._manifest().drop("modified")))) for w in (streamed, batch)]
    assert listed[0] == listed[1] and len(listed[0]) == 6
    ingest.ingest_available(streamed, raw_dir, **choices)
    assert bronze_rows(streamed) == bronze_rows(batch)


def call(event_id, day, clock, cost, **changes):
    properties = {"model": "m", "prompt_tokens": 1, "completion_tokens": 1, "cost_usd": cost}
    return event_line(event_id, "ai_response_generated", clock, day=day, properties=properties, **changes)


def test_hourly_costs(spark, tmp_path):
    raw_dir = write_raw(tmp_path / "raw", {})
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    warehouse.ingest(raw_dir, INGESTED_AT, pattern=None)

    def arrive(name, *lines):
        (tmp_path / "raw" / f"events_{name}.jsonl").write_text("\n".join(lines) + "\n")
        costs.cost_stream(warehouse, raw_dir, late="1 day").awaitTermination()
        found = costs.hourly_costs(warehouse).orderBy("hour", "account_id")
        return [(r.hour.day, r.hour.hour, r.account_id, r.calls, r.cost_usd) for r in found.collect()]

    first = call("a", DAYS[0], "08:10:00", 0.1)
    assert arrive("1", first, first, call("b", DAYS[0], "08:50:00", None), "{bad",
                  call("c", DAYS[0], "09:00:00", 0.5, account_id="sued")) == [(10, 8, "nord", 2, 0.1)]
    # After a restart a copy is known, an hour is added to, and another one is new.
    assert arrive("2", first, call("d", DAYS[0], "08:59:59", 0.2), call("e", DAYS[1], "01:00:00", 1.0)) == [
        (10, 8, "nord", 3, 0.3), (11, 1, "nord", 1, 1.0)]
    # Three days on, the first day is too late for these figures.
    arrive("3", call("f", DAYS[4], "00:00:00", 2.0))
    last = arrive("4", call("g", DAYS[0], "08:00:00", 9.0), call("h", DAYS[4], "00:30:00", 3.0))
    assert last == [(10, 8, "nord", 3, 0.3), (11, 1, "nord", 1, 1.0), (14, 0, "nord", 2, 5.0)]


def mentions(folder, word):
    return [path for path in folder.rglob("*") if path.is_file() and word in path.read_bytes()]


def test_erased_users_leave_no_byte(spark, tmp_path):
    """Uncompressed files are searched for the id; folders without the user stay as they are."""
    draw = random.Random(9)
    files = {f"events_{day}.jsonl": random_day(draw, day, 25) for day in DAYS}
    for name, day in ((f"events_{DAYS[1]}.jsonl", DAYS[1]), (f"events_{DAYS[4]}.jsonl", DAYS[4])):
        files[name] += [
            event_line(f"{day}-{i}", "prompt_submitted", day=day, user_id="zzgone", session_id=f"zz{i}")
            for i in range(3)
        ]
    files[f"events_{DAYS[1]}.jsonl"] += ['{"user_id":"zzgone",', "[zzgone-2, 1"]
    gone = "zzgone,nord,zzgone@nord.example,editor,active,2024-11-06T00:00:00Z"
    users = ["user_id,account_id,email,role,status,created_at", gone,
             "mia,nord,mia@nord.example,editor,active,2024-11-06T00:00:00Z",
             "tom,nord,tom@nord.example,owner,active,2024-11-07T00:00:00Z",
             "lea,sued,lea@sued.example,owner,active,2024-12-10T00:00:00Z"]
    raw_dir = write_raw(tmp_path / "raw", files, users=users)
    root = tmp_path / "warehouse"
    spark.conf.set("spark.sql.parquet.compression.codec", "uncompressed")
    try:
        warehouse = Warehouse(spark, str(root))
        warehouse.ingest(raw_dir, INGESTED_AT)
        warehouse.build(check=False)
        assert mentions(root, b"zzgone")
        before = data_files(root)
        assert erasure.erase_users(warehouse, ["zzgone", "no-such-user"], check=False) == {
            "lines": 7, "users": 1, "files": 2}
        left = mentions(root, b"zzgone")
        assert {path.parent.name for path in left} == {f"source_file=events_{DAYS[1]}.jsonl",
                                                        "ingest_rejections"}
        assert not any(b"zzgone" in path.read_bytes().replace(b"zzgone-2", b"") for path in left)
    finally:
        spark.conf.unset("spark.sql.parquet.compression.codec")
    replaced = {p.parent.name for p in before - data_files(root)}
    assert f"source_file=events_{DAYS[0]}.jsonl" not in replaced
    assert f"source_file=events_{DAYS[1]}.jsonl" in replaced
    clean = {
        name: [line for line in lines if '"zzgone"' not in line] for name, lines in files.items()
    }
    fresh = Warehouse(spark, str(tmp_path / "fresh"))
    fresh.ingest(write_raw(tmp_path / "clean", clean, users=[users[0], *users[2:]]), INGESTED_AT)
    fresh.build(check=False)
    expected, found = contents(fresh), contents(warehouse)
    for name in ("rejected_events", "stg_events"):  # lines keep their numbers, so these differ
        assert len(found.pop(name)) == len(expected.pop(name))
    assert found == expected
    assert warehouse.ingest_changed(raw_dir, INGESTED_AT) == 0
    assert warehouse.refresh(check=False) == 0
