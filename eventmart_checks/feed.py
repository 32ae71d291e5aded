"""An event feed derived from the ``events``, ``customer``, ``nation`` and ``region`` tables.

The tables have no accounts, sessions, receive times or JSON events, so all of these are
computed from the ids by the fixed rules of FIXTURES.md, part 3 (rows are classes of
``event_id`` modulo a prime). The feed grows with the tables and is nowhere collected.
"""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart import Warehouse, configure
from eventmart.functions.scalar import utc_literal
from eventmart.operators.classify import classify_events, type_events, validate_events
from eventmart.schemas import EVENT_KEYS
from eventmart.session import scratch_dir
from eventmart.sources import bronze
from eventmart.sources.jsonl import parse_lines

INGESTED_AT = datetime(2024, 2, 1)
CREATED_AT = datetime(2023, 6, 1)
CLOCK = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# Lines of one generated event file hold this many consecutive ids, so no file grows with
# the data; there are more files instead.
IDS_PER_FILE = 5000


def number() -> Column:
    """The id of an event in the ``events`` table, which all rules count by."""
    return F.col("event_id")


def every(n: int) -> Column:
    return number() % n == 0


def text(*parts) -> Column:
    return F.concat(
        *(part.cast("string") if isinstance(part, Column) else F.lit(part) for part in parts)
    )


def padded(number: Column) -> Column:
    return F.lpad(number.cast("string"), 3, "0")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """A table spread over all cores; the given ones are single files."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)


def _event_name() -> Column:
    turn, user = number() % 20, F.col("user_id")
    return (
        F.when(every(269), "assistant_hovered")
        .when(every(271), None)
        .when((F.col("event_type") == "error") & (user % 50 == 0), "error_raised")
        .when(turn == 0, "user_invited")
        .when(turn == 1, "user_signed_up")
        .when(turn <= 4, "session_started")
        .when(turn <= 8, "prompt_submitted")
        .when(turn <= 13, "ai_response_generated")
        .when(turn <= 15, "response_accepted")
        .when(turn == 16, "response_rejected")
        .when(turn <= 18, "workflow_completed")
        .otherwise("error_raised")
    )


def _properties(name: Column) -> Column:
    """The properties object as compact JSON text; null for unknown event names."""
    i = number()
    workflow = text('"workflow":"wf_', F.col("user_id") % 4, '"')
    latency = (
        F.when(every(277), text('"latency_ms":"fast"'))
        .when(every(281), text('"latency_ms":-5'))
        .otherwise(text('"latency_ms":', 200 + (i * 37) % 4800))
    )
    cost = (
        F.when(every(7), None)
        .when(every(11), text('"cost_usd":null'))
        .otherwise(text('"cost_usd":0.1', padded((i * 13) % 1000), "1"))
    )
    accepted = (
        F.when(i % 8 == 1, None)
        .when(every(3), text('"accepted":false'))
        .otherwise(text('"accepted":true'))
    )
    members = {
        "ai_response_generated": (
            workflow,
            text('"model":"m', i % 3, '"'),
            text('"prompt_tokens":', 50 + i % 900),
            text('"completion_tokens":', 10 + i % 300),
            latency,
            cost,
            accepted,
        ),
        "prompt_submitted": (workflow, text('"prompt_length_chars":', i % 500)),
        "workflow_completed": (workflow, text('"duration_ms":', 1000 + i % 100000)),
        "session_started": (workflow, text('"device":"web"')),
        "error_raised": (text('"error_code":"E', i % 5, '"'),),
        "response_rejected": (workflow, text('"reason":"tone"')),
        "response_accepted": (workflow,),
        "user_invited": (text('"invite_channel":"email"'),),
        "user_signed_up": (text('"invite_channel":"email"'),),
    }
    body = F.lit(None).cast("string")
    for event, parts in members.items():
        body = F.when(name == event, F.concat_ws(",", *parts)).otherwise(body)
    return F.concat(F.lit("{"), body, F.lit("}"))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event line, with late, broken and repeated ones among them."""
    configure(spark)
    base = spread(table(spark, sf_dir, "events"), "event_id").join(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
        F.col("user_id") == F.col("c_custkey"),
    )
    i, user, nation = number(), F.col("user_id"), F.col("c_nationkey")
    moment = F.col("ts")
    delay = F.when(every(37), 7200 + i % 1000).otherwise(i % 120)
    six_days = F.floor(F.datediff(moment, F.lit("2024-01-01").cast("date")) / 6)
    session = F.when(
        ~every(263)
        & ~F.coalesce(F.col("event_name").isin("user_invited", "user_signed_up"), F.lit(False)),
        text("sess_", user, "_", six_days),
    )
    # 0 is the event itself, 1 an exact copy, 2 an invalid copy that arrives first.
    copies = F.filter(
        F.array(F.lit(0), F.when(every(31), 1), F.when(every(293), 2)), lambda n: n.isNotNull()
    )
    copy = F.col("copy")
    rows = base.withColumn("event_name", _event_name()).withColumn("copy", F.explode(copies))
    rows = rows.select(
        i.alias("id"),
        "copy",
        F.when(every(211), None).when(every(223), "").otherwise(text("evt_", i)).alias("event_id"),
        F.when(every(227), "2024-01-01 99:99:99")
        .otherwise(F.date_format(moment, CLOCK))
        .alias("event_ts"),
        F.when(copy == 2, "2023-12-31T00:00:00Z")
        .when(~every(229), F.date_format(F.timestamp_add("SECOND", delay, moment), CLOCK))
        .alias("received_ts"),
        F.when(copy == 2, None)
        .when(every(233), None)
        .when(every(239), "acct_999")
        .when(every(241), text("acct_", padded((nation + 1) % 25)))
        .otherwise(text("acct_", padded(nation)))
        .alias("account_id"),
        F.when(every(251), None)
        .when(every(257), "user_x")
        .otherwise(text("user_", user))
        .alias("user_id"),
        session.alias("session_id"),
        "event_name",
        _properties(F.col("event_name")).alias("properties_text"),
        F.concat(F.lit("events_"), F.date_format(moment, "yyyy-MM-dd"), F.lit(".jsonl")).alias(
            "source_file"
        ),
        # Four lines an event: itself, its two copies, and a line that is no event.
        (4 * i + 1 + copy).alias("line_number"),
    )
    return rows.withColumn("raw_line", _json_line())


def _json_line() -> Column:
    """A feed row as a JSON object without its null keys."""
    members = [
        F.concat(F.lit(f'"{key}":"'), F.col(key), F.lit('"')) for key in EVENT_KEYS
    ]
    members.append(F.concat(F.lit('"properties":'), F.col("properties_text")))
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as raw events."""
    return feed(spark, sf_dir).select(
        *EVENT_KEYS,
        F.try_parse_json("properties_text").alias("properties"),
        F.lit(False).alias("has_wide_misfit"),
        F.col("raw_line").alias("raw_payload"),
        "source_file",
        "line_number",
        utc_literal(INGESTED_AT).alias("ingested_at"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            text("acct_", padded(key)).alias("account_id"),
            F.col("n_name").alias("account_name"),
            F.element_at(
                F.array(F.lit("enterprise"), F.lit("growth"), F.lit("starter")), key % 3 + 1
            ).alias("plan"),
            F.col("r_name").alias("industry"),
            (10 + 5 * key).cast("int").alias("seat_limit"),
            utc_literal(CREATED_AT).alias("created_at"),
        )
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    return table(spark, sf_dir, "customer").select(
        text("user_", key).alias("user_id"),
        text("acct_", padded(nation)).alias("account_id"),
        text("u", key, "@n", nation, ".example").alias("email"),
        F.col("c_mktsegment").alias("role"),
        F.lit("active").alias("status"),
        utc_literal(CREATED_AT).alias("created_at"),
    )


def _bad_line() -> Column:
    """A line that is no event object, for some ids; the first matching class wins."""
    return (
        F.when(F.col("id") % 307 == 0, text("{not json ", F.col("id") + 1))
        .when(F.col("id") % 311 == 0, text("[", F.col("id"), "]"))
        .when(F.col("id") % 313 == 0, text('"', F.col("id"), '"'))
        .when(F.col("id") % 317 == 0, text(F.col("id")))
        .when(F.col("id") % 331 == 0, text(F.col("id"), ".5"))
        .when(F.col("id") % 337 == 0, text("true"))
        .when(F.col("id") % 347 == 0, text("null"))
        .when(F.col("id") % 349 == 0, text('{"a":', F.col("id"), "} x"))
        .when(F.col("id") % 353 == 0, text('{"a":', F.col("id"), '},{"b":1}'))
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(value, source_file, line_number)`` of the feed and of its bad lines, and the id."""
    rows = feed(spark, sf_dir)
    bad = F.when(F.col("copy") == 0, _bad_line())
    line = F.col("line_number")
    values = F.array(
        F.struct(F.col("raw_line").alias("value"), line.alias("line_number")),
        F.struct(bad.alias("value"), (line + 3).alias("line_number")),
    )
    return (
        rows.select("id", "source_file", F.inline(values))
        .filter(F.col("value").isNotNull())
        .select("value", "source_file", "line_number", "id")
    )


def write_files(spark: SparkSession, sf_dir: str, label: str) -> str:
    """The lines as text files of ``IDS_PER_FILE`` ids each, blank lines among them.

    Returns the folder; the files lie in ``file=<n>`` folders below it.
    """
    folder = scratch_dir(spark, label)
    blank = F.when(F.col("id") % 13 == 0, F.lit("\n \t")).otherwise(F.lit(""))
    file = F.floor(F.col("id") / IDS_PER_FILE).alias("file")
    (
        lines(spark, sf_dir)
        .select(file, "line_number", F.concat("value", blank).alias("value"))
        .repartition("file")
        .sortWithinPartitions("file", "line_number")
        .select("file", "value")
        .write.partitionBy("file")
        .text(folder)
    )
    return folder


def write_daily_files(spark: SparkSession, rows: DataFrame, label: str) -> str:
    """Lines as one text file per day under the days' own file names; returns the folder."""
    folder = scratch_dir(spark, label)
    (
        rows.select(F.col("source_file").alias("day"), "line_number", "value")
        .repartition("day")
        .sortWithinPartitions("day", "line_number")
        .select("day", "value")
        .write.partitionBy("day")
        .text(folder)
    )
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for part in files.globStatus(path(f"{folder}/day=*/*.txt")):  # Spark chose their names
        day = part.getPath().getParent().getName().removeprefix("day=")
        files.rename(part.getPath(), path(folder, day))
    return folder


def ingest_daily_files(loaded: Warehouse, rows: DataFrame, label: str) -> None:
    folder = write_daily_files(loaded.spark, rows, label)
    loaded.ingest(folder, INGESTED_AT, accounts=None, users=None)


FILES = "file=*/*.txt"


def file_number() -> Column:
    return F.regexp_extract("source_file", r"file=(\d+)/", 1).cast("long")


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_events(raw_events(spark, sf_dir))


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_events(
        raw_events(spark, sf_dir), accounts(spark, sf_dir), users(spark, sf_dir)
    )


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_events(
        raw_events(spark, sf_dir), accounts(spark, sf_dir), users(spark, sf_dir)
    )


def load(spark: SparkSession, sf_dir: str, root: str) -> Warehouse:
    """A warehouse with the feed in its raw layer, not yet built."""
    loaded = Warehouse(spark, root)
    # Lines read from files lie together by file; those of the feed have to be brought so.
    by_file = lines(spark, sf_dir).hint("rebalance", "source_file")
    bronze.replace_by_file(parse_lines(by_file, INGESTED_AT), loaded.path("raw/lines"))
    for name, rows in (("accounts", accounts(spark, sf_dir)), ("users", users(spark, sf_dir))):
        store_metadata(loaded, name, rows)
    return loaded


def store_metadata(loaded: Warehouse, name: str, rows: DataFrame) -> None:
    """Rows in the raw layer, as if read from ``<name>.csv``."""
    stored = rows.select(
        "*",
        utc_literal(INGESTED_AT).alias("ingested_at"),
        F.lit(f"{name}.csv").alias("source_file"),
    )
    bronze.replace_by_file(stored, loaded.path(f"raw/{name}"))


_built: dict[tuple[str, str], Warehouse] = {}
_building = threading.Lock()


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The built warehouse of a folder of tables, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _building:
        if key not in _built:
            fresh = load(spark, sf_dir, scratch_dir(spark, "warehouse"))
            fresh.build(check=False)  # the checks are queries of their own
            _built[key] = fresh
    return Warehouse(spark, _built[key].root)
