"""Queries by operator: name -> (function of session and table folder, expected-result SQL).

Queries on the clean events and the marts read the warehouse that ``feed.warehouse`` builds
once from the tables; the others compute from the tables directly. Means and
deviations of doubles are rounded on both sides, as their last digits depend on row order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions import scalar
from eventmart.functions.scalar import money_sum, ratio, reason_bucket
from eventmart.operators import classify, marts, quality
from eventmart.operators.quantiles import histogram_quantiles
from eventmart.plans import consumers, monitoring, reports
from eventmart.plans.warehouse import CLEAN, REJECTED, Warehouse
from eventmart.schemas import EVENT_KEYS, FUNNEL_STAGES, METRICS
from eventmart.session import materialize, scratch_dir
from eventmart.sources import jsonl, metadata
from eventmart.streaming import costs
from eventmart.streaming import ingest as stream
from eventmart_checks import feed
from eventmart_checks.expected import sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
EXPECTED: dict[str, str] = {}

LINEAGE = ("source_file", "line_number")


def query(name: str, expected: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        EXPECTED[name] = sql(expected)
        return function

    return register


def mart(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return feed.warehouse(spark, sf_dir).table(name)


# -- sources and sinks ---------------------------------------------------------------


@query(
    "s01_jsonl_scan",
    "SELECT file, line AS value FROM placed "
    "UNION ALL SELECT file, ' \t' FROM placed WHERE id % 13 = 0",
)
def jsonl_scan(spark, sf_dir):
    lines = jsonl.read_lines(spark, feed.write_files(spark, sf_dir, "scan"), feed.FILES)
    return lines.select(feed.file_number().alias("file"), "value")


@query(
    "s02_line_lineage",
    "SELECT file, place::BIGINT AS line_number, line AS value FROM placed "
    "UNION ALL SELECT file, place::BIGINT + 1, ' \t' FROM placed WHERE id % 13 = 0",
)
def line_lineage(spark, sf_dir):
    lines = jsonl.read_lines(spark, feed.write_files(spark, sf_dir, "lineage"), feed.FILES)
    return lines.select(feed.file_number().alias("file"), "line_number", "value")


@query(
    "s03_blank_line_skip",
    "SELECT file, place::BIGINT AS line_number, line AS value FROM placed",
)
def blank_line_skip(spark, sf_dir):
    lines = jsonl.read_lines(spark, feed.write_files(spark, sf_dir, "blank"), feed.FILES)
    return jsonl.skip_blank(lines).select(feed.file_number().alias("file"), "line_number", "value")


@query(
    "s04_json_gate",
    "SELECT source_file, line_number, NULL AS ingest_reason FROM f "
    "UNION ALL SELECT source_file, line_number, reason FROM bad",
)
def json_gate(spark, sf_dir):
    parsed = jsonl.parse_lines(feed.lines(spark, sf_dir), feed.INGESTED_AT)
    return parsed.select(*LINEAGE, "ingest_reason")


@query(
    "s05_promote_columns",
    """SELECT source_file, line_number, event_id, event_ts_raw AS event_ts,
              strftime(received_ts, '%Y-%m-%dT%H:%M:%SZ') AS received_ts, account_id, user_id,
              session_id, event_name,
              CASE WHEN ai THEN '{' || coalesce('"accepted":' || accepted::VARCHAR || ',', '')
                   || '"completion_tokens":' || completion_tokens
                   || CASE WHEN id % 7 = 0 THEN '' WHEN id % 11 = 0 THEN ',"cost_usd":null'
                      ELSE ',"cost_usd":0.1' || lpad(((id * 13) % 1000)::VARCHAR, 3, '0') || '1'
                      END
                   || ',"latency_ms":' || coalesce(latency_ms::VARCHAR, '"fast"')
                   || ',"model":"' || model || '","prompt_tokens":' || prompt_tokens
                   || ',"workflow":"' || workflow || '"}'
                   WHEN event_name = 'prompt_submitted' THEN '{"prompt_length_chars":'
                   || prompt_length_chars || ',"workflow":"' || workflow || '"}'
                   WHEN event_name = 'workflow_completed' THEN '{"duration_ms":' || duration_ms
                   || ',"workflow":"' || workflow || '"}'
                   WHEN event_name = 'session_started' THEN '{"device":"web","workflow":"'
                   || workflow || '"}'
                   WHEN event_name = 'response_rejected' THEN '{"reason":"tone","workflow":"'
                   || workflow || '"}'
                   ELSE properties END AS properties
       FROM j""",
)
def promote_columns(spark, sf_dir):
    return mart(spark, sf_dir, "raw_events").select(
        *LINEAGE, *EVENT_KEYS, F.to_json("properties").alias("properties")
    )


@query(
    "s06_raw_payload_keep",
    "SELECT source_file, line_number, line AS raw_payload, TIMESTAMP '2024-02-01' AS ingested_at "
    "FROM j",
)
def raw_payload_keep(spark, sf_dir):
    return mart(spark, sf_dir, "raw_events").select(*LINEAGE, "raw_payload", "ingested_at")


@query(
    "s07_replace_by_file",
    """SELECT source_file, count(*) AS line_count, count(reason) AS rejected FROM (
         SELECT source_file, NULL AS reason FROM j
         UNION ALL SELECT source_file, reason FROM bad
                   WHERE source_file >= 'events_2024-01-11') GROUP BY source_file""",
)
def replace_by_file(spark, sf_dir):
    """Load all files, then new versions of the first ten days, without their bad lines."""
    loaded = Warehouse(spark, scratch_dir(spark, "versions"))
    lines = feed.lines(spark, sf_dir)
    early = F.col("source_file") < "events_2024-01-11"
    is_bad = F.col("line_number") % 4 == 0
    for label, part in (("first", lines), ("second", lines.filter(early & ~is_bad))):
        feed.ingest_daily_files(loaded, part, label)
    return loaded.ingest_stats().select(
        "source_file",
        (F.col("events_loaded") + F.col("lines_rejected")).alias("line_count"),
        F.col("lines_rejected").alias("rejected"),
    )


@query(
    "s08_csv_metadata",
    """SELECT 'accounts' AS table_name, account_id AS key, account_name AS name, plan AS detail,
              seat_limit, created_at, (SELECT count(*) FROM accounts) AS rows_loaded FROM accounts
       UNION ALL SELECT 'users', user_id, email, role, NULL, created_at,
              (SELECT count(*) FROM users) FROM users""",
)
def csv_metadata(spark, sf_dir):
    """CSV files of awkward names, loaded twice; the number of rows comes from the load."""
    folder = scratch_dir(spark, "metadata")
    stamp = F.date_format("created_at", feed.CLOCK).alias("created_at")
    for name, rows in (("accounts", feed.accounts(spark, sf_dir)), ("users", feed.users(spark, sf_dir))):
        rows = rows.select(*(c for c in rows.columns if c != "created_at"), stamp)
        rows.write.option("header", True).csv(f"{folder}/all {name} 100%")
    loaded = Warehouse(spark, f"{folder}/warehouse")
    for _ in range(2):
        counts = loaded.ingest(
            folder, feed.INGESTED_AT, None, None, "all accounts 100%/*.csv", "all users 100%/*.csv"
        )
    read = {
        name: loaded.table(f"raw_{name}").withColumn(
            "rows_loaded", F.lit(counts[f"{name}_loaded"]).cast("long")
        )
        for name in ("accounts", "users")
    }
    return (
        read["accounts"]
        .select(
            F.lit("accounts").alias("table_name"),
            F.col("account_id").alias("key"),
            F.col("account_name").alias("name"),
            F.col("plan").alias("detail"),
            "seat_limit",
            "created_at",
            "rows_loaded",
        )
        .unionAll(
            read["users"].select(
                F.lit("users"),
                "user_id",
                "email",
                "role",
                F.lit(None).cast("int"),
                "created_at",
                "rows_loaded",
            )
        )
    )


@query(
    "s09_contract_seed",
    "SELECT names.event_name, count(f.id) AS events FROM names "
    "LEFT JOIN f ON f.event_name = names.event_name GROUP BY names.event_name",
)
def contract_seed(spark, sf_dir):
    """The contract as a file, stored by the warehouse and read back from it."""
    folder = scratch_dir(spark, "contract")
    metadata.contract_seed(spark).write.option("header", True).csv(f"{folder}/names.csv")
    loaded = Warehouse(spark, f"{folder}/warehouse")
    loaded.ingest(folder, None, None, f"{folder}/names.csv", None, None)
    counts = feed.feed(spark, sf_dir).groupBy("event_name").agg(F.count("*").alias("events"))
    return (
        loaded.table("expected_event_names")
        .join(counts, "event_name", "left")
        .select("event_name", F.coalesce("events", F.lit(0)).cast("long").alias("events"))
    )


@query("s10_layer_sink", "SELECT event_date, account_id, events, plan FROM d")
def layer_sink(spark, sf_dir):
    """The mart as the warehouse wrote it, through the view it offers to SQL."""
    feed.warehouse(spark, sf_dir).create_views()
    return spark.sql("SELECT event_date, account_id, events, plan FROM daily_account_metrics")


@query(
    "s11_ingest_stats",
    """SELECT source_file, count(*) - count(reason) AS events_loaded,
              count(reason) AS lines_rejected, 0::BIGINT AS lines_beyond_limits
       FROM (SELECT source_file, NULL AS reason FROM f
             UNION ALL SELECT source_file, reason FROM bad) GROUP BY source_file""",
)
def ingest_stats(spark, sf_dir):
    return feed.warehouse(spark, sf_dir).ingest_stats()


# -- typing, projection and scalar functions -------------------------------------------


@query("e01_try_cast_ts", "SELECT source_file, line_number, event_ts, received_ts FROM f")
def try_cast_ts(spark, sf_dir):
    return feed.raw_events(spark, sf_dir).select(
        *LINEAGE,
        scalar.lenient_timestamp(F.col("event_ts")).alias("event_ts"),
        scalar.lenient_timestamp(F.col("received_ts")).alias("received_ts"),
    )


@query("e02_ts_to_date", "SELECT event_id, event_date FROM s")
def ts_to_date(spark, sf_dir):
    return mart(spark, sf_dir, "stg_events").select("event_id", "event_date")


TEXTS = ("workflow", "model", "device", "error_code", "rejected_reason_text", "invite_channel")


@query("e03_json_string", f"SELECT source_file, line_number, {', '.join(TEXTS)} FROM f")
def json_string(spark, sf_dir):
    return feed.typed(spark, sf_dir).select(*LINEAGE, *TEXTS)


@query("e04_json_number", f"SELECT source_file, line_number, {', '.join(METRICS)} FROM f")
def json_number(spark, sf_dir):
    return feed.typed(spark, sf_dir).select(*LINEAGE, *METRICS)


@query("e05_json_boolean", "SELECT source_file, line_number, accepted FROM f")
def json_boolean(spark, sf_dir):
    return feed.typed(spark, sf_dir).select(*LINEAGE, "accepted")


@query("e06_json_type_check", "SELECT source_file, line_number, breaks_contract FROM f")
def json_type_check(spark, sf_dir):
    return feed.typed(spark, sf_dir).select(*LINEAGE, "breaks_contract")


@query(
    "e07_coalesce_default",
    "SELECT source_file, line_number, "
    + ", ".join(f"coalesce({metric}, 0) AS {metric}" for metric in METRICS)
    + " FROM f",
)
def coalesce_default(spark, sf_dir):
    return feed.typed(spark, sf_dir).select(
        *LINEAGE, *(F.coalesce(metric, F.lit(0)).alias(metric) for metric in METRICS)
    )


@query(
    "e08_least_of",
    "SELECT source_file, line_number, "
    "CASE WHEN latency_ms < 0 THEN -5 ELSE 0 END::DOUBLE AS lowest FROM f",
)
def least_of(spark, sf_dir):
    return feed.typed(spark, sf_dir).select(*LINEAGE, classify.lowest_metric().alias("lowest"))


@query(
    "e09_case_first_match",
    "SELECT source_file, line_number, CASE WHEN rejection_reason <> 'duplicate_event_id' "
    "THEN rejection_reason END AS rejection_reason FROM c",
)
def case_first_match(spark, sf_dir):
    return feed.validated(spark, sf_dir).select(*LINEAGE, "rejection_reason")


@query(
    "e10_null_if_zero",
    "SELECT event_date, account_id, "
    "round(responses_rejected / nullif(prompts_submitted, 0), 6) AS per_prompt FROM d",
)
def null_if_zero(spark, sf_dir):
    share = ratio(F.col("responses_rejected"), F.col("prompts_submitted"))
    return mart(spark, sf_dir, "daily_account_metrics").select(
        "event_date", "account_id", F.round(share, 6).alias("per_prompt")
    )


DIGITS = (0, 1, 2, 4, 6)


@query(
    "e11_round_n",
    "SELECT event_id AS interaction_id, "
    + ", ".join(f"round(cost_usd, {n}) AS cost_{n}" for n in DIGITS)
    + " FROM i",
)
def round_n(spark, sf_dir):
    return mart(spark, sf_dir, "fact_ai_interactions").select(
        "interaction_id", *(F.round("cost_usd", n).alias(f"cost_{n}") for n in DIGITS)
    )


@query("e12_email_mask", "SELECT user_id, '***' || substr(email, strpos(email, '@')) AS masked FROM users")
def email_mask(spark, sf_dir):
    return feed.users(spark, sf_dir).select(
        "user_id", scalar.masked_email(F.col("email")).alias("masked")
    )


@query(
    "e13_lateness",
    "SELECT event_id, lateness_seconds, lateness_seconds > 3600 AS is_late FROM s",
)
def lateness(spark, sf_dir):
    return mart(spark, sf_dir, "stg_events").select("event_id", "lateness_seconds", "is_late")


@query("e14_token_sum", "SELECT event_id, total_tokens FROM s")
def token_sum(spark, sf_dir):
    return mart(spark, sf_dir, "stg_events").select("event_id", "total_tokens")


@query("e15_null_flag", "SELECT event_id AS interaction_id, cost_usd IS NULL AS is_cost_estimated FROM i")
def null_flag(spark, sf_dir):
    return mart(spark, sf_dir, "fact_ai_interactions").select("interaction_id", "is_cost_estimated")


@query("e16_like_bucket", "SELECT source_file, line_number, rejection_reason AS reason FROM rejected")
def like_bucket(spark, sf_dir):
    """Reasons with parser detail behind them, as other loaders write them, fall together."""
    reason = F.col("rejection_reason")
    detailed = F.when(
        reason == "malformed_json", F.concat(reason, F.lit(": line "), F.col("line_number"))
    ).otherwise(reason)
    return (
        mart(spark, sf_dir, "rejected_events")
        .select(*LINEAGE, detailed.alias("detailed"))
        .select(*LINEAGE, reason_bucket(F.col("detailed")).alias("reason"))
    )


@query(
    "e17_col_exclude",
    "SELECT source_file, line_number, event_id, event_name, rejection_reason FROM c",
)
def col_exclude(spark, sf_dir):
    kept = {*LINEAGE, "event_id", "event_name", "rejection_reason"}
    events = mart(spark, sf_dir, "int_events_classified")
    return events.drop(*(column for column in events.columns if column not in kept))


@query(
    "e18_rename_typed_null",
    "SELECT rejection_stage, rejection_reason, event_id, event_name, raw_data, source_file, "
    "line_number FROM rejected WHERE rejection_stage = 'ingest'",
)
def rename_typed_null(spark, sf_dir):
    built = feed.warehouse(spark, sf_dir)
    return (
        classify.rejected_events(built.table("raw_ingest_rejections"), built.classified(REJECTED))
        .filter(F.col("rejection_stage") == "ingest")
        .drop("ingested_at")
    )


@query("e19_duration", "SELECT session_id, duration_seconds FROM q")
def duration(spark, sf_dir):
    return mart(spark, sf_dir, "fact_sessions").select("session_id", "duration_seconds")


# -- filters -----------------------------------------------------------------------------


@query(
    "f01_valid_split",
    "SELECT source_file, line_number, CASE WHEN rejection_reason IS NULL THEN 'clean' "
    "ELSE 'rejected' END AS side FROM c",
)
def valid_split(spark, sf_dir):
    built = feed.warehouse(spark, sf_dir)
    sides = [
        built.classified(side).select(*LINEAGE, F.lit(side).alias("side"))
        for side in (CLEAN, REJECTED)
    ]
    return sides[0].unionByName(sides[1])


@query("f02_name_equals", "SELECT event_id, model FROM s WHERE ai")
def name_equals(spark, sf_dir):
    return marts.ai_calls(mart(spark, sf_dir, "stg_events")).select("event_id", "model")


@query(
    "f03_name_in_list",
    "SELECT event_id, event_name FROM s WHERE event_name = 'response_accepted' "
    "OR event_name = 'response_rejected'",
)
def name_in_list(spark, sf_dir):
    return (
        mart(spark, sf_dir, "stg_events")
        .filter(F.col("event_name").isin("response_accepted", "response_rejected"))
        .select("event_id", "event_name")
    )


@query(
    "f04_not_in_seed",
    "SELECT source_file, line_number, event_name FROM f "
    "WHERE event_name IS NULL OR event_name = 'assistant_hovered'",
)
def not_in_seed(spark, sf_dir):
    """By the rule of the build, with the names the warehouse holds."""
    unknown = classify.is_unknown_name(feed.warehouse(spark, sf_dir).event_names())
    return feed.raw_events(spark, sf_dir).filter(unknown).select(*LINEAGE, "event_name")


@query("f05_not_null_filter", "SELECT event_id, session_id FROM s WHERE session_id IS NOT NULL")
def not_null_filter(spark, sf_dir):
    return (
        mart(spark, sf_dir, "stg_events")
        .filter(F.col("session_id").isNotNull())
        .select("event_id", "session_id")
    )


@query("f06_flag_filter", "SELECT session_id FROM q WHERE n1 > 0 AND n2 > 0 AND n3 > 0")
def flag_filter(spark, sf_dir):
    return (
        mart(spark, sf_dir, "fact_sessions")
        .filter(
            F.col("has_session_started")
            & F.col("has_prompt_submitted")
            & F.col("has_ai_response")
        )
        .select("session_id")
    )


@query(
    "f07_positive_filter",
    "SELECT event_date, account_id, ai_interactions FROM d WHERE ai_interactions > 0",
)
def positive_filter(spark, sf_dir):
    return (
        mart(spark, sf_dir, "daily_account_metrics")
        .filter(F.col("ai_interactions") > 0)
        .select("event_date", "account_id", "ai_interactions")
    )


@query(
    "f08_scalar_threshold",
    "SELECT user_id, account_id, events, errors FROM user_rates WHERE rate > "
    "(SELECT avg(rate) + 2 * stddev_pop(rate) FROM user_rates)",
)
def scalar_threshold(spark, sf_dir):
    rates = reports.user_error_rates(mart(spark, sf_dir, "stg_events"))
    return (
        rates.crossJoin(F.broadcast(reports.error_rate_cutoff(rates)))
        .filter(F.col("error_rate") > F.col("cutoff"))
        .select("user_id", "account_id", "events", "errors")
    )


# -- joins -------------------------------------------------------------------------------


@query(
    "j01_left_equi_metadata",
    """SELECT source_file, line_number, a.account_id AS known_account_id,
              u.user_id AS known_user_id, u.account_id AS user_home_account_id
       FROM f LEFT JOIN accounts a ON f.account_id = a.account_id
       LEFT JOIN users u ON f.user_id = u.user_id""",
)
def left_equi_metadata(spark, sf_dir):
    return classify.attach_owners(
        feed.raw_events(spark, sf_dir), feed.accounts(spark, sf_dir), feed.users(spark, sf_dir)
    ).select(*LINEAGE, "known_account_id", "known_user_id", "user_home_account_id")


@query(
    "j02_left_using_rates",
    "SELECT event_id, model, usd_per_token FROM i",
)
def left_using_rates(spark, sf_dir):
    calls = marts.ai_calls(mart(spark, sf_dir, "stg_events"))
    return calls.join(mart(spark, sf_dir, "model_rates"), "model", "left").select(
        "event_id", "model", "usd_per_token"
    )


@query(
    "j03_left_composite",
    """SELECT d.event_date, d.account_id, d.events, x.estimated
       FROM d LEFT JOIN (SELECT event_date, account_id,
                                sum(cost_usd_estimated::DECIMAL(18, 6))::DOUBLE AS estimated
                         FROM i GROUP BY event_date, account_id) x
       ON x.event_date = d.event_date AND x.account_id = d.account_id""",
)
def left_composite(spark, sf_dir):
    costs = (
        mart(spark, sf_dir, "fact_ai_interactions")
        .groupBy("event_date", "account_id")
        .agg(money_sum(F.col("cost_usd_estimated")).alias("estimated"))
    )
    return (
        marts.account_days(mart(spark, sf_dir, "stg_events"))
        .join(costs, ["event_date", "account_id"], "left")
        .select("event_date", "account_id", "events", "estimated")
    )


@query(
    "j04_left_dim_enrich",
    "SELECT event_id, account_name, plan FROM s JOIN accounts USING (account_id)",
)
def left_dim_enrich(spark, sf_dir):
    return (
        mart(spark, sf_dir, "stg_events")
        .join(mart(spark, sf_dir, "dim_accounts"), "account_id", "left")
        .select("event_id", "account_name", "plan")
    )


@query("j05_inner_using", "SELECT session_id, account_id, user_id, event_count FROM q")
def inner_using(spark, sf_dir):
    return mart(spark, sf_dir, "fact_sessions").select(
        "session_id", "account_id", "user_id", "event_count"
    )


@query(
    "j06_cross_scalar",
    """SELECT event_date, account_id, (SELECT min(event_date) FROM d) AS first_day,
              (SELECT max(event_date) FROM d) AS last_day FROM d""",
)
def cross_scalar(spark, sf_dir):
    daily = mart(spark, sf_dir, "daily_account_metrics")
    return daily.crossJoin(F.broadcast(reports.boundary_days(daily))).select(
        "event_date", "account_id", "first_day", "last_day"
    )


@query(
    "j07_orphan_anti",
    """SELECT 'account_id' AS column_name, account_id AS value, count(*) AS n FROM f
       WHERE account_id NOT IN (SELECT account_id FROM accounts) GROUP BY account_id
       UNION ALL SELECT 'user_id', user_id, count(*) FROM f
       WHERE user_id NOT IN (SELECT user_id FROM users) GROUP BY user_id""",
)
def orphan_anti(spark, sf_dir):
    events = mart(spark, sf_dir, "raw_events")
    parts = [
        quality.relationships(events, column, mart(spark, sf_dir, parent), column).select(
            F.lit(column).alias("column_name"), F.col(column).alias("value"), "n"
        )
        for column, parent in (("account_id", "raw_accounts"), ("user_id", "raw_users"))
    ]
    return parts[0].unionAll(parts[1])


# -- aggregations --------------------------------------------------------------------------


@query(
    "a01_group_count",
    "SELECT workflow, model, count(*) AS calls FROM i GROUP BY workflow, model",
)
def group_count(spark, sf_dir):
    calls = mart(spark, sf_dir, "fact_ai_interactions")
    return calls.groupBy("workflow", "model").agg(F.count("*").alias("calls"))


@query("a02_count_distinct", "SELECT event_date, account_id, active_users, sessions FROM d")
def count_distinct(spark, sf_dir):
    return marts.account_days(mart(spark, sf_dir, "stg_events")).select(
        "event_date", "account_id", "active_users", "sessions"
    )


COUNTS = (
    "prompts_submitted",
    "ai_interactions",
    "responses_accepted",
    "responses_rejected",
    "workflows_completed",
    "errors_raised",
    "uncosted_interactions",
)


@query("a03_count_filter", f"SELECT event_date, account_id, {', '.join(COUNTS)} FROM d")
def count_filter(spark, sf_dir):
    return marts.account_days(mart(spark, sf_dir, "stg_events")).select(
        "event_date", "account_id", *COUNTS
    )


@query("a04_sum_filter", "SELECT event_date, account_id, ai_total_tokens, ai_cost_usd FROM d")
def sum_filter(spark, sf_dir):
    days = marts.account_days(mart(spark, sf_dir, "stg_events"))
    return days.select("event_date", "account_id", "ai_total_tokens", "ai_cost_usd")


@query("a05_sum_ratio", "SELECT model, usd_per_token FROM rates")
def sum_ratio(spark, sf_dir):
    calls = marts.ai_calls(mart(spark, sf_dir, "stg_events"))
    return marts.model_rates(calls)


@query("a06_min_max", "SELECT session_id, started_at, ended_at, workflow FROM q")
def min_max(spark, sf_dir):
    return marts.fact_sessions(mart(spark, sf_dir, "stg_events")).select(
        "session_id", "started_at", "ended_at", "workflow"
    )


@query(
    "a07_bool_or",
    """SELECT session_id, n1 > 0 AS has_session_started, n2 > 0 AS has_prompt_submitted,
              n3 > 0 AS has_ai_response, n4 > 0 AS has_response_accepted,
              n5 > 0 AS has_workflow_completed FROM q""",
)
def bool_or(spark, sf_dir):
    return marts.fact_sessions(mart(spark, sf_dir, "stg_events")).select(
        "session_id",
        "has_session_started",
        "has_prompt_submitted",
        "has_ai_response",
        "has_response_accepted",
        "has_workflow_completed",
    )


@query(
    "a08_count_nonnull",
    """SELECT workflow, model, sum((accepted IS NOT NULL)::INT)::BIGINT AS flagged,
              sum((accepted IS TRUE)::INT)::BIGINT AS accepted FROM i GROUP BY ALL""",
)
def count_nonnull(spark, sf_dir):
    calls = mart(spark, sf_dir, "fact_ai_interactions")
    return calls.groupBy("workflow", "model").agg(
        F.count("accepted").alias("flagged"), F.count_if("accepted").alias("accepted")
    )


@query(
    "a09_average",
    "SELECT workflow, model, round(sum(cost_usd_estimated) / count(cost_usd_estimated), 6) "
    "AS avg_cost FROM i GROUP BY workflow, model",
)
def average(spark, sf_dir):
    calls = mart(spark, sf_dir, "fact_ai_interactions")
    return calls.groupBy("workflow", "model").agg(
        F.round(F.avg("cost_usd_estimated"), 6).alias("avg_cost")
    )


def _latency_quantile(spark: SparkSession, sf_dir: str, name: str, quantile: float) -> DataFrame:
    calls = mart(spark, sf_dir, "fact_ai_interactions")
    histogram = calls.groupBy("workflow", "latency_ms").agg(F.count("*").alias("n"))
    return histogram_quantiles(histogram, "workflow", "latency_ms", "n", {name: quantile})


@query("a10_median", "SELECT workflow, median(latency_ms) AS median_ms FROM i GROUP BY workflow")
def median(spark, sf_dir):
    return _latency_quantile(spark, sf_dir, "median_ms", 0.5)


@query(
    "a11_quantile_cont",
    "SELECT workflow, round(quantile_cont(latency_ms, 0.95), 3) AS p95_ms FROM i GROUP BY workflow",
)
def quantile_cont(spark, sf_dir):
    quantiles = _latency_quantile(spark, sf_dir, "p95_ms", 0.95)
    return quantiles.withColumn("p95_ms", F.round("p95_ms", 3))


@query(
    "a12_stddev_pop",
    "SELECT round(sqrt(avg(rate * rate) - avg(rate) ** 2), 9) AS spread FROM user_rates",
)
def stddev_pop(spark, sf_dir):
    rates = reports.user_error_rates(mart(spark, sf_dir, "stg_events"))
    return rates.agg(F.round(F.stddev_pop("error_rate"), 9).alias("spread"))


@query(
    "a13_global_agg",
    """SELECT count(*) AS events, count(DISTINCT user_id) AS users,
              min(event_date) AS first_day, max(event_date) AS last_day FROM s""",
)
def global_agg(spark, sf_dir):
    return mart(spark, sf_dir, "stg_events").agg(
        F.count("*").alias("events"),
        F.count_distinct("user_id").alias("users"),
        F.min("event_date").alias("first_day"),
        F.max("event_date").alias("last_day"),
    )


BOUNDARY = """
    SELECT account_id, account_name,
           sum(CASE WHEN event_date = lo THEN events END)::BIGINT AS first_day_events,
           sum(CASE WHEN event_date = hi THEN events END)::BIGINT AS last_day_events,
           sum(events)::BIGINT AS total_events
    FROM d, (SELECT min(event_date) AS lo, max(event_date) AS hi FROM d) b
    GROUP BY account_id, account_name"""


@query("a14_conditional_pivot", BOUNDARY)
def conditional_pivot(spark, sf_dir):
    return reports.boundary_day_events(mart(spark, sf_dir, "daily_account_metrics"))


@query(
    "a15_having_count",
    "SELECT event_id, count(*) AS n FROM f WHERE event_id IS NOT NULL "
    "GROUP BY event_id HAVING count(*) > 1",
)
def having_count(spark, sf_dir):
    return quality.unique(mart(spark, sf_dir, "raw_events"), "event_id")


# -- windows, sorts, set operations ----------------------------------------------------------


@query(
    "w01_dedup_first_received",
    "SELECT event_id, source_file, line_number, rejection_reason IS NULL AS is_kept FROM c "
    "WHERE coalesce(rejection_reason, 'duplicate_event_id') = 'duplicate_event_id'",
)
def dedup_first_received(spark, sf_dir):
    validated = materialize(feed.validated(spark, sf_dir), "validated")
    repeated = materialize(classify.repeated_events(validated), "repeated")
    marked = classify.mark_duplicates(validated, repeated)
    reason = F.col("rejection_reason")
    return marked.filter(reason.isNull() | (reason == classify.DUPLICATE)).select(
        "event_id", *LINEAGE, reason.isNull().alias("is_kept")
    )


@query("w02_first_row_qualify", "SELECT session_id, first_event_id, account_id, user_id FROM q")
def first_row_qualify(spark, sf_dir):
    first = F.min_by(
        F.struct("event_id", "account_id", "user_id"), F.struct("event_ts", "event_id")
    )
    return (
        mart(spark, sf_dir, "stg_events")
        .filter(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(first.alias("first"))
        .select(
            "session_id",
            F.col("first.event_id").alias("first_event_id"),
            "first.account_id",
            "first.user_id",
        )
    )


FUNNEL = """
    SELECT stage_order, stage, sessions, round(100.0 * sessions / (SELECT max(sessions)
           FROM stages WHERE stage_order = 1), 1)::DOUBLE AS pct_of_started FROM stages"""


@query("w03_first_value_share", f"SELECT stage_order, pct_of_started FROM ({FUNNEL})")
def first_value_share(spark, sf_dir):
    return reports.session_funnel(mart(spark, sf_dir, "fact_sessions")).select(
        "stage_order", "pct_of_started"
    )


@query("o01_sort_multi", "SELECT event_date, account_id, active_users FROM d ORDER BY ALL")
def sort_multi(spark, sf_dir):
    daily = mart(spark, sf_dir, "daily_account_metrics")
    return daily.select("event_date", "account_id", "active_users").orderBy(
        F.col("event_date").asc_nulls_last(), F.col("account_id").asc_nulls_last()
    )


DECISIONS = """
    SELECT account_id, account_name,
           sum((event_name = 'response_rejected')::INT)::BIGINT AS rejected_responses,
           sum((event_name = 'response_accepted')::INT)::BIGINT AS accepted_responses,
           round(100.0 * rejected_responses / count(*), 1)::DOUBLE AS rejection_rate_pct
    FROM s JOIN accounts USING (account_id)
    WHERE event_name IN ('response_rejected', 'response_accepted')
    GROUP BY account_id, account_name"""


@query(
    "o02_sort_desc_metric",
    f"SELECT account_id, rejected_responses FROM ({DECISIONS}) ORDER BY 2 DESC, 1",
)
def sort_desc_metric(spark, sf_dir):
    built = feed.warehouse(spark, sf_dir)
    return reports.rejected_by_account(
        built.table("stg_events"), built.table("dim_accounts")
    ).select("account_id", "rejected_responses")


@query("u01_union_audit", "SELECT * FROM rejected")
def union_audit(spark, sf_dir):
    built = feed.warehouse(spark, sf_dir)
    return classify.rejected_events(
        built.table("raw_ingest_rejections"), built.classified(REJECTED)
    ).drop("ingested_at")


@query("u02_union_stages", "SELECT stage_order, stage, sessions FROM stages")
def union_stages(spark, sf_dir):
    return reports.funnel_stages(mart(spark, sf_dir, "fact_sessions"))


# -- models ----------------------------------------------------------------------------------

TYPED = (
    "workflow, model, prompt_tokens, completion_tokens, latency_ms, cost_usd, accepted, "
    "duration_ms, prompt_length_chars, device, error_code, rejected_reason_text, invite_channel"
)


@query(
    "m01_classify_events",
    f"""SELECT c.event_id, c.event_ts, j.event_ts_raw, c.received_ts, c.account_id, c.user_id,
               c.session_id, c.event_name,
               {', '.join('c.' + column for column in TYPED.split(', '))},
               j.line AS raw_payload, c.source_file, c.line_number,
               TIMESTAMP '2024-02-01' AS ingested_at, user_home_account_id, rejection_reason
        FROM c JOIN j USING (id, copy)""",
)
def classify_events(spark, sf_dir):
    return feed.classified(spark, sf_dir)


@query(
    "m02_stg_events",
    f"""SELECT event_id, event_ts, event_date, received_ts, lateness_seconds,
               lateness_seconds > 3600 AS is_late, account_id, user_id, session_id, event_name,
               {TYPED}, total_tokens, source_file, line_number,
               TIMESTAMP '2024-02-01' AS ingested_at FROM s""",
)
def stg_events(spark, sf_dir):
    return classify.stg_events(feed.classified(spark, sf_dir))


@query("m03_rejected_events", "SELECT *, TIMESTAMP '2024-02-01' AS ingested_at FROM rejected")
def rejected_events(spark, sf_dir):
    return mart(spark, sf_dir, "rejected_events")


@query(
    "m04_dim_accounts",
    "SELECT account_id, account_name, plan, industry, seat_limit, "
    "created_at AS account_created_at FROM accounts",
)
def dim_accounts(spark, sf_dir):
    return marts.dim_accounts(feed.accounts(spark, sf_dir))


@query(
    "m05_dim_users",
    """SELECT user_id, u.account_id, account_name,
              '***' || regexp_extract(email, '@.*') AS email_masked, role, status,
              u.created_at AS user_created_at
       FROM users u LEFT JOIN accounts a ON a.account_id = u.account_id""",
)
def dim_users(spark, sf_dir):
    return marts.dim_users(feed.users(spark, sf_dir), feed.accounts(spark, sf_dir))


@query(
    "m06_fact_ai_interactions",
    """SELECT event_id AS interaction_id, event_ts, event_date, account_id, user_id, session_id,
              workflow, model, prompt_tokens, completion_tokens, total_tokens, latency_ms,
              cost_usd, cost_usd_estimated, cost_usd IS NULL AS is_cost_estimated, accepted,
              lateness_seconds > 3600 AS is_late FROM i""",
)
def fact_ai_interactions(spark, sf_dir):
    built = feed.warehouse(spark, sf_dir)
    return marts.fact_ai_interactions(built.table("stg_events"), built.table("model_rates"))


@query(
    "m07_fact_sessions",
    """SELECT session_id, account_id, user_id, started_at, ended_at,
              started_at::DATE AS session_date, workflow, event_count, n2 AS prompts_submitted,
              n3 AS ai_responses, n4 AS responses_accepted, n6 AS responses_rejected,
              n5 AS workflows_completed, n7 AS errors_raised, total_tokens, cost_usd,
              n1 > 0 AS has_session_started, n2 > 0 AS has_prompt_submitted,
              n3 > 0 AS has_ai_response, n4 > 0 AS has_response_accepted,
              n5 > 0 AS has_workflow_completed, duration_seconds FROM q""",
)
def fact_sessions(spark, sf_dir):
    return marts.fact_sessions(mart(spark, sf_dir, "stg_events"))


@query("m08_daily_account_metrics", "SELECT * FROM d")
def daily_account_metrics(spark, sf_dir):
    built = feed.warehouse(spark, sf_dir)
    return marts.daily_account_metrics(
        built.table("stg_events"),
        built.table("fact_ai_interactions"),
        built.table("dim_accounts"),
    )


# -- reports -----------------------------------------------------------------------------------


@query(
    "r01_daily_active_users", "SELECT event_date, account_id, account_name, active_users FROM d"
)
def daily_active_users(spark, sf_dir):
    return feed.warehouse(spark, sf_dir).report("daily_active_users")


@query(
    "r02_ai_by_workflow_model",
    "SELECT workflow, model, count(*) AS ai_interactions FROM i GROUP BY workflow, model",
)
def ai_by_workflow_model(spark, sf_dir):
    return feed.warehouse(spark, sf_dir).report("ai_by_workflow_model")


@query("r03_latency_by_model", "SELECT * FROM latency")
def latency_by_model(spark, sf_dir):
    return feed.warehouse(spark, sf_dir).report("latency_by_model")


@query(
    "r04_daily_cost_by_account",
    """SELECT event_date, account_id, account_name,
              round(ai_cost_usd::DECIMAL(18, 6), 4)::DOUBLE AS ai_cost_usd,
              round(ai_cost_usd_estimated::DECIMAL(18, 6), 4)::DOUBLE AS ai_cost_usd_estimated,
              ai_interactions,
              uncosted_interactions FROM d WHERE ai_interactions <> 0""",
)
def daily_cost_by_account(spark, sf_dir):
    return feed.warehouse(spark, sf_dir).report("daily_cost_by_account")


@query("r05_session_funnel", FUNNEL)
def session_funnel(spark, sf_dir):
    return feed.warehouse(spark, sf_dir).report("session_funnel")


@query("r06_rejected_by_account", DECISIONS)
def rejected_by_account(spark, sf_dir):
    return feed.warehouse(spark, sf_dir).report("rejected_by_account")


@query(
    "r07_high_error_users",
    """SELECT user_id, account_id, events, errors, round(100 * rate, 2) AS error_rate_pct,
              round(100 * cutoff, 2) AS threshold_pct
       FROM user_rates, (SELECT avg(rate) + 2 * stddev_pop(rate) AS cutoff FROM user_rates) x
       WHERE rate > cutoff""",
)
def high_error_users(spark, sf_dir):
    return feed.warehouse(spark, sf_dir).report("high_error_users")


@query(
    "r08_usage_growth",
    f"""SELECT *, last_day_events - first_day_events AS absolute_growth,
               round(100.0 * last_day_events / first_day_events - 100, 1)::DOUBLE AS growth_pct
        FROM ({BOUNDARY}) WHERE first_day_events + last_day_events IS NOT NULL""",
)
def usage_growth(spark, sf_dir):
    return feed.warehouse(spark, sf_dir).report("usage_growth")


@query(
    "r09_acceptance_by_model",
    """SELECT model, count(*) AS ai_calls, count(accepted) AS flagged_calls,
              count(*) FILTER (WHERE accepted) AS accepted_calls,
              round(100.0 * accepted_calls / nullif(flagged_calls, 0), 1)::DOUBLE
                AS acceptance_rate_pct,
              round(avg(cost_usd_estimated), 4) AS avg_cost_usd,
              round(median(latency_ms)) AS median_latency_ms
       FROM i GROUP BY model""",
)
def acceptance_by_model(spark, sf_dir):
    return feed.warehouse(spark, sf_dir).report("acceptance_by_model")


# -- data quality: violations of raw data, as clean data has none ------------------------------


def _violations(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count("*").alias("violations")).select(
        F.lit(column).alias("column_name"), "violations"
    )


@query(
    "q01_unique",
    """SELECT 'event_id' AS column_name, count(*) AS violations FROM (
         SELECT event_id FROM f WHERE event_id IS NOT NULL GROUP BY event_id HAVING count(*) > 1)
       UNION ALL SELECT 'clean event_id', 0""",
)
def unique(spark, sf_dir):
    raw = quality.unique(mart(spark, sf_dir, "raw_events"), "event_id")
    clean = quality.unique(mart(spark, sf_dir, "stg_events"), "event_id")
    return _violations(raw, "event_id").unionAll(_violations(clean, "clean event_id"))


@query(
    "q02_not_null",
    " UNION ALL ".join(
        f"SELECT '{key}' AS column_name, count(*) - count({key}) AS violations FROM f"
        for key in ("event_id", "received_ts", "account_id", "user_id", "session_id", "event_name")
    ),
)
def not_null(spark, sf_dir):
    keys = ("event_id", "received_ts", "account_id", "user_id", "session_id", "event_name")
    checks = quality.row_checks(mart(spark, sf_dir, "raw_events"), "raw_events", keys, ())
    return checks.select("column_name", "violations")


@query(
    "q03_relationships",
    """SELECT 'account_id' AS column_name, count(DISTINCT account_id) AS violations FROM f
       WHERE account_id NOT IN (SELECT account_id FROM accounts)
       UNION ALL SELECT 'user_id', count(DISTINCT user_id) FROM f
       WHERE user_id NOT IN (SELECT user_id FROM users)
       UNION ALL SELECT 'event_name', count(DISTINCT event_name) FROM f
       WHERE event_name NOT IN (SELECT event_name FROM names)""",
)
def relationships(spark, sf_dir):
    events = mart(spark, sf_dir, "raw_events")
    parts = [
        _violations(
            quality.relationships(events, column, mart(spark, sf_dir, parent), column), column
        )
        for column, parent in (
            ("account_id", "raw_accounts"),
            ("user_id", "raw_users"),
            ("event_name", "expected_event_names"),
        )
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query(
    "q04_non_negative",
    "SELECT source_file, line_number, latency_ms FROM f WHERE latency_ms < 0",
)
def non_negative(spark, sf_dir):
    events = mart(spark, sf_dir, "int_events_classified")
    return quality.non_negative(events, "latency_ms").select(*LINEAGE, "latency_ms")


@query(
    "q05_unique_combination",
    "SELECT event_id, received_ts, count(*) AS n FROM f GROUP BY ALL HAVING count(*) > 1",
)
def unique_combination(spark, sf_dir):
    events = mart(spark, sf_dir, "int_events_classified")
    return quality.unique_combination(events, ["event_id", "received_ts"])


@query(
    "q06_reconciliation",
    """SELECT (SELECT count(*) FROM f) AS raw_events, (SELECT count(*) FROM bad)
              AS ingest_rejections, (SELECT count(*) FROM s) AS staged,
              (SELECT count(*) FROM rejected) AS rejected, TRUE AS reconciled""",
)
def reconciliation(spark, sf_dir):
    built = feed.warehouse(spark, sf_dir)
    return quality.reconciliation_summary(
        built.table("raw_events"),
        built.table("raw_ingest_rejections"),
        built.table("stg_events"),
        built.table("rejected_events"),
    )


@query(
    "q07_table_counts",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {part}"
        for name, part in (
            ("raw_events", "f"),
            ("raw_ingest_rejections", "bad"),
            ("raw_accounts", "accounts"),
            ("raw_users", "users"),
            ("stg_events", "s"),
            ("rejected_events", "rejected"),
            ("dim_accounts", "accounts"),
            ("dim_users", "users"),
            ("fact_ai_interactions", "i"),
            ("fact_sessions", "q"),
            ("daily_account_metrics", "d"),
        )
    ),
)
def table_counts(spark, sf_dir):
    return feed.warehouse(spark, sf_dir).table_counts()


@query(
    "q08_rejection_breakdown",
    "SELECT rejection_stage, rejection_reason AS reason, count(*) AS row_count FROM rejected "
    "GROUP BY ALL",
)
def rejection_breakdown(spark, sf_dir):
    return quality.rejection_breakdown(mart(spark, sf_dir, "rejected_events"))


# -- consumer queries ----------------------------------------------------------------------------


@query(
    "c01_kpi_summary",
    """SELECT (SELECT count(DISTINCT user_id) FROM s) AS users,
              (SELECT count(*) FROM q) AS sessions, (SELECT count(*) FROM i) AS interactions,
              (SELECT round(sum(ai_cost_usd_estimated::DECIMAL(18, 6)), 2)::DOUBLE FROM d) AS cost,
              (SELECT round(100 * avg((n5 > 0)::INT), 1) FROM q WHERE n1 > 0) AS completion""",
)
def kpi_summary(spark, sf_dir):
    built = feed.warehouse(spark, sf_dir)
    return consumers.kpi_summary(
        built.table("stg_events"),
        built.table("fact_sessions"),
        built.table("fact_ai_interactions"),
        built.table("daily_account_metrics"),
    )


@query("c02_daily_cost_series", "SELECT event_date, account_name, ai_cost_usd_estimated FROM d")
def daily_cost_series(spark, sf_dir):
    return consumers.daily_cost_series(mart(spark, sf_dir, "daily_account_metrics"))


@query(
    "c03_latency_long",
    """SELECT model, 'median_ms' AS metric, median_latency_ms AS ms FROM latency
       UNION ALL SELECT model, 'p95_ms', p95_latency_ms FROM latency""",
)
def latency_long(spark, sf_dir):
    return consumers.latency_long(feed.warehouse(spark, sf_dir).report("latency_by_model"))


@query(
    "c04_reject_reason_counts",
    "SELECT rejection_reason AS reason, count(*) AS row_count FROM rejected GROUP BY ALL",
)
def reject_reason_counts(spark, sf_dir):
    return consumers.reject_reason_counts(mart(spark, sf_dir, "rejected_events"))


@query(
    "c05_reject_listing",
    "SELECT rejection_stage, rejection_reason, event_id, source_file, line_number FROM rejected",
)
def reject_listing(spark, sf_dir):
    return consumers.reject_listing(mart(spark, sf_dir, "rejected_events"))


# -- beyond the batch: streams, alerts, ordered funnel ----------------------------------------------


@query(
    "x01_stream_ingest",
    """SELECT source_file, count(*) - count(reason) AS events_loaded,
              count(reason) AS lines_rejected, 0::BIGINT AS lines_beyond_limits
       FROM (SELECT source_file, NULL AS reason FROM f
             UNION ALL SELECT source_file, reason FROM bad) GROUP BY source_file""",
)
def stream_ingest(spark, sf_dir):
    """The feed's daily files through the stream, seven files a micro-batch."""
    loaded = Warehouse(spark, scratch_dir(spark, "stream"))
    folder = feed.write_daily_files(spark, feed.lines(spark, sf_dir), "stream-files")
    stream.ingest_available(loaded, folder, files_per_batch=7, clock=lambda: feed.INGESTED_AT)
    return loaded.ingest_stats()


@query(
    "x02_hourly_costs",
    """SELECT date_trunc('hour', event_ts) AS hour, account_id, model, count(*) AS calls,
              count(*) - count(cost_usd) AS uncosted_calls,
              sum(total_tokens)::BIGINT AS total_tokens,
              sum(cost_usd::DECIMAL(18, 6))::DOUBLE AS cost_usd
       FROM i GROUP BY ALL""",
)
def hourly_costs(spark, sf_dir):
    """Costs kept up to date by a stream; nothing is late, as the ids of all days are held."""
    loaded = Warehouse(spark, scratch_dir(spark, "stream"))
    for name, rows in (("accounts", feed.accounts(spark, sf_dir)), ("users", feed.users(spark, sf_dir))):
        feed.store_metadata(loaded, name, rows)
    folder = feed.write_daily_files(spark, feed.lines(spark, sf_dir), "stream-files")
    costs.cost_stream(loaded, folder, late="400 days", files_per_batch=11).awaitTermination()
    return costs.hourly_costs(loaded)


SIGNALS = """
    l AS (SELECT regexp_extract(source_file, '[0-9-]{10}')::DATE AS day, event_name, NULL AS reason
          FROM s UNION ALL SELECT regexp_extract(source_file, '[0-9-]{10}')::DATE, event_name,
          rejection_reason FROM rejected),
    signals AS (SELECT 'volume' AS signal, event_name AS key, day, count(*) AS value FROM l
          WHERE event_name IS NOT NULL GROUP BY ALL
          UNION ALL SELECT 'reject_rate', reason, day, 1000000 * count(*) // any_value(total)
          FROM l JOIN (SELECT day, count(*) AS total FROM l GROUP BY day) USING (day)
          WHERE reason IS NOT NULL GROUP BY reason, day),
    days AS (SELECT signal, key, unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS day
          FROM (SELECT DISTINCT signal, key FROM signals),
               (SELECT min(day)::TIMESTAMP AS lo, max(day)::TIMESTAMP AS hi FROM signals)),
    filled AS (SELECT signal, key, day, coalesce(value, 0)::BIGINT AS value
          FROM days LEFT JOIN signals USING (signal, key, day)),
    judged AS (SELECT *, count(*) OVER w AS n, avg(value) OVER w AS mean, sum(value) OVER w AS total,
          sum(value::HUGEINT * value) OVER w AS squares FROM filled WINDOW w AS (
          PARTITION BY signal, key ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))"""


@query(
    "x03_volume_anomalies",
    f"""SELECT signal, key, day, value, round(mean, 3) AS baseline,
              abs(7 * value - total) > 140
              AND (7 * value - total) ** 2 > 9 * (7 * squares - total ** 2) AS is_anomaly
        FROM (WITH {SIGNALS} SELECT * FROM judged) WHERE n = 7""",
)
def volume_anomalies(spark, sf_dir):
    built = feed.warehouse(spark, sf_dir)
    signals = monitoring.daily_signals(built.table("stg_events"), built.table("rejected_events"))
    return monitoring.signal_anomalies(signals)


@query(
    "x04_cost_anomalies",
    """SELECT account_id, model, day::DATE AS event_date, round(value / 1000000, 6) AS cost_usd,
              round(middle2 / 2000000, 7) AS median_usd, round(spread4 / 4000000, 8) AS deviation_usd,
              change2 > 20000 AND 2 * change2 > 5 * spread4 AS is_anomaly
       FROM (SELECT *, abs(2 * value - middle2) AS change2,
                    list_sort(list_transform(past, lambda x: abs(2 * x - middle2))) AS apart,
                    apart[(len(past) + 1) // 2] + apart[len(past) // 2 + 1] AS spread4
             FROM (SELECT *, list_sort(past) AS ordered,
                          ordered[(len(past) + 1) // 2] + ordered[len(past) // 2 + 1] AS middle2
                   FROM (SELECT account_id, model, day, value, list(value) OVER (
                           PARTITION BY account_id, model ORDER BY day
                           ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS past
                         FROM (SELECT account_id, model, day, coalesce(value, 0) AS value FROM (
                             SELECT account_id, model, unnest(generate_series(min(event_date)::TIMESTAMP,
                               (SELECT max(event_date)::TIMESTAMP FROM i), INTERVAL 1 DAY)) AS day
                             FROM i GROUP BY account_id, model)
                           LEFT JOIN (SELECT account_id, model, event_date::TIMESTAMP AS day,
                               sum(round(cost_usd_estimated::DECIMAL(30, 15) * 1000000))::BIGINT AS value
                             FROM i GROUP BY ALL) USING (account_id, model, day)))
                   WHERE len(past) >= 7))""",
)
def cost_anomalies(spark, sf_dir):
    return monitoring.cost_baselines(
        monitoring.daily_costs(mart(spark, sf_dir, "fact_ai_interactions"))
    )


def _chain(order: int) -> str:
    """The earliest event of a stage after the chain so far, as SQL."""
    stage = FUNNEL_STAGES[order - 1]
    if order == 1:
        return f"""t1 AS (SELECT session_id, min((event_ts, event_id)) AS m FROM s
            WHERE session_id IS NOT NULL AND event_name = '{stage}' GROUP BY session_id)"""
    return f"""t{order} AS (SELECT session_id, min((event_ts, event_id)) AS m FROM s
        JOIN t{order - 1} USING (session_id) WHERE event_name = '{stage}'
        AND (event_ts, event_id) > t{order - 1}.m GROUP BY session_id)"""


def _reached(order: int) -> str:
    return f"""SELECT {order} AS stage_order, '{FUNNEL_STAGES[order - 1]}' AS stage,
        count(*) AS sessions FROM t{order}"""


@query(
    "x05_ordered_funnel",
    f"""SELECT stage_order::INTEGER AS stage_order, stage, sessions,
              round(100.0 * sessions / max(sessions) OVER (), 1)::DOUBLE AS pct_of_started
        FROM (WITH {', '.join(map(_chain, range(1, 6)))}
              {' UNION ALL '.join(map(_reached, range(1, 6)))})""",
)
def ordered_funnel(spark, sf_dir):
    return feed.warehouse(spark, sf_dir).report("ordered_session_funnel")
