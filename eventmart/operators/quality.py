"""Data-quality checks. A check is a DataFrame of violations; an empty one passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.functions.scalar import reason_bucket


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number; nulls do not count."""
    return unique_combination(df.filter(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def non_negative(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) < 0)


def relationships(df: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Non-null values without a parent row, with the number of rows that carry them.

    Counting first reduces the child to its distinct values, so a hot one costs nothing.
    """
    children = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    parents = parent.select(F.col(key).alias(column))
    return children.join(parents, column, "left_anti")


def reconciliation(
    raw_events: DataFrame,
    ingest_rejections: DataFrame,
    staged: DataFrame,
    rejected: DataFrame,
) -> DataFrame:
    """The four row counts, returned only when input and output do not add up."""
    totals = _layer_totals(raw_events, ingest_rejections, staged, rejected)
    return totals.filter(
        F.col("raw_events") + F.col("ingest_rejections") != F.col("staged") + F.col("rejected")
    )


def _layer_totals(
    raw_events: DataFrame,
    ingest_rejections: DataFrame,
    staged: DataFrame,
    rejected: DataFrame,
) -> DataFrame:
    layers = {
        "raw_events": raw_events,
        "ingest_rejections": ingest_rejections,
        "staged": staged,
        "rejected": rejected,
    }
    return table_counts(layers).agg(
        *(
            F.sum(F.when(F.col("table_name") == layer, F.col("row_count"))).alias(layer)
            for layer in layers
        )
    )


def reconciliation_summary(
    raw_events: DataFrame,
    ingest_rejections: DataFrame,
    staged: DataFrame,
    rejected: DataFrame,
) -> DataFrame:
    """The four row counts and whether they add up."""
    totals = _layer_totals(raw_events, ingest_rejections, staged, rejected)
    return totals.withColumn(
        "reconciled",
        F.col("raw_events") + F.col("ingest_rejections") == F.col("staged") + F.col("rejected"),
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` of every table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def rejection_breakdown(rejected: DataFrame) -> DataFrame:
    """Rejected rows by stage and reason, the frequent reasons of a stage first."""
    return (
        rejected.groupBy(
            "rejection_stage", reason_bucket(F.col("rejection_reason")).alias("reason")
        )
        .agg(F.count("*").alias("row_count"))
        .orderBy("rejection_stage", F.desc("row_count"), "reason")
    )


# The checks every build must pass, as (table, columns).
UNIQUE = (
    ("stg_events", "event_id"),
    ("dim_accounts", "account_id"),
    ("dim_users", "user_id"),
    ("fact_ai_interactions", "interaction_id"),
    ("fact_sessions", "session_id"),
)
NOT_NULL = (
    ("stg_events", ("event_id", "event_ts", "account_id", "user_id", "event_name")),
    ("rejected_events", ("rejection_reason", "source_file", "line_number")),
    ("dim_accounts", ("account_id",)),
    ("dim_users", ("user_id", "account_id")),
    ("fact_ai_interactions", ("interaction_id", "model", "latency_ms")),
    ("fact_sessions", ("session_id", "account_id")),
    ("daily_account_metrics", ("active_users", "ai_cost_usd", "ai_cost_usd_estimated")),
)
NON_NEGATIVE = (
    ("stg_events", ("prompt_tokens", "completion_tokens", "latency_ms", "cost_usd")),
    ("fact_ai_interactions", ("latency_ms", "cost_usd", "cost_usd_estimated")),
    ("daily_account_metrics", ("active_users", "ai_cost_usd", "ai_cost_usd_estimated")),
)
RELATIONSHIPS = (
    ("stg_events", "account_id", "dim_accounts", "account_id"),
    ("stg_events", "user_id", "dim_users", "user_id"),
    ("stg_events", "event_name", "expected_event_names", "event_name"),
    ("dim_users", "account_id", "dim_accounts", "account_id"),
    ("fact_sessions", "account_id", "dim_accounts", "account_id"),
)
UNIQUE_COMBINATION = (("daily_account_metrics", ("event_date", "account_id")),)


def row_checks(
    df: DataFrame, table: str, required: Sequence[str], positive: Sequence[str]
) -> DataFrame:
    """All null and sign checks of a table in one pass over it."""
    tests = [("not_null", column, F.col(column).isNull()) for column in required]
    tests += [("non_negative", column, F.col(column) < 0) for column in positive]
    counted = df.agg(
        *(F.count_if(broken).alias(f"v{place}") for place, (_, _, broken) in enumerate(tests))
    )
    rows = [
        F.struct(
            F.lit(check).alias("check_name"),
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.col(f"v{place}").alias("violations"),
        )
        for place, (check, column, _) in enumerate(tests)
    ]
    return counted.select(F.inline(F.array(*rows)))


def _violations(violating: DataFrame, check: str, table: str, column: str) -> DataFrame:
    return violating.agg(F.count("*").alias("violations")).select(
        F.lit(check).alias("check_name"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        "violations",
    )


def all_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(check_name, table_name, column_name, violations)`` of every check of a build."""
    required, positive = dict(NOT_NULL), dict(NON_NEGATIVE)
    results = [
        row_checks(tables[table], table, required.get(table, ()), positive.get(table, ()))
        for table in required
    ]
    results += [
        _violations(unique(tables[table], column), "unique", table, column)
        for table, column in UNIQUE
    ]
    results += [
        _violations(
            unique_combination(tables[table], columns),
            "unique_combination",
            table,
            ",".join(columns),
        )
        for table, columns in UNIQUE_COMBINATION
    ]
    results += [
        _violations(
            relationships(tables[table], column, tables[parent], key),
            "relationships",
            table,
            column,
        )
        for table, column, parent, key in RELATIONSHIPS
    ]
    results.append(
        _violations(
            reconciliation(
                tables["raw_events"],
                tables["raw_ingest_rejections"],
                tables["stg_events"],
                tables["rejected_events"],
            ),
            "reconciliation",
            "raw_events",
            "*",
        )
    )
    return reduce(DataFrame.unionAll, results)
