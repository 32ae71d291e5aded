"""Typing, validation and deduplication of raw events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.scalar import is_late, lenient_timestamp, seconds_between
from eventmart.functions.variant import property_columns, with_contract_check
from eventmart.schemas import (
    CLASSIFIED_COLUMNS,
    EVENT_NAMES,
    METRICS,
    PROPERTIES,
    SESSIONLESS_EVENTS,
)
from eventmart.session import materialize

DUPLICATE = "duplicate_event_id"


def type_events(raw_events: DataFrame) -> DataFrame:
    """Typed, flattened events; ``breaks_contract`` flags a wrongly typed property."""
    checked = with_contract_check(raw_events, "properties", "breaks_contract")
    return checked.select(
        "event_id",
        lenient_timestamp(F.col("event_ts")).alias("event_ts"),
        F.col("event_ts").alias("event_ts_raw"),
        lenient_timestamp(F.col("received_ts")).alias("received_ts"),
        "account_id",
        "user_id",
        "session_id",
        "event_name",
        *property_columns(F.col("properties")),
        (F.col("breaks_contract") | F.col("has_wide_misfit")).alias("breaks_contract"),
        "raw_payload",
        "source_file",
        "line_number",
        "ingested_at",
    )


def attach_owners(events: DataFrame, accounts: DataFrame, users: DataFrame) -> DataFrame:
    """Left join the account and the user an event names.

    No broadcast is forced: Spark broadcasts a side whose measured size is below its
    threshold, and otherwise sorts and merges, splitting a hot account or user at run time.
    """
    known = accounts.select("account_id", F.col("account_id").alias("known_account_id"))
    homes = users.select(
        "user_id",
        F.col("user_id").alias("known_user_id"),
        F.col("account_id").alias("user_home_account_id"),
    )
    return events.join(known, "account_id", "left").join(homes, "user_id", "left")


def lowest_metric() -> Column:
    """The smallest metric of a row, or zero when none is negative."""
    return F.least(F.lit(0.0), *METRICS)


def is_unknown_name(event_names: Sequence[str] = EVENT_NAMES) -> Column:
    """Whether an event's name is missing or outside the contract."""
    return ~F.coalesce(F.col("event_name").isin(*event_names), F.lit(False))


def first_failure(event_names: Sequence[str] = EVENT_NAMES) -> Column:
    """The first validation rule a typed event with owners breaks; null when it is valid."""
    # The reasons and their order.
    rules = (
        ("missing_event_id", F.coalesce(F.col("event_id"), F.lit("")) == ""),
        ("unparseable_event_ts", F.col("event_ts").isNull()),
        ("unknown_event_name", is_unknown_name(event_names)),
        ("missing_account_id", F.col("account_id").isNull()),
        ("missing_user_id", F.col("user_id").isNull()),
        (
            "missing_session_id",
            F.col("session_id").isNull() & ~F.col("event_name").isin(*SESSIONLESS_EVENTS),
        ),
        ("invalid_property_type", F.col("breaks_contract")),
        ("negative_metric_value", lowest_metric() < 0),
        ("unknown_account", F.col("known_account_id").isNull()),
        ("unknown_user", F.col("known_user_id").isNull()),
        # A user without a home account is not a mismatch.
        ("user_account_mismatch", F.col("user_home_account_id") != F.col("account_id")),
    )
    (reason, broken), *others = rules
    verdict = F.when(broken, reason)
    for reason, broken in others:
        verdict = verdict.when(broken, reason)
    return verdict


def validate_events(
    raw_events: DataFrame,
    accounts: DataFrame,
    users: DataFrame,
    event_names: Sequence[str] = EVENT_NAMES,
) -> DataFrame:
    """Typed events with the first broken rule, copies of one event still included."""
    return (
        attach_owners(type_events(raw_events), accounts, users)
        .withColumn("rejection_reason", first_failure(event_names))
        .select(*CLASSIFIED_COLUMNS)
    )


def repeated_events(validated: DataFrame) -> DataFrame:
    """Events with several valid copies, and the lineage of the copy that arrived first.

    An aggregate rather than a ranking window: copies collapse before the shuffle, so an
    event that was sent a billion times costs its group one row per task.
    """
    arrival = F.struct(
        F.col("received_ts").isNull().alias("never_received"),
        "received_ts",
        "source_file",
        "line_number",
    )
    return (
        validated.filter(F.col("rejection_reason").isNull())
        .groupBy("event_id")
        .agg(F.min(arrival).alias("first"), F.count("*").alias("copies"))
        .filter(F.col("copies") > 1)
        .select(
            "event_id",
            F.col("first.source_file").alias("first_source_file"),
            F.col("first.line_number").alias("first_line_number"),
        )
    )


def mark_duplicates(validated: DataFrame, repeated: DataFrame) -> DataFrame:
    """Give every valid copy but the first received one the duplicate reason.

    Only valid copies compete. ``repeated`` is best a written table: as long as few events
    are repeated it is broadcast, however often they are, and the events stay in place.
    """
    is_first = (F.col("source_file") == F.col("first_source_file")) & (
        F.col("line_number") == F.col("first_line_number")
    )
    # Only valid events can be in ``repeated``. Any other row gets a key of its own, so that
    # missing or empty ids do not meet in one task when the join has to shuffle.
    own = F.concat(F.lit("\x00"), "source_file", F.lit(":"), F.col("line_number").cast("string"))
    keyed = validated.withColumn(
        "_key", F.when(F.col("rejection_reason").isNull(), F.col("event_id")).otherwise(own)
    )
    return (
        keyed.join(repeated.withColumnRenamed("event_id", "_key"), "_key", "left")
        .withColumn(
            "rejection_reason",
            F.when(F.col("rejection_reason").isNull() & ~is_first, F.lit(DUPLICATE)).otherwise(
                F.col("rejection_reason")
            ),
        )
        .select(*CLASSIFIED_COLUMNS)
    )


def classify_events(
    raw_events: DataFrame,
    accounts: DataFrame,
    users: DataFrame,
    event_names: Sequence[str] = EVENT_NAMES,
    scratch: str | None = None,
) -> DataFrame:
    """One row per raw event with its rejection reason, null for the clean ones.

    The events are typed and validated in one pass, whose rows are written below ``scratch``
    (or in new folders of the shared scratch space). Repeated ids are found from a few
    columns of that table, and the duplicates marked as it is read again. ``accounts`` and
    ``users`` must have unique keys (``Warehouse.build`` checks this).
    """
    stored, again = (scratch and f"{scratch}/{name}" for name in ("validated", "repeated"))
    validated = materialize(
        validate_events(raw_events, accounts, users, event_names), "validated", stored
    )
    repeated = materialize(repeated_events(validated), "repeated", again)
    return mark_duplicates(validated, repeated)


def stg_events(classified: DataFrame) -> DataFrame:
    """The clean event stream: one row per valid event, dated by when it happened.

    ``event_date`` is taken as it is where the input has it already.
    """
    dated = "event_date" in classified.columns
    lateness = seconds_between(F.col("event_ts"), F.col("received_ts"))
    properties = [column for _, column, _ in PROPERTIES]
    after_tokens = properties.index("completion_tokens") + 1
    return classified.filter(F.col("rejection_reason").isNull()).select(
        "event_id",
        "event_ts",
        "event_date" if dated else F.to_date("event_ts").alias("event_date"),
        "received_ts",
        lateness.alias("lateness_seconds"),
        is_late(lateness).alias("is_late"),
        "account_id",
        "user_id",
        "session_id",
        "event_name",
        *properties[:after_tokens],
        F.try_add("prompt_tokens", "completion_tokens").alias("total_tokens"),
        *properties[after_tokens:],
        "source_file",
        "line_number",
        "ingested_at",
    )


def rejected_events(ingest_rejections: DataFrame, classified: DataFrame) -> DataFrame:
    """One audit trail of refused lines and refused events, each traceable to its line."""
    refused_lines = ingest_rejections.select(
        F.lit("ingest").alias("rejection_stage"),
        "rejection_reason",
        F.lit(None).cast("string").alias("event_id"),
        F.lit(None).cast("string").alias("event_name"),
        F.col("raw_line").alias("raw_data"),
        "source_file",
        "line_number",
        "ingested_at",
    )
    refused_events = classified.filter(F.col("rejection_reason").isNotNull()).select(
        F.lit("staging").alias("rejection_stage"),
        "rejection_reason",
        "event_id",
        "event_name",
        F.col("raw_payload").alias("raw_data"),
        "source_file",
        "line_number",
        "ingested_at",
    )
    return refused_lines.unionByName(refused_events)
