"""Cost by hour, account and model while the day is under way.

The build has the figures that count. These are for alerts: they take an event's copies for
one as long as its id is held, and leave out events that come later than that.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventmart.functions.scalar import money_sum
from eventmart.operators import classify, marts
from eventmart.plans.warehouse import Warehouse
from eventmart.sources import bronze, jsonl

COSTS = (
    "hour timestamp_ntz, account_id string, model string, calls bigint, uncosted_calls bigint, "
    "total_tokens bigint, cost_usd double, batch bigint"
)
KEY = ("hour", "account_id", "model")


def valid_calls(warehouse: Warehouse, lines: DataFrame) -> DataFrame:
    """The valid AI calls among lines, copies included; for a stream as for a table."""
    numbered = lines.withColumn("line_number", F.lit(0))
    raw = bronze.raw_events(jsonl.parse_lines(numbered, datetime(1970, 1, 1)))
    validated = classify.validate_events(
        raw, warehouse.table("raw_accounts"), warehouse.table("raw_users"), warehouse.event_names()
    )
    return marts.ai_calls(validated.filter(F.col("rejection_reason").isNull()))


def cost_stream(
    warehouse: Warehouse,
    raw_dir: str,
    pattern: str = jsonl.EVENT_FILES,
    late: str = "2 days",
    files_per_batch: int = 1000,
    available_now: bool = True,
) -> StreamingQuery:
    """Start a query that keeps the hourly costs up to date as event files arrive.

    An event's copies count once: the first to arrive holds its id in the state until the
    watermark, ``late`` behind the latest event, has passed the event by that time once more.
    Ids and hours behind the watermark leave the state, so it grows with that span of time
    only. Each micro-batch writes the hours it changed, as a folder of its own that a repeated
    batch replaces.
    """
    spark, raw_dir = warehouse.spark, raw_dir.rstrip("/")
    lines = (
        spark.readStream.schema("value string")
        .option("maxFilesPerTrigger", files_per_batch)
        .text(f"{raw_dir}/{pattern}")
        .select("value", F.lit(pattern).alias("source_file"))
    )
    once = (
        valid_calls(warehouse, lines)
        .withColumn("moment", F.col("event_ts").cast("timestamp"))
        .withWatermark("moment", late)
        .dropDuplicatesWithinWatermark(["event_id"])
    )
    tokens = F.try_add("prompt_tokens", "completion_tokens")
    hourly = once.groupBy(F.window("moment", "1 hour"), "account_id", "model").agg(
        F.count("*").alias("calls"),
        F.count_if(F.col("cost_usd").isNull()).alias("uncosted_calls"),
        F.sum(tokens).alias("total_tokens"),
        money_sum(F.col("cost_usd")).alias("cost_usd"),
    )

    def store(batch: DataFrame, number: int) -> None:
        hour = F.col("window.start").cast("timestamp_ntz").alias("hour")
        changed = batch.select(hour, *(c for c in batch.columns if c != "window"))
        changed.write.mode("overwrite").parquet(
            warehouse.path(f"streams/hourly_costs/batch={number}")
        )

    query = hourly.writeStream.queryName("hourly_costs").outputMode("update").foreachBatch(store)
    query = query.option("checkpointLocation", warehouse.path("streams/hourly_costs_state"))
    return (query.trigger(availableNow=True) if available_now else query).start()


def hourly_costs(warehouse: Warehouse) -> DataFrame:
    """The costs as the last micro-batch that changed an hour left them."""
    stored = warehouse.spark.read.schema(COSTS).parquet(warehouse.path("streams/hourly_costs"))
    values = [c for c in stored.columns if c not in (*KEY, "batch")]
    latest = F.max_by(F.struct(*values), "batch").alias("latest")
    return stored.groupBy(*KEY).agg(latest).select(*KEY, "latest.*")
