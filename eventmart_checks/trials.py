"""Plans measured against each other on a feed that is many times the given tables.

``python -m eventmart_checks.trials [FACTOR] [FOLDER]`` prints the seconds of every variant; the
"""

from __future__ import annotations

import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventmart import Warehouse
from eventmart.operators import classify, marts
from eventmart.plans.warehouse import CLEAN, REJECTED
from eventmart.session import materialize, scratch_dir
from eventmart_checks import feed

ROUNDS = 3


def grown_tables(spark: SparkSession, sf_dir: str, factor: int) -> str:
    """The tables with ``factor`` times the events, a third of them of one user."""
    folder = scratch_dir(spark, "grown")
    for name in ("customer", "nation", "region"):
        feed.table(spark, sf_dir, name).write.parquet(f"{folder}/{name}.parquet")
    events = feed.table(spark, sf_dir, "events")
    step = (events.agg(F.max("event_id")).first()[0] or 0) + 1
    copies = events.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))))
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.col("user_id"))
    (
        copies.withColumn("user_id", hot)
        .withColumn("event_id", F.col("event_id") + step * F.col("_copy"))
        .drop("_copy")
        .repartition(spark.sparkContext.defaultParallelism * 4)
        .write.parquet(f"{folder}/events.parquet")
    )
    return folder


def split_by_outcome(classified: DataFrame, path: str) -> None:
    """The write of a build: by outcome and day."""
    outcome = F.when(F.col("rejection_reason").isNull(), CLEAN).otherwise(REJECTED)
    (
        classified.withColumns({"outcome": outcome, "event_date": F.to_date("event_ts")})
        .hint("rebalance", "outcome", "event_date")
        .write.mode("overwrite")
        .partitionBy("outcome", "event_date")
        .parquet(path)
    )


def evaluated_twice(raw: dict[str, DataFrame], path: str) -> None:
    """Typing and validation run for the repeated ids and again for the result."""
    validated = classify.validate_events(raw["raw_events"], raw["raw_accounts"], raw["raw_users"])
    repeated = materialize(classify.repeated_events(validated), "repeated")
    split_by_outcome(classify.mark_duplicates(validated, repeated), path)


def written_once(raw: dict[str, DataFrame], path: str) -> None:
    """Validated rows are written where they are; repeated ids and the result are read from there."""
    validated = classify.validate_events(raw["raw_events"], raw["raw_accounts"], raw["raw_users"])
    validated = materialize(validated, "validated")
    repeated = materialize(classify.repeated_events(validated), "repeated")
    split_by_outcome(classify.mark_duplicates(validated, repeated), path)


def bucketed(raw: dict[str, DataFrame], path: str) -> None:
    """Validated rows are written in buckets of their event id; a window over a bucket, without
    a shuffle or a join, marks the duplicates. All copies of an event are in one task."""
    spark = raw["raw_events"].sparkSession
    validated = classify.validate_events(raw["raw_events"], raw["raw_accounts"], raw["raw_users"])
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    valid = F.col("rejection_reason").isNull()
    own = F.concat(F.lit("\x00"), "source_file", F.lit(":"), F.col("line_number").cast("string"))
    keyed = validated.withColumn("_key", F.when(valid, F.col("event_id")).otherwise(own))
    (
        keyed.repartition(buckets, "_key")
        .write.mode("overwrite")
        .bucketBy(buckets, "_key")
        .sortBy("_key")
        .option("path", scratch_dir(spark, "bucketed"))
        .saveAsTable("trial_bucketed")
    )
    arrival = (F.col("received_ts").isNull(), "received_ts", "source_file", "line_number")
    place = F.row_number().over(Window.partitionBy("_key").orderBy(*arrival))
    marked = spark.table("trial_bucketed").withColumn("_place", place)
    reason = F.when(valid & (F.col("_place") > 1), classify.DUPLICATE).otherwise(
        F.col("rejection_reason")
    )
    split_by_outcome(marked.withColumn("rejection_reason", reason).drop("_key", "_place"), path)


def sessions_in_one(events: DataFrame, path: str) -> None:
    """Owner and workflow along with the counts: their buffers hold strings, so all is sorted."""
    inside = events.filter(F.col("session_id").isNotNull())
    found = inside.groupBy("session_id").agg(*marts.session_counts(), *marts.session_origin())
    marts.session_columns(found).write.mode("overwrite").parquet(path)


def sessions_in_two(events: DataFrame, path: str) -> None:
    """Counts in a hash aggregate, owner and workflow in a narrow one."""
    marts.fact_sessions(events).write.mode("overwrite").parquet(path)


def timed(spark: SparkSession, name: str, variant: Callable, given) -> None:
    seconds = []
    for _ in range(ROUNDS):
        path = scratch_dir(spark, "trial")
        start = time.perf_counter()
        variant(given, path)
        seconds.append(time.perf_counter() - start)
    listed = " ".join(f"{s:.1f}" for s in seconds)
    print(f"{name}: {statistics.median(seconds):.1f} s ({listed})", flush=True)


def main() -> None:
    factor = int(sys.argv[1]) if len(sys.argv) > 1 else 30
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("eventmart-trials")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="eventmart-trials-"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="eventmart-trials-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    grown = grown_tables(spark, sf_dir, factor)
    loaded = feed.load(spark, grown, scratch_dir(spark, "trial-warehouse"))
    raw = {name: loaded.table(name) for name in ("raw_events", "raw_accounts", "raw_users")}
    print(f"{raw['raw_events'].count()} events", flush=True)
    for variant in (evaluated_twice, written_once, bucketed):
        timed(spark, variant.__name__, variant, raw)
    loaded.build(check=False)
    events = Warehouse(spark, loaded.root).table("stg_events")
    for variant in (sessions_in_one, sessions_in_two):
        timed(spark, variant.__name__, variant, events)
    spark.stop()


if __name__ == "__main__":
    main()
