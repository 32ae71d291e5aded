"""Event files into the bronze table as they arrive, with the same result as a batch load."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventmart.plans.warehouse import Warehouse
from eventmart.session import materialize
from eventmart.sources import jsonl

# What the source tells of a file; its content is not read here.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def ingest_stream(
    warehouse: Warehouse,
    raw_dir: str,
    pattern: str = jsonl.EVENT_FILES,
    files_per_batch: int = 1000,
    available_now: bool = True,
    clock: Callable[[], datetime] = utc_now,
) -> StreamingQuery:
    """Start a query that loads each new event file into the warehouse's raw layer.

    The checkpoint, below the warehouse, remembers the files of each micro-batch. A batch
    replaces its files in the bronze table, so a batch that is run again after a crash leaves
    what it would have left the first time, and a restart goes on with the files that came
    meanwhile. ``available_now`` ends the query when the present files are loaded.

    A micro-batch brings the driver the names of its files, ``files_per_batch`` at most. A
    file is taken once, when it is complete: writers should move files in. A new version of
    a file under its old name is left to ``Warehouse.ingest``.
    """
    spark, raw_dir = warehouse.spark, raw_dir.rstrip("/")
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(f"{raw_dir}/{pattern}")
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )

    def load(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        # The source passes over empty files, but they may replace an earlier version.
        empty = jsonl.empty_files(session, f"{raw_dir}/{pattern}")
        named = jsonl.named_files(batch.unionAll(empty), pattern)
        loaded = Warehouse(session, warehouse.root)
        loaded.load_files(materialize(named, "stream-files"), pattern, clock())

    query = files.writeStream.queryName("ingest_events").foreachBatch(load)
    query = query.option("checkpointLocation", warehouse.path("streams/ingest_events"))
    return (query.trigger(availableNow=True) if available_now else query).start()


def ingest_available(warehouse: Warehouse, raw_dir: str, **choices) -> None:
    """Load the files that are there and were not loaded yet, and wait for the end."""
    ingest_stream(warehouse, raw_dir, **choices).awaitTermination()


