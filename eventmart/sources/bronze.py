"""The bronze table: every line of every event file, replaced file by file."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.scalar import utc_literal
from eventmart.schemas import EVENT_KEYS
from eventmart.sources.jsonl import (
    BEYOND_LIMITS,
    EVENT_FILES,
    list_event_files,
    parse_lines,
    read_chosen_lines,
    read_lines,
)

# Marks the one row a file always has, so that a file which lost its lines, or its bad
# lines, still replaces what an earlier version left behind.
FILE_MARKER = "file_marker"

BRONZE_SCHEMA = ", ".join(
    [f"{key} string" for key in EVENT_KEYS]
    + [
        "properties variant",
        "has_wide_misfit boolean",
        "raw_line string",
        "ingest_reason string",
        "line_number bigint",
        "ingested_at timestamp_ntz",
        "source_file string",
    ]
)


def replace_by_file(rows: DataFrame, path: str) -> None:
    """Write rows, replacing exactly the ``source_file`` partitions present in them."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("source_file")
        .parquet(path)
    )


def file_markers(files: DataFrame, ingested_at: datetime) -> DataFrame:
    return files.select(
        "source_file",
        F.lit(FILE_MARKER).alias("ingest_reason"),
        F.lit(0).cast("long").alias("line_number"),
        utc_literal(ingested_at).alias("ingested_at"),
    )


def ingest_events(
    spark: SparkSession,
    raw_dir: str,
    path: str,
    ingested_at: datetime,
    pattern: str = EVENT_FILES,
    scratch: str | None = None,
) -> None:
    """Load the event files of a directory into the bronze table. Safe to repeat."""
    lines = read_lines(spark, raw_dir, pattern, scratch)
    replace_lines(lines, list_event_files(spark, raw_dir, pattern), path, ingested_at)


def ingest_files(
    spark: SparkSession,
    files: DataFrame,
    path: str,
    ingested_at: datetime,
    pattern: str = EVENT_FILES,
    scratch: str | None = None,
) -> None:
    """Load files as ``list_event_files`` lists them; their names reach the driver."""
    paths = [row.path for row in files.filter("length > 0").select("path").collect()]
    if paths:
        lines = read_chosen_lines(spark, paths, pattern, scratch)
    else:
        lines = spark.createDataFrame([], "value string, source_file string, line_number bigint")
    replace_lines(lines, files, path, ingested_at)


def replace_lines(lines: DataFrame, files: DataFrame, path: str, ingested_at: datetime) -> None:
    """Parse the lines of some files and replace those files in the bronze table."""
    markers = file_markers(files, ingested_at)
    replace_by_file(
        parse_lines(lines, ingested_at).unionByName(markers, allowMissingColumns=True), path
    )


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BRONZE_SCHEMA).parquet(path)


def raw_events(bronze: DataFrame) -> DataFrame:
    """The parseable event objects, with their original line as payload."""
    return bronze.filter(F.col("ingest_reason").isNull()).select(
        *EVENT_KEYS,
        "properties",
        "has_wide_misfit",
        F.col("raw_line").alias("raw_payload"),
        "source_file",
        "line_number",
        "ingested_at",
    )


def raw_ingest_rejections(bronze: DataFrame) -> DataFrame:
    """The lines that are no JSON object."""
    return bronze.filter(F.col("ingest_reason") != FILE_MARKER).select(
        "source_file",
        "line_number",
        "raw_line",
        F.col("ingest_reason").alias("rejection_reason"),
        "ingested_at",
    )


def ingest_stats(bronze: DataFrame) -> DataFrame:
    """Events loaded and lines rejected per file, files without a single line included.

    ``lines_beyond_limits`` are those of the rejected lines that may be valid JSON.
    """
    reason = F.col("ingest_reason")
    return bronze.groupBy("source_file").agg(
        F.count_if(reason.isNull()).alias("events_loaded"),
        F.count_if(reason.isNotNull() & (reason != FILE_MARKER)).alias("lines_rejected"),
        F.count_if(reason == BEYOND_LIMITS).alias("lines_beyond_limits"),
    )
