"""Account and user metadata from CSV, and the event-name contract."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.scalar import utc_literal
from eventmart.schemas import EVENT_NAMES
from eventmart.sources.bronze import replace_by_file
from eventmart.sources.jsonl import decoded_path, list_event_files


def read_metadata(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    ingested_at: datetime,
    line_breaks: bool = False,
) -> DataFrame:
    """A CSV file with header under an explicit schema; a value that does not fit fails.

    A quote inside quotes is doubled. ``line_breaks`` allows them inside quotes, at the
    price that a file can no longer be read in parts.
    """
    as_read = T.StructType(
        [
            T.StructField(
                field.name,
                T.StringType()
                if isinstance(field.dataType, T.TimestampNTZType)
                else field.dataType,
            )
            for field in schema
        ]
    )
    rows = (
        spark.read.schema(as_read)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .option("multiLine", line_breaks)
        .csv(path)
    )
    return rows.select(
        *(
            # The zone offset applies before the zone is dropped.
            F.col(field.name).cast("timestamp").cast("timestamp_ntz").alias(field.name)
            if isinstance(field.dataType, T.TimestampNTZType)
            else F.col(field.name)
            for field in schema
        ),
        F.substring_index(decoded_path(F.col("_metadata.file_path")), "/", -1).alias("source_file"),
        utc_literal(ingested_at).alias("ingested_at"),
    )


def ingest_metadata(
    spark: SparkSession,
    csv_path: str,
    table_path: str,
    schema: T.StructType,
    ingested_at: datetime,
    line_breaks: bool = False,
) -> int:
    """Replace the rows of the metadata files that match a path; returns how many they have.

    Each file is marked by a row without ``ingested_at``, so that one with a header alone
    replaces its earlier rows too. A path without files raises.
    """
    folder, _, pattern = csv_path.rstrip("/").rpartition("/")
    files = list_event_files(spark, folder, pattern).select("source_file")
    rows = read_metadata(spark, csv_path, schema, ingested_at, line_breaks)
    replace_by_file(rows.unionByName(files, allowMissingColumns=True), table_path)
    return read_metadata_table(spark, table_path, schema).join(files, "source_file", "left_semi").count()


def read_metadata_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_stored(spark, path, schema).filter(F.col("ingested_at").isNotNull())


def read_stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """With the rows that only mark a file."""
    stored = T.StructType(
        [
            *schema.fields,
            T.StructField("ingested_at", T.TimestampNTZType()),
            T.StructField("source_file", T.StringType()),
        ]
    )
    return spark.read.schema(stored).parquet(path)


def contract_seed(spark: SparkSession, csv_path: str | None = None) -> DataFrame:
    """The valid event names: column ``event_name`` of a CSV file, or else the built-in nine."""
    if csv_path is None:
        return spark.createDataFrame([(name,) for name in EVENT_NAMES], "event_name string")
    names = spark.read.option("header", True).option("escape", '"').csv(csv_path)
    return names.select("event_name").filter("event_name IS NOT NULL").distinct()
