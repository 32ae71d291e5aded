"""What was loaded of each event file, and when: the ground for loading and building less."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.scalar import utc_literal
from eventmart.sources.bronze import FILE_MARKER, read_bronze, replace_by_file

MANIFEST = (
    "length bigint, modified timestamp, lines bigint, checksum string, loaded_at timestamp_ntz, "
    "source_file string"
)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per loaded file; none before the first load."""
    try:
        return spark.read.schema(MANIFEST).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def record_files(
    spark: SparkSession, files: DataFrame, bronze_path: str, path: str, loaded_at: datetime
) -> None:
    """Record files that the bronze table now holds, with a checksum of their lines.

    ``files`` has their ``source_file``, ``length`` and ``modified``. A file whose row is
    missing or of another length or time counts as not loaded, so a load that breaks off
    before this step is simply done again.
    """
    line = F.col("ingest_reason").isNull() | (F.col("ingest_reason") != FILE_MARKER)
    own = F.when(line, F.xxhash64("line_number", "raw_line"))
    # Two sums of the lines' hashes, which do not depend on the order of the rows.
    sums = (
        read_bronze(spark, bronze_path)
        .join(files.select("source_file"), "source_file", "left_semi")
        .groupBy("source_file")
        .agg(
            F.count_if(line).alias("lines"),
            F.bit_xor(own).alias("x"),
            F.sum(own.cast("decimal(38,0)")).alias("s"),
        )
    )
    checksum = F.concat_ws("-", F.hex("x"), F.col("s").cast("string"))
    recorded = files.join(sums, "source_file").select(
        "source_file", "length", "modified", "lines", checksum.alias("checksum"),
        utc_literal(loaded_at).alias("loaded_at"),
    )
    replace_by_file(recorded, path)


USER_FILES = "user_id string, source_file string"


def read_user_files(spark: SparkSession, path: str) -> DataFrame:
    """The files in which a user has an event."""
    return spark.read.schema(USER_FILES).parquet(path)


def record_users(spark: SparkSession, files: DataFrame, bronze_path: str, path: str) -> None:
    """Index the users of files by file; sorted, so that a look-up passes over most of it."""
    users = (
        read_bronze(spark, bronze_path)
        .join(files.select("source_file"), "source_file", "left_semi")
        .select("user_id", "source_file")
        .distinct()  # with the marker's null, so that a file without users is replaced, too
        .repartition("source_file")
        .sortWithinPartitions("source_file", "user_id")
    )
    replace_by_file(users, path)


def not_loaded(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """The listed files that are new, or of another length or time than when loaded."""
    known = manifest.select("source_file", "length", "modified")
    return files.join(known, ["source_file", "length", "modified"], "left_anti")
