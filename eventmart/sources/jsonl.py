"""Event files: physical lines with lineage, and the gate that turns a line into an event."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventmart.functions.scalar import utc_literal
from eventmart.functions.variant import JSON_ROOT, has_wide_misfit, with_json
from eventmart.schemas import BRONZE_COLUMNS, EVENT_KEYS, PROPERTIES
from eventmart.session import materialize

EVENT_FILES = "events_*.jsonl"

# What VARIANT cannot hold: 16 MiB of text or binary form, numbers of more digits, deeper
# nesting. A line near one of these limits that does not parse may still be valid JSON.
NEAR_LIMIT_BYTES = 8 * 1024 * 1024
NEAR_LIMIT_DEPTH = 200
BEYOND_LIMITS = "json_beyond_limits"
UNLIMITED = {name: "2147483647" for name in ("maxNestingDepth", "maxNumLen", "maxStringLen")}


def list_event_files(spark: SparkSession, raw_dir: str, pattern: str = EVENT_FILES) -> DataFrame:
    """``(path, source_file, length, modified)`` per event file; raises if there is none.

    Reads no content.
    """
    path = f"{raw_dir.rstrip('/')}/{pattern}"
    try:
        found = spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no event files match {path}") from error
        raise
    return named_files(
        found.select("path", "length", F.col("modificationTime").alias("modified")).unionAll(
            empty_files(spark, path)
        ),
        pattern,
    )


def named_files(files: DataFrame, pattern: str) -> DataFrame:
    named = source_file(F.col("path"), pattern).alias("source_file")
    return files.select("path", named, "length", "modified")


def empty_files(spark: SparkSession, path: str) -> DataFrame:
    """Files without a byte that match a path; Spark's scans pass over them."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob) or []
    empty = [
        (file.getPath().toString(), 0, file.getModificationTime())
        for file in files
        if file.getLen() == 0 and file.isFile()
    ]
    listed = spark.createDataFrame(empty, "path string, length bigint, millis bigint")
    return listed.select("path", "length", F.timestamp_millis("millis").alias("modified"))


def read_lines(
    spark: SparkSession, raw_dir: str, pattern: str = EVENT_FILES, scratch: str | None = None
) -> DataFrame:
    """``(value, source_file, line_number)`` for every physical line, blank ones included.

    Large files stay splittable: a line's number is its position inside its split plus the
    lines of all earlier splits of the same file. Runs a job that writes a table of the
    lines per split (to ``scratch``); the lines join it by broadcast as long as Spark finds
    it small, and by their split otherwise.
    """
    list_event_files(spark, raw_dir, pattern)
    text = spark.read.text(f"{raw_dir.rstrip('/')}/{pattern}")
    return number_lines(text, pattern, scratch)


def read_chosen_lines(
    spark: SparkSession, files: list[str], pattern: str = EVENT_FILES, scratch: str | None = None
) -> DataFrame:
    """The lines of files given by their full paths, which are no patterns."""
    literal = [re.sub(r"([\\*?\[\]{}])", r"\\\1", file) for file in files]
    text = spark.read.schema("value string").text(literal)
    return number_lines(text, pattern, scratch)


def number_lines(text: DataFrame, pattern: str, scratch: str | None = None) -> DataFrame:
    """Lines of text files with their file and their number in it, as ``read_lines`` has them."""
    lines = text.select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("position"),
    )
    earlier_splits = (
        Window.partitionBy("file_path")
        .orderBy("split_start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        lines.groupBy("file_path", "split_start")
        .agg(F.count("*").alias("split_lines"), F.min("position").alias("first_position"))
        .select(
            "file_path",
            "split_start",
            (
                F.coalesce(F.sum("split_lines").over(earlier_splits), F.lit(0))
                - F.col("first_position")
                + 1
            ).alias("shift"),
        )
    )
    offsets = materialize(offsets, "line-offsets", scratch)
    return lines.join(offsets, ["file_path", "split_start"]).select(
        "value",
        source_file(decoded_path(F.col("file_path")), pattern).alias("source_file"),
        (F.col("position") + F.col("shift")).alias("line_number"),
    )


def source_file(path: Column, pattern: str) -> Column:
    """The path below the raw directory: as many components as the pattern has."""
    return F.substring_index(path, "/", -(pattern.count("/") + 1))


def decoded_path(path: Column) -> Column:
    """A path of the file metadata as the file system spells it: ``%20`` is a space there.

    A plus sign is a plus sign in a path, unlike in a form, so it is escaped first.
    """
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def is_blank(value: Column) -> Column:
    """Only whitespace, in the Unicode sense, which includes the four ASCII separators."""
    return value.rlike(r"(?U)^[\s\x1c-\x1f]*$")


def skip_blank(lines: DataFrame) -> DataFrame:
    return lines.filter(~is_blank(F.col("value")))


def near_limit(value: Column) -> Column:
    """Whether a line is so large, deep or rich in digits that VARIANT may not hold it."""
    brackets = F.length(value) - F.length(F.translate(value, "[{", ""))
    return (
        (F.octet_length(value) > NEAR_LIMIT_BYTES)
        | (brackets > NEAR_LIMIT_DEPTH)
        | value.rlike(r"\d{39}")
    )


def oversized_event(value: Column) -> Column:
    """The kept members of an event object beyond the limits of VARIANT; else null.

    The line is read by a schema of the promoted keys and the contract's properties, so
    that whatever else is in it is only passed over. As in ``with_json``, it is the first
    of two elements whose second must come out intact. The properties are read as text
    first, which fails for those nested too deeply to be built as VARIANT.
    """
    keys = ", ".join(f"{key}: string" for key in EVENT_KEYS)
    mark = F.xxhash64(value).cast("string")
    text = F.concat(F.lit("["), value, F.lit(',{"_mark":"'), mark, F.lit('"}]'))

    def read(kind: str) -> tuple[Column, Column]:
        members = ", ".join(f"{key}: {kind}" for key, _, _ in PROPERTIES)
        schema = f"array<struct<{keys}, properties: struct<{members}>, _mark: string>>"
        pair = F.from_json(text, schema, UNLIMITED)
        intact = (F.size(pair) == 2) & (F.get(pair, F.lit(1))["_mark"] == mark)
        return intact, F.get(pair, F.lit(0))

    shallow, _ = read("string")
    intact, event = read("variant")
    kept = [event[key].alias(key) for key in EVENT_KEYS]
    properties = F.to_variant_object(event["properties"]).alias("properties")
    found = F.when(intact & event.isNotNull(), F.struct(*kept, properties))
    return F.when(shallow, found)


def is_json_of_any_size(value: Column) -> Column:
    """Whether a text is exactly one JSON value, however large, deep or rich in digits.

    The parser passes over the value of a key it is not asked for, and so checks it without
    building it. The value stands there once on its own and once as an element, before a key
    with its hash that must come out intact: text with a comma at its top level breaks one
    of the two, as after it one needs a key and the other a value.
    """
    mark = F.xxhash64(value).cast("string")

    def intact(before: str, after: str) -> Column:
        text = F.concat(F.lit('{"_json":' + before), value, F.lit(after + ',"_mark":"'), mark, F.lit('"}'))
        read = F.from_json(text, "_mark string", UNLIMITED)
        return F.coalesce(read["_mark"] == mark, F.lit(False))

    return intact("", "") & intact("[", "]")


def ingest_reason(value: Column, document: Column, oversized: Column) -> Column:
    """Why a line is no event object; null for a JSON object.

    A line near the limits of VARIANT is malformed, too, unless all of it is one JSON value;
    an object of which the kept members can't be held either has a reason of its own.
    Once a line is known to be valid JSON its first character tells the kind of value.
    """
    text = F.btrim(value, F.lit(" \t\r\n"))
    first = F.substring(text, 1, 1)
    kind = (
        F.when(first == "[", "list")
        .when(first == '"', "str")
        .when(first.isin("t", "f"), "bool")
        .when(first == "n", "NoneType")
        .when(text.rlike(r"^-?\d+$"), "int")
        .otherwise("float")
    )
    unread = document.isNull() & oversized.isNull()
    # Only the few lines that are near a limit and unread are validated again.
    valid = F.when(unread & near_limit(value), is_json_of_any_size(value)).otherwise(False)
    return (
        F.when(unread & ~valid, F.lit("malformed_json"))
        .when(first != "{", F.concat(F.lit("not_a_json_object: got "), kind))
        .when(unread, F.lit(BEYOND_LIMITS))
    )


# The kept members of an event object; casting all of them at once beats eight look-ups.
EVENT_TYPE = f"struct<{', '.join(f'{key}: string' for key in EVENT_KEYS)}, properties: variant>"


def promoted_columns(event: str) -> list[Column]:
    """The promoted keys as strings, and ``properties`` as VARIANT; a JSON null is missing."""
    properties = F.col(f"{event}.properties")
    return [
        *(F.col(f"{event}.{key}") for key in EVENT_KEYS),
        F.when(~F.is_variant_null(properties), properties).alias("properties"),
    ]


def parse_lines(lines: DataFrame, ingested_at: datetime) -> DataFrame:
    """Bronze rows: one per non-blank line, parsed once, with the reason it was refused."""
    parsed = with_json(skip_blank(lines), "value", "document")
    value = F.col("value")
    unread = F.col("document").isNull() & near_limit(value)
    parsed = parsed.withColumn("oversized", F.when(unread, oversized_event(value)))
    from_variant = F.try_variant_get("document", JSON_ROOT, EVENT_TYPE)
    parsed = parsed.withColumn("event", F.coalesce(from_variant, F.col("oversized")))
    return parsed.select(
        *promoted_columns("event"),
        has_wide_misfit(F.col("value")).alias("has_wide_misfit"),
        F.col("value").alias("raw_line"),
        ingest_reason(value, F.col("document"), F.col("oversized")).alias("ingest_reason"),
        "source_file",
        F.col("line_number").cast("long").alias("line_number"),
        utc_literal(ingested_at).alias("ingested_at"),
    ).select(*BRONZE_COLUMNS)
