"""Deletion requests: what a user left in the raw layer goes, and with it all that came of it."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventmart.operators import marts
from eventmart.plans.refresh import refresh_files
from eventmart.plans.warehouse import Warehouse
from eventmart.schemas import USERS
from eventmart.session import materialize
from eventmart.sources import bronze, manifest, metadata

# Intermediate tables of builds, which hold events of all users.
WORK_TABLES = ("staging/refresh", "staging/classification", "staging/erasure")


def erase_users(warehouse: Warehouse, user_ids: Sequence[str], check: bool = True) -> dict[str, int]:
    """Remove users with all their events and metadata, and update the built tables.

    The raw layer's index tells the files that hold a line of theirs; only these are written
    again, and of the marts only the folders that had some of it. Refused lines have no
    parsed user: those that name one of the ids as a word go, too. Lines of other users that
    mention an id stay as they are. Returns the numbers of lines, users and files.

    The event files themselves lie outside the warehouse. Whoever keeps them removes the
    lines there, or they come back with the next version of a file. A warehouse that was
    not completely built is built anew. Intermediate tables are removed.
    """
    spark, ids = warehouse.spark, list(user_ids)
    lines = bronze.read_bronze(spark, warehouse.path("raw/lines"))
    refused = F.col("ingest_reason").isNotNull() & (F.col("ingest_reason") != bronze.FILE_MARKER)
    theirs = F.coalesce(F.col("user_id").isin(ids), F.lit(False)) | (
        refused & _names_one(F.col("raw_line"), ids)
    )
    indexed = manifest.read_user_files(spark, warehouse.path("raw/user_files"))
    files = indexed.filter(F.col("user_id").isin(ids)).select("source_file").union(
        lines.filter(refused & _names_one(F.col("raw_line"), ids)).select("source_file")
    )
    files = materialize(files.distinct(), "files", warehouse.path("staging/erasure/files"))
    inside = lines.join(files, "source_file", "left_semi")
    gone = inside.filter(theirs).count()
    users = _erase_metadata(warehouse, ids)
    number = files.count()
    built = warehouse.built_inputs()
    if number:
        warehouse.record_build(None)
        kept = inside.filter(~F.coalesce(theirs, F.lit(False)))
        kept = materialize(kept, "lines", warehouse.path("staging/erasure/lines"))
        bronze.replace_by_file(kept, warehouse.path("raw/lines"))
        warehouse.record_again(files)
    if built is None:
        warehouse.build(check=check)
    else:
        if number:
            refresh_files(warehouse, files)
        _rewrite_users(warehouse)
        warehouse.record_build(warehouse.build_inputs())
        if check:
            warehouse.require_checks()
    _remove(warehouse, WORK_TABLES)
    return {"lines": gone, "users": users, "files": number}


def _names_one(text: Column, ids: Sequence[str]) -> Column:
    words = "|".join(re.escape(i) for i in ids)
    return text.rlike(rf"(?<![\w-])({words})(?![\w-])")


def _erase_metadata(warehouse: Warehouse, ids: Sequence[str]) -> int:
    path = warehouse.path("raw/users")
    stored = metadata.read_stored(warehouse.spark, path, USERS)
    theirs = F.coalesce(F.col("user_id").isin(list(ids)), F.lit(False))
    number = stored.filter(theirs).count()
    if number:
        files = stored.filter(theirs).select("source_file").distinct()
        kept = stored.join(files, "source_file", "left_semi").filter(~theirs)
        kept = materialize(kept, "users", warehouse.path("staging/erasure/users"))
        bronze.replace_by_file(kept, path)
    return number


def _rewrite_users(warehouse: Warehouse) -> None:
    dim = marts.dim_users(warehouse.table("raw_users"), warehouse.table("raw_accounts"))
    dim.write.mode("overwrite").parquet(warehouse.path("marts/dim_users"))


def _remove(warehouse: Warehouse, names: Sequence[str]) -> None:
    spark = warehouse.spark
    path = spark._jvm.org.apache.hadoop.fs.Path
    for name in names:
        folder = path(warehouse.path(name))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
