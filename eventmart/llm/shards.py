"""Sharding by longest processing time: groups of equal texts go to the least-loaded shard."""

from __future__ import annotations

import heapq
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import pick, text_or_empty
from eventmart.session import materialize

SALTS = 64


def schedule(sizes: list[tuple[int, int]], shards: int) -> dict[int, list[int]]:
    """How many groups of each size each shard gets, from (size, number of groups).

    Longest first, each group to the shard with the least load (ties: smaller shard). Of
    very many groups of one size, those that fill the shards up to a common level are
    counted out at once; the last ones go through the heap one by one, as do all of few.
    """
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for size, groups in sorted(sizes, reverse=True):
        given = [0] * shards
        if not size:
            given[heap[0][1]], groups = groups, 0
        if groups > shards:
            low, high = heap[0][0], heap[0][0] + groups * size
            while low < high:  # the highest level that the groups can fill the shards to
                level = (low + high + 1) // 2
                if sum(max(0, -(-(level - load) // size)) for load, _ in heap) <= groups:
                    low = level
                else:
                    high = level - 1
            for load, shard in heap:
                given[shard] = max(0, -(-(low - load) // size))
            heap = [(load + given[shard] * size, shard) for load, shard in heap]
            heapq.heapify(heap)
            groups -= sum(given)
        for _ in range(groups):
            load, shard = heap[0]
            heapq.heapreplace(heap, (load + size, shard))
            given[shard] += 1
        placed[size] = given
    return placed


def assign(documents: DataFrame, shards: int = 24, overhead: int = 8) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of every document.

    ``size`` is the UTF-8 length of the text plus ``overhead``. Documents of equal text
    form a group, which stays together. The schedule needs the groups' sizes only: how many
    groups there are of each size goes to the driver, one row per distinct size, and comes
    back as the number of them for each shard. Groups of one size take their places in the
    order of their texts' hashes. ``slot`` counts from 0 in each shard without gaps.

    A null text counts as an empty one; null or repeated ids are rows like any other, and
    keep no order among equal texts; an empty table gives an empty result; other columns
    are ignored. Texts are measured and hashed whole.
    """
    spark = documents.sparkSession
    text = text_or_empty()
    rows = materialize(
        pick(documents, "doc_id", "text").select(
            "doc_id",
            (F.octet_length(text).cast("long") + overhead).alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("text_hash"),
        ),
        "shard-rows",
    )
    key = ["text_hash", "text_crc32", "size"]
    groups = rows.groupBy(*key).agg((F.count("*") * F.col("size")).alias("bytes"))
    groups = materialize(
        groups.withColumn("salt", F.pmod("text_hash", F.lit(SALTS)).cast("int")), "shard-groups"
    )
    sizes = groups.groupBy("bytes").agg(F.count("*").alias("n")).collect()
    placed = schedule([(r.bytes, r.n) for r in sizes], shards)
    ends = spark.createDataFrame(
        [(size, list(accumulate(given))) for size, given in placed.items()],
        "bytes long, ends array<long>",
    )
    # A group's place among those of its size: its place in its salt, after the other salts.
    by_salt = groups.groupBy("bytes", "salt").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("bytes").orderBy("salt")
    before = by_salt.select("bytes", "salt", (F.sum("n").over(earlier) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("bytes", "salt").orderBy("text_hash", "text_crc32"))
    rank = F.col("before") + F.col("place") - 1
    group_shards = materialize(
        groups.withColumn("place", place)
        .join(before, ["bytes", "salt"])
        .join(ends, "bytes")
        .select(*key, F.size(F.filter("ends", lambda end: end <= rank)).alias("shard")),
        "group-shards",
    )
    placed_rows = materialize(
        rows.join(group_shards, key).select("doc_id", "size", "text_crc32", "shard"),
        "shard-places",
    )
    # A slot is the place in a written file plus the rows of the shard in earlier files,
    # so no task numbers a whole shard.
    filed = placed_rows.select(
        "*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    counts = filed.groupBy("shard", "file").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "shard", "file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")
    )
    place = F.row_number().over(Window.partitionBy("shard", "file").orderBy("row"))
    return (
        filed.withColumn("place", place)
        .join(offsets, ["shard", "file"])
        .select(
            "doc_id", "size", "text_crc32", "shard",
            (F.col("offset") + F.col("place") - 1).cast("long").alias("slot"),
        )
    )
