"""Helpers of the text operators: row identity, text batches, words and rolling hashes.

Hashes are polynomials modulo 2**64 over random symbols: with the prefix sums of
``symbol[i] * BASE**i`` the hash of any span is one subtraction and one product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_SYMBOLS = np.random.default_rng(20240917).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2)
_SYMBOLS += np.uint64(1)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def prepare(spark: SparkSession) -> None:
    """Bound the batches that Python workers get: rows of text may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def pick(df: DataFrame, *names: str) -> DataFrame:
    """These columns, spelled exactly so, whatever other columns there are.

    Spark finds names whatever their case, so a table with ``text`` and ``TEXT`` needs its
    columns taken by place.
    """
    lower = [column.lower() for column in df.columns]
    if all(lower.count(name.lower()) == 1 for name in names):
        return df.select(*names)
    numbered = df.toDF(*(f"c{i}" for i in range(len(lower))))
    return numbered.select(*(F.col(f"c{df.columns.index(name)}").alias(name) for name in names))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def with_variant(documents: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``variant``, ``text`` (null: empty) and the columns in ``keep``.

    ``variant`` tells apart rows of one ``doc_id`` that hold different texts: it is the
    text's hash for such ids (null ids included) and 0 for all others. The table of such
    ids is written first: while it is small, and mostly it is empty, no text is shuffled.
    """
    rows = pick(documents, "doc_id", "text", *keep).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), *keep
    )
    hashed = rows.select("doc_id", F.xxhash64("text").alias("h"))
    mixed = (
        hashed.groupBy("doc_id")
        .agg(F.min("h").alias("low"), F.max("h").alias("high"))
        .filter("low <> high")
        .select(F.col("doc_id").alias("mixed_id"), F.lit(True).alias("mixed"))
    )
    mixed = materialize(mixed, "mixed-ids")
    return rows.join(mixed, rows["doc_id"].eqNullSafe(mixed["mixed_id"]), "left").select(
        "doc_id",
        F.when(F.col("mixed"), F.xxhash64("text")).otherwise(F.lit(0)).alias("variant"),
        "text",
        *keep,
    )


def join_rows(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """``left`` with ``columns`` of ``right`` (one row per doc_id and variant), null-safe."""
    right = right.select(
        F.col("doc_id").alias("_id"), F.col("variant").alias("_variant"), *columns
    )
    same = left["doc_id"].eqNullSafe(right["_id"]) & (left["variant"] == right["_variant"])
    return left.join(right, same, "left").drop("_id", "_variant")


def slices(batches: Iterator[pa.RecordBatch], name: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in record batches of about ``SLICE_BYTES`` of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = string_parts(batch.column(batch.schema.get_field_index(name)))[1]
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def string_parts(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without nulls, and where each value starts."""
    if array.null_count:
        array = array.fill_null("" if pa.types.is_string(array.type) else b"")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = array.buffers()
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, kind)[array.offset : array.offset + len(array) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**i`` and its inverse modulo 2**64, for i below ``size`` or more."""
    if len(_powers[0]) < size:
        size = 1 << size.bit_length()
        for place, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            column = np.full(size, base, np.uint64)
            column[0] = 1
            _powers[place] = np.multiply.accumulate(column)
    return _powers[0], _powers[1]


class Spans:
    """Hashes of spans of a symbol sequence."""

    def __init__(self, symbols: np.ndarray):
        self.size = len(symbols)
        power, self.inverse = powers(self.size + 1)
        self.sums = np.zeros(self.size + 1, np.uint64)
        np.cumsum(symbols * power[: self.size], out=self.sums[1:])

    def grams(self, length: int) -> np.ndarray:
        """The hash of every ``length`` consecutive symbols."""
        count = max(0, self.size - length + 1)
        found = self.sums[length : length + count] - self.sums[:count]
        return mix(found * self.inverse[:count])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        found = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(found + (end - start).astype(np.uint64) * np.uint64(_BASE))


def byte_symbols(data: np.ndarray) -> np.ndarray:
    return _SYMBOLS[data]


class Words:
    """The words of a batch of texts: places, document, hash. ``first[d]`` is the index of
    the first word of document d, with one more entry for the end."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        inside = ~_SEPARATOR[data]
        edges = offsets[:-1][offsets[:-1] < offsets[1:]]
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        before[edges] = False
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        after[edges[1:] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.hash = Spans(byte_symbols(data)).of(self.start, self.end)
        self.inside = inside


def repeats(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs more than once."""
    bits = np.uint64(max(1, len(keys)).bit_length())
    place = (np.uint64(1) << bits) - np.uint64(1)
    found = np.zeros(len(keys), bool)
    # Sorting values is several times as fast as sorting places: the low bits of the key
    # make room for the place, and the few that agree in the high bits are looked at again.
    packed = np.sort((keys & ~place) | np.arange(len(keys), dtype=np.uint64))
    near = (packed[1:] & ~place) == (packed[:-1] & ~place)
    close = np.zeros(len(keys), bool)
    close[1:] |= near
    close[:-1] |= near
    at = (packed[close] & place).astype(np.int64)
    _, inverse, count = np.unique(keys[at], return_inverse=True, return_counts=True)
    found[at] = count[inverse] > 1
    return found


def groups_of(batches: Iterator[pa.RecordBatch], key: str, rows: int) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows that never cut the rows of one key; sorted input."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], "left"))
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).combine_chunks().to_batches()
        count = table.num_rows - cut
    if count:
        yield pa.Table.from_batches(held)
