"""Reversible line dedup: sharded cuckoo filters in front of exact document counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.common import join_rows, pick, prepare, slices, text_or_empty, with_variant
from eventmart.session import scratch_dir

BLANK = b" \t\n\x0b\x0c\r"
SLOTS = 4
KICKS = 500
DOCS_PER_SHARD = 1000
STEPS = 2
STATE = "shard int, k1 long, k2 long, docs long, filter binary"


def line_key(line: bytes) -> bytes:
    """The line without blanks at its ends, A-Z lower-cased (other bytes are not letters)."""
    return line.strip(BLANK).lower()


def digest(key: bytes) -> tuple[int, int]:
    """128 bits of a key, as two signed longs."""
    whole = xxhash.xxh3_128_digest(key)
    return int.from_bytes(whole[:8], "little", signed=True), int.from_bytes(
        whole[8:], "little", signed=True
    )


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; both buckets of a key can be told from either.

    It may report a key that it does not hold, never miss one that it does. It grows when a
    key finds no place, which needs the keys again: ``add`` then returns False.
    """

    def __init__(self, table: np.ndarray):
        self.table = table
        self.mask = len(table) - 1

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(1, int(np.ceil(np.log2(max(1, keys) / (SLOTS * 0.85) + 1))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def of(cls, keys: list[tuple[int, int]]) -> CuckooFilter:
        size = len(keys)
        while True:
            built = cls.sized(size)
            if all(built.add(key) for key in keys):
                return built
            size = 2 * max(size, 1)

    def _places(self, key: tuple[int, int]) -> tuple[int, int, int]:
        mark = (key[1] & 0xFFFF) or 1
        first = (key[0] & 0xFFFFFFFFFFFF) & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995) & self.mask)

    def add(self, key: tuple[int, int]) -> bool:
        mark, *both = self._places(key)
        for bucket in both:
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = mark
                return True
        bucket = both[mark & 1]
        for kick in range(KICKS):
            slot = (mark + kick) % SLOTS
            mark, self.table[bucket, slot] = int(self.table[bucket, slot]), mark
            bucket = self._other(bucket, mark)
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = mark
                return True
        return False

    def may_hold(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        mark = (k2 & 0xFFFF).astype(np.int64)
        mark[mark == 0] = 1
        first = (k1 & 0xFFFFFFFFFFFF) & self.mask
        other = first ^ ((mark * 0x5BD1E995) & self.mask)
        marks = mark.astype(np.uint16)[:, None]
        return ((self.table[first] == marks) | (self.table[other] == marks)).any(axis=1)

    def remove(self, key: tuple[int, int]) -> None:
        mark, *both = self._places(key)
        for bucket in both:
            held = np.flatnonzero(self.table[bucket] == mark)
            if len(held):
                self.table[bucket, held[0]] = 0
                return


def _merge(state: pd.DataFrame, change: pd.DataFrame) -> pd.DataFrame:
    """A shard after a change: the filter tells new keys from those to look up."""
    shard = int((state if len(state) else change)["shard"].iloc[0])
    stored = state[state["filter"].notna()]["filter"]
    rows = state[state["filter"].isna()]
    counts = dict(zip(zip(rows["k1"], rows["k2"]), rows["docs"]))
    if len(stored):
        cells = np.frombuffer(stored.iloc[0], np.uint16).copy()
        filter_ = CuckooFilter(cells.reshape(-1, SLOTS))
    else:
        filter_ = CuckooFilter.sized(len(change))
    k1, k2 = change["k1"].to_numpy(np.int64), change["k2"].to_numpy(np.int64)
    known = filter_.may_hold(k1, k2) if len(change) else np.zeros(0, bool)
    full = False
    for key, docs, seen in zip(zip(k1.tolist(), k2.tolist()), change["docs"].tolist(), known):
        before = counts.get(key, 0) if seen else 0
        after = before + docs
        if after > 0:
            counts[key] = after
            if not before and not full:
                full = not filter_.add(key)
        elif before:
            del counts[key]
            if not full:
                filter_.remove(key)
    if full:
        filter_ = CuckooFilter.of(list(counts))
    keys = np.array(list(counts), np.int64).reshape(-1, 2)
    merged = pd.DataFrame(
        {"shard": shard, "k1": keys[:, 0], "k2": keys[:, 1], "docs": list(counts.values())}
    )
    merged["filter"] = None
    last = pd.DataFrame(
        {"shard": [shard], "k1": [0], "k2": [0], "docs": [0],
         "filter": [filter_.table.tobytes()]}
    )
    return pd.concat([merged, last]) if len(merged) else last


def _keys(min_chars: int):
    """Per document the digests of its distinct keys; rows of one key are counted per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found: dict[tuple[int, int], int] = {}
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                keys = {line_key(line) for line in text.split(b"\n")}
                for key in keys:
                    if len(key) < min_chars or len(key.decode()) < min_chars:
                        continue
                    name = digest(key)
                    found[name] = found.get(name, 0) + 1
            if found:
                k1, k2 = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                     pa.array(list(found.values()), pa.int64())],
                    ["k1", "k2", "docs"],
                )

    return run


def _document_keys(min_chars: int):
    """Rows of document and key, each key of a document once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            place, names = [], []
            for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                for key in {line_key(line) for line in text.split(b"\n")}:
                    if len(key) >= min_chars and len(key.decode()) >= min_chars:
                        place.append(i)
                        names.append(digest(key))
            k1, k2 = zip(*names) if names else ((), ())
            at = pa.array(place, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("variant").take(at),
                 pa.array(k1, pa.int64()), pa.array(k2, pa.int64())],
                ["doc_id", "variant", "k1", "k2"],
            )

    return run


def _drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        lists = batch.column("dropped_keys").to_pylist()
        kept, lines, dropped = [], [], []
        for text, names in zip(texts, lists):
            parts = text.split(b"\n")
            stay = parts
            if names:
                names = {(x["k1"], x["k2"]) for x in names}
                stay = [x for x in parts if not (key := line_key(x)) or digest(key) not in names]
            kept.append(text if stay is parts else b"\n".join(stay))
            lines.append(len(parts))
            dropped.append(len(parts) - len(stay))
        names = [n for n in batch.schema.names if n not in ("text", "dropped_keys")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.array(kept, pa.binary()).cast(pa.string()),
             pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
            [*names, "text", "n_lines", "n_dropped"],
        )


class LineIndex:
    """How many documents hold each line key, in shards of the key's digest.

    Each shard has the exact counts and a cuckoo filter of the keys with a count. A change
    asks the filter first: a key it does not hold is new and needs no look-up; a key it
    seems to hold is looked up in the exact counts. Deleting documents takes their counts
    back, and removes keys that no document holds any more from counts and filter, so that
    inserting and deleting the same documents leaves the index as it was. The state is a
    table in the shared folder; each change writes the next one.
    """

    def __init__(self, spark: SparkSession, shards: int, min_docs: int = 10, min_chars: int = 1):
        prepare(spark)
        self.spark, self.shards = spark, shards
        self.min_docs, self.min_chars = min_docs, min_chars
        self.state = spark.createDataFrame([], STATE)

    def _change(self, documents: DataFrame, sign: int) -> None:
        rows = pick(documents, "text").select(text_or_empty().alias("text"))
        counted = rows.mapInArrow(_keys(self.min_chars), "k1 long, k2 long, docs long")
        change = (
            counted.groupBy("k1", "k2")
            .agg((F.sum("docs") * sign).alias("docs"))
            .withColumn("shard", F.pmod("k1", F.lit(self.shards)).cast("int"))
        )
        merged = (
            self.state.groupBy("shard")
            .cogroup(change.groupBy("shard"))
            .applyInPandas(_merge, STATE)
        )
        path = scratch_dir(self.spark, "line-index")
        merged.write.parquet(path)
        self.state = self.spark.read.schema(STATE).parquet(path)

    def insert(self, documents: DataFrame) -> LineIndex:
        self._change(documents, 1)
        return self

    def delete(self, documents: DataFrame) -> LineIndex:
        self._change(documents, -1)
        return self

    def counts(self) -> DataFrame:
        return self.state.filter("filter IS NULL").select("k1", "k2", "docs")

    def clean(self, documents: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """``doc_id``, the columns in ``keep``, ``text`` without the lines of frequent keys,
        ``n_lines`` (before) and ``n_dropped``.

        A key that at least ``min_docs`` of the inserted documents hold loses all its lines;
        keys below ``min_chars`` code points stay. A null or empty text is one empty line.
        Every row counts as a document of its own, repeated rows and null ids included.
        """
        rows = with_variant(documents, keep)
        frequent = self.counts().filter(F.col("docs") >= self.min_docs).select("k1", "k2")
        held = rows.select("doc_id", "variant", "text").mapInArrow(
            _document_keys(self.min_chars), "doc_id long, variant long, k1 long, k2 long"
        )
        dropped = (
            held.join(frequent, ["k1", "k2"])
            .groupBy("doc_id", "variant")
            .agg(F.collect_set(F.struct("k1", "k2")).alias("dropped_keys"))
        )
        joined = join_rows(rows, dropped, ["dropped_keys"])
        kept = [f for f in joined.schema.fields if f.name not in ("variant", "text", "dropped_keys")]
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
        return joined.drop("variant").mapInArrow(
            _drop, ", ".join([*fields, "text string", "n_lines long", "n_dropped long"])
        )


def drop_frequent_lines(
    documents: DataFrame, min_docs: int = 10, min_chars: int = 1, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``LineIndex.clean`` of the documents against an index of themselves.

    The index grows in ``STEPS`` insertions of documents chosen by a hash, so the later ones
    ask the filters which of their keys the earlier ones brought.
    """
    spark = documents.sparkSession
    shards = 1 + documents.count() // DOCS_PER_SHARD
    index = LineIndex(spark, shards, min_docs, min_chars)
    texts = pick(documents, "doc_id", "text")
    step = F.pmod(F.xxhash64("doc_id"), F.lit(STEPS))
    for number in range(STEPS):
        index.insert(texts.filter(step == number))
    return index.clean(documents, keep)
