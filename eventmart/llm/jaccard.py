"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets decide."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import (
    Spans,
    Words,
    groups_of,
    mix,
    pick,
    prepare,
    slices,
    string_parts,
    text_or_empty,
)
from eventmart.llm.components import components
from eventmart.session import materialize

ROWS = 4  # minimum hashes in a band
RECALL = 0.99999  # of a pair that just reaches the threshold
BLOCK = 256  # texts of a bucket that are compared with as many others in one task


def band_count(threshold: float, rows: int = ROWS, recall: float = RECALL) -> int:
    """Bands with which a pair at the threshold meets in one of them with that probability."""
    return ceil(log(1 - recall) / log(1 - threshold**rows))


def _random(count: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams, and where each text's begin; a text of fewer than n words
    has one, of all its words, unless it has none."""
    count = np.diff(words.first)
    number = np.maximum(count - n + 1, np.minimum(count, 1))
    first = np.append(0, np.cumsum(number))
    doc = np.repeat(np.arange(len(count)), number)
    start = words.first[doc] + np.arange(first[-1]) - first[doc]
    stop = start + np.minimum(n, count[doc])
    return Spans(mix(words.hash)).of(start, stop), first


def sequence_keys(words: Words) -> list[bytes]:
    """128 bits of each text's words in order."""
    start, stop = words.first[:-1], words.first[1:]
    one = Spans(mix(words.hash + np.uint64(3))).of(start, stop)
    two = Spans(mix(words.hash + np.uint64(5))).of(start, stop)
    both = np.stack([one, two], axis=1).astype("<u8")
    return [row.tobytes() for row in both]


def band_hashes(grams: np.ndarray, first: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A hash per text (with n-grams) and band, over the minima of ``rows`` hash functions."""
    found = np.empty((len(first) - 1, bands), np.uint64)
    factor, shift = _random(2 * bands * rows).reshape(2, -1)
    factor = factor | np.uint64(1)
    for band in range(bands):
        key = np.full(len(first) - 1, band + 1, np.uint64)
        for i in range(band * rows, (band + 1) * rows):
            least = np.minimum.reduceat((grams ^ shift[i]) * factor[i], first[:-1])
            key = mix(key * np.uint64(31) + least)
        found[:, band] = key
    return found


def _signatures(n: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = Words(*string_parts(batch.column("text")))
            grams, first = shingles(words, n)
            some = np.diff(first) > 0
            keys = sequence_keys(words)
            values = np.zeros((batch.num_rows, bands), np.uint64)
            if some.any():
                values[some] = band_hashes(grams, np.append(first[:-1][some], first[-1]), bands, rows)
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(np.where(some, bands, 0))).astype(np.int32)),
                pa.array(values[some].view(np.int64).ravel()),
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(keys, pa.binary()), lists],
                ["doc_id", "k", "bands"],
            )

    return run


def add_keys(documents: DataFrame) -> DataFrame:
    """All columns, and ``_k``: 128 bits of the text's words, null for a text without."""
    prepare(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            words = Words(*string_parts(batch.column("_text")))
            none = np.diff(words.first) == 0
            keys = [None if empty else key for key, empty in zip(sequence_keys(words), none)]
            columns = [batch.column(name) for name in batch.schema.names[:-1]]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(keys, pa.binary())], [*batch.schema.names[:-1], "_k"]
            )

    rows = documents.select("*", text_or_empty().alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(run, ", ".join([*fields, "_k binary"]))


def _sets(table: pa.Table, n: int) -> list[np.ndarray]:
    found = []
    for batch in slices(iter(table.to_batches())):
        grams, first = shingles(Words(*string_parts(batch.column("text"))), n)
        found += [np.unique(grams[a:b]) for a, b in zip(first[:-1], first[1:])]
    return found


def _first_meetings(bands: np.ndarray, band: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Pairs that meet in this band and in no earlier one: (places in left and in right)."""
    meet = bands[left, band][:, None] == bands[right, band][None, :]
    for earlier in range(band):
        meet &= bands[left, earlier][:, None] != bands[right, earlier][None, :]
    return np.argwhere(meet)


def _shared(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many n-grams each pair has in common."""
    members, inverse = np.unique(np.append(a, b), return_inverse=True)
    if len(a) < 2 * len(members):
        pairs = ((sets[x], sets[y]) for x, y in zip(a, b))
        return np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in pairs])
    # Many pairs of few texts: products of the incidence matrix, a block of n-grams at a
    # time. N-grams of one text alone are in no pair.
    doc = np.repeat(np.arange(len(members)), [len(sets[m]) for m in members])
    _, gram, count = np.unique(
        np.concatenate([sets[m] for m in members]), return_inverse=True, return_counts=True
    )
    held = count[gram] > 1
    _, gram = np.unique(gram[held], return_inverse=True)
    doc = doc[held]
    order = np.argsort(gram, kind="stable")
    gram, doc = gram[order], doc[order]
    total = np.zeros((len(members), len(members)), np.float32)
    width = 4096
    for begin in range(0, int(gram[-1]) + 1 if len(gram) else 0, width):
        low, high = np.searchsorted(gram, [begin, begin + width])
        part = np.zeros((len(members), width), np.float32)
        part[doc[low:high], gram[low:high] - begin] = 1
        total += part @ part.T
    return total[inverse[: len(a)], inverse[len(a) :]].astype(np.int64)


def _verified(n: int, percent: int, as_pairs: bool):
    """Links of each task of a bucket: pairs, or per text their number and a hub."""

    def links(keys, bands, sets, band, side, low, high):
        _, once = np.unique(keys, return_index=True)  # repeated rows of one text
        once = np.sort(once)
        if low == high:
            left = right = once
        else:
            left, right = once[side[once] == low], once[side[once] == high]
        pairs = _first_meetings(bands, band, left, right)
        if low == high:
            pairs = pairs[pairs[:, 0] < pairs[:, 1]]
        if not len(pairs):
            return pairs[:, 0], pairs[:, 1]
        a, b = left[pairs[:, 0]], right[pairs[:, 1]]
        size = np.array([len(s) for s in sets])
        shared = _shared(sets, a, b)
        near = 100 * shared >= percent * (size[a] + size[b] - shared)
        return a[near], b[near]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups_of(batches, "task", 2 * BLOCK):
            table = table.combine_chunks()
            task = table.column("task").to_numpy()
            edges = np.append(np.flatnonzero(np.append(True, task[1:] != task[:-1])), len(task))
            keys = np.array(table.column("k").to_pylist(), object)
            bands = np.stack(table.column("bands").to_numpy(zero_copy_only=False))
            band, side, low, high = (
                table.column(c).to_numpy() for c in ("band", "side", "low", "high")
            )
            sets = _sets(table, n)
            one, two, three = [], [], []
            for i, j in zip(edges[:-1], edges[1:]):
                if j - i < 2:
                    continue
                a, b = links(keys[i:j], bands[i:j], sets[i:j], band[i], side[i:j], low[i], high[i])
                names = keys[i:j]
                if as_pairs:
                    one += names[np.minimum(a, b)].tolist()
                    two += names[np.maximum(a, b)].tolist()
                    three += [1] * len(a)
                elif len(a):
                    label = np.arange(j - i)
                    while True:  # the least place of each connected part
                        least = np.minimum(label[a], label[b])
                        after = label.copy()
                        np.minimum.at(after, a, least)
                        np.minimum.at(after, b, least)
                        after = after[after]
                        if (after == label).all():
                            break
                        label = after
                    number = np.bincount(np.append(a, b), minlength=j - i)
                    linked = np.flatnonzero(number)
                    one += names[linked].tolist()
                    two += names[label[linked]].tolist()
                    three += number[linked].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(one, pa.binary()), pa.array(two, pa.binary()), pa.array(three, pa.int64())],
                ["k", "other", "links"],
            )

    return run


class JaccardJoin:
    """Links between documents whose sets of ``n`` consecutive words have a Jaccard
    similarity of at least ``percent`` / 100.

    Words are runs of other characters than blanks, unchanged. A text of fewer than n
    words has one n-gram, of all its words; a text without words has none and no links.
    Documents with the same words in the same order are copies; one of them stands for
    all. Null or repeated ids and repeated rows are documents like any other.

    Each text's band hashes put it into buckets. Of buckets with the same texts only that
    of the first band is kept, and a pair is compared in the first band in which it meets,
    so once. The number of bands gives a pair at the threshold a chance of 1 in 100,000 to
    meet in none. A bucket of many texts is dealt into blocks of about 256, and each pair
    of blocks is a task of its own, so no task holds more than some 512 texts; its links
    leave it as one row per text (their number, and one text of their connected part),
    unless pairs are asked for.
    """

    def __init__(self, documents: DataFrame, n: int = 5, percent: int = 80):
        prepare(documents.sparkSession)
        self.n, self.percent = n, percent
        self.bands = band_count(percent / 100)
        self.rows = pick(documents, "doc_id", "text").select(
            F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")
        )
        signed = materialize(
            self.rows.mapInArrow(
                _signatures(n, self.bands, ROWS), "doc_id long, k binary, bands array<long>"
            ),
            "jaccard-rows",
        )
        self.members = signed.select("doc_id", "k")
        self.classes = materialize(
            signed.groupBy("k").agg(
                F.min("doc_id").alias("first_id"),
                F.count("*").alias("n_copies"),
                F.any_value("bands").alias("bands"),
            ),
            "jaccard-classes",
        )

    def _tasks(self) -> DataFrame:
        """Texts and the tasks they belong to, with what the comparison needs."""
        spread = self.classes.select("k", F.posexplode("bands").alias("band", "bucket"))
        buckets = (
            spread.groupBy("band", "bucket")
            .agg(
                F.count("*").alias("size"),
                F.bit_xor(F.xxhash64("k")).alias("x"),
                F.bit_xor(F.xxhash64("k", F.lit(1))).alias("y"),
            )
            .filter("size > 1")
            .groupBy("size", "x", "y")
            .agg(F.min(F.struct("band", "bucket")).alias("b"))
            .select("b.band", "b.bucket", "size")
        )
        blocks = F.ceil(F.col("size") / BLOCK).cast("int")
        # Every block meets itself and each other block.
        placed = (
            spread.join(materialize(buckets, "jaccard-buckets"), ["band", "bucket"])
            .withColumn("blocks", blocks)
            .withColumn("side", F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(
                "k", "band", "side",
                F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"),
                F.xxhash64(
                    "band", "bucket", F.least("side", "other"), F.greatest("side", "other")
                ).alias("task"),
            )
        )
        places = placed.groupBy("k").agg(
            F.collect_list(F.struct("task", "band", "side", "low", "high")).alias("places")
        )
        wanted = places.join(self.classes.select("k", "first_id", "bands"), "k")
        texts = add_keys(self.rows)
        same = (texts["_k"] == wanted["k"]) & texts["doc_id"].eqNullSafe(wanted["first_id"])
        return (
            texts.join(wanted, same)
            .select("k", "text", "bands", F.explode("places").alias("p"))
            .select("k", "text", "bands", "p.*")
        )

    def _links(self, as_pairs: bool) -> DataFrame:
        tasks = self._tasks().repartition("task").sortWithinPartitions("task")
        return tasks.mapInArrow(
            _verified(self.n, self.percent, as_pairs), "k binary, other binary, links long"
        )

    def pairs(self) -> DataFrame:
        """``doc_id`` and ``other_id`` of linked texts, one document for all copies of each."""
        ids = self.classes.select("k", "first_id")
        return (
            self._links(as_pairs=True)
            .join(ids.withColumnRenamed("first_id", "doc_id"), "k")
            .join(ids.select(F.col("k").alias("other"), F.col("first_id").alias("other_id")), "other")
            .select("doc_id", "other_id")
        )

    def texts(self) -> DataFrame:
        """Per text ``k``: ``first_id``, ``n_copies``, ``wordless``, ``n_links``, ``root`` (a
        text of its connected group), and of the group ``class_id`` (its least document id) and
        ``head`` (the text of that document)."""
        found = materialize(self._links(as_pairs=False), "jaccard-links")
        number = found.groupBy("k").agg(F.sum("links").alias("n_links"))
        stars = components(found.select(F.col("k").alias("u"), F.col("other").alias("v")))
        texts = (
            self.classes.select(
                "k", "first_id", "n_copies", (F.size("bands") == 0).alias("wordless")
            )
            .join(number, "k", "left")
            .join(stars.select(F.col("u").alias("k"), F.col("v").alias("root")), "k", "left")
            .withColumn("root", F.coalesce("root", "k"))
            .withColumn("n_links", F.coalesce("n_links", F.lit(0)))
        )
        texts = materialize(texts, "jaccard-texts")
        groups = texts.groupBy("root").agg(
            F.min(F.struct(F.col("first_id").isNull(), "first_id", "k")).alias("least")
        )
        return texts.join(
            groups.select(
                "root", F.col("least.first_id").alias("class_id"), F.col("least.k").alias("head")
            ),
            "root",
        )

    def classified(self) -> DataFrame:
        """One row per document: ``doc_id``, ``class_id`` (the least document id of all
        that links connect it with), ``text_id`` (the least id of its copies), ``n_copies``
        (documents with its words, itself included) and ``n_links`` (different texts it is
        linked with). A text without words is no copy of another: its class is its own id."""
        texts = self.texts()
        own = lambda c, alone: F.when(F.col("wordless"), alone).otherwise(F.col(c))
        return self.members.join(texts, "k").select(
            "doc_id",
            own("class_id", F.col("doc_id")).alias("class_id"),
            own("first_id", F.col("doc_id")).alias("text_id"),
            own("n_copies", F.lit(1)).alias("n_copies"),
            "n_links",
        )


def one_of_each(
    documents: DataFrame, n: int = 5, percent: int = 80, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id``, ``text`` and the columns in ``keep``, without near duplicates: of each
    connected group the document of the least id stays (one row, if it is repeated); texts
    without words all stay."""
    documents = pick(documents, "doc_id", "text", *keep)
    heads = JaccardJoin(documents, n, percent).texts().filter("k = head")
    keyed = add_keys(documents)
    single = keyed.filter("_k IS NOT NULL").join(
        heads.select(F.col("k").alias("_k"), F.col("class_id").alias("_class_id")), "_k"
    )
    single = single.filter(F.col("doc_id").cast("long").eqNullSafe(F.col("_class_id")))
    return (
        single.dropDuplicates(["_k"])
        .select(*documents.columns)
        .unionByName(keyed.filter("_k IS NULL").select(*documents.columns))
    )
