"""Approximate nearest neighbours by an adaptive scan over the dimensions of probed lists.

Vectors lie in lists around the means of a sample. A list is stored in blocks of rotated
differences from its mean, dimension by dimension. A query reads the dimensions of a block
in steps: what the first d of them add up to estimates the whole distance, and a candidate
whose estimate is beyond the bar by more than chance allows is abandoned.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import pick, prepare, string_parts
from eventmart.session import materialize

SAMPLE_ROWS, SAMPLE_BYTES = 16384, 32 << 20
SAMPLE_PER_LIST = 16
SAMPLE_QUERIES = 256
ITERATIONS = 8
BLOCK_ROWS, QUERY_ROWS = 2048, 512
STEP = 16  # dimensions read between two tests
SLAB = 256  # candidates between two updates of the bar
DEVIATIONS = 2.1


@cache
def rotation(dims: int) -> np.ndarray:
    """A random orthogonal matrix, the same one in every task."""
    q, r = np.linalg.qr(np.random.default_rng(dims).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def means(sample: np.ndarray, lists: int) -> np.ndarray:
    """Lloyd's iterations from sampled rows; a mean that gets no row stays."""
    chosen = np.random.default_rng(7).choice(len(sample), lists, replace=False)
    centres = sample[np.sort(chosen)].copy()
    for _ in range(ITERATIONS):
        nearest = _nearest(sample, centres, 1)[:, 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        counts = np.bincount(nearest, minlength=lists)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def _nearest(rows: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The n nearest centres of each row, nearest first."""
    found = np.empty((len(rows), n), np.int64)
    norms = (centres * centres).sum(axis=1)
    for low in range(0, len(rows), SLAB):
        far = norms - 2.0 * (rows[low : low + SLAB] @ centres.T)
        if n == 1:
            found[low : low + SLAB, 0] = far.argmin(axis=1)
        else:
            found[low : low + SLAB] = np.argsort(far, axis=1, kind="stable")[:, :n]
    return found


def probes_needed(sample: np.ndarray, centres: np.ndarray, k: int, recall: float) -> int:
    """How many of the nearest lists hold this share of the k nearest within the sample.

    The sample is sparser than the table, so its neighbours lie farther off: the number is
    on the safe side.
    """
    chosen = np.random.default_rng(11).permutation(len(sample))[:SAMPLE_QUERIES]
    order = _nearest(sample[chosen], centres, len(centres))
    rank = np.argsort(order, axis=1)
    lists = _nearest(sample, centres, 1)[:, 0]
    norms = (sample * sample).sum(axis=1)
    needed = []
    for i, row in enumerate(chosen):
        far = norms - 2.0 * (sample @ sample[row])
        far[row] = np.inf
        near = np.argsort(far, kind="stable")[: min(k, len(sample) - 1)]
        needed.append(rank[i, lists[near]])
    needed = np.sort(np.concatenate(needed))
    return 1 + int(needed[int(np.ceil(recall * len(needed))) - 1]) if len(needed) else 1


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows, added up dimension after dimension."""
    total = np.zeros(len(left))
    for j in range(left.shape[1]):
        gap = left[:, j] - right[:, j]
        total += gap * gap
    return np.sqrt(total)


def _best(query: np.ndarray, vec_id: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k nearest, by query, score and id."""
    order = np.lexsort((vec_id, score, query))
    new = np.flatnonzero(np.diff(query[order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(new, np.diff(np.append(new, len(order))))
    return order[rank < k]


def scan_block(
    columns: np.ndarray, ids: np.ndarray, vectors: np.ndarray,
    turned: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, bars: np.ndarray, k: int,
    tested: list[int] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's k nearest in a block, of those not beyond its bar: query, row, distance.

    ``columns`` has a row per dimension of the rotated differences, ``turned`` those of the
    queries by query. With a share d of all D dimensions read, a candidate goes if its sum
    times D / d is above the squared bar times (1 + 2.1 / sqrt(d))^2. What stays to the end
    is measured on the original vectors. ``tested`` counts the dimensions read.
    """
    dims = len(columns)
    query = row = np.zeros(0, np.int64)
    score = np.zeros(0)
    limit = bars * bars * (1 + 1e-9)
    for low in range(0, len(ids), SLAB):
        part = columns[:, low : low + SLAB].astype(np.float64)
        near, at = min(STEP, dims), 0
        head, first = part[:near], turned[:, :near]
        sums = (first * first).sum(axis=1)[:, None] + (head * head).sum(axis=0) - 2.0 * first @ head
        if tested is not None:
            tested.append(sums.size * near)
        slack = dims / near * sums > limit[:, None] * (1 + DEVIATIONS / np.sqrt(near)) ** 2
        if near == dims:
            slack[:] = False
        left, right = np.nonzero(~slack & (query_ids[:, None] != ids[low : low + SLAB]))
        sums = sums[left, right]
        for at in range(near, dims, STEP):
            stop = min(at + STEP, dims)
            gap = turned[left, at:stop] - part[at:stop, right].T
            sums = sums + np.einsum("ij,ij->i", gap, gap)
            if tested is not None:
                tested.append(gap.size)
            if stop < dims:
                far = dims / stop * sums > limit[left] * (1 + DEVIATIONS / np.sqrt(stop)) ** 2
                left, right, sums = left[~far], right[~far], sums[~far]
        exact = distances(queries[left], vectors[low + right])
        query = np.concatenate([query, left])
        row = np.concatenate([row, low + right])
        score = np.concatenate([score, exact])
        best = _best(query, ids[row], score, k)
        query, row, score = query[best], row[best], score[best]
        counts = np.bincount(query, minlength=len(query_ids))
        full = np.flatnonzero(counts >= k)
        last = score[np.cumsum(counts)[full] - 1]
        limit[full] = np.minimum(limit[full], last * last * (1 + 1e-9))
    return query, row, score


def _matrix(column: pa.Array, dims: int, kind: str) -> np.ndarray:
    data, _ = string_parts(column)
    return data.view(kind).reshape(-1, dims).astype(np.float64)


class NeighbourIndex:
    """Lists of all vectors around the means of a sample, in blocks.

    The sample is at most ``SAMPLE_ROWS`` rows and ``SAMPLE_BYTES``, chosen by a hash of the
    id; it only places the means, of which there are one per ``rows_per_list`` rows and one
    per 16 sampled rows at most. Every row is indexed: in the list of its nearest mean, in
    one of as many blocks as the list needs. Vectors of a length that the sample lacks are
    one list. Only numbers per list reach the driver.

    Rows whose id is null, or whose vector is null, empty, zero or holds a null or
    non-finite component, take no part. If an id repeats, its smallest vector stands for
    it. Equal vectors are equally near to anything, so the smaller ids win all ties: of one
    vector's rows the ``k + 1`` least ids are stored, as no search can return more. Vectors meet only vectors of the same length.
    """

    def __init__(self, embeddings: DataFrame, k: int, recall: float, rows_per_list: int = 512):
        prepare(embeddings.sparkSession)
        self.spark, self.k, self.recall = embeddings.sparkSession, k, recall
        self.rows = self._fit_rows(pick(embeddings, "vec_id", "embedding"))
        element = embeddings.schema["embedding"].dataType.elementType.simpleString()
        self.kind = "<f4" if element == "float" else "<f8"
        seen = self.rows.agg(F.count("*").alias("n"), F.max("dims").alias("dims")).first()
        self.centres: dict[int, np.ndarray] = {}
        self.probes: dict[int, int] = {}
        self._fit(seen.n, seen.dims or 1, rows_per_list)
        self.counts = self._counts()
        self.blocks = self._store()

    def _fit_rows(self, named: DataFrame) -> DataFrame:
        bad = F.exists(
            "vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
        )
        rows = (
            named.select(
                F.col("vec_id").cast("long").alias("vec_id"),
                F.col("embedding").cast("array<double>").alias("vector"),
            )
            .filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~bad)
            .filter(F.exists("vector", lambda x: x != 0))
            .withColumn("dims", F.size("vector"))
        )
        again = rows.groupBy("vec_id").agg(F.count("*").alias("n")).filter("n > 1")
        again = materialize(again.select("vec_id"), "repeated-ids")
        least = rows.join(again, "vec_id").groupBy("vec_id").agg(F.min("vector").alias("vector"))
        return rows.join(again, "vec_id", "left_anti").unionByName(
            least.withColumn("dims", F.size("vector"))
        )

    def _fit(self, n: int, dims: int, rows_per_list: int) -> None:
        most = max(256, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dims)))
        place = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30))
        wanted = self.rows.filter(place < int((1 << 30) * min(1.0, most / max(n, 1))) + 1)
        table = wanted.select("dims", "vector").toArrow()
        lengths = table.column("dims").to_numpy()
        for length in np.unique(lengths).tolist():
            vectors = table.filter(pa.array(lengths == length)).column("vector").combine_chunks()
            sample = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)
            sample = sample[np.lexsort(sample.T)]  # tasks return rows in any order
            lists = max(1, min(len(sample) // SAMPLE_PER_LIST, n // rows_per_list))
            self.centres[length] = means(sample, lists)
            self.probes[length] = probes_needed(sample, self.centres[length], self.k, self.recall)

    def _placed(self, rows: DataFrame, asked: bool = False) -> DataFrame:
        """``vec_id``, ``dims``, ``vector`` (binary) and ``list``, that of the nearest mean.

        If ``asked``, as many lists as queries need, but more if they hold no more than k
        rows; ``first`` is true for the lists that are needed to hold more.
        """
        centres, kind, k, probes = self.centres, self.kind, self.k, self.probes
        counts = self.counts if asked else {}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lengths = batch.column("dims").to_numpy()
                for length in np.unique(lengths).tolist():
                    part = batch.filter(pa.array(lengths == length))
                    flat = part.column("vector").flatten().to_numpy(zero_copy_only=False)
                    vectors = flat.reshape(-1, length)
                    known = centres.get(length, np.zeros((1, length)))
                    nearest = _nearest(vectors, known, len(known) if asked else 1)
                    chosen = first = np.ones(nearest.shape, bool)
                    if asked:
                        sizes = np.array([counts.get((length, i), 0) for i in range(len(known))])
                        first = sizes[nearest].cumsum(axis=1) - sizes[nearest] <= k
                        chosen = first | (np.arange(len(known)) < probes.get(length, 1))
                    at, place = np.nonzero(chosen)
                    blobs = pa.array([x.tobytes() for x in vectors.astype(kind)], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [part.column("vec_id").take(pa.array(at)),
                         pa.array(np.full(len(at), length, np.int32)), blobs.take(pa.array(at)),
                         pa.array(nearest[at, place].astype(np.int32)), pa.array(first[at, place])],
                        ["vec_id", "dims", "vector", "list", "first"],
                    )

        return rows.mapInArrow(run, "vec_id long, dims int, vector binary, list int, first boolean")

    def _lists(self, counts: dict[tuple[int, int], int], rows: int) -> DataFrame:
        """Into how many parts of about ``rows`` rows each list falls."""
        parts = [(*key, -(-n // rows)) for key, n in counts.items()]
        return self.spark.createDataFrame(parts, "dims int, list int, parts int")

    def _counts(self) -> dict[tuple[int, int], int]:
        placed = self._placed(self.rows).groupBy("dims", "list").agg(F.count("*").alias("n"))
        return {(r.dims, r.list): r.n for r in placed.collect()}

    def _store(self) -> DataFrame:
        """A row per block: ids, rotated differences by dimension, and the vectors."""
        placed = self._placed(self.rows).withColumns(
            {"h1": F.xxhash64("vector"), "h2": F.xxhash64("dims", "vector")}
        )
        counted = placed.groupBy("h1", "h2").agg(F.count("*").alias("n"))
        copies = self.k + 1
        hot = materialize(counted.filter(F.col("n") > copies).drop("n"), "hot-vectors")
        least = Window.partitionBy("h1", "h2").orderBy("vec_id")
        kept = placed.join(hot, ["h1", "h2"], "left_anti").unionByName(
            placed.join(hot, ["h1", "h2"])
            .withColumn("place", F.row_number().over(least))
            .filter(F.col("place") <= copies)
            .drop("place")
        )
        centres, kind = self.centres, self.kind

        def run(table: pa.Table) -> pa.Table:
            dims, number = (table.column(n)[0].as_py() for n in ("dims", "list"))
            table = table.sort_by("vec_id")
            vectors = table.column("vector").combine_chunks()
            centre = centres[dims][number] if dims in centres else np.zeros(dims)
            turned = (_matrix(vectors, dims, kind) - centre) @ rotation(dims)
            columns = np.ascontiguousarray(turned.T, np.float32)
            return pa.table(
                {"dims": pa.array([dims], pa.int32()), "list": pa.array([number], pa.int32()),
                 "block": table.column("block").slice(0, 1),
                 "ids": [table.column("vec_id").to_numpy().astype("<i8").tobytes()],
                 "columns": [columns.tobytes()], "vectors": [string_parts(vectors)[0].tobytes()]}
            )

        parts = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
        blocked = kept.join(F.broadcast(self._lists(self.counts, BLOCK_ROWS)), ["dims", "list"])
        stored = blocked.select("vec_id", "dims", "list", "vector", parts.alias("block"))
        return materialize(
            stored.groupBy("dims", "list", "block").applyInArrow(
                run, "dims int, list int, block int, ids binary, columns binary, vectors binary"
            ),
            "neighbour-blocks",
        )

    def _scan(self, asked: DataFrame, k: int) -> DataFrame:
        """The k nearest of each query in each block of the lists it asks."""
        asked = materialize(asked, "asked-lists")
        loads = asked.groupBy("dims", "list").agg(F.count("*").alias("n"))
        loads = {(r.dims, r.list): r.n for r in loads.collect()}
        queries = self._lists(loads, QUERY_ROWS).withColumnRenamed("parts", "query_parts")
        chunk = F.pmod(F.xxhash64("vec_id"), F.col("query_parts")).cast("int")
        key = ["dims", "list", "block", "chunk"]
        blocks = self._lists(self.counts, BLOCK_ROWS)
        # A hot list is many blocks and its queries many chunks; each pair is one row.
        left = (
            asked.join(F.broadcast(queries), ["dims", "list"])
            .withColumn("chunk", chunk)
            .groupBy("dims", "list", "chunk")
            .agg(F.collect_list(F.struct("vec_id", "vector", "bar")).alias("queries"))
            .join(F.broadcast(blocks), ["dims", "list"])
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        )
        right = self.blocks.join(F.broadcast(queries), ["dims", "list"]).withColumn(
            "chunk", F.explode(F.sequence(F.lit(0), F.col("query_parts") - 1))
        )
        pairs = left.join(right, key).select("dims", "list", "queries", "ids", "columns", "vectors")
        centres, kind = self.centres, self.kind

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    one = {name: batch.column(name)[i] for name in batch.schema.names}
                    dims, number = one["dims"].as_py(), one["list"].as_py()
                    asked_rows = one["queries"].values
                    vectors = _matrix(asked_rows.field("vector"), dims, kind)
                    centre = centres[dims][number] if dims in centres else np.zeros(dims)
                    query_ids = asked_rows.field("vec_id").to_numpy()
                    ids = np.frombuffer(one["ids"].as_py(), "<i8")
                    query, row, score = scan_block(
                        np.frombuffer(one["columns"].as_py(), np.float32).reshape(dims, -1), ids,
                        np.frombuffer(one["vectors"].as_py(), kind).reshape(-1, dims).astype(float),
                        (vectors - centre) @ rotation(dims), query_ids, vectors,
                        asked_rows.field("bar").to_numpy(), k,
                    )
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(query_ids[query]), pa.array(ids[row]), pa.array(score)],
                        ["query_id", "vec_id", "score"],
                    )

        return pairs.mapInArrow(run, "query_id long, vec_id long, score double")

    def search(self, every: int) -> DataFrame:
        """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of each query's k nearest.

        Queries are the rows whose id is divisible by ``every``; all rows but the query's
        own are its candidates. The score is the Euclidean distance of the vectors as given;
        ties go to the smaller id. A query first reads its nearest list, and further ones
        while they hold no more than k rows; its k-th distance there is the bar for the rest
        of the lists that the share ``recall`` of neighbours needs within the sample.
        """
        k = self.k
        queries = self.rows.filter(F.col("vec_id") % every == 0)
        placed = materialize(self._placed(queries, asked=True), "placed-queries")
        order = Window.partitionBy("query_id").orderBy("score", "vec_id")

        def best(found: DataFrame) -> DataFrame:
            return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

        no_bar = F.lit(float("inf"))
        near = materialize(
            best(self._scan(placed.filter("first").withColumn("bar", no_bar), k)), "nearest-lists"
        )
        bars = near.filter(F.col("rank") == k).selectExpr("query_id AS vec_id", "score AS far")
        rest = placed.filter("NOT first").join(bars, "vec_id", "left")
        rest = rest.withColumn("bar", F.coalesce("far", no_bar)).drop("far")
        both = near.drop("rank").unionByName(self._scan(rest, k))
        return best(both).select("query_id", "rank", "vec_id", "score")


def search(
    embeddings: DataFrame, every: int = 100, k: int = 10, recall: float = 0.95,
    rows_per_list: int = 512,
) -> DataFrame:
    """``NeighbourIndex.search`` in an index of all the rows, for queries among them."""
    return NeighbourIndex(embeddings, k, recall, rows_per_list).search(every)
