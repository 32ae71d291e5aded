"""Exact top-k inner products by no-random-access aggregation over sorted lists."""

from __future__ import annotations

from fractions import Fraction
from math import floor, inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import pick, prepare

BLOCK, QUERY_BLOCK = 4096, 1024  # rows of a candidate block and of a query block
FIRST_DEPTH = 64
EXACT_IN_DOUBLE, LONGEST = 2**53, 2**63 - 1
SMALL = 2**20  # components below this are multiplied in doubles


def block_top_k(
    queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int,
    read: list[int] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows of a block for each query: places of queries and rows, and scores.

    Rows and queries with a very large component are taken apart from the others, so that
    they alone are multiplied in Python's integers. ``read`` counts the list entries read.
    """
    large_row, large_query = (
        np.array([bool(x.any()) for x in abs(m) >= SMALL], bool) for m in (rows, queries)
    )
    found = []
    for of_queries, of_rows in (
        (~large_query, ~large_row), (~large_query, large_row), (large_query, large_row | True),
    ):
        at, to = np.flatnonzero(of_queries), np.flatnonzero(of_rows)
        if len(at) and len(to):
            query, row, score = _aggregate(
                queries[at], query_ids[at], rows[to], row_ids[to], k, read
            )
            found.append((at[query], to[row], score))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    query, row, score = (np.concatenate(x) for x in zip(*found))
    return _best(query, row, score, row_ids, k)


def _best(query, row, score, row_ids, k):
    best = np.lexsort((row_ids[row], ~score, query))
    query, row, score = query[best], row[best], score[best]
    new = np.flatnonzero(np.diff(query, prepend=-1))
    rank = np.arange(len(query)) - np.repeat(new, np.diff(np.append(new, len(query))))
    chosen = rank < k
    return query[chosen], row[chosen], score[chosen]


def _exact_kind(queries: np.ndarray, rows: np.ndarray) -> type:
    """A type in which no sum of products of the two is rounded."""
    largest = [int(abs(m).max(initial=0)) for m in (queries, rows)]
    bound = largest[0] * largest[1] * max(rows.shape[1], 1)
    return np.float64 if bound < EXACT_IN_DOUBLE else np.int64 if bound <= LONGEST else object


def _aggregate(queries, query_ids, rows, row_ids, k, read):
    """No-random-access aggregation over the sorted lists of the dimensions.

    Each dimension has one list of the rows by descending component, read from the front for
    positive query components and from the back for negative ones, all to the same depth,
    which doubles from round to round. An entry is read once: it adds to what is known of its
    row's score (for all queries at a time, as a product of matrices of the new entries).
    The lower bound takes the end of the list for what is not known, the upper bound the
    place reached. A row whose upper bound is below the k-th largest lower bound is out for
    good. A query stops when few rows are left, or all has been read; their scores are then
    resolved. Ties go to the smaller id.
    """
    n, dims = rows.shape
    kind = _exact_kind(queries, rows)
    if kind is object:
        rows, queries = (np.frompyfunc(int, 1, 1)(m) for m in (rows, queries))
    rows, queries = rows.astype(kind), queries.astype(kind)
    order = np.argsort(-rows, axis=0, kind="stable")  # the sorted lists
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(n)[:, None], axis=0)
    lists = np.take_along_axis(rows, order, axis=0)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    # What is known of each score, all components counted from the ends of their lists.
    known = np.zeros((len(queries), n), kind)
    alive = query_ids[:, None] != row_ids[None, :]
    open_ = np.flatnonzero(alive.any(axis=1))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    before, depth = 0, n if kind is object else FIRST_DEPTH
    while len(open_):
        depth = min(depth, n)
        new_front = (place >= before) & (place < depth)
        new_back = (place < n - before) & (place >= n - depth)
        known[open_] += up[open_] @ np.where(new_front, rows - lists[-1], 0).T
        known[open_] += down[open_] @ np.where(new_back, rows - lists[0], 0).T
        if read is not None:
            read.append(int((queries[open_] != 0).sum()) * (depth - before))
        lower = known[open_]
        if depth < n:
            # Unread components reach no farther than the place read in their lists.
            front, back = (lists[depth - 1] - lists[-1]), (lists[n - depth] - lists[0])
            unread_front = (place >= depth).astype(kind)
            unread_back = (place < n - depth).astype(kind)
            upper = lower + (up[open_] * front) @ unread_front.T
            upper += (down[open_] * back) @ unread_back.T
        else:
            upper = lower
        own = ~(query_ids[open_][:, None] != row_ids[None, :])
        ranked = np.where(own, lower.min() - 1, lower)
        wanted = min(k, n)
        bar = np.sort(ranked, axis=1)[:, n - wanted]
        if kind is object:  # what lies beyond 64 bits ties
            bar = np.array([min(x, LONGEST) if x > -LONGEST else -inf for x in bar], object)
        alive[open_] &= (upper >= bar[:, None]).astype(bool)
        done = (alive[open_].sum(axis=1) <= 8 * k) | (depth == n)
        at, row = np.nonzero(alive[open_[done]])
        found.append((open_[done][at], row))
        open_ = open_[~done]
        before, depth = depth, 2 * depth
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    query, row = (np.concatenate(x) for x in zip(*found))
    score = (queries[query] * rows[row]).sum(axis=1)
    score = np.clip(score, -LONGEST - 1, LONGEST) if kind is object else score
    return _best(query, row, score.astype(np.int64), row_ids, k)


def _scaled(table: pa.Table, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, as whole numbers in doubles or Python integers."""
    vectors = table.column("vector").combine_chunks()
    given = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)
    if not (np.abs(given) >= EXACT_IN_DOUBLE / scale).any():
        return np.floor(scale * given)
    whole = np.empty(given.shape, object)
    whole[:] = [[floor(scale * Fraction(x)) for x in row] for row in given.tolist()]
    return whole


def search(
    embeddings: DataFrame, every: int = 50, k: int = 5, scale: int = 256
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of each query's k best rows.

    A vector's components x become floor(scale * x). Queries are the rows whose ``vec_id``
    is divisible by ``every``; all rows but the query's own are its candidates. The score
    is the inner product; ties go to the smaller id.

    Rows whose id is null, or whose vector is null, empty, or holds a null or a non-finite
    component, take no part. If an id repeats, its smallest vector stands for it. Vectors
    meet only vectors of the same length. Components of any size are multiplied exactly; a
    score beyond 64 bits counts as the nearest that has 64.

    Query blocks meet candidate blocks, whose numbers grow with the table; each block
    yields its own k best, and the best of those are the result.
    """
    prepare(embeddings.sparkSession)
    unfit = F.exists(
        "vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    rows = (
        pick(embeddings, "vec_id", "embedding")
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("embedding").cast("array<double>").alias("vector"),
        )
        .filter(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & ~unfit)
        .groupBy("vec_id")
        .agg(F.min("vector").alias("vector"))
        .withColumn("dims", F.size("vector"))
    )
    total = embeddings.count()
    row_blocks = 1 + total // BLOCK
    query_blocks = 1 + total // every // QUERY_BLOCK
    spread = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    candidates = rows.withColumn("row_block", spread(row_blocks)).withColumn(
        "query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    )
    asked = (
        rows.filter(F.col("vec_id") % every == 0)
        .withColumn("query_block", spread(query_blocks))
        .withColumn("row_block", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    )
    key = ["query_block", "row_block", "dims"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        query_ids, row_ids = (t.column("vec_id").to_numpy() for t in (left, right))
        if not len(query_ids) or not len(row_ids):
            query = row = score = np.zeros(0, np.int64)
        else:
            query, row, score = block_top_k(
                _scaled(left, scale), query_ids, _scaled(right, scale), row_ids, k
            )
        return pa.table(
            {"query_id": query_ids[query], "vec_id": row_ids[row], "score": score}
        )

    blocks = (
        asked.groupBy(*key)
        .cogroup(candidates.groupBy(*key))
        .applyInArrow(run, "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        blocks.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
