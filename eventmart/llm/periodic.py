"""Periodic runs of words: block convolution by an exact number-theoretic transform.

A run of period q is a stretch of words that equal the ones q places on. At the dyadic
scale of block length B, the block at each multiple of B is correlated with the words that
follow it, which gives the sum of squared differences at every distance from B to 2B - 1.
Where it is zero, the block occurs again, and the distance seeds an extension to both sides.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventmart.llm.common import mix, pick, prepare, slices, text_or_empty

# A prime of the form k * 2**20 + 1 and a generator of its units. The sum of 128 products
# of residues stays below 2**53, so products of matrices of doubles are exact.
MODULUS, GENERATOR = 7340033, 3
DENSE = 128
LONGEST_BLOCK = 1 << 19  # periods from twice as many words on are found by blocks of this length
CHUNK = 1 << 18  # residues of a block matrix that are transformed at once
COLOUR_BITS = 8

RUNS = "array<struct<start: long, length: long, period: long>>"


def residue(x: np.ndarray) -> np.ndarray:
    """The residues of whole numbers in doubles; exact below 2**53."""
    return x - np.floor(x / MODULUS) * MODULUS


@cache
def _roots(n: int) -> np.ndarray:
    """The powers of an n-th root of unity."""
    root, found = pow(GENERATOR, (MODULUS - 1) // n, MODULUS), np.ones(1)
    while len(found) < n:
        found = np.concatenate([found, residue(found * pow(root, len(found), MODULUS))])
    return found


@cache
def _matrix(n: int) -> np.ndarray:
    place = np.arange(n)
    return _roots(n)[np.outer(place, place) % n]


@cache
def _twiddles(n: int, rows: int) -> np.ndarray:
    return _roots(n)[np.outer(np.arange(rows), np.arange(n // rows)) % n]


def transform(x: np.ndarray) -> np.ndarray:
    """The number-theoretic transform of each row; the length is a power of two."""
    count_, n = x.shape
    if n <= DENSE:
        return residue(x @ _matrix(n))
    rows = min(DENSE, n // 2)
    y = residue(np.matmul(_matrix(rows), x.reshape(count_, rows, n // rows)))
    y = residue(y * _twiddles(n, rows))
    y = transform(y.reshape(count_ * rows, n // rows))
    return np.ascontiguousarray(y.reshape(count_, rows, -1).transpose(0, 2, 1)).reshape(count_, n)


def _padded_transform(blocks: np.ndarray) -> np.ndarray:
    """The transform of each block followed by as many zeros."""
    size = blocks.shape[1]
    if 2 * size <= DENSE:
        return residue(blocks @ _matrix(2 * size)[:size])
    return transform(np.concatenate([blocks, np.zeros_like(blocks)], axis=1))


def _first_lags(x: np.ndarray, lags: int) -> np.ndarray:
    if x.shape[1] <= DENSE:
        return residue(x @ _matrix(x.shape[1])[:, :lags])
    return transform(x)[:, :lags]


def _colours(ids: np.ndarray, size: int) -> np.ndarray:
    """Small numbers for word ids: equal for equal words, and such that a block's sum of
    squared differences stays below the modulus."""
    bits = COLOUR_BITS
    while size * (2**bits - 1) ** 2 >= MODULUS:
        bits -= 1
    salted = ids.astype(np.uint64) + np.uint64(size << 40)
    return (mix(salted) & np.uint64(2**bits - 1)).astype(np.float64)


def _occurrences(
    colours: np.ndarray, size: int, offsets: range
) -> tuple[np.ndarray, np.ndarray]:
    """Places of blocks and distances at which their colours occur again without mismatch.

    Each offset of f blocks gives the distances from ``f * size`` to ``(f + 1) * size - 1``.
    The window at an offset is two blocks, whose transforms are those of blocks of their
    own, so each block is transformed once for the offsets 0 and 1.
    """
    blocks = -(-len(colours) // size)
    padded = np.zeros((blocks + offsets[-1] + 2) * size)
    padded[: len(colours)] = colours
    squares = np.concatenate([[0.0], np.cumsum(padded * padded)])
    matrix = padded.reshape(-1, size)
    back = (-np.arange(2 * size)) % (2 * size)
    sign = 1.0 - 2.0 * (np.arange(2 * size) % 2)
    half = (2 * size) * pow(2, -1, MODULUS) % MODULUS
    step = max(8, CHUNK // (2 * size))
    places, distances = [], []
    for low in range(0, blocks, step):
        high = min(blocks, low + step)
        near = _padded_transform(matrix[low : high + 2])
        own, turned = near[: high - low], near[:, back]
        at = np.arange(low, high)[:, None] * size
        square = squares[at + size] - squares[at]
        for offset in offsets:
            ahead = turned[offset:]
            if offset > 1:
                ahead = _padded_transform(matrix[low + offset : high + offset + 1])[:, back]
            # The second block of a window is shifted by half the transform's length.
            window = ahead[: high - low] + sign * ahead[1 : high - low + 1]
            lags = _first_lags(residue(own * window), size)
            start = at + offset * size + np.arange(size)
            both = square + squares[start + size] - squares[start]
            # The sum of squared differences is below the modulus: zero if its residue is.
            zero = lags == residue(both * half)
            if not offset:
                zero[:, 0] = False
            block, lag = np.nonzero(zero)
            places.append((block + low) * size)
            distances.append(lag + offset * size)
    return np.concatenate(places), np.concatenate(distances)


def _agree(left: np.ndarray, right: np.ndarray) -> int:
    """How many leading entries are equal."""
    at, step = 0, 64
    while at < len(left):
        unequal = left[at : at + step] != right[at : at + step]
        if unequal.any():
            return at + int(unequal.argmax())
        at += step
        step *= 2
    return len(left)


def find_runs(
    ids: np.ndarray, offsets: np.ndarray, min_length: int = 24, repeats: int = 3
) -> list[tuple[int, int, int, int]]:
    """(document, start, length, period) of every run, in this order.

    ``ids`` are the words of documents one after the other, equal for equal words;
    ``offsets`` is where each document starts, with one more entry for the end. A run has
    the smallest period, ``min_length`` words and ``repeats`` periods at least, and can't be
    extended. A run of period q from B to 2B - 1 is long enough to hold a whole block of
    length B and that block's next occurrence, wherever the blocks lie.
    """
    if repeats < 3:
        raise ValueError("blocks find runs of three periods or more")
    size = 1
    while 3 * (2 * size) - 2 <= min_length:
        size *= 2
    sizes = np.diff(offsets)
    found: list[tuple[int, int, int, int]] = []
    blocks_apart = range(2)  # the first scale has the shorter periods too
    while True:
        enough = sizes >= max(min_length, repeats * size * blocks_apart[0])
        if not enough.any():
            return sorted(found)
        long = np.flatnonzero(enough)
        words = ids[np.repeat(enough, sizes)]
        base = np.concatenate([[0], np.cumsum(sizes[long])])
        if size == LONGEST_BLOCK:
            blocks_apart = range(blocks_apart[0], 1 + int(sizes.max()) // (repeats * size))
        place, distance = _occurrences(_colours(words, size), size, blocks_apart)
        document = np.minimum(np.searchsorted(base, place, "right") - 1, len(long) - 1)
        inside = np.flatnonzero(place + size + distance <= base[document + 1])
        inside = inside[np.argsort(place[inside], kind="stable")]
        place, distance, document = place[inside], distance[inside], document[inside]
        alive = np.ones(len(place), bool)

        def drop_multiples(start: int, end: int, period: int) -> None:
            # Within a run, its period's multiples are no smallest periods.
            here = slice(*np.searchsorted(place, (start, end)))
            alive[here] &= (distance[here] % period != 0) | (
                place[here] + size + distance[here] > end
            )

        for d, start, length, period in found:
            if enough[d] and length >= 2 * size:
                low = int(base[np.searchsorted(long, d)]) + start
                drop_multiples(low, low + length, period)
        reach = (0, 0)  # the last distance, and the end of what matches at it
        for i in np.lexsort((place, distance)).tolist():
            if not alive[i]:
                continue
            at, period, d = int(place[i]), int(distance[i]), int(document[i])
            if reach[0] == period and at < reach[1]:
                continue
            low, high = int(base[d]), int(base[d + 1])
            end = at + period + _agree(words[at : high - period], words[at + period : high])
            if end < at + period + size:
                continue  # equal colours of other words
            start = at - _agree(words[low:at][::-1], words[low + period : at + period][::-1])
            reach = (period, end - period)
            if end - start >= max(min_length, repeats * period):
                found.append((int(long[d]), start - low, end - start, period))
                drop_multiples(start, end, period)
        if size == LONGEST_BLOCK:
            return sorted(found)
        size *= 2
        blocks_apart = range(1, 2)


def _collapse(min_length: int, repeats: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            cut = [text.split() for text in texts]  # bytes are cut at the six ASCII blanks
            sizes = np.array([len(words) for words in cut], np.int64)
            number = defaultdict(count().__next__)
            ids = np.fromiter(
                (number[word] for words in cut for word in words), np.int64, int(sizes.sum())
            )
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            runs = find_runs(ids, offsets, min_length, repeats)
            gone: dict[int, np.ndarray] = {}
            for d, start, length, period in runs:
                if d not in gone:
                    gone[d] = np.zeros(len(cut[d]), bool)
                gone[d][start + period : start + length] = True
            for d, dropped in gone.items():
                cut[d] = [cut[d][i] for i in np.flatnonzero(~dropped).tolist()]
            table = np.array(runs, np.int64).reshape(-1, 4)
            ends = np.searchsorted(table[:, 0], np.arange(len(cut) + 1)).astype(np.int32)
            rows = pa.StructArray.from_arrays(
                [pa.array(table[:, i]) for i in (1, 2, 3)], ["start", "length", "period"]
            )
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sizes),
                 pa.ListArray.from_arrays(pa.array(ends), rows),
                 pa.array([b" ".join(words) for words in cut], pa.binary()).cast(pa.string())],
                [*names, "n_words", "runs", "text"],
            )

    return run


def collapse_runs(
    documents: DataFrame, min_length: int = 24, repeats: int = 3, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id``, the columns in ``keep``, ``n_words``, ``runs`` and ``text`` of every document.

    Words are what lies between ASCII blanks. ``runs`` has ``start``, ``length`` and
    ``period`` of every maximal stretch of words with that smallest period, of
    ``min_length`` words and ``repeats`` periods at least, by start and then period.
    ``text`` has the words left when each run keeps its first period only, joined by one
    space; a word goes if any run drops it.

    A null or empty text has no words, no runs and an empty text. Null and repeated ids are
    rows like any other, equal texts get equal results, an empty table gives an empty one,
    and columns not named are ignored. A text is worked on whole, in memory in proportion to
    its length, with others up to about a megabyte; texts are never split over tasks.
    """
    prepare(documents.sparkSession)
    rows = pick(documents, "doc_id", "text", *keep).select(
        "doc_id", *keep, text_or_empty().alias("text")
    )
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(
        _collapse(min_length, repeats),
        ", ".join([*fields, "n_words long", f"runs {RUNS}", "text string"]),
    )
