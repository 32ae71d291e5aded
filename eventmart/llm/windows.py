"""Repeated windows of tokens: how equal windows of all documents are brought together.

Every window of ``window`` tokens has an anchor: of the ``gram``-token strings in it the one
with the least hash, the leftmost of equal ones. Equal windows have equal anchors at equal
places, so windows need to be compared only with those of the same anchor. Neighbouring
windows mostly share their anchor; a maximal row of them is a run, about half as long as a
window, and what is shuffled is one row per run:

1. Runs of equal content are copies of each other, all their windows repeat. Each task
   sends one run of each content only, so a passage in a third of all documents makes at
   most one row per task.
2. Runs with an anchor in common but different content may share some windows. Only for
   these are tokens looked up and compared, by the operator's own method.

An anchor in many different surroundings, such as a frequent short line, would put many
runs into one group. Anchors that hold more than a thousandth of a task's runs are
counted first, and their runs are sent window by window, keyed by the window's hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import (
    Spans,
    Words,
    byte_symbols,
    groups_of,
    join_rows,
    mix,
    prepare,
    repeats,
    slices,
    string_parts,
)
from eventmart.session import materialize

CHUNK_RUNS = 500_000
HEAVY = 1 / 2000  # of a task's runs
HEAVY_LEAST = 16
# A run's shape: its length in the low half, its anchor's place in the high one, two flags.
HALF = 30
LOW = (1 << HALF) - 1
MANY, PASSED = 1 << 2 * HALF, 1 << 2 * HALF + 1
RUNS = "h long, c long, shape long, doc_id long, variant long, pos long"
MARKS = "doc_id long, variant long, pos long, count int, place int, h long"
CONTEXTS = "h long, doc_id long, variant long, pos long, count int, place int, context binary"
SPANS = "doc_id long, variant long, start long, stop long"


@dataclass(frozen=True)
class Spec:
    """``keep_first``: the first occurrence is not a repeat; order is doc_id, then place."""

    window: int
    gram: int
    words: bool
    keep_first: bool

    @property
    def reach(self) -> int:
        return self.window - self.gram + 1


@dataclass
class Runs:
    """``pos`` and ``count``: first window and number of windows; ``place``: the anchor's
    distance from ``pos``; ``h``, ``c``: hashes of anchor and content."""

    doc: np.ndarray
    pos: np.ndarray
    count: np.ndarray
    place: np.ndarray
    h: np.ndarray
    c: np.ndarray


def tokens(spec: Spec, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A symbol per token of a batch, and where each document's tokens start."""
    if not spec.words:
        return byte_symbols(data), offsets
    words = Words(data, offsets)
    return mix(words.hash), words.first


def find_runs(
    spec: Spec, symbols: np.ndarray, first: np.ndarray, heavy: np.ndarray | None = None
) -> Runs | None:
    """The runs of a batch; those of heavy anchors as windows."""
    long_enough = np.flatnonzero(np.diff(first) >= spec.window)
    if not len(long_enough):
        return None
    spans = Spans(symbols)
    grams = spans.grams(spec.gram)
    place = (np.uint64(1) << np.uint64(len(symbols).bit_length())) - np.uint64(1)
    least = (grams & ~place) | np.arange(len(grams), dtype=np.uint64)
    size = 1
    while 2 * size <= spec.reach:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < spec.reach:
        shift = spec.reach - size
        least = np.minimum(least[:-shift], least[shift:])
    anchor = (least & place).astype(np.int64)
    edge = np.zeros(len(symbols) + 1, np.int8)
    edge[first[long_enough]] += 1
    edge[first[long_enough + 1] - spec.window + 1] -= 1
    window = np.flatnonzero(np.cumsum(edge[: len(anchor)]) > 0)
    new = np.ones(len(window), bool)
    new[1:] = (anchor[window[1:]] != anchor[window[:-1]]) | (window[1:] != window[:-1] + 1)
    # Documents of exactly the window's length leave no gap between their windows.
    new[np.searchsorted(window, first[long_enough])] = True
    starts = np.flatnonzero(new)
    count = np.diff(np.append(starts, len(window)))
    start = window[starts]
    h = grams[anchor[start]]
    c = spans.of(start, start + count - 1 + spec.window)
    distance = anchor[start] - start
    if heavy is not None and len(heavy):
        split = np.isin(h, heavy)
        if split.any():
            each, stay = np.flatnonzero(split), ~split
            step = np.arange(count[each].sum()) - np.repeat(
                np.cumsum(count[each]) - count[each], count[each]
            )
            at = np.repeat(start[each], count[each]) + step
            whole = spans.of(at, at + spec.window)
            other = Spans(mix(symbols + np.uint64(1))).of(at, at + spec.window)
            far = np.repeat(distance[each], count[each]) - step
            start, count = np.append(start[stay], at), np.append(count[stay], np.ones_like(at))
            distance = np.append(distance[stay], far)
            h, c = np.append(h[stay], other), np.append(c[stay], whole)
    doc = np.searchsorted(first, start, "right") - 1
    return Runs(doc, start - first[doc], count, distance, h, c)


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and null flags of a long column."""
    null = np.asarray(column.is_null())
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), null


class _Chunk:
    """Runs of several batches, with their documents."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, batch: pa.RecordBatch, runs: Runs) -> None:
        ids, null = _ids(batch.column("doc_id"))
        variant = batch.column("variant").to_numpy()
        shape = runs.count.astype(np.int64) | runs.place.astype(np.int64) << HALF
        doc = runs.doc
        self.parts.append(
            (runs.h, runs.c, shape, ids[doc], null[doc], variant[doc], runs.pos)
        )
        self.size += len(doc)

    def columns(self) -> list[np.ndarray]:
        found = [np.concatenate(x) for x in zip(*self.parts)]
        self.__init__()
        return found


def _one_of_each(columns: list[np.ndarray]) -> pa.RecordBatch:
    """The earliest run of each content; the others as marked rows that need no partner."""
    h, c, shape, ids, null, variant, pos = columns
    kept = np.ones(len(h), bool)
    again = np.flatnonzero(repeats(mix(h + mix(c))))
    again = again[np.lexsort((pos[again], variant[again], ids[again], ~null[again], c[again], h[again]))]
    new = np.ones(len(again), bool)
    new[1:] = (h[again][1:] != h[again][:-1]) | (c[again][1:] != c[again][:-1])
    head = again[np.flatnonzero(new)[np.cumsum(new) - 1]]
    same = (ids[again] == ids[head]) & (null[again] == null[head])
    same &= (variant[again] == variant[head]) & (pos[again] == pos[head])
    shape = shape.copy()
    shape[head[~new]] |= MANY
    shape[again[~new & ~same]] |= PASSED
    kept[again[~new & same]] = False  # a repeated row of the same document
    passed = (shape & PASSED) > 0
    h = np.where(passed, mix(h + ids.astype(np.uint64) + pos.astype(np.uint64)), h)
    return pa.RecordBatch.from_arrays(
        [pa.array(h.view(np.int64)[kept]), pa.array(c.view(np.int64)[kept]),
         pa.array(shape[kept]), pa.array(ids[kept], mask=null[kept]),
         pa.array(variant[kept]), pa.array(pos[kept].astype(np.int64))],
        ["h", "c", "shape", "doc_id", "variant", "pos"],
    )


def _run_rows(spec: Spec, heavy: list[int]):
    heavy_hashes = np.array(heavy, np.int64).view(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk()
        for batch in slices(batches):
            symbols, first = tokens(spec, *string_parts(batch.column("text")))
            runs = find_runs(spec, symbols, first, heavy_hashes)
            if runs is not None:
                chunk.add(batch, runs)
            if chunk.size >= CHUNK_RUNS:
                yield _one_of_each(chunk.columns())
        if chunk.size:
            yield _one_of_each(chunk.columns())

    return run


def _heavy_rows(spec: Spec):
    """Anchors with many different runs in a chunk, and (as h null) the number of runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[Runs] = []

        def counts():
            h = np.concatenate([r.h for r in parts])
            c = np.concatenate([r.c for r in parts])
            parts.clear()
            total = len(h)
            again = repeats(h)
            h, c = h[again], c[again]
            order = np.lexsort((c, h))
            h, c = h[order], c[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
            names, number = np.unique(h[new], return_counts=True)
            large = number >= max(HEAVY_LEAST, HEAVY * total)
            return pa.RecordBatch.from_arrays(
                [pa.array([*names[large].view(np.int64).tolist(), None], pa.int64()),
                 pa.array([*number[large].tolist(), total], pa.int64())],
                ["h", "n"],
            )

        size = 0
        for batch in slices(batches):
            runs = find_runs(spec, *tokens(spec, *string_parts(batch.column("text"))))
            if runs is not None:
                parts.append(runs)
                size += len(runs.h)
            if size >= CHUNK_RUNS:
                yield counts()
                size = 0
        if size:
            yield counts()

    return run


def heavy_anchors(documents: DataFrame, spec: Spec) -> list[int]:
    """Hashes of the anchors whose runs are sent window by window.

    Only shares of all runs above a quarter of ``HEAVY`` are taken, so there are at most
    4 / HEAVY = 8000. Which they are does not change any result.
    """
    counted = (
        documents.select("text")
        .mapInArrow(_heavy_rows(spec), "h long, n long")
        .groupBy("h")
        .agg(F.sum("n").alias("n"))
    )
    counted = materialize(counted, "window-anchors")
    total = counted.filter("h IS NULL").first()
    if total is None:
        return []
    found = counted.filter(F.col("h").isNotNull() & (F.col("n") * 4 >= total["n"] * HEAVY))
    return [row["h"] for row in found.select("h").collect()]


def _marks(spec: Spec):
    """Reads runs by anchor and content: copies are marked (h null), and one run of each
    content is asked for (h set) if its anchor has other contents too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups_of(batches, "h", 200_000):
            table = table.combine_chunks()
            h, c = table.column("h").to_numpy(), table.column("c").to_numpy()
            shape = table.column("shape").to_numpy()
            ids, null = _ids(table.column("doc_id").combine_chunks())
            variant, pos = table.column("variant").to_numpy(), table.column("pos").to_numpy()
            passed = (shape & PASSED) > 0
            at = np.flatnonzero(~passed)
            new = np.ones(len(at), bool)
            new[1:] = (h[at][1:] != h[at][:-1]) | (c[at][1:] != c[at][:-1])
            group = np.cumsum(new) - 1
            head = at[np.flatnonzero(new)]
            mine = head[group]
            if spec.keep_first:
                marked = (ids[at] != ids[mine]) | (null[at] != null[mine])
                marked |= (variant[at] != variant[mine]) | (pos[at] != pos[mine])
            else:
                size = np.bincount(group, minlength=len(head))
                many = np.zeros(len(head), bool)
                np.logical_or.at(many, group, (shape[at] & MANY) > 0)
                marked = ((size > 1) | many)[group]
            _, inverse, contents = np.unique(h[head], return_inverse=True, return_counts=True)
            asked = head[contents[inverse] > 1] if len(head) else head
            chosen = np.concatenate([np.flatnonzero(passed), at[marked], asked])
            anchors = pa.array(h[chosen], mask=np.arange(len(chosen)) < len(chosen) - len(asked))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[chosen], mask=null[chosen]), pa.array(variant[chosen]),
                 pa.array(pos[chosen]), pa.array((shape[chosen] & LOW).astype(np.int32)),
                 pa.array((shape[chosen] >> HALF & LOW).astype(np.int32)), anchors],
                ["doc_id", "variant", "pos", "count", "place", "h"],
            )

    return run


def context_tokens(spec: Spec, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens as they are compared: bytes, or 32 bits of a word's hash (35 words: 1120)."""
    if not spec.words:
        return data, offsets
    words = Words(data, offsets)
    return (words.hash >> np.uint64(32)).astype(np.uint32), words.first


def _contexts(spec: Spec):
    """The tokens of each run that was asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values, first = context_tokens(spec, *string_parts(batch.column("text")))
            lists = batch.column("asked")
            doc = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            h, pos, count, place = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
            start = first[doc] + pos
            size = count.astype(np.int64) - 1 + spec.window
            ends = np.cumsum(size)
            index = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + size, size)
            raw = np.ascontiguousarray(values[index]).view(np.uint8)
            width = values.dtype.itemsize
            offsets = np.concatenate([[0], ends * width]).astype(np.int32)
            context = pa.Array.from_buffers(
                pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]
            )
            at = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), batch.column("doc_id").take(at), batch.column("variant").take(at),
                 pa.array(pos), pa.array(count), pa.array(place), context],
                ["h", "doc_id", "variant", "pos", "count", "place", "context"],
            )

    return run


#: Gets a table of contexts sorted by anchor; returns rows of the table and, for each, the
#: first token and the end of a repeated span in it.
Match = Callable[[Spec, pa.Table], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _matched(spec: Spec, match: Match):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups_of(batches, "h", 20_000):
            table = table.combine_chunks()
            row, start, stop = match(spec, table)
            pos = table.column("pos").to_numpy()[row]
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [table.column("doc_id").combine_chunks().take(at),
                 table.column("variant").combine_chunks().take(at),
                 pa.array(pos + start), pa.array(pos + stop)],
                ["doc_id", "variant", "start", "stop"],
            )

    return run


def repeated_spans(rows: DataFrame, spec: Spec, match: Match) -> DataFrame:
    """``rows`` (doc_id, variant, text, ...) with ``spans``: an array of (start, stop).

    The spans of a row cover exactly the tokens that lie in a repeated window; they may
    overlap, and are null where there are none.
    """
    prepare(rows.sparkSession)
    texts = rows.select("doc_id", "variant", "text")
    runs = texts.mapInArrow(_run_rows(spec, heavy_anchors(texts, spec)), RUNS)
    ordered = runs.repartition("h").sortWithinPartitions("h", "c", "doc_id", "variant", "pos")
    marks = materialize(ordered.mapInArrow(_marks(spec), MARKS), "window-marks")
    asked = (
        marks.filter("h IS NOT NULL")
        .groupBy("doc_id", "variant")
        .agg(F.collect_list(F.struct("h", "pos", "count", "place")).alias("asked"))
    )
    contexts = (
        join_rows(rows, asked, ["asked"])
        .filter("asked IS NOT NULL")
        .select("doc_id", "variant", "text", "asked")
        .mapInArrow(_contexts(spec), CONTEXTS)
    )
    found = contexts.repartition("h").sortWithinPartitions("h").mapInArrow(
        _matched(spec, match), SPANS
    )
    copies = marks.filter("h IS NULL").select(
        "doc_id", "variant", F.col("pos").alias("start"),
        (F.col("pos") + F.col("count") - 1 + spec.window).alias("stop"),
    )
    spans = (
        copies.unionByName(found)
        .groupBy("doc_id", "variant")
        .agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    )
    return join_rows(rows, spans, ["spans"])


def covered(batch: pa.RecordBatch, first: np.ndarray) -> np.ndarray:
    """Which tokens of a batch lie in a span of their document."""
    lists = batch.column("spans")
    edge = np.zeros(first[-1] + 1, np.int32)
    flat = lists.flatten()
    if len(flat):
        size = np.asarray(lists.value_lengths().fill_null(0))
        doc = np.repeat(np.arange(batch.num_rows), size)
        start, stop = (x.to_numpy(zero_copy_only=False) for x in flat.flatten())
        np.add.at(edge, first[doc] + start, 1)
        np.add.at(edge, first[doc] + stop, -1)
    return np.cumsum(edge[:-1]) > 0
