"""Suffix dedup: equal windows by a depth-limited radix sort of suffixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventmart.llm.common import string_parts, slices, with_variant
from eventmart.llm.windows import Spec, covered, repeated_spans


def radix_groups(
    data: np.ndarray, starts: np.ndarray, group: np.ndarray, depth: int
) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that agree with another of their group through ``depth`` bytes.

    Most-significant-digit passes: each takes the next bytes of every suffix that is left,
    splits the groups by them, and drops suffixes that have become alone. Returns the
    places of the suffixes left and their groups, equal suffixes next to each other.
    """
    live = np.arange(len(starts))
    done = 0
    while len(live) and done < depth:
        bits = max(1, int(group.max(initial=0))).bit_length()
        width = min((64 - bits) // 8, depth - done)
        key = group.astype(np.uint64)
        for i in range(width):
            key = key << np.uint64(8) | data[starts[live] + done + i]
        order = np.argsort(key, kind="stable")
        key, live = key[order], live[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        group = np.cumsum(new) - 1
        many = np.bincount(group)[group] > 1
        live, group = live[many], group[many]
        if len(group):
            fresh = np.ones(len(group), bool)
            fresh[1:] = group[1:] != group[:-1]
            group = np.cumsum(fresh) - 1
        done += width
    return live, group


def windows_of(spec: Spec, table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, offset in the row, and group (anchor and its place) of every window."""
    count = table.column("count").to_numpy().astype(np.int64)
    place = table.column("place").to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(count)), count)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    h = table.column("h").to_numpy()
    anchor = np.cumsum(np.append(True, h[1:] != h[:-1])) - 1
    return row, offset, anchor[row] * spec.reach + place[row] - offset


def match_later(spec: Spec, table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that an equal one of an earlier document, or earlier place, precedes."""
    data, edges = string_parts(table.column("context").combine_chunks())
    row, offset, group = windows_of(spec, table)
    _, group = np.unique(group, return_inverse=True)
    live, group = radix_groups(data, edges[row] + offset, group, spec.window)
    ids = table.column("doc_id").combine_chunks()
    null = np.asarray(ids.is_null())[row[live]]
    ids = ids.fill_null(0).to_numpy(zero_copy_only=False)[row[live]]
    variant = table.column("variant").to_numpy()[row[live]]
    place = table.column("pos").to_numpy()[row[live]] + offset[live]
    order = np.lexsort((place, variant, ids, ~null, group))
    live, group = live[order], group[order]
    ids, null, variant, place = ids[order], null[order], variant[order], place[order]
    new = np.ones(len(live), bool)
    new[1:] = group[1:] != group[:-1]
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(live) else np.zeros(0, np.int64)
    same = (ids == ids[head]) & (null == null[head])
    same &= (variant == variant[head]) & (place == place[head])
    later = np.sort(live[~same])
    # Consecutive windows of a row make one span.
    ends = np.ones(len(later), bool)
    ends[1:] = (later[1:] != later[:-1] + 1) | (row[later[1:]] != row[later[:-1]])
    begin = later[ends]
    last = later[np.append(np.flatnonzero(ends)[1:] - 1, len(later) - 1)] if len(later) else later
    return row[begin], offset[begin], offset[last] + spec.window


def _whole_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """The bytes of all characters that have a byte among those that go."""
    first = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(first):
        return gone
    hit = np.logical_or.reduceat(gone, first)
    return np.repeat(hit, np.diff(np.append(first, len(data))))


def _remove(keep: tuple[str, ...], as_text: bool):
    kept_name = "text" if as_text else "kept"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = string_parts(batch.column("text"))
            gone = covered(batch, offsets)
            if as_text:
                gone = _whole_characters(data, gone)
            stay = np.zeros(len(data) + 1, np.int64)
            np.cumsum(~gone, out=stay[1:])
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            edges = offsets[:-1][offsets[:-1] < offsets[1:]]
            begins[edges] = gone[edges]
            spans = np.zeros(len(data) + 1, np.int64)
            np.cumsum(begins, out=spans[1:])
            kept = pa.Array.from_buffers(
                pa.binary(), batch.num_rows,
                [None, pa.py_buffer(stay[offsets].astype(np.int32)), pa.py_buffer(data[~gone])],
            )
            if as_text:
                kept = kept.cast(pa.string())
            size = np.diff(offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(batch.column(n) for n in keep), kept,
                 pa.array(size), pa.array(size - np.diff(stay[offsets])),
                 pa.array(np.diff(spans[offsets]))],
                ["doc_id", *keep, kept_name, "n_bytes", "n_removed", "n_spans"],
            )

    return run


def remove_repeats(
    documents: DataFrame, window: int = 100, keep: tuple[str, ...] = (), as_text: bool = False
) -> DataFrame:
    """Remove each byte covered by a string of ``window`` bytes that also starts earlier.

    Earlier means in a document of smaller id, or before in the same document; matches
    never cross documents, and strings are judged on the input. Columns: ``doc_id``, the
    columns in ``keep``, ``kept`` (the bytes left, which need not be valid UTF-8),
    ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed spans). With ``as_text`` a
    character goes with any of its bytes, and ``text`` has what is left, as a string.

    A null or empty text has no bytes. A null id is smaller than all others; rows of one
    id with different texts are ordered by the texts' hashes; rows repeated as a whole are
    the same document and not earlier than each other. Texts are processed whole.
    """
    spec = Spec(window, max(1, window // 3), words=False, keep_first=True)
    rows = with_variant(documents, keep)
    marked = repeated_spans(rows, spec, match_later)
    fields = [f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in ("doc_id", *keep)]
    kept = "text string" if as_text else "kept binary"
    return marked.drop("variant").mapInArrow(
        _remove(keep, as_text),
        ", ".join([*fields, kept, "n_bytes long, n_removed long, n_spans long"]),
    )
