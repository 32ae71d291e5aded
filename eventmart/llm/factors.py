"""Substring dedup by relative Lempel-Ziv factors of documents against reference blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventmart.llm.common import Spans, Words, mix, slices, string_parts, with_variant
from eventmart.llm.suffixes import windows_of
from eventmart.llm.windows import Spec, covered, repeated_spans


def factors(spec: Spec, table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Factor each phrase against the block of all phrases with the same anchor.

    The block's index holds every window with its anchor's place. All phrases are parsed
    side by side, from the left: where the index has the next window from another phrase,
    the factor is the longest common string from there, at least a window long, and the
    parse goes on at the windows that cross the factor's end; else it steps to the next
    window. So each window is inside a factor or was looked up itself.
    """
    data, edges = string_parts(table.column("context").combine_chunks())
    words = np.ascontiguousarray(data).view(np.uint32)
    first = edges // 4
    row, offset, group = windows_of(spec, table)
    start = first[row] + offset
    spans = Spans(mix(words.astype(np.uint64) + np.uint64(1)))
    key = mix(spans.of(start, start + spec.window) + mix(group.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(order)))
    # The source of a window is the next equal one, of the last the first one.
    after = np.arange(1, len(order) + 1)
    after[begin + size - 1] = begin
    source = np.empty(len(order), np.int64)
    source[order] = order[after]

    count = table.column("count").to_numpy().astype(np.int64)
    base = np.cumsum(count) - count  # each phrase's first window
    phrase = np.arange(len(count))
    at = np.zeros(len(count), np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    width = spec.window + spec.reach - 1
    step = np.arange(width)
    while len(phrase):
        window = base[phrase] + at
        partner = source[window]
        known = partner != window
        p, w, y = phrase[known], window[known], partner[known]
        if len(p):
            mine, other = start[w], start[y]
            room = np.minimum(first[p + 1] - mine, first[row[y] + 1] - other)
            inside = step[None, :] < room[:, None]
            last = len(words) - 1
            equal = inside & (
                words[np.minimum(mine[:, None] + step, last)]
                == words[np.minimum(other[:, None] + step, last)]
            )
            length = np.where(equal.all(axis=1), width, equal.argmin(axis=1))
            enough = length >= spec.window
            found.append((p[enough], at[known][enough], (at[known] + length)[enough]))
            ahead = np.ones(len(phrase), np.int64)
            ahead[known] = np.where(enough, length - spec.window + 1, 1)
        else:
            ahead = 1
        at = at + ahead
        going = at < count[phrase]
        phrase, at = phrase[going], at[going]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def _rejoin(keep: tuple[str, ...]):
    """The words that are left, joined by single spaces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = string_parts(batch.column("text"))
            words = Words(data, offsets)
            gone = covered(batch, words.first)
            start, size = words.start[~gone], (words.end - words.start)[~gone] + 1
            ends = np.cumsum(size)
            index = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + size, size)
            joined = np.append(data, np.uint8(0))[index]
            joined[ends - 1] = 0x20
            left = np.bincount(words.doc[~gone], minlength=batch.num_rows)
            last = np.cumsum(left)
            total = np.append(0, ends)
            # Each text is a slice of all words, without the space after its last one.
            whole = joined.tobytes()
            texts = [
                whole[a : b - 1] if b > a else b""
                for a, b in zip(total[last - left].tolist(), total[last].tolist())
            ]
            number = np.diff(words.first)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(batch.column(n) for n in keep),
                 pa.array(texts, pa.binary()).cast(pa.string()), pa.array(number),
                 pa.array(number - left)],
                ["doc_id", *keep, "text", "n_words", "n_removed"],
            )

    return run


def remove_repeats(
    documents: DataFrame, window: int = 35, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Remove each word covered by ``window`` consecutive words that also start elsewhere.

    All occurrences go, the first one too; elsewhere may be in the same document. Words
    are compared unchanged, by 64-bit hashes for routing and 32 bits of each in a window.
    Columns: ``doc_id``, the columns in ``keep``, ``text`` (the words left, joined by one
    space), ``n_words`` (before) and ``n_removed``.

    A null or empty text has no words. Every row is a document of its own, so the windows
    of a row that is repeated as a whole go from all of its copies; null ids are like any
    other. Texts are processed whole.
    """
    spec = Spec(window, max(1, window // 4), words=True, keep_first=False)
    rows = with_variant(documents, keep)
    marked = repeated_spans(rows, spec, factors)
    fields = [f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in ("doc_id", *keep)]
    return marked.drop("variant").mapInArrow(
        _rejoin(keep), ", ".join([*fields, "text string, n_words long, n_removed long"])
    )
