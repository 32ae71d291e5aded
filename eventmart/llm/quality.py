"""Quality rules: counts of a text, and how much of it repeats."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventmart.llm.common import (
    Spans,
    Words,
    byte_symbols,
    mix,
    pick,
    prepare,
    repeats,
    slices,
    string_parts,
    text_or_empty,
)

SYMBOLS = "#*$%&|<>"
WINDOW = 3
# Characters inside n-grams that occur again in the text (all occurrences), and inside
# repeated lines (without the first): the largest percentage of the characters in words
# that a kept text may have. A short clean text with its heading line twice stays below.
MAX_GRAM_PERCENT = {5: 30, 6: 30, 7: 30, 8: 30, 9: 30, 10: 30}
MAX_LINE_PERCENT = 30
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_dup_line_chars")

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS.encode())] = True


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values[first[d]:first[d + 1]]`` for each d."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def _covered(flags: np.ndarray, length: int) -> np.ndarray:
    """Which places lie in a window of ``length`` that starts at a flag."""
    edge = np.zeros(len(flags) + 1, np.int32)
    at = np.flatnonzero(flags)
    np.add.at(edge, at, 1)
    np.add.at(edge, np.minimum(at + length, len(flags)), -1)
    return np.cumsum(edge[:-1]) > 0


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each text of a batch, by rolling hashes over its words.

    Only windows whose shorter window occurs again can occur again, so each length looks
    at what the one before has left. Keys of windows and lines contain the document.
    """
    docs = len(offsets) - 1
    words = Words(data, offsets)
    first, count = words.first, len(words.start)
    is_char = (data & 0xC0) != 0x80  # the first byte of each code point
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum(is_char, out=chars[1:])
    word_chars = chars[words.end] - chars[words.start]
    found = {
        "n_words": np.diff(first),
        "word_chars": _sums(word_chars, first),
        "n_symbols": _sums(_IS_SYMBOL[data], offsets),
    }

    spans = Spans(mix(words.hash))
    doc_key = mix(np.arange(docs, dtype=np.uint64) + np.uint64(1))
    left = np.arange(count)
    for length in (WINDOW, *MAX_GRAM_PERCENT):
        left = left[left + length <= count]
        left = left[words.doc[left] == words.doc[left + length - 1]]
        keys = mix(spans.of(left, left + length) + doc_key[words.doc[left]])
        left = left[repeats(keys)]
        flags = np.zeros(count, bool)
        flags[left] = True
        inside = _covered(flags, length)
        if length == WINDOW:
            found["n_repeat_words"] = _sums(inside, first)
        else:
            found[f"n_dup_{length}gram_chars"] = _sums(word_chars * inside, first)

    # A line with a word: from after a line break, or the text's start, to the next one.
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.union1d(offsets[:-1][offsets[:-1] < offsets[1:]], breaks + 1)
    starts = starts[starts < len(data)]
    ends = np.append(starts[1:], len(data))
    ends = ends - ((data[ends - 1] == 0x0A) & (ends > starts))
    word = np.searchsorted(words.start, starts)
    held = np.searchsorted(words.start, ends) > word
    starts, ends = starts[held], ends[held]
    doc = np.searchsorted(offsets, starts, "right") - 1
    lines = Spans(byte_symbols(data)).of(starts, ends)
    _, earliest = np.unique(mix(lines + doc_key[doc]), return_index=True)
    again = np.ones(len(starts), bool)
    again[earliest] = False
    found["n_dup_lines"] = np.bincount(doc[again], minlength=docs)
    total = np.zeros(count + 1, np.int64)
    np.cumsum(word_chars, out=total[1:])
    size = total[np.searchsorted(words.start, ends)] - total[np.searchsorted(words.start, starts)]
    found["n_dup_line_chars"] = np.bincount(doc[again], size[again], docs).astype(np.int64)
    return found


def verdicts(found: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``base_failed`` and ``kept`` of each text."""
    failed = (found["n_words"] < 50) | (100 * found["n_repeat_words"] > 50 * found["n_words"])
    kept = ~failed
    for length, share in MAX_GRAM_PERCENT.items():
        kept &= 100 * found[f"n_dup_{length}gram_chars"] <= share * found["word_chars"]
    kept &= 100 * found["n_dup_line_chars"] <= MAX_LINE_PERCENT * found["word_chars"]
    return failed, kept


def judge(documents: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The counts and verdict of every document.

    Columns: ``doc_id``, the columns in ``keep``, ``n_words``, ``word_chars`` (code points
    in words), ``n_symbols``, ``n_dup_lines`` (lines with a word that equal an earlier
    one), ``n_repeat_words`` (words in three-word windows found again), ``n_dup_line_chars``
    (code points of words in such lines), ``n_dup_Ngram_chars`` for N from 5 to 10 (code
    points of words inside N-grams found again), ``base_failed`` and ``kept``. A text fails
    the base with fewer than 50 words or more than half of its words repeated; it is kept
    if it does not, and no repetition covers more than its share.

    A null or empty text has no words and fails; null and repeated ids are rows like any
    other; an empty table gives an empty result. A text is read whole, whatever its length.
    """
    prepare(documents.sparkSession)
    names = [*COUNTS, *(f"n_dup_{n}gram_chars" for n in MAX_GRAM_PERCENT)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            found = measure(*string_parts(batch.column("_text")))
            failed, kept = verdicts(found)
            kept_columns = ["doc_id", *keep]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept_columns),
                 *(pa.array(found[n].astype(np.int64)) for n in names),
                 pa.array(failed), pa.array(kept)],
                [*kept_columns, *names, "base_failed", "kept"],
            )

    rows = pick(documents, *dict.fromkeys(["doc_id", "text", *keep])).select(
        "doc_id", *keep, text_or_empty().alias("_text")
    )
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    schema = ", ".join([*fields, *(f"{n} long" for n in names), "base_failed boolean, kept boolean"])
    return rows.mapInArrow(run, schema)
