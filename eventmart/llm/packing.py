"""Packing documents into training sequences: first-fit decreasing in random groups."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventmart.llm.common import mix, pick, prepare, slices, text_or_empty
from eventmart.llm.pieces import PADDING, PieceMemory, cut_pieces, is_common, stretches

DOCS_PER_GROUP, BYTES_PER_GROUP = 4096, 16 << 20
REMEMBERED = 300_000  # parts; a worker keeps the ids of twice as many at most
LONGEST_REMEMBERED = 64
REMEMBERED_PIECES = 1 << 20  # whose ids a worker keeps at most
MERGED_AT_ONCE, LOOKED_UP_AT_ONCE = 256, 1 << 18  # pieces
GROUP_BITS = 24  # bins of a group are numbered below 2**24

# The characters that stand for bytes in a byte-level vocabulary.
_printed = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_others = [byte for byte in range(256) if byte not in _printed]
BYTE_CHARACTERS = np.arange(256, dtype="<u2")
BYTE_CHARACTERS[_others] = 256 + np.arange(len(_others))
NO_TEXT = "\u00ff"  # stands for byte 255, which no text has


class Tournament:
    """Bins of equal capacity; a complete binary tree holds the largest room below a node."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def first_fit(self, size: int) -> int:
        """Take ``size`` from the first bin with that much room; returns the bin."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        room[node] -= size
        found = node - self.leaves
        node //= 2
        while node:
            left, right = room[2 * node], room[2 * node + 1]
            larger = left if left > right else right
            if room[node] == larger:
                break
            room[node] = larger
            node //= 2
        return found


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each size, and its offset there; bins are numbered from 0."""
    order = np.argsort(-sizes, kind="stable")
    tree = Tournament(len(sizes), capacity)
    bins = np.empty(len(sizes), np.int64)
    bins[order] = [tree.first_fit(size) for size in sizes[order].tolist()]
    by_bin = order[np.argsort(bins[order], kind="stable")]
    ends = np.cumsum(sizes[by_bin])
    starts = ends - sizes[by_bin]
    new = np.flatnonzero(np.diff(bins[by_bin], prepend=-1))
    base = np.repeat(starts[new], np.diff(np.append(new, len(by_bin))))
    offsets = np.empty(len(sizes), np.int64)
    offsets[by_bin] = starts - base
    return bins, offsets


class CachedTokenizer:
    """A byte-level tokenizer of the ``tokenizers`` library that remembers parts of texts.

    Texts of common characters are cut into pieces as the library cuts them, and new pieces
    are merged by the library's model: many as one string, with a character between them that
    the model merges with no other.

    In other texts, a space before a character that is not white space always starts a
    pre-token, so a text is the sum of its parts between spaces. The new parts of a batch
    are encoded as one text with a line each: a single line break between other characters
    is a token of its own, so the ids of the parts lie between line breaks. Other parts, and
    texts where a space stands before white space or that hold the string of an added token,
    are encoded on their own.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.in_pieces = _is_byte_level(path)
        self.merger = Tokenizer(self.tokenizer.model)
        self.pieces = PieceMemory(REMEMBERED_PIECES)
        # What is known, and what was known before it grew full; parts with the space before them.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}
        (self.line_break,) = self._ids("\n")

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _whole(self, text: str) -> bytes:
        return np.array(self._ids(text), "<u4").tobytes()

    def _encoded(self, lines: list[str]) -> list[bytes]:
        """The ids of strings, in one go as far as they can share a text."""
        breaks = [_line_breaks(line) for line in lines]
        joined = [line for line, n in zip(lines, breaks) if n is not None]
        ids = np.array(self._ids("\n".join(joined)), "<u4")
        ends = np.append(np.flatnonzero(ids == self.line_break), len(ids))
        last = np.cumsum([n + 1 for n in breaks if n is not None], dtype=np.int64) - 1
        if joined and last[-1] != len(ends) - 1:
            raise ValueError("a line break is not a token of its own in this vocabulary")
        blob, stops = ids.tobytes(), (4 * ends[last]).tolist()
        parts = iter([blob[a:b] for a, b in zip([0, *(x + 4 for x in stops)], stops)])
        return [self._whole(x) if n is None else next(parts) for x, n in zip(lines, breaks)]

    def _merged(
        self, data: np.ndarray, begin: np.ndarray, size: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces of text, one after the other, and the number of each piece's ids."""
        ends = np.cumsum(size + 1)
        data = BYTE_CHARACTERS[data[stretches(begin, size + 1)]]
        data[ends - 1] = ord(NO_TEXT)
        text = data.tobytes().decode("utf-16-le")
        stops = [0, *ends[MERGED_AT_ONCE - 1 : -1 : MERGED_AT_ONCE].tolist(), len(text)]
        parts = [text[a:b] for a, b in zip(stops, stops[1:])]
        found = self.merger.encode_batch_fast(parts, add_special_tokens=False)
        ids = np.concatenate([np.array(part.ids, np.uint32) for part in found])
        inside = ids != self.merger.token_to_id(NO_TEXT)
        return ids[inside], np.diff(np.flatnonzero(~inside), prepend=-1) - 1

    def _encode_in_pieces(self, texts: list[str]) -> list[bytes]:
        joined = "\0".join([*texts, ""])
        chars = np.frombuffer(joined.encode("utf-16-le"), "<u2")
        data = np.frombuffer(joined.encode() + bytes(PADDING), np.uint8)
        begin, end = cut_pieces(chars)
        last = np.searchsorted(begin, np.flatnonzero(chars == 0))
        if len(data) - PADDING > len(chars):  # from characters to bytes
            width = 1 + (chars >= 0x80).astype(np.int64) + (chars >= 0x800)
            place = np.cumsum(width) - width
            begin, end = place[begin], place[end]
        ids, sizes = [], [np.zeros(1, np.int64)]
        for at in range(0, len(begin), LOOKED_UP_AT_ONCE):
            some = slice(at, at + LOOKED_UP_AT_ONCE)
            found = self.pieces.encode(data, begin[some], (end - begin)[some], self._merged)
            ids.append(found[0].astype("<u4").tobytes())
            sizes.append(found[1])
        blob, stops = b"".join(ids), (4 * np.cumsum(np.concatenate(sizes))[last]).tolist()
        return [blob[a:b] for a, b in zip([0, *stops], stops)]

    def encode(self, texts: list[str]) -> list[bytes]:
        common = [
            self.in_pieces and bool(is_common(text)) and not any(x in text for x in self.added)
            for text in texts
        ]
        ways = {True: self._encode_in_pieces, False: self._encode_by_parts}
        found = {
            own: iter(way([text for text, its in zip(texts, common) if its == own]))
            for own, way in ways.items()
            if own in common
        }
        return [next(found[own]) for own in common]

    def _encode_by_parts(self, texts: list[str]) -> list[bytes]:
        special = {i for i, text in enumerate(texts) if any(x in text for x in self.added)}
        cut = [[""] if i in special else text.split(" ") for i, text in enumerate(texts)]
        if len(self.known) >= REMEMBERED:
            self.known, self.older = {}, self.known
        if len(self.heads) >= REMEMBERED:
            self.heads = {}
        known, older, heads = self.known, self.older, self.heads
        new = set().union(*(parts[1:] for parts in cut)).difference(known)
        again = [part for part in new if part in older]
        known.update((part, older[part]) for part in again)
        new.difference_update(again)
        new = [part for part in new if part and not part[0].isspace()]
        known.update(zip(new, self._encoded([" " + part for part in new])))
        begins = list({parts[0] for parts in cut}.difference(heads))
        heads.update(zip(begins, self._encoded(begins)))
        found = []
        for i, (text, parts) in enumerate(zip(texts, cut)):
            try:
                if i in special:
                    found.append(self._whole(text))
                else:
                    found.append(heads[parts[0]] + b"".join(map(known.__getitem__, parts[1:])))
            except KeyError:  # a space before white space or the end
                found.append(self._whole(text))
        _forget_long(new, known)
        _forget_long(begins, heads)
        return found


def _forget_long(new: Iterable[str], known: dict[str, bytes]) -> None:
    for part in new:
        if len(part) > LONGEST_REMEMBERED:
            known.pop(part, None)


def _is_byte_level(path: str) -> bool:
    """Whether the byte-level pattern alone cuts texts, and then the model merges bytes by rank
    alone and ``NO_TEXT`` with nothing."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    cut = spec.get("pre_tokenizer") or {}
    model = spec.get("model") or {}
    options = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
    return (
        model.get("type") == "BPE"
        and not any(model.get(name) for name in options)
        and [token for token in model["vocab"] if NO_TEXT in token] == [NO_TEXT]
        and cut.get("type") == "ByteLevel"
        and cut.get("use_regex", True)
        and not cut.get("add_prefix_space")
        and not any(spec.get(name) for name in ("normalizer", "truncation", "padding"))
    )


def _line_breaks(line: str) -> int | None:
    """How many line breaks a string holds, if they are all its white space but a space
    before it, and each lies between other characters; else None."""
    if len(line.split()) == 1 and not line[-1].isspace() and not line[1:2].isspace():
        return 0 if line[0] == " " or not line[0].isspace() else None
    parts = line.removeprefix(" ").split("\n")
    return len(parts) - 1 if all(part.split() == [part] for part in parts) else None


@cache
def load_tokenizer(path: str) -> CachedTokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker on each core
    return CachedTokenizer(path)


def _cut(path: str, end_id: int, capacity: int, groups: int):
    """Pieces of at most ``capacity`` ids, dealt to random groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(path)
        end = np.array([end_id], "<u4").tobytes()
        width = 4 * capacity
        row = 0
        for batch in slices(batches):
            place, start, pieces, total = [], [], [], []
            for i, ids in enumerate(tokenizer.encode(batch.column("text").to_pylist())):
                ids += end
                for at in range(0, len(ids), width):
                    place.append(i)
                    start.append(at // 4)
                    pieces.append(ids[at : at + width])
                    total.append(len(ids) // 4)
            # The row number keeps copies of one document apart.
            spread = np.array([crc32(piece) for piece in pieces], np.uint64) << np.uint64(32)
            spread = mix(spread + np.arange(row, row + len(place), dtype=np.uint64))
            row += len(place)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(place, pa.int64())),
                 pa.array(start, pa.int64()), pa.array(pieces, pa.binary()),
                 pa.array(total, pa.int64()),
                 pa.array((spread % np.uint64(groups)).astype(np.int64))],
                ["doc_id", "start", "ids", "doc_tokens", "bin_group"],
            )

    return run


def _pack(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        sizes = np.asarray(pc.binary_length(table.column("ids")), np.int64) // 4
        bins, offsets = first_fit_decreasing(sizes, capacity)
        group = table.column("bin_group")[0].as_py()
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "start": table.column("start"),
                "length": sizes,
                "ids": table.column("ids"),
                "doc_tokens": table.column("doc_tokens"),
                "sequence_id": bins + (group << GROUP_BITS),
                "offset": offsets,
            }
        )

    return run


def pack(
    documents: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = 1024
) -> DataFrame:
    """The pieces of all documents and their places in sequences of ``capacity`` ids.

    A document's ids are those of the tokenizer and ``end_id``; it is cut every
    ``capacity`` ids. Columns: ``doc_id``, ``start`` (ids of the document before the
    piece), ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens`` (of the
    whole document), ``sequence_id`` and ``offset`` in the sequence, without gaps from 0.

    Pieces are dealt to random groups of about 4096 documents or 16 MB of text, whichever is
    less; their number grows with the table, and each group is packed by first-fit
    decreasing on its own. A null or empty text is the end id alone; null and repeated ids
    are rows like any other; an empty table gives no pieces; other columns are ignored. A
    very long text is tokenized whole, in memory in proportion to it, and its pieces go to
    many groups. Pieces of equal length take places in the order in which they arrive, so
    the places, not the pieces, may differ from run to run.
    """
    prepare(documents.sparkSession)
    rows = pick(documents, "doc_id", "text").select("doc_id", text_or_empty().alias("text"))
    size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    groups = 1 + max(size.n // DOCS_PER_GROUP, (size.bytes or 0) // BYTES_PER_GROUP)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    pieces = rows.mapInArrow(
        _cut(tokenizer_path, end_id, capacity, groups),
        f"doc_id {id_type}, start long, ids binary, doc_tokens long, bin_group long",
    )
    return pieces.groupBy("bin_group").applyInArrow(
        _pack(capacity),
        f"doc_id {id_type}, start long, length long, ids binary, doc_tokens long, "
        "sequence_id long, offset long",
    )
