"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from eventmart.llm.common import pick, prepare, slices, text_or_empty

LEAF = 8  # bits of a rank that index into one word of the lower bitmap level
MASK = (1 << LEAF) - 1
REMEMBERED = 300_000  # parts, and pieces; a worker keeps the ids of twice as many at most
LONGEST_REMEMBERED = 64
NO_RANK = 1 << 40  # of a pair that is no token; above every rank


class RankQueue:
    """Positions by merge rank; the lowest rank is found by two find-first-set steps.

    The upper bitmap marks the words of the lower one that are not zero, and a lower word
    marks the ranks whose bucket holds positions. Entries are not removed when a merge
    makes them stale; the reader skips them.
    """

    __slots__ = ("upper", "lower", "buckets")

    def __init__(self):
        self.upper = 0
        self.lower: dict[int, int] = {}
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [position]
            word = rank >> LEAF
            self.lower[word] = self.lower.get(word, 0) | 1 << (rank & MASK)
            self.upper |= 1 << word
        else:
            bucket.append(position)

    def pop(self) -> tuple[int, list[int]]:
        """The lowest rank and its positions from left to right; not for an empty queue."""
        upper = self.upper
        word = (upper & -upper).bit_length() - 1
        bits = self.lower[word]
        rest = self.lower[word] = bits & (bits - 1)
        if not rest:
            self.upper = upper & (upper - 1)
        rank = word << LEAF | ((bits & -bits).bit_length() - 1)
        positions = self.buckets.pop(rank)
        if len(positions) > 1:
            positions.sort()
        return rank, positions


class LooseSpace(Exception):
    """A space before white space or the end: the text can't simply be cut at spaces."""


class PieceIds(dict):
    """Ids (little-endian unsigned 32-bit) of a space and the part of a text up to the next.

    A space before a character that is not white space always starts a piece, so a text is
    the sum of its parts. Parts are remembered, and what they are made of too: most are a
    word and perhaps signs, which are one piece each.
    """

    def __init__(self, pattern: str, encode_piece: Callable[[str], bytes]):
        super().__init__()
        self.find = regex.compile(pattern).findall
        self.encode_piece = encode_piece
        self.pieces: dict[str, bytes] = {}
        # What was remembered before the last clearing; frequent entries come back from it.
        self.older: dict[str, bytes] = {}
        self.older_pieces: dict[str, bytes] = {}

    def piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            found = self.older_pieces.get(piece) or self.encode_piece(piece)
            if len(piece) <= LONGEST_REMEMBERED:
                self.remember_piece(piece, found)
        return found

    def remember_piece(self, piece: str, ids: bytes) -> None:
        if len(self.pieces) >= REMEMBERED:
            self.older_pieces, self.pieces = self.pieces, {}
        self.pieces[piece] = ids

    def split(self, text: str) -> list[str]:
        """The pieces of a text; letters and then signs are told without the pattern."""
        simple = _word_and_signs(text)
        if simple is None:
            return self.find(text)
        word, signs = simple.groups()
        return [word, signs] if signs else [word]

    def remember_part(self, part: str, ids: bytes) -> None:
        if len(part) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[part] = ids

    def __missing__(self, part: str) -> bytes:
        if not part or part[0].isspace():
            raise LooseSpace
        found = self.older.get(part) or b"".join(map(self.piece, self.split(" " + part)))
        self.remember_part(part, found)
        return found

    def encode(self, text: str) -> bytes:
        return self.encode_parts(text.split(" "))

    def encode_parts(self, parts: list[str]) -> bytes:
        """The ids of a text that was cut at its spaces."""
        try:
            first = b"".join(map(self.piece, self.split(parts[0]))) if parts[0] else b""
            return first + b"".join(map(self.__getitem__, parts[1:]))
        except LooseSpace:
            return b"".join(map(self.piece, self.find(" ".join(parts))))


# Pieces of the pattern that such a text has whatever the letters are.
_word_and_signs = regex.compile(r"( ?\p{L}+)([^\s\p{L}\p{N}]*)").fullmatch


class Encoder:
    """Ids of texts by merge ranks; ``pattern`` cuts a text into pieces that never merge."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.parts = PieceIds(pattern, self._piece_ids)
        self.encode = self.parts.encode

    def _piece_ids(self, piece: str) -> bytes:
        return np.array(self.merge(piece.encode()), "<u4").tobytes()

    def merge(self, piece: bytes) -> list[int]:
        """Merge the adjacent pair of lowest rank, the leftmost first, until none is left.

        ``end[i]`` and ``before[i]`` link the tokens that are left, by their first bytes. Only
        pairs that rank no higher than both neighbours are queued: the lowest is one of them,
        and any other has to wait until a neighbour is gone.
        """
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        rank_of = ranks.get
        size = len(piece)
        queue = RankQueue()
        push, pop = queue.push, queue.pop
        end = list(range(1, size + 1))
        before = list(range(-1, size))
        # With the successor; two more for the last token and for what is beyond both ends.
        pair = [rank_of(piece[i : i + 2], NO_RANK) for i in range(size - 1)]
        pair += NO_RANK, NO_RANK
        for i in range(size - 1):
            rank = pair[i]
            if rank <= pair[i + 1] and rank <= pair[i - 1] and rank < NO_RANK:
                push(rank, i)
        while queue.upper:
            rank, positions = pop()
            for place, i in enumerate(positions):
                if pair[i] != rank:
                    continue  # stale
                middle = end[i]
                stop = end[i] = end[middle]
                before[stop] = i
                gone, pair[middle] = pair[middle], NO_RANK
                right = pair[stop]
                lowest = new = pair[i] = (
                    rank_of(piece[i : end[stop]], NO_RANK) if stop < size else NO_RANK
                )
                new_left = NO_RANK
                left = before[i]
                if left >= 0:
                    was = pair[left]
                    new_left = pair[left] = rank_of(piece[left:stop], NO_RANK)
                    if new_left < new:
                        lowest = new_left
                    far = before[left]
                    beyond = pair[far]
                    if new_left <= new and new_left <= beyond and new_left < NO_RANK:
                        push(new_left, left)
                    if was < beyond <= new_left and beyond < NO_RANK and beyond <= pair[before[far]]:
                        push(beyond, far)
                if new <= new_left and new <= right and new < NO_RANK:
                    push(new, i)
                if gone < right <= new and right < NO_RANK and right <= pair[end[stop]]:
                    push(right, stop)
                if lowest < rank:  # the rest of the bucket waits for the lower rank
                    for later in positions[place + 1 :]:
                        push(rank, later)
                    break
        ids, i = [], 0
        while i < size:
            ids.append(ranks[piece[i : end[i]]])
            i = end[i]
        return ids

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@cache
def load_encoder(path: str, pattern: str) -> Encoder:
    """An encoder from a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return Encoder(ranks, pattern)


def encode_decode(documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``ids`` (little-endian unsigned 32-bit integers) and ``decoded`` (bytes).

    A null text counts as an empty one, which has no ids; null and repeated ids are rows
    like any other, and equal texts get equal ids; an empty table gives an empty one; other
    columns are ignored. A very long text is encoded whole, by itself, in memory in
    proportion to it; a very long piece of it takes time in proportion to its length.
    ``ranks_path`` must exist on every worker.
    """
    prepare(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder(ranks_path, pattern)
        for batch in slices(batches):
            ids = [encoder.encode(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()),
                 pa.array(list(map(encoder.decode, ids)), pa.binary())],
                ["doc_id", "ids", "decoded"],
            )

    rows = pick(documents, "doc_id", "text").select("doc_id", text_or_empty().alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, ids binary, decoded binary")
