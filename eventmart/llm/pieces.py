"""Texts cut as byte-level tokenizers cut them, and the ids of pieces seen before, in arrays."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import numpy as np

from eventmart.llm.common import mix

WORDS = 3  # of eight bytes; longer pieces are not remembered
PADDING = 8 * WORDS
IDS_A_PIECE = 8
END, BLANK, LETTER, NUMBER, SIGN = range(5)

_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_WEIGHTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _classes() -> np.ndarray:
    """The class of each common character; of the others END.

    Common are line breaks, spaces, and letters, numbers, marks and signs of which Unicode
    has said the same since version 3.2, whatever the version the tokenizer library knows.
    """
    old, new = unicodedata.ucd_3_2_0.category, unicodedata.category
    of = {"L": LETTER, "N": NUMBER, "P": SIGN, "S": SIGN, "M": SIGN}
    found = np.zeros(1 << 16, np.uint8)
    found[[0x0A, 0x20]] = BLANK
    for code in range(0x21, 1 << 16):
        kind = new(chr(code))[0]
        if kind in of and old(chr(code))[0] == kind:
            found[code] = of[kind]
    return found


def _ranges(codes: np.ndarray) -> str:
    """Characters as ranges for a pattern."""
    edge = np.flatnonzero(np.diff(codes) > 1)
    ranges = zip(codes[np.append(0, edge + 1)], codes[np.append(edge, -1)])
    return "".join(f"\\u{first:04x}-\\u{last:04x}" for first, last in ranges)


CLASS = _classes()
is_common = re.compile(f"[{_ranges(np.flatnonzero(CLASS))}]*").fullmatch


def stretches(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``begin``, ``begin + 1``, ... of each stretch, one stretch after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + size, size)


def cut_pieces(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces begin and end in texts of common characters (UTF-16), a zero after each.

    The pieces are those of the pattern of byte-level tokenizers,
    ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
    """
    kind = CLASS[chars]
    before, after = np.roll(kind, 1), np.roll(kind, -1)
    before[:1] = END
    spaced = np.roll(chars, 1) == ord(" ")
    spaced[:1] = False
    first = (kind != before) & ~spaced
    # The last blank before other characters is on its own or, if a space, begins their piece.
    first |= (kind == BLANK) & ((before != BLANK) | (after > BLANK))
    first |= kind == END
    quote = np.flatnonzero(chars == ord("'"))
    quote = quote[first[quote]]
    one = chars[quote + 1]
    two = chars[np.minimum(quote + 2, len(chars) - 1)]
    single = np.isin(one, [ord(c) for c in "stmd"])
    double = (one == ord("l")) & (two == ord("l"))
    double |= ((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))
    first[quote[single | double] + 1] = False
    first[quote[single] + 2] = True
    first[quote[double] + 3] = True
    begin = np.flatnonzero(first)
    end = np.append(begin[1:], len(chars))
    inside = kind[begin] != END
    return begin[inside], end[inside]


class PieceMemory:
    """The ids of pieces of up to ``PADDING`` bytes, in a hash table with open addresses.

    Keys are the bytes themselves, padded with zeros, which no common character holds; entry
    0 is no piece's. When the table is full, pieces met again since the last time stay.
    """

    def __init__(self, limit: int):
        self.limit, self.shift = limit, np.uint64(64 - (2 * limit).bit_length())
        self._clear()

    def _clear(self) -> None:
        # Pages of zeros take no memory before they are written to.
        self.slots = np.zeros(1 << (64 - int(self.shift)), np.int32)
        self.keys = np.zeros((WORDS, self.limit + 1), np.uint64)
        self.begin = np.zeros(self.limit + 1, np.int64)
        self.size = np.zeros(self.limit + 1, np.int64)
        self.again = np.zeros(self.limit + 1, bool)
        self.ids = np.zeros(self.limit * IDS_A_PIECE, np.uint32)
        self.count = self.end = 0

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return mix(sum(words * weight for words, weight in zip(keys, _WEIGHTS)))

    def find(self, keys: np.ndarray, hashed: np.ndarray) -> np.ndarray:
        """The entries of keys, 0 for those not known."""
        found = np.zeros(len(hashed), np.int64)
        left, slot = np.arange(len(hashed)), (hashed >> self.shift).astype(np.int64)
        while len(left):
            entry = self.slots[slot]
            same = entry > 0
            other = same.copy()
            for words, own in zip(self.keys, keys):
                same &= words[entry] == own
            found[left[same]] = entry[same]
            other &= ~same
            left, keys = left[other], keys[:, other]
            slot = (slot[other] + 1) & (len(self.slots) - 1)
        return found

    def put(self, keys: np.ndarray, hashed: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        """New entries; their ids lie in ``ids`` already."""
        entry = np.arange(self.count + 1, self.count + 1 + len(hashed))
        self.count += len(hashed)
        self.keys[:, entry], self.begin[entry], self.size[entry] = keys, begin, size
        slot = (hashed >> self.shift).astype(np.int64)
        while len(entry):
            free = self.slots[slot] == 0
            self.slots[slot[free]] = entry[free]
            other = self.slots[slot] != entry  # of several at one slot the last has got it
            entry, slot = entry[other], (slot[other] + 1) & (len(self.slots) - 1)

    def append(self, ids: np.ndarray) -> int:
        """Lay ids behind those of the entries; returns where. They stay if ``end`` is moved."""
        if self.end + len(ids) > len(self.ids):
            more = np.zeros(self.end + 2 * len(ids), np.uint32)
            more[: self.end] = self.ids[: self.end]
            self.ids = more
        self.ids[self.end : self.end + len(ids)] = ids
        return self.end

    def make_room(self) -> None:
        usual = self.limit * IDS_A_PIECE
        if self.count < self.limit and self.end < usual == len(self.ids):
            return
        kept = np.flatnonzero(self.again)[: self.limit // 2]
        keys, size = self.keys[:, kept], self.size[kept]
        ids = self.ids[stretches(self.begin[kept], size)]
        self._clear()
        if len(ids) <= usual // 2:
            self.put(keys, self._hash(keys), self.append(ids) + np.cumsum(size) - size, size)
            self.end += len(ids)

    def encode(
        self, data: np.ndarray, begin: np.ndarray, size: np.ndarray, merge: Callable
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, one after the other, and the number of each piece's ids.

        ``data`` holds the bytes of the texts and ``PADDING`` more. ``merge`` takes
        data, begin and size of new pieces and gives what this function gives.
        """
        self.make_room()
        view = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
        keys = np.zeros((WORDS, len(begin)), np.uint64)
        for word, column in enumerate(keys):
            at = np.flatnonzero(size > 8 * word)
            part = np.minimum(size[at] - 8 * word, 8)
            column[at] = view[begin[at] + 8 * word] & _LOW_BYTES[part]
        hashed = self._hash(keys)
        short = size <= PADDING
        entry = self.find(keys, hashed)
        entry[~short] = 0
        self.again[entry] = True
        self.again[0] = False
        place, length = self.begin[entry], self.size[entry]
        missing = np.flatnonzero((entry == 0) & short)
        missing = missing[np.argsort(hashed[missing])]
        new = np.ones(len(missing), bool)
        new[1:] = (keys[:, missing[1:]] != keys[:, missing[:-1]]).any(axis=0)
        long = np.flatnonzero(~short)
        to_merge = np.concatenate([missing[new], long])
        if len(to_merge):
            ids, number = merge(data, begin[to_merge], size[to_merge])
            start = self.append(ids) + np.cumsum(number) - number
            which = np.cumsum(new) - 1
            place[missing], length[missing] = start[which], number[which]
            place[long], length[long] = start[new.sum() :], number[new.sum() :]
            room = min(new.sum(), self.limit - self.count)
            kept = to_merge[:room]
            self.put(keys[:, kept], hashed[kept], start[:room], number[:room])
            self.end += number[:room].sum()
        return self.ids[stretches(place, length)], length
