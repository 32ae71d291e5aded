"""Encoding against the tiktoken library, decoding by round trip."""

import random

import public_tokenizers
import pytest
import tiktoken
from cases import documents  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from eventmart.llm import bpe
from eventmart.llm.bpe import RankQueue, encode_decode, load_encoder

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ENCODER = load_encoder(PATH, public_tokenizers.PATTERN)
EXPECTED = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ENCODER.ranks, special_tokens={}
)
ODD = [
    "", " ", "  ", "\n", " a", "a  b", "a \n b", "a\n\n b\t c ", "it's they'll 've 'S", "x" * 5000,
    "ab" * 3000 + " " * 700, "日本語 текст éèê ñ ä́", "a\x85b \xa0c \x1c d\x1c e", "  　x",
    "<|endoftext|> 123456 $$$ ### != ", "aaaaaaaaaaab" * 999, "\U0001f600" * 50,
]


def ids(text):
    found = ENCODER.encode(text)
    return [int.from_bytes(found[i : i + 4], "little") for i in range(0, len(found), 4)]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    assert ids(text) == EXPECTED.encode_ordinary(text)
    assert ENCODER.decode(ENCODER.encode(text)) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\tab'sé1#\x1c\x85"), st.characters(codec="utf-8"))))
def test_any_text(text):
    assert ids(text) == EXPECTED.encode_ordinary(text)


def test_long_pieces_of_random_letters():
    letters = random.Random(5)
    for alphabet in ("ab", "etaoin", "abcdefghijklmnopqrstuvwxyz"):
        text = "".join(letters.choice(alphabet) for _ in range(20000))
        assert ids(text) == EXPECTED.encode_ordinary(text)


def test_rank_queue_gives_the_lowest_rank_and_its_leftmost_position():
    queue = RankQueue()
    for rank, position in ((700, 9), (3, 5), (700, 2), (49999, 1), (3, 4), (255, 0), (256, 0)):
        queue.push(rank, position)
    found = []
    while queue.upper:
        found.append(queue.pop())
    assert found == [(3, [4, 5]), (255, [0]), (256, [0]), (700, [2, 9]), (49999, [1])]


def test_only_the_lowest_of_neighbouring_pairs_are_queued(monkeypatch):
    queued = []

    class Counted(RankQueue):
        __slots__ = ()

        def push(self, rank, position):
            queued.append(rank)
            super().push(rank, position)

    monkeypatch.setattr(bpe, "RankQueue", Counted)
    letters = random.Random(6)
    size = 20000
    text = "".join(letters.choice("etaoinshrdlu") for _ in range(size))
    assert ids(text) == EXPECTED.encode_ordinary(text)
    assert len(queued) < size


def test_ranks_in_any_order():
    """Merges of a lower rank than those they are made of, against the definition."""
    draw = random.Random(7)
    for _ in range(300):
        tokens = {bytes([c]) for c in b"abc"}
        for _ in range(draw.randrange(1, 25)):
            tokens.add(draw.choice(sorted(tokens)) + draw.choice(sorted(tokens)))
        order = draw.sample(range(len(tokens)), len(tokens))
        ranks = dict(zip(sorted(tokens), order))
        piece = bytes(draw.choices(b"abc", k=draw.randrange(1, 30)))
        parts = [piece] if piece in ranks else [bytes([c]) for c in piece]
        while True:
            pairs = [(ranks.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, i = min(pairs, default=(1 << 40, 0))
            if rank == 1 << 40:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert bpe.Encoder(ranks, r"\S+").merge(piece) == [ranks[part] for part in parts]


def test_rows(documents):
    rows = [(1, "a b"), (1, "a b"), (None, None), (2, ""), (3, "long " * 9000)]
    coded = encode_decode(documents(rows), PATH, public_tokenizers.PATTERN)
    assert coded.columns == ["doc_id", "ids", "decoded"]
    found = sorted((str(r[0]), len(r[1]), bytes(r[2]).decode()) for r in coded.collect())
    assert found == sorted((str(i), len(ids(t or "")) * 4, t or "") for i, t in rows)
    assert encode_decode(documents([]), PATH, public_tokenizers.PATTERN).count() == 0


def test_what_is_remembered_changes_no_ids(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 25)
    encoder = bpe.Encoder(ENCODER.ranks, public_tokenizers.PATTERN)
    draw = random.Random(4)
    words = ["".join(draw.choices("etaoinshrdlu", k=draw.randrange(1, 14))) for _ in range(300)]
    for _ in range(60):
        text = " ".join(draw.choices([*words, "a-b", "x\ny", "!?"], k=30))
        found = encoder.encode(text)
        ids_ = [int.from_bytes(found[i : i + 4], "little") for i in range(0, len(found), 4)]
        assert ids_ == EXPECTED.encode_ordinary(text)
    assert encoder.parts.older and encoder.parts.older_pieces


def test_columns_of_clashing_names(documents):
    table = documents(["one two", None]).selectExpr("*", "1 AS ids", "2 AS `Text`", "3 AS decoded", "4 AS DOC_ID")
    found = encode_decode(table, PATH, public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id, bytes(r.decoded)) for r in found) == [(0, b"one two"), (1, b"")]
