"""Packing: pieces, sequences, and ids against the tokenizer on whole texts."""

import json
import random
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
from cases import documents  # noqa: F401
from tokenizers import Tokenizer

from eventmart.llm import packing
from eventmart.llm.packing import Tournament, first_fit_decreasing, pack
from eventmart.llm.pieces import PieceMemory, cut_pieces

PATH = public_tokenizers.path("byte_bpe_50k.json")


def first_fit_by_scan(sizes, capacity):
    room, bins = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        for b, left in enumerate(room):
            if left >= sizes[i]:
                break
        else:
            b = len(room)
            room.append(capacity)
        room[b] -= sizes[i]
        bins[i] = b
    return [bins[i] for i in range(len(sizes))]


def test_bins_equal_those_of_a_scan():
    random = np.random.default_rng(1)
    for count in (1, 2, 3, 50, 700):
        sizes = random.integers(1, 101, count)
        bins, offsets = first_fit_decreasing(sizes, 100)
        assert bins.tolist() == first_fit_by_scan(sizes.tolist(), 100)
        for b in set(bins.tolist()):
            inside = sorted((o, s) for o, s in zip(offsets[bins == b], sizes[bins == b]))
            assert [o for o, _ in inside] == [sum(s for _, s in inside[:i]) for i in range(len(inside))]


def test_tournament_takes_the_first_bin_with_room():
    tree = Tournament(3, 10)
    assert [tree.first_fit(s) for s in (7, 7, 3, 10, 3)] == [0, 1, 0, 2, 1]


def check(rows, found, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    texts = defaultdict(list)
    for i, text in rows:
        texts[i].append(tokenizer.encode(text or "", add_special_tokens=False).ids + [0])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length
        by_doc[r.doc_id].append((r.start, ids))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for i, expected in texts.items():
        if len(expected) == 1:
            assert sum((ids for _, ids in sorted(by_doc[i])), []) == expected[0]
        assert sum(len(ids) for _, ids in by_doc[i]) == sum(map(len, expected))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return by_sequence


def test_rows(documents):
    rows = [(i, f"Some words{i} " * (i % 400)) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "a  <|endoftext|> b\n\n c"), (None, "x y"), (None, "z"),
             (7777, "same"), (7777, "same"), (1003, "q" * 30000), (1004, "\x1c \x85 a 　 b")]
    by_sequence = check(rows, pack(documents(rows), PATH).collect(), 1024)
    total = sum(length for parts in by_sequence.values() for _, length in parts)
    assert len(by_sequence) <= 1.02 * total / 1024 + 1


def test_no_rows(documents):
    assert pack(documents([]), PATH).count() == 0


def test_many_groups(documents, monkeypatch):
    """Groups by the number of documents, and by their bytes."""
    made = [(i, f"text {i} " * (1 + i % 40)) for i in range(300)] + [(999, "long " * 30000)]
    for limits in ((20, 1 << 30), (1 << 30, 5000)):
        for name, limit in zip(("DOCS_PER_GROUP", "BYTES_PER_GROUP"), limits):
            monkeypatch.setattr(packing, name, limit)
        table = documents(made).selectExpr("*", "1 AS start", "2 AS `TEXT`", "3 AS ids", "4 AS bin_group")
        found = pack(table, PATH, capacity=128).collect()
        check(made, found, 128)
        groups = {r.sequence_id >> packing.GROUP_BITS for r in found}
        assert len(groups) > 10


def test_what_is_remembered_changes_no_ids(monkeypatch):
    """More parts than are kept, in many batches, with odd white space in some of them."""
    monkeypatch.setattr(packing, "REMEMBERED", 30)
    tokenizer, plain = packing.CachedTokenizer(PATH), Tokenizer.from_file(PATH)
    draw = random.Random(3)
    words = [f"w{draw.randrange(10**draw.randrange(1, 5))}" for _ in range(400)]
    odd = ["\n", "a\nb", "\t", " ", "", "x\u00a0y", "\u2003", "\n\n", "c\n", "<|endoftext|>", "é" * 80]
    for batch in range(40):
        texts = []
        for _ in range(12):
            parts = draw.choices(words, k=draw.randrange(30))
            texts.append(" ".join(parts + (draw.choices(odd, k=3) if batch % 2 else [])))
        for text, ids in zip(texts, tokenizer.encode(texts)):
            expected = plain.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == expected, text
    assert len(tokenizer.older) > 0


def test_pieces_give_the_ids_of_whole_texts():
    """Every common character beside letters, numbers, signs and white space; contractions."""
    tokenizer, plain = packing.CachedTokenizer(PATH), Tokenizer.from_file(PATH)
    draw = random.Random(5)
    common = [c for c in map(chr, range(0x10000)) if packing.is_common(c)]
    assert len(common) > 40000 and not {"\t", "\x1c", "\u00a0", "\u2003", "\ud800"} & set(common)
    texts = ["".join(f"a{c}1{c}, {c}\n{c}{c} " for c in common[i::400]) for i in range(400)]
    odd = ["'s", "'ll", " '", "'re", "'S", "\n", " ", "  ", "\n\n", "é", "x", "42", "²", "_", "!?", "ß日", "<|"]
    texts += ["".join(draw.choices(odd, k=draw.randrange(25))) for _ in range(3000)]
    for text, ids in zip(texts, tokenizer.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text
    assert not tokenizer.known


def test_known_pieces_are_not_encoded_again():
    tokenizer = packing.CachedTokenizer(PATH)
    tokenizer.encode(["One, two\n\nthree two"])
    expected = Tokenizer.from_file(PATH).encode("One two,\n\nthree, two", add_special_tokens=False).ids
    tokenizer.tokenizer = None
    (ids,) = tokenizer.encode(["One two,\n\nthree, two"])
    assert np.frombuffer(ids, "<u4").tolist() == expected


def test_other_tokenizers_are_not_cut_into_pieces(tmp_path):
    spec = json.loads(open(PATH, encoding="utf-8").read())
    spec["normalizer"] = {"type": "Lowercase"}
    (tmp_path / "lower.json").write_text(json.dumps(spec), encoding="utf-8")
    (ids,) = packing.CachedTokenizer(str(tmp_path / "lower.json")).encode(["Some WORDS"])
    expected = Tokenizer.from_file(PATH).encode("some words", add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == expected


def encoded(tokenizer, texts):
    return [np.frombuffer(ids, "<u4").tolist() for ids in tokenizer.encode(texts)]


def expected_ids(texts):
    plain = Tokenizer.from_file(PATH)
    return [plain.encode(text, add_special_tokens=False).ids for text in texts]


def test_new_pieces_are_merged_many_at_a_time():
    """Finding of round 3: a call for each new piece took half of the time."""
    texts = [" ".join(f"word{n}x{i}" for n in range(100)) for i in range(50)]
    tokenizer = packing.CachedTokenizer(PATH)
    library, sent = tokenizer.merger, []

    class Counted:
        def encode_batch_fast(self, parts, **options):
            sent.extend(parts)
            return library.encode_batch_fast(parts, **options)

        def token_to_id(self, token):
            return library.token_to_id(token)

    tokenizer.merger = Counted()
    assert encoded(tokenizer, texts) == expected_ids(texts)
    assert 0 < len(sent) < 20
    assert encoded(tokenizer, texts[::-1]) == expected_ids(texts[::-1])
    assert len(sent) < 20


def test_pieces_are_remembered_in_little_room(monkeypatch):
    """More pieces than are kept, long ones among them, few looked up and merged at once."""
    monkeypatch.setattr(packing, "REMEMBERED_PIECES", 30)
    monkeypatch.setattr(packing, "LOOKED_UP_AT_ONCE", 7)
    monkeypatch.setattr(packing, "MERGED_AT_ONCE", 3)
    tokenizer, draw = packing.CachedTokenizer(PATH), random.Random(8)
    edge = ["q" * n for n in (22, 23, 24, 25, 26, 40)] + ["ж" * 11 + "a", "ж" * 12, "日" * 8, "日" * 9]
    words = edge + [f"{'ab'[i % 2]}{'é' * (i % 5)}w{i}" for i in range(60)] + ["the", "of", "it's", "'", "''ll", "\n"]
    cleared = 0
    for _ in range(60):
        texts = ["", " ".join(draw.choices(words, k=draw.randrange(40))), "of the", "x" * draw.randrange(400)]
        before = tokenizer.pieces.count
        assert encoded(tokenizer, texts) == expected_ids(texts), texts
        cleared += tokenizer.pieces.count < before
        assert tokenizer.pieces.count <= 30
    assert cleared > 3


def test_pieces_at_one_place_of_the_table():
    memory = PieceMemory(100)
    keys = np.zeros((3, 90), np.uint64)
    keys[1] = np.arange(1, 91)
    hashed, size = np.full(90, 2**64 - 1, np.uint64), np.arange(90)
    memory.put(keys, hashed, np.arange(90), size)
    found = memory.find(keys[:, ::-1], hashed)
    assert memory.size[found].tolist() == size[::-1].tolist()
    assert memory.find(keys + np.uint64(90), hashed).tolist() == [0] * 90


def test_cuts_equal_those_of_the_pattern():
    letter, number = "a-zé日", "0-9²"
    pattern = re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^ \n{letter}{number}]+"
        r"|[ \n]+(?![^ \n])|[ \n]+"
    )
    draw = random.Random(9)
    texts = ["".join(draw.choices("''srevmldté日4²  \n\n.!", k=draw.randrange(30))) for _ in range(5000)]
    chars = np.frombuffer("\0".join([*texts, ""]).encode("utf-16-le"), "<u2")
    begin, end = cut_pieces(chars)
    found = [chars[a:b].tobytes().decode("utf-16-le") for a, b in zip(begin, end)]
    assert found == [piece for text in texts for piece in pattern.findall(text)]


def test_vocabularies_that_merge_the_parting_character_are_not_cut(tmp_path):
    spec = json.loads(open(PATH, encoding="utf-8").read())
    spec["model"]["vocab"]["Ġÿ"] = 50257
    (tmp_path / "other.json").write_text(json.dumps(spec), encoding="utf-8")
    tokenizer = packing.CachedTokenizer(str(tmp_path / "other.json"))
    assert encoded(tokenizer, ["a few words"]) == expected_ids(["a few words"])
    assert not tokenizer.pieces.count and tokenizer.known
