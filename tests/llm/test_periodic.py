"""Periodic runs against all periods one by one."""

import random

import numpy as np
import pytest
from cases import documents, rows  # noqa: F401

from eventmart.llm import periodic


def every_run(words, min_length, repeats):
    for period in range(1, len(words) // repeats + 1):
        i = 0
        while i + period < len(words):
            start = i
            while i + period < len(words) and words[i] == words[i + period]:
                i += 1
            end = i + period
            if end - start >= max(min_length, repeats * period) and not any(
                words[start : end - p] == words[start + p : end] for p in range(1, period)
            ):
                yield start, end - start, period
            i += 1


def drawn(draw, size):
    words = []
    while len(words) < size:
        if draw.random() < 0.4:
            words += draw.choices(range(draw.choice([2, 3, 50])), k=draw.randrange(1, 40))
        else:
            period = draw.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 33, 64, 100])
            stretch = draw.choices(range(draw.choice([1, 2, 40])), k=period) * draw.randrange(2, 9)
            words += stretch[: draw.randrange(10, 500)]
    return words


@pytest.mark.parametrize("longest", [32, 1 << 19])
def test_runs(monkeypatch, longest):
    monkeypatch.setattr(periodic, "LONGEST_BLOCK", longest)
    draw = random.Random(1)
    for _ in range(60):
        texts = [drawn(draw, draw.choice([0, 10, 60, 400, 900])) for _ in range(draw.randrange(1, 6))]
        least = draw.choice([3, 5, 24, 40])
        offsets = np.concatenate([[0], np.cumsum([len(words) for words in texts])])
        ids = np.array([x for words in texts for x in words], np.int64)
        expected = [(d, *run) for d, words in enumerate(texts) for run in every_run(words, least, 3)]
        assert periodic.find_runs(ids, offsets, least, 3) == sorted(expected)


def test_two_repeats_are_no_run():
    with pytest.raises(ValueError):
        periodic.find_runs(np.zeros(9, np.int64), np.array([0, 9]), 3, 2)


@pytest.mark.parametrize("size", [2, 16, 128, 512, 4096])
def test_transform_is_exact(size):
    draw = np.random.default_rng(size)
    left, right = draw.integers(0, 200, (2, size // 2))
    padded = np.zeros((2, size))
    padded[0, : size // 2], padded[1, : size // 2] = left, right
    spectrum = periodic.transform(padded)
    product = periodic.transform(periodic.residue(spectrum[:1] * spectrum[1:]))[0]
    product = periodic.residue(product[-np.arange(size)] * pow(size, -1, periodic.MODULUS))
    assert product[: size - 1].tolist() == (np.convolve(left, right) % periodic.MODULUS).tolist()


def test_a_long_text_of_one_word():
    assert periodic.find_runs(np.zeros(300_000, np.int64), np.array([0, 300_000])) == [(0, 0, 300_000, 1)]


def test_texts_are_collapsed(spark, documents):
    draw = random.Random(5)
    made = rows() + [(300 + i, "\t".join(f"é{w}" for w in drawn(draw, 300))) for i in range(30)]
    made += [(400, "a " * 30000), (400, "a " * 30000), (401, "a b\n" * 8), (402, "a b\n" * 12)]
    table = documents(made).selectExpr("*", "1 AS runs", "2 AS n_words", "3 AS `TEXT`", "4 AS start")
    found = periodic.collapse_runs(table, keep=("lang",)).collect()
    got = [(r.doc_id, r.lang, r.n_words, [tuple(x) for x in r.runs], r.text) for r in found]
    expected = []
    for doc_id, text in made:
        words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
        # every_run takes too long for the two long texts of one word
        runs = [(0, 30000, 1)] if len(words) == 30000 and len(set(words)) == 1 else (
            [] if len(words) == 30000 else sorted(every_run(words, 24, 3)))
        kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]
        expected.append((doc_id, "en", len(words), runs, " ".join(kept)))
    order = lambda row: (row[0] is None, row[0] or 0, row[4])
    assert sorted(got, key=order) == sorted(expected, key=order)
    assert sum(len(row[3]) for row in got) > 40
    assert periodic.collapse_runs(table.limit(0)).count() == 0
