"""Quality, line dedup, suffix dedup, substring dedup and the Jaccard join against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from cases import WORDS, documents, rows  # noqa: F401

from eventmart.llm import jaccard, lines, quality, suffixes, factors, windows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ROWS = rows()


@pytest.fixture(scope="module")
def docs(spark, documents):
    """With columns whose names could be taken for the operators' own."""
    table = documents(ROWS).selectExpr(
        "*", "1 AS variant", "2 AS k", "3 AS spans", "4 AS `TEXT`", "5 AS n_words", "6 AS _text"
    )
    return table


@pytest.fixture(scope="module")
def none(documents):
    return documents([])


def sha(data):
    return hashlib.sha256(data).hexdigest()


def found(frame, *columns):
    return Counter(tuple(bytes(x) if isinstance(x, bytearray) else x for x in r)
                   for r in frame.select(*columns).collect())


# -- quality -----------------------------------------------------------------------


def again(words, n):
    """Which words lie in an n-gram that occurs twice or more."""
    grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
    count = Counter(grams)
    inside = [False] * len(words)
    for i, gram in enumerate(grams):
        if count[gram] > 1:
            inside[i : i + n] = [True] * n
    return inside


def judged(text):
    words = WORD.findall(text or "")
    chars = sum(map(len, words))
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    seen, dup_lines, dup_chars = set(), 0, 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            if line in seen:
                dup_lines += 1
                dup_chars += sum(map(len, WORD.findall(line)))
            seen.add(line)
    repeated = sum(again(words, 3))
    failed = len(words) < 50 or 100 * repeated > 50 * len(words)
    kept = not failed and 100 * dup_chars <= 30 * chars
    for n in range(5, 11):
        share = sum(len(w) for w, x in zip(words, again(words, n)) if x)
        kept = kept and 100 * share <= 30 * chars
    return len(words), chars, symbols, dup_lines, repeated, failed, kept


def test_quality(docs, none):
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
               "base_failed", "kept"]
    assert found(quality.judge(docs), *columns) == Counter((i, *judged(t)) for i, t in ROWS)
    assert quality.judge(none).count() == 0


def test_quality_of_repeated_lines_and_symbols(documents):
    base = rows()[5][1] + " " + rows()[7][1]
    texts = ["a b c\n" * 30 + base, "# $ < > | & % * x\n\nx\nx \nx", base + "\n" + base, base * 3]
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
               "kept"]
    assert found(quality.judge(documents(texts)), *columns) == Counter(map(judged, texts))


# -- lines -------------------------------------------------------------------------


def key_of(line):
    return line.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)})


def cleaned(rows, min_docs):
    count = Counter(key for _, t in rows for key in {key_of(x) for x in (t or "").split("\n")})
    for i, text in rows:
        parts = (text or "").split("\n")
        kept = [x for x in parts if not key_of(x) or count[key_of(x)] < min_docs]
        yield i, len(parts), len(parts) - len(kept), "\n".join(kept)


def test_line_dedup(docs, none):
    for min_docs in (2, 10):
        result = lines.drop_frequent_lines(docs, min_docs, keep=("source",))
        assert result.columns == ["doc_id", "source", "text", "n_lines", "n_dropped"]
        expected = Counter(cleaned(ROWS, min_docs))
        assert found(result, "doc_id", "n_lines", "n_dropped", "text") == expected
    assert lines.drop_frequent_lines(none).count() == 0


def test_deleted_documents_leave_the_line_index_as_it_was(spark, documents):
    first, second = documents(ROWS[:50]), documents(ROWS[50:])
    index = lines.LineIndex(spark, 5, min_docs=2).insert(first)
    before = found(index.counts(), "k1", "k2", "docs")
    both = found(index.insert(second).counts(), "k1", "k2", "docs")
    assert both == found(lines.LineIndex(spark, 3).insert(documents(ROWS)).counts(), "k1", "k2", "docs")
    assert found(index.delete(second).counts(), "k1", "k2", "docs") == before
    assert index.delete(first).counts().count() == 0


def test_the_index_asks_its_filter(monkeypatch):
    """Keys that the filter does not hold are not looked up; those it holds are added to."""
    import pandas as pd

    asked = []
    may_hold = lines.CuckooFilter.may_hold

    def watched(self, k1, k2):
        answer = may_hold(self, k1, k2)
        asked.append(int(answer.sum()))
        return answer

    monkeypatch.setattr(lines.CuckooFilter, "may_hold", watched)
    keys = [lines.digest(b"%d" % i) for i in range(3000)]

    def change(part, docs):
        return pd.DataFrame([(0, *key, docs) for key in part], columns=["shard", "k1", "k2", "docs"])

    state = pd.DataFrame({"shard": [], "k1": [], "k2": [], "docs": [], "filter": []})
    for part, docs in ((keys[:2000], 2), (keys[1500:], 3), (keys[:100], -2)):
        state = lines._merge(state, change(part, docs))
    counts = state[state["filter"].isna()]
    left = {(r.k1, r.k2): r.docs for r in counts.itertuples()}
    expected = {key: 2 * (i < 2000) + 3 * (i >= 1500) for i, key in enumerate(keys) if i >= 100}
    assert left == expected
    assert asked[0] == 0 and 500 <= asked[1] <= 520 and asked[2] == 100


def test_cuckoo_filter_holds_what_was_added():
    import numpy as np

    keys = [lines.digest(b"%d" % i) for i in range(5000)]
    table = lines.CuckooFilter.of(keys)
    k1, k2 = (np.array(x) for x in zip(*keys))
    assert table.may_hold(k1, k2).all()
    for key in keys[:2500]:
        table.remove(key)
    assert table.may_hold(k1[2500:], k2[2500:]).all()
    others = [lines.digest(b"x%d" % i) for i in range(5000)]
    assert table.may_hold(*(np.array(x) for x in zip(*others))).sum() < 50


# -- repeated windows --------------------------------------------------------------


def order(row):
    """Nulls first; texts of one id by the hash that the operator orders them by."""
    return (row[0] is not None, row[0] or 0)


def without_later(rows, size):
    """Rows of one id must have one text, or texts that share no string of ``size`` bytes."""
    seen = {}
    for i, text in sorted(set(rows), key=order):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - size + 1):
            if seen.setdefault(data[s : s + size], (i, text, s)) != (i, text, s):
                gone[s : s + size] = b"\x01" * size
        kept = bytes(x for x, g in zip(data, gone) if not g)
        yield (i, text), (len(data), sum(gone), len(re.findall(b"\x01+", bytes(gone))), kept)


def without_repeats(rows, size):
    count = Counter()
    for _, text in rows:
        words = WORD.findall(text or "")
        count.update(tuple(words[s : s + size]) for s in range(len(words) - size + 1))
    for i, text in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for s in range(len(words) - size + 1):
            if count[tuple(words[s : s + size])] > 1:
                gone[s : s + size] = [True] * size
        yield i, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)


@pytest.fixture(params=["as it is", "all anchors heavy"])
def heavy(request, monkeypatch):
    if request.param != "as it is":
        monkeypatch.setattr(windows, "HEAVY", 1e-9)
        monkeypatch.setattr(windows, "HEAVY_LEAST", 2)
        monkeypatch.setattr(windows, "CHUNK_RUNS", 300)


@pytest.mark.parametrize("size", [100, 20])
def test_suffix_dedup(docs, none, heavy, size):
    expected = dict(without_later(ROWS, size))
    result = suffixes.remove_repeats(docs, size)
    assert found(result, "doc_id", "n_bytes", "n_removed", "n_spans", "kept") == Counter(
        (row[0], *expected[row]) for row in ROWS
    )
    assert suffixes.remove_repeats(none, size).count() == 0


def shifted(words):
    """Texts that share stretches of a long passage, at other places and to other ends."""
    draw = random.Random(12)
    line = [draw.choice(WORDS) for _ in range(words)]
    made = []
    for i in range(14):
        first, last = sorted(draw.sample(range(words + 1), 2))
        made.append((i, " ".join([f"begin{i}", *line[first:last], f"end{i}", *line[:i]])))
    return made


@pytest.mark.parametrize("window", [384, 600])
def test_long_windows_of_bytes(documents, window):
    made = shifted(700)
    expected = dict(without_later(made, window))
    result = suffixes.remove_repeats(documents(made), window)
    assert found(result, "doc_id", "n_bytes", "n_removed", "n_spans", "kept") == Counter(
        (row[0], *expected[row]) for row in made
    )


@pytest.mark.parametrize("window", [340, 400])
def test_long_windows_of_words(documents, window):
    made = shifted(2500)
    result = factors.remove_repeats(documents(made), window)
    expected = Counter(without_repeats(made, window))
    assert found(result, "doc_id", "n_words", "n_removed", "text") == expected


def test_suffix_dedup_as_text_drops_whole_characters(documents):
    texts = ["é" * 60 + "ab" + "ü" * 60, "x" + "é" * 59 + "yé" + "é" * 60]
    kept = found(suffixes.remove_repeats(documents(texts), 100, as_text=True), "doc_id", "text")
    for (i, text), (size, gone, _, left) in without_later(list(enumerate(texts)), 100):
        assert kept[(i, left.decode(errors="ignore"))] or gone


@pytest.mark.parametrize("size", [35, 6])
def test_substring_dedup(docs, none, heavy, size):
    expected = Counter(without_repeats(ROWS, size))
    result = factors.remove_repeats(docs, size)
    assert found(result, "doc_id", "n_words", "n_removed", "text") == expected
    assert factors.remove_repeats(none, size).count() == 0


def test_radix_groups_are_the_equal_windows():
    import numpy as np

    data = np.frombuffer(b"abcabdabcabcab" * 40 + b"xyz" * 50, np.uint8)
    starts = np.arange(len(data) - 30)
    live, group = suffixes.radix_groups(data, starts, np.zeros(len(starts), int), 30)
    whole = data.tobytes()
    count = Counter(whole[s : s + 30] for s in starts)
    assert sorted(live) == [s for s in starts if count[whole[s : s + 30]] > 1]
    assert len({(g, whole[s : s + 30]) for s, g in zip(live, group)}) == len(set(group))


# -- near duplicates ---------------------------------------------------------------


def least(ids):
    return min((i for i in ids if i is not None), default=None)


def groups(rows, n=5, percent=80):
    """Of each connected group the copies of its texts, and per text its links."""
    copies = defaultdict(list)
    for i, text in rows:
        copies[tuple(WORD.findall(text or ""))].append(i)
    wordless = copies.pop((), [])
    keys = list(copies)
    sets = [{key[i : i + n] for i in range(max(1, len(key) - n + 1))} for key in keys]
    links = defaultdict(set)
    for a in range(len(keys)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                links[a].add(b)
                links[b].add(a)
    left, found = set(range(len(keys))), []
    while left:
        group, todo = set(), [left.pop()]
        while todo:
            group.add(text := todo.pop())
            todo += links[text] - group
        left -= group
        found.append([(copies[keys[x]], len(links[x])) for x in group])
    return found, wordless


def classes(rows):
    found, wordless = groups(rows)
    for group in found:
        head = least([i for ids, _ in group for i in ids])
        for ids, links in group:
            yield from ((i, head, least(ids), len(ids), links) for i in ids)
    yield from ((i, i, i, 1, 0) for i in wordless)


def test_jaccard_join(docs, none):
    result = jaccard.JaccardJoin(docs).classified()
    columns = ["doc_id", "class_id", "text_id", "n_copies", "n_links"]
    assert result.columns == columns
    assert found(result, *columns) == Counter(classes(ROWS))
    assert jaccard.JaccardJoin(none).classified().count() == 0


def near_copies(count):
    base = [f"b{i}" for i in range(150)]
    texts = []
    for i in range(count):
        words = list(base)
        for j in range(i % 4):
            words[(7 * i + 40 * j) % 150] = f"x{i}"
        texts.append(" ".join(words))
    return texts


def test_large_groups_are_compared_in_blocks(documents, monkeypatch):
    """Also the pairs themselves, each once."""
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rows = list(enumerate(near_copies(130)))
    joined = jaccard.JaccardJoin(documents(rows))
    expected = list(classes(rows))
    columns = ["doc_id", "class_id", "text_id", "n_copies", "n_links"]
    assert found(joined.classified(), *columns) == Counter(expected)
    pairs = joined.pairs().collect()
    ends = Counter(i for pair in pairs for i in pair)
    texts = {text_id: links for _, _, text_id, _, links in expected if links}
    assert ends == texts and len(set(map(frozenset, pairs))) == len(pairs)


def test_one_of_each(docs, none):
    kept = jaccard.one_of_each(docs, keep=("lang",))
    assert kept.columns == ["doc_id", "text", "lang"]
    found_groups, wordless = groups(ROWS)
    heads = [least([i for ids, _ in group for i in ids]) for group in found_groups]
    assert Counter(r.doc_id for r in kept.collect()) == Counter(heads + wordless)
    assert jaccard.one_of_each(none).count() == 0


def test_bands_reach_the_recall():
    bands = jaccard.band_count(0.8)
    assert (1 - 0.8**jaccard.ROWS) ** bands <= 1e-5
