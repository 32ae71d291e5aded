"""The pipeline against its stages' brute-force versions, and the registered queries."""

import random
from collections import Counter

import cases
from cases import documents, rows  # noqa: F401
from pyspark.sql import functions as F
from test_packing import check
from test_text_operators import cleaned, groups, judged, least

import __spark_entry__ as entry_module
import corpus_pipeline


def whole_characters(size, rows_):
    """Characters of each text that have no byte in a string that starts earlier too."""
    seen = {}
    for i, t in rows_:
        data = t.encode()
        gone = bytearray(len(data))
        for s in range(len(data) - size + 1):
            if seen.setdefault(data[s : s + size], (i, s)) != (i, s):
                gone[s : s + size] = b"\x01" * size
        at, kept = 0, []
        for char in t:
            width = len(char.encode())
            if not any(gone[at : at + width]):
                kept.append(char)
            at += width
        yield i, "".join(kept)


def test_stages(spark, documents):
    made = sorted({i: t for i, t in rows() if i is not None}.items())
    docs = documents(made)
    expected = made
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == corpus_pipeline.COLUMNS
        if name == "quality_rules":
            expected = [(i, t) for i, t in expected if judged(t)[-1]]
        elif name == "line_dedup":
            expected = [(i, text) for i, _, _, text in cleaned(expected, 10)]
        elif name == "near_duplicates":
            found, wordless = groups(expected)
            heads = {least([i for ids, _ in group for i in ids]) for group in found} | {*wordless}
            expected = [(i, t) for i, t in expected if i in heads]
        else:
            expected = list(whole_characters(100, expected))
        got = sorted((r.doc_id, r.text, r.n_chars) for r in docs.collect())
        assert got == [(i, t, len(t)) for i, t in expected], name
        assert got
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    check(expected, packed.collect(), 1024)


def test_stages_take_odd_rows(spark, documents):
    """Null ids, repeated rows and ids, other columns of clashing names, very long texts."""
    draw = random.Random(31)
    prose_ = [cases.prose(90, draw) for _ in range(12)]
    made = [(i, text) for i, text in enumerate(prose_[:8])]
    made += [(2, prose_[2]), (2, prose_[2]), (3, prose_[8]), (None, prose_[9]), (None, prose_[9])]
    made += [(None, None), (None, ""), (50, None), (51, " \n\t "), (52, cases.prose(40000, draw))]
    made += [(60, prose_[10] + " " + prose_[11]), (61, prose_[10] + " " + prose_[11] + " more")]
    clashing = {"TEXT": 1, "kept": True, "n_words": 2, "class_id": 3, "spans": 4, "DOC_ID": 5, "variant": 6}
    docs = documents(made)
    for name, value in clashing.items():
        docs = docs.toDF(*docs.columns).select("*", F.lit(value).alias(name))
    for name, stage in corpus_pipeline.STAGES:
        given = Counter((r[0], r[1]) for r in docs.collect())
        docs = stage(spark, docs, "")
        if name == "packing":
            check(sorted(given.elements(), key=repr), docs.collect(), 1024)
            break
        assert docs.columns == corpus_pipeline.COLUMNS
        left = Counter((r.doc_id, r.text) for r in docs.collect())
        if name == "quality_rules":
            assert left == Counter({row: n for row, n in given.items() if judged(row[1])[-1]})
            assert left[(2, prose_[2])] == 3 and left[(None, prose_[9])] == 2
        elif name == "line_dedup":
            assert sum(left.values()) == sum(given.values())
        elif name == "near_duplicates":
            assert max(left.values()) == 1 and 61 not in {i for i, _ in left}
        else:
            assert sum(left.values()) == sum(given.values()) and 52 in {i for i, _ in left}
        # The same clashing columns stand beside the result, too.
        for other, value in clashing.items():
            docs = docs.select("*", F.lit(value).alias(other))


def test_stages_take_no_rows(spark, documents):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents([]), "").count() == 0, name


def test_every_operator_is_registered():
    names = entry_module.queries()
    assert [sum(name.startswith(f"op{n}_") for name in names) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


def test_run_on_the_smallest_tables(spark):
    sequences = corpus_pipeline.run(spark, "/root/testdata/sf0.001").groupBy("sequence_id")
    assert sequences.sum("length").filter("`sum(length)` > 1024").count() == 0
