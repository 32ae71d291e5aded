"""Texts with the odd cases that every operator on documents must take, and a fixture that
turns texts into a table. (A conftest module here would hide that of the other tests.)"""

import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Turns a list of texts, or of (doc_id, text), into a documents table."""

    def make(rows, partitions=3):
        rows = [row if isinstance(row, tuple) else (i, row) for i, row in enumerate(rows)]
        rows = [(i, text, "en", None, len(text or "")) for i, text in rows]
        return spark.createDataFrame(rows, DOCUMENTS).repartition(partitions)

    return make


DRAW = random.Random(20)
WORDS = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(600)]


def prose(words, draw=DRAW):
    out = []
    for i in range(words):
        out.append(draw.choice(WORDS))
        if i % 12 == 11:
            out[-1] += "\n"
    return " ".join(out)


def rows():
    """(doc_id, text): copies, shared passages, repeated lines, nulls, repeats, a long text."""
    shared, line = prose(70), "the very same line"
    made = [(i, prose(DRAW.randrange(1, 160))) for i in range(40)]
    made += [(50 + i, f"{prose(20)} {shared} {prose(15)}") for i in range(6)]
    made += [(60 + i, f"{line}\n{prose(30)}\n  {line.upper()} \t") for i in range(12)]
    twin = prose(120)
    made += [(80, twin), (81, twin), (82, twin.replace(" ", "  ")), (83, twin + " more words")]
    made += [(84, "a b c"), (85, "a b c"), (86, "x " * 400), (87, "é" * 300), (88, "日本" * 90)]
    made += [(89, None), (90, ""), (91, " \n\t "), (None, "no id"), (None, None), (None, twin)]
    made += [(92, twin), (92, twin), (93, "one text of 93"), (93, prose(60)), (94, prose(30000))]
    return made
