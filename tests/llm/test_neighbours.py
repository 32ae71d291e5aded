"""Nearest neighbours against distances to all rows."""

import math
import random

import numpy as np
import pytest

from eventmart.llm import neighbours


def nearest(vectors, every, k):
    best = {}
    for i, v in vectors:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        best[i] = min(best.get(i, v), v)
    for q, a in best.items():
        if q % every == 0:
            found = sorted(
                (math.sqrt(sum((x - y) * (x - y) for x, y in zip(a, b))), i)
                for i, b in best.items() if i != q and len(b) == len(a)
            )
            yield from ((q, rank, i, score) for rank, (score, i) in enumerate(found[:k], 1))


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("rows_per_list", [1000, 20])
def test_odd_rows(spark, monkeypatch, kind, rows_per_list):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 30)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 8)
    monkeypatch.setattr(neighbours, "SAMPLE_PER_LIST", 8)
    random.seed(6)
    draw = lambda n: [random.randrange(-64, 64) / 32 for _ in range(n)]
    same = draw(20)
    vectors = [(i, draw(20)) for i in range(150)] + [(200 + i, same) for i in range(60)]
    vectors += [(300, None), (301, []), (302, [1.0, None]), (303, [math.nan] * 20), (None, same)]
    vectors += [(304, [math.inf] * 20), (0, draw(20)), (5, same), (5, same), (310, [0.5, -0.5]),
                (315, [0.25, 1.0]), (320, [0.0] * 20), (-5, draw(20)), (330, [2.0**60] * 20)]
    table = spark.createDataFrame(
        [(i, v, 0, 1) for i, v in vectors], f"vec_id long, embedding array<{kind}>, rank int, DIMS int"
    )
    # All lists are asked, so only the tests by partial distances could lose a neighbour.
    found = neighbours.search(table, every=5, k=4, recall=1.0, rows_per_list=rows_per_list).collect()
    expected = list(nearest(vectors, 5, 4))
    got = {(r.query_id, r.vec_id): r.score for r in found}
    assert len(got) == len(found) == len(expected)
    assert {(r.query_id, r.rank) for r in found} == {row[:2] for row in expected}
    hit = sum(got.get((q, i)) == score for q, _, i, score in expected)
    assert hit >= 0.97 * len(expected)
    ordered = sorted(found, key=lambda r: (r.query_id, r.rank))
    pairs = [(a, b) for a, b in zip(ordered, ordered[1:]) if a.query_id == b.query_id]
    assert all((a.score, a.vec_id) < (b.score, b.vec_id) for a, b in pairs) and pairs
    assert neighbours.search(table.limit(0)).count() == 0


def test_recall_and_abandoned_candidates(spark):
    """Clustered rows: few lists are read, and of most candidates only some dimensions."""
    draw = np.random.default_rng(3)
    middle = draw.normal(size=(25, 48))
    rows = middle[draw.integers(0, 25, 4000)] + 0.3 * draw.normal(size=(4000, 48))
    table = spark.createDataFrame(
        [(i, v) for i, v in enumerate(rows.tolist())], "vec_id long, embedding array<double>"
    )
    index = neighbours.NeighbourIndex(table, 10, 0.95, rows_per_list=160)
    assert index.probes[48] < len(index.centres[48]) / 2
    found = index.search(every=20).collect()
    expected = set()
    for q in range(0, 4000, 20):
        far = np.sqrt(((rows - rows[q]) ** 2).sum(axis=1))
        far[q] = np.inf
        expected |= {(q, int(i)) for i in np.argsort(far)[:10]}
    assert len(found) == len(expected) == 2000
    assert len(expected & {(r.query_id, r.vec_id) for r in found}) >= 0.9 * 2000

    tested = []
    turned = rows @ neighbours.rotation(48)
    columns, ids = np.ascontiguousarray(turned.T, np.float32), np.arange(4000)
    far = np.sort(((rows[:8, None] - rows) ** 2).sum(axis=2), axis=1)
    bars = np.sqrt(far[:, 10])
    query, row, _ = neighbours.scan_block(
        columns, ids, rows, turned[:8], ids[:8], rows[:8], bars, 10, tested
    )
    assert sum(tested) < 0.5 * 8 * 4000 * 48
    hits = sum(((rows[q] - rows[i]) ** 2).sum() <= far[q, 10] for q, i in zip(query, row))
    assert hits >= 0.9 * 80
