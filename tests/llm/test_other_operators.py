"""URL rules, sharding and top-k search against brute force."""

import math
import random
from collections import Counter, defaultdict
from fractions import Fraction
from zlib import crc32

import numpy as np
import pytest
from cases import documents, rows  # noqa: F401

from eventmart.llm import shards, topk, urls

RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"), ("a.b.example.org", "/fr/x", "block"), ("Tie.example", "/ab", "allow"),
    ("tie.example", "/ab", "block"), ("x.tie.example", "", "allow"), (None, "/", "block"),
]
URLS = [
    "http://example.net/en/x?a=/b", "https://EXAMPLE.net/en", "http://a.example.com/de/", "net",
    "http://example.com/DE/", "http://notexample.com/de/", "http://x.net", "http://x.net?y=/",
    "http://x.net/", "ftp://a.b.example.org/fr/xyz#f", "http://b.example.org/fr/xyz",
    "http://b.example.org/de", "http://tie.example/abc", "http://x.tie.example/q", "://net/", "://",
    "http://net/", "http://user@x.net:80/", "http://.net/a", "http://a..net/a", "", None, " ",
    "http://" + "a." * 60 + "net/" + "p/" * 3000, "HTTP://É.NET/é", "x://y://z.net/a\nb", "http://NET\n/",
]


def judged(url, rules):
    url = url or ""
    _, mark, rest = url.partition("://")
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = (rest[:cut], rest[cut:]) if mark else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    fits = []
    for rule_host, rule_path, verdict in rules:
        if rule_host is None or not host:
            continue
        rule_host = rule_host.lower()
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            size = len(rule_host) + len(rule_path)
            fits.append((size, len(rule_host), verdict == "block", rule_host + rule_path, verdict))
    *_, rule, verdict = max(fits, default=(None, "allow"))
    return host, path, rule, verdict


def test_url_rules(spark):
    pages = [(i, u) for i, u in enumerate(URLS)] + [(None, URLS[0]), (3, URLS[0]), (0, URLS[0])]
    table = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, host string, prefix int")
    for rules in (RULES, RULES[:4], []):
        found = urls.judge(table, urls.rule_table(spark, rules))
        expected = Counter((i, u, *judged(u, rules)) for i, u in pages)
        assert Counter(map(tuple, found.collect())) == expected
    assert urls.judge(table.limit(0), urls.rule_table(spark, RULES)).count() == 0


def longest_first(sizes, count):
    loads = [0] * count
    for size in sorted(sizes, reverse=True):
        loads[loads.index(min(loads))] += size
    return loads


def scheduled(sizes, count):
    placed = shards.schedule(list(Counter(sizes).items()), count)
    assert {size: sum(given) for size, given in placed.items()} == Counter(sizes)
    return [sum(size * given[i] for size, given in placed.items()) for i in range(count)]


def test_schedule_is_longest_first():
    assert scheduled([7, 6, 5, 4, 3], 2) == [14, 11]  # 7+4+3, 6+5
    random.seed(2)
    for most, number in ((1000, 500), (5, 900), (3, 40), (10**9, 30)):
        sizes = [random.randrange(most) for _ in range(number)]
        for count in (1, 2, 24):
            assert scheduled(sizes, count) == longest_first(sizes, count)
    assert sum(scheduled([8] * 10**6 + [9] * 10**6, 24)) == 17 * 10**6


def test_sharding(spark, documents):
    made = rows() + [(1000 + i, "copy " * 30) for i in range(90)]
    table = documents(made).selectExpr("*", "1 AS size", "2 AS shard", "3 AS file", "4 AS `Text`")
    found = shards.assign(table, 6).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter(
        (i, len((t or "").encode()) + 8, crc32((t or "").encode())) for i, t in made
    )
    slots, groups = defaultdict(list), defaultdict(set)
    for r in found:
        slots[r.shard].append(r.slot)
        groups[r.text_crc32, r.size].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(6))
    assert all(len(shard) == 1 for shard in groups.values())
    assert shards.assign(documents([]), 6).count() == 0


def test_loads_are_those_of_longest_first(documents):
    """One rule for large groups, groups of copies, and very many groups of one size."""
    random.seed(4)
    made = [(i, "t" * random.randrange(300) + str(i)) for i in range(1500)]
    made += [(2000 + i, f"{i:04d}") for i in range(1500)] + [(4000 + i, "copy") for i in range(300)]
    made += [(5000 + i, "long " * 2000) for i in range(3)]
    for count in (3, 24):
        loads = Counter()
        for r in shards.assign(documents(made), count).collect():
            loads[r.shard] += r.size
        sizes = Counter()
        for _, text in made:
            sizes[text] += len(text) + 8
        assert [loads[i] for i in range(count)] == longest_first(sizes.values(), count)


def top(vectors, every, k, scale=256):
    best = {}
    for i, v in vectors:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        best[i] = min(best.get(i, v), v)
    best = {i: [math.floor(scale * Fraction(x)) for x in v] for i, v in best.items()}
    longest = 2**63 - 1
    for q, a in best.items():
        if q % every == 0:
            scores = sorted(
                (-max(-longest - 1, min(longest, sum(x * y for x, y in zip(a, b)))), i)
                for i, b in best.items() if i != q and len(b) == len(a)
            )
            yield from ((q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1))


@pytest.mark.parametrize("block", [4096, 7])
def test_top_k(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", block)
    monkeypatch.setattr(topk, "FIRST_DEPTH", 2)
    random.seed(6)
    draw = lambda n: [random.uniform(-1, 1) for _ in range(n)]
    same = draw(8)
    vectors = [(i, draw(8)) for i in range(60)] + [(100 + i, same) for i in range(15)]
    vectors += [(200, None), (201, []), (202, [1.0, None]), (203, [math.nan] * 8), (None, same)]
    vectors += [(204, [math.inf] * 8), (0, draw(8)), (5, same), (5, same), (210, [0.5, -0.5]),
                (215, [0.25, 1.0]), (220, [0.0] * 8), (-5, draw(8)), (230, [1e6] * 8),
                (231, [1e7, 0.0] * 4), (232, [-1e7] + [0.0] * 7), (235, [3e7] + [0.25] * 7),
                (236, [1e300] * 8), (240, [-1e308, 1.0] * 4), (245, [2.0**55, 0.5] * 4)]
    table = spark.createDataFrame(
        [(i, v, 0, 1) for i, v in vectors], "vec_id long, embedding array<double>, rank int, dims int"
    )
    found = [tuple(r) for r in topk.search(table, every=5, k=3).collect()]
    assert Counter(found) == Counter(top(vectors, 5, 3))
    assert topk.search(table.limit(0)).count() == 0


def test_block_with_sums_beyond_doubles():
    rng = np.random.default_rng(1)
    for most in (2**29, 2**40):
        rows_ = rng.integers(-most, most, (40, 4)).astype(object)
        ids = np.arange(40)
        query, row, score = topk.block_top_k(rows_[:3], ids[:3], rows_, ids, 5)
        for q in range(3):
            exact = sorted(
                (-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(rows_[q], rows_[i])))), i)
                for i in range(40) if i != q
            )[:5]
            assert [(-int(s), int(i)) for s, i in zip(score[query == q], row[query == q])] == exact


def test_lists_are_read_until_outsiders_cannot_qualify():
    """Rows of very uneven size: the best lie in front of all lists. Alike rows: all is read."""
    rng = np.random.default_rng(2)
    alike = np.abs(np.floor(256 * rng.normal(size=(4096, 32))))
    uneven = np.floor(alike * (1 + rng.pareto(1.0, (4096, 1))))
    ids = np.arange(4096)
    for rows_, least, most in ((alike, 0.3, 1.0), (uneven, 0.0, 0.1)):
        read = []
        query, row, score = topk.block_top_k(alike[:64], ids[:64], rows_, ids, 5, read)
        assert least <= sum(read) / (64 * 4096 * 32) <= most
        exact = alike[:64] @ rows_.T
        exact[np.arange(64), np.arange(64)] = -1
        assert (np.sort(exact, axis=1)[:, :-6:-1].ravel() == score).all()
