"""Conversation repair against a search of all edits."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import xxhash

from eventmart.llm import conversations as c

TABLE = "conv_id long, turn long, role string, text string, kind int, `Text` string, audit string"


def cheapest(codes):
    """The least (cost, audit) of each state, row after row."""

    def inserted(best):
        best = dict(best)
        for _ in range(3):
            for state, (cost, audit) in list(best.items()):
                offer = (cost + 5, audit + "I")
                best[c.WANTED[state]] = min(best.get(c.WANTED[state], offer), offer)
        return best

    best = {c.START: (0, "")}
    for code in codes:
        after = {}
        for state, (cost, audit) in inserted(best).items():
            edits = [("D", 2, state)]
            if code // 4 != c.REFUSED:
                extra = 5 if code // 4 == c.CUT else 0
                edits.append(("R", 1 + extra, c.WANTED[state]))
                if (state, code % 4) in c.FOLLOWS:
                    edits.append(("K", extra, c.FOLLOWS[state, code % 4]))
            for edit, more, to in edits:
                offer = (cost + more, audit + edit)
                after[to] = min(after.get(to, offer), offer)
        best = after
    best = inserted(best)
    return min(best[state] for state in (c.START, c.AFTER_PAIR) if state in best)


@pytest.mark.parametrize("block", [1, 3, 64])
def test_edits_are_cheapest_and_least(monkeypatch, block):
    monkeypatch.setattr(c, "BLOCK", block)
    draw = random.Random(block)
    for _ in range(1500):
        codes = bytes(draw.choices(range(12), k=draw.choice([0, 1, 2, 3, 4, 5, 6, 7, 9, 13])))
        assert c.cheapest_edits(codes) == cheapest(codes), codes
    for _ in range(5):
        codes = bytes(draw.choices(range(12), weights=[1, 9, 9, 1, 1, 3, 3, 1, 1, 3, 3, 1], k=400))
        assert c.cheapest_edits(codes) == cheapest(codes)


def test_long_conversations():
    assert c.cheapest_edits(bytes([1, 2] * 20000)) == (0, "K" * 40000)
    cost, audit = c.cheapest_edits(bytes([1] * 5000))
    assert (cost, len(audit)) == (2500, 5000) and set(audit) == {"K", "R"}


def repaired(rows):
    """Numbers, audit and rows of one conversation, from (turn, role, text)."""
    rows = [(turn, role if role is not None else " ", text if text is not None else " ")
            for turn, role, text in rows]

    def place(row):
        role, text = row[1].encode(), row[2].encode()
        h1 = xxhash.xxh64(text, seed=xxhash.xxh64(role, seed=42).intdigest()).intdigest()
        return row[0] is not None, row[0] or 0, h1 - 2**64 if h1 >= 2**63 else h1

    rows.sort(key=place)
    seen, codes, faults = set(), [], Counter()
    for _, role, text in rows:
        stripped = text.rstrip(c.BLANKS)
        fault = "blank" if not stripped else "duplicate" if (role, text) in seen else (
            None if stripped[-1] in ".!?" else "truncated")
        seen.add((role, text))
        faults[fault] += 1
        codes.append({"s": 0, "u": 1, "a": 2}.get(role[:1], 3)
                     + 4 * {None: 0, "truncated": 1}.get(fault, 2))
    turns = {turn for turn, _, _ in rows if turn is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = cheapest(codes)
    left, out = iter(rows), []
    for edit in audit:
        _, role, text = (None, "", "") if edit == "I" else next(left)
        if edit != "D":
            out.append((role if edit == "K" else None, text))
    odd = len(out) % 2
    out = [(role or ("assistant" if (i - odd) % 2 else "user"), text) for i, (role, text) in enumerate(out)]
    numbers = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit)
    return numbers, out


def conversations():
    draw = random.Random(8)
    texts = ["Yes.", "No!", "cut", " \t\n", "", None, "é?", "日本", "long " * 3000 + "."]
    roles = ["user", "assistant", "system", "User", "", None, "agent", "umbrella"]
    made = defaultdict(list)
    for conv_id in [None, *range(60)]:
        for turn in range(draw.choice([1, 2, 5, 9])):
            turn = draw.choice([turn, turn, turn + 2, None, 3, -4])
            role = draw.choices(roles, weights=[9, 9, 2, 1, 1, 1, 1, 1])[0]
            row = (turn, role, draw.choices(texts, weights=[6, 6, 2, 1, 1, 1, 3, 1, 1])[0])
            made[conv_id] += [row] * draw.choice([1, 1, 1, 2])
    made[100] = [(turn, "user", f"turn {turn}.") for turn in range(700)] + [(5, "user", "turn 5.")] * 300
    made[101] = [(0, "user", "Hm."), (1, "assistant", "So.")]
    return made


def test_repair(spark):
    made = conversations()
    rows = [(i, *row, 1, "x", "y") for i, part in made.items() for row in part]
    repair = c.ConversationRepair(spark.createDataFrame(rows, TABLE).repartition(5))
    audits = {r.conv_id: tuple(r)[1:] for r in repair.audits().collect()}
    left = defaultdict(list)
    for r in sorted(repair.rows().collect(), key=lambda r: r.place):
        assert r.place == len(left[r.conv_id])
        left[r.conv_id].append((r.role, r.text))
    digests = {r.conv_id: r.repaired_sha256 for r in repair.digests().collect()}
    assert set(audits) == set(made)
    for conv_id, part in made.items():
        numbers, out = repaired(part)
        assert (audits[conv_id], left[conv_id]) == (numbers, out), conv_id
        lines = "\n".join(f"{role}:{text}" for role, text in out)
        assert digests.get(conv_id) == (hashlib.sha256(lines.encode()).hexdigest() if out else None)
    again = c.ConversationRepair(repair.rows().selectExpr("conv_id", "place AS turn", "role", "text"))
    assert {r.illegal for r in again.audits().collect()} == {0}


def test_no_conversations(spark):
    repair = c.ConversationRepair(spark.createDataFrame([], TABLE))
    assert repair.audits().count() == repair.rows().count() == repair.digests().count() == 0
