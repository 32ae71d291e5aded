"""Repair of conversation structure: shortest paths by the auction algorithm.

The edits of a conversation are paths in a lattice: a node is a row still to come and what
the roles kept so far end with, an arc is an edit with its integer cost. Repaired roles are
an optional system row and then one or more pairs of user and assistant, or nothing.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import pick, prepare
from eventmart.session import materialize

BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5  # costs

START, AFTER_SYSTEM, AFTER_USER, AFTER_PAIR = range(4)
OTHER = 3  # role initials are s, u, a or another
FOLLOWS = {
    (START, 0): AFTER_SYSTEM, (START, 1): AFTER_USER, (AFTER_SYSTEM, 1): AFTER_USER,
    (AFTER_USER, 2): AFTER_PAIR, (AFTER_PAIR, 1): AFTER_USER,
}
# The one role of user and assistant that may come next, and what follows it.
WANTED = [AFTER_USER, AFTER_USER, AFTER_PAIR, AFTER_USER]
SOUND, CUT, REFUSED = range(3)  # refused rows, the blank and duplicate ones, must go
END = 12  # in place of a row's code, which is its initial + 4 * its fault
BLOCK = 64
REMEMBERED_ROWS = 24

NARROW = "conv_id long, turn long, h1 long, h2 long, code int, repeated boolean, later boolean"
AUDIT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string"
)


def _edits(code: int, state: int) -> list[tuple[str, int, int]]:
    """(initial, cost, distance to the target node), by initial."""
    inserted = ("I", INSERT, WANTED[state] - state)
    if code == END:
        finished = [("", 0, 4 - state)] if state in (START, AFTER_PAIR) else []
        return [inserted, *finished]
    initial, fault = code % 4, code // 4
    edits = [("D", DELETE, 4), inserted]
    if fault != REFUSED:
        extra = TRUNCATED if fault == CUT else 0
        if (state, initial) in FOLLOWS:
            edits.append(("K", KEEP + extra, 4 + FOLLOWS[state, initial] - state))
        edits.append(("R", REROLE + extra, 4 + WANTED[state] - state))
    return edits


EDITS = [[_edits(code, state) for state in range(4)] for code in range(END + 1)]


def _bid(codes: bytes, price: array, low: int, high: int) -> None:
    """Auctions from the nodes of layer ``low``; the prices of layer ``high`` are exact.

    Prices start from a bound that holds for every path: the least price of layer ``high``,
    and deletion for each row in between that is cut or refused. The path's last node takes
    the best bid among its arcs: if that raises its price, the path contracts by that node,
    else it extends along the arc. No price is ever above an arc's cost plus the price of
    its target, and arcs of the path are tight, so a path that arrives has least cost and
    its first node's price is exact.
    """
    arrived = 4 * high
    bound = min(price[arrived : arrived + 4])
    for layer in range(high - 1, low - 1, -1):
        if codes[layer] // 4 in (CUT, REFUSED):
            bound += DELETE
        price[4 * layer : 4 * layer + 4] = array("q", [bound] * 4)
    for origin in range(4 * low, 4 * low + 4):
        path = [origin]
        while path[-1] < arrived:
            node = path[-1]
            best, to = min(
                (cost + price[node + step], node + step)
                for _, cost, step in EDITS[codes[node >> 2]][node & 3]
            )
            if price[node] < best:
                price[node] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """The least cost, and of the edits that cost it the initials that are least in ASCII.

    Blocks of layers are auctioned from the end, so the work grows with the number of rows.
    The arcs of all cheapest paths are tight at the prices reached;
    they are followed in the order of their initials, and nodes that lead nowhere on tight
    arcs are left again.
    """
    rows = len(codes)
    layers = codes + bytes([END])
    price = array("q", bytes(32 * (rows + 2)))
    for low in range(rows // BLOCK * BLOCK, -1, -BLOCK):
        _bid(layers, price, low, min(low + BLOCK, rows + 1))
    path, audit, dead = [START], [], set()
    while path[-1] < 4 * (rows + 1):
        node = path[-1]
        for initial, cost, step in EDITS[layers[node >> 2]][node & 3]:
            if price[node] == cost + price[node + step] and node + step not in dead:
                path.append(node + step)
                audit.append(initial)
                break
        else:
            dead.add(path.pop())
            audit.pop()
    return price[START], "".join(audit)


_remembered = lru_cache(1 << 14)(cheapest_edits)


def _audit(conv_id: int | None, codes: bytes, faults: list[int], turns: list) -> tuple:
    initials = np.frombuffer(codes, np.uint8) % 4
    first, second = initials[:-1], initials[1:]
    legal = ((first == 0) & (second == 1)) | ((first == 1) & (second == 2))
    legal |= (first == 2) & (second == 1)
    low, high, distinct = turns
    solve = _remembered if len(codes) <= REMEMBERED_ROWS else cheapest_edits
    return (
        conv_id, high - low + 1 - distinct if distinct else 0, *faults,
        int((~legal).sum()), *solve(codes),
    )


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation, from rows sorted by conversation, turn and digest."""
    schema = pa.schema(
        [("conv_id", pa.int64()), *((n, pa.int64()) for n in
         ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string())]
    )
    codes, faults, turns, last = bytearray(), [0, 0, 0], [0, -1, 0], None
    done: list[tuple] = []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else ([] for _ in schema)
        return pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(columns, schema)], schema=schema
        )

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(7))):
            conv_id, turn, h1, h2, code, repeated, later = row
            if last is not None and last[0] != conv_id:
                done.append(_audit(last[0], bytes(codes), faults, turns))
                codes, faults, turns, last = bytearray(), [0, 0, 0], [0, -1, 0], None
            # Of a repeated row only the first in the earliest of its turns is no duplicate.
            copy = repeated and (later or row[:4] == last)
            kind = 0 if code // 4 == REFUSED else 1 if copy else 2 if code // 4 == CUT else None
            if kind is not None:
                faults[kind] += 1
            codes.append(code % 4 + 4 * REFUSED if kind in (0, 1) else code)
            if turn is not None and (not turns[2] or turn != turns[1]):
                turns = [turns[0] if turns[2] else turn, turn, turns[2] + 1]
            last = row[:4]
        yield batch_of(done)
        done = []
    if last is not None:
        yield batch_of([_audit(last[0], bytes(codes), faults, turns)])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows left, from rows sorted by conversation with its audit in front."""
    names = ["conv_id", "place", "role", "text"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    audit, at, place, begins, current = "", 0, 0, 0, None
    out: list[tuple] = []

    def add(role: str | None, text: str) -> None:
        nonlocal place
        wanted = "assistant" if (place - begins) % 2 else "user"
        out.append((current, place, role or wanted, text))
        place += 1

    def insert() -> None:
        nonlocal at
        while audit[at : at + 1] == "I":
            add(None, "")
            at += 1

    def taken() -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * len(names)
        out.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, types)], names
        )

    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("conv_id", "kind", "role", "text"))
        for conv_id, kind, role, text in zip(*columns):
            insert()
            if kind:
                edit = audit[at]
                at += 1
                if edit != "D":
                    add(role if edit == "K" else None, text)
            else:
                audit, at, place, current = text, 0, 0, conv_id
                begins = (len(audit) - audit.count("D")) % 2  # an odd number starts with system
        yield taken()
    insert()
    yield taken()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's ``role:text`` lines, whose rows come in order."""
    current, digest = None, None
    for batch in batches:
        found: list[tuple] = []
        columns = (batch.column(name).to_pylist() for name in ("conv_id", "place", "role", "text"))
        for conv_id, place, role, text in zip(*columns):
            if not place:
                if digest:
                    found.append((current, digest.hexdigest()))
                current, digest = conv_id, hashlib.sha256()
            digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
        yield _digest_batch(found)
    if digest:
        yield _digest_batch([(current, digest.hexdigest())])


def _digest_batch(found: list[tuple]) -> pa.RecordBatch:
    ids, digests = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(digests, pa.string())], ["conv_id", "repaired_sha256"]
    )


class ConversationRepair:
    """The cheapest edits that give the rows of each conversation a legal order of roles.

    Rows are taken by turn, null turns first; those of one turn come in the order of a hash
    of role and text, identical ones next to each other. A null role or text counts as one
    space. A row's fault is the first of: blank (nothing but ASCII blanks), duplicate (role
    and text seen earlier in the conversation), truncated (the last character that is no
    blank is none of ``.!?``). Roles count by their first character; an empty role has none
    and can't be kept. Edits: keep costs 0, another role 1, deletion 2 (blank and duplicate
    rows must go), an inserted row of empty text 5; a truncated row that stays costs 5 more.

    Rows with a null conversation id are one conversation; identical rows are duplicates of
    the first; an empty table has no conversations; other columns are ignored.

    The edits are found from a byte per row, so only those bytes of one conversation are
    held together; texts pass through a task one after the other. Repeated rows are told by
    an aggregate, so a conversation's hot row is counted before it is shuffled.
    """

    def __init__(self, conversations: DataFrame):
        prepare(conversations.sparkSession)
        named = pick(conversations, "conv_id", "turn", "role", "text").select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        )
        self.given = named.withColumns(
            {"h1": F.xxhash64("role", "text"), "h2": F.xxhash64("text", "role")}
        )
        self._audits: DataFrame | None = None

    def _faults(self) -> DataFrame:
        stripped = F.rtrim(F.col("text"), F.lit(BLANKS))
        ends = F.substring(stripped, -1, 1)
        fault = (
            F.when(stripped == "", REFUSED).when(ends.isin(*ENDS), SOUND).otherwise(CUT)
        )
        initial = F.substring("role", 1, 1)
        code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2)
        rows = self.given.select(
            "conv_id", "turn", "h1", "h2", (code.otherwise(OTHER) + 4 * fault).alias("code")
        )
        again = (
            rows.groupBy("conv_id", "h1", "h2")
            .agg(
                F.count("*").alias("n"),
                F.when(F.bool_or(F.col("turn").isNull()), None).otherwise(F.min("turn")).alias("first"),
            )
            .filter("n > 1")
            .selectExpr("conv_id AS id", "h1 AS k1", "h2 AS k2", "first", "true AS repeated")
        )
        again = materialize(again, "repeated-turns")
        same = F.col("conv_id").eqNullSafe(F.col("id"))
        same &= (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))
        return rows.join(again, same, "left").select(
            "conv_id", "turn", "h1", "h2", "code",
            F.coalesce("repeated", F.lit(False)).alias("repeated"),
            (~F.col("turn").eqNullSafe(F.col("first"))).alias("later"),
        )

    def audits(self) -> DataFrame:
        """Per conversation ``gaps`` (turns that are missing between the first and the last),
        numbers of ``blank``, ``duplicate``, ``truncated`` rows and ``illegal`` neighbours,
        ``cost``, and ``audit``: the edits' initials K, R, D, I, least in ASCII of equal cost.
        """
        if self._audits is None:
            order = ["conv_id", "turn", "h1", "h2"]
            found = (
                self._faults().repartition("conv_id").sortWithinPartitions(*order)
                .mapInArrow(_audits, AUDIT)
            )
            self._audits = materialize(found, "audits")
        return self._audits

    def rows(self) -> DataFrame:
        """The repaired rows: ``conv_id``, ``place`` from 0, ``role`` and ``text``."""
        marks = self.audits().selectExpr(
            "conv_id", "0 AS kind", "NULL AS turn", "0 AS h1", "0 AS h2", "'' AS role", "audit AS text"
        )
        both = self.given.withColumn("kind", F.lit(1)).unionByName(marks)
        return (
            both.repartition("conv_id")
            .sortWithinPartitions("conv_id", "kind", "turn", "h1", "h2")
            .select("conv_id", "kind", "role", "text")
            .mapInArrow(_repaired, "conv_id long, place long, role string, text string")
        )

    def digests(self) -> DataFrame:
        """``conv_id`` and ``repaired_sha256`` of the lines ``role:text``; conversations
        without rows left have none."""
        return self.rows().mapInArrow(_digests, "conv_id long, repaired_sha256 string")
