"""Cheapest repair of conversations: bidirectional Dijkstra over the lattice of edits.

A node of the lattice is (rows used, what the repaired turns end with); an edge keeps, deletes
or gives another role to the next row, or inserts an empty turn. A forward heap from the start
and a reverse heap from the goals meet; all crossings of equal cost are finished, and of their
concatenated audits (initials of the edits) the ASCII-least one is taken. Heaps order equal
costs by rows used, so the only free edge (keep) never leads to a node that is settled, and
equal audits so far are decided where they differ: neither is the beginning of the other.

Rows are range-partitioned by conversation and order, so a conversation with a third of all
rows is spread over the tasks like any other rows. A conversation within one task and one
block is repaired there. Of others, blocks of ``BLOCK_ROWS`` rows are searched from each state
to each, and the resulting tables of (cost, audit) are multiplied, least first, within a task
and then along the conversation. Its repaired text is then digested as a stream. What is in
memory for one conversation is its audit, a few times, which it returns anyway.

Defined results: null roles and texts are one space, and a null ``conv_id`` is a conversation
of its own. Rows go by turn, null first; rows of one turn by role, then by the MD5 of their
text, and rows alike in all that in any order. A role counts by its first character, so an
empty or unknown one is legal nowhere, and can be changed or deleted. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm import common

#: Rows that are searched together.
BLOCK_ROWS = 256

# Costs of the edits, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

# What the repaired turns end with. Legal ends are nothing at all and an assistant's turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = (NOTHING, SYSTEM, USER, ASSISTANT)
GOALS = (NOTHING, ASSISTANT)
_NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_BEFORE = {NOTHING: (), SYSTEM: (), USER: (NOTHING, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
_ROLES = {USER: "user", ASSISTANT: "assistant"}
_INITIAL = {USER: "u", ASSISTANT: "a"}
_LEGAL = ("su", "ua", "au")
_BLANKS = " \t\n\x0b\x0c\r"

Row = tuple[str, str]  # the role's initial, and the fault: "", "blank", "duplicate", "truncated"
Solution = tuple[int, str]


def fault_of(text: str, first: bool) -> str:
    seen = text.strip(_BLANKS)
    if not seen:
        return "blank"
    if not first:
        return "duplicate"
    return "" if seen[-1] in ".!?" else "truncated"


def _ahead(rows: list[Row], node: int) -> Iterator[tuple[int, str, int]]:
    """The edges that leave a node: (cost, initial, node)."""
    i, state = node >> 2, node & 3
    after = _NEXT[state]
    yield INSERT, "I", i << 2 | after
    if i == len(rows):
        return
    initial, fault = rows[i]
    yield DELETE, "D", i + 1 << 2 | state
    if fault in ("blank", "duplicate"):
        return
    more = TRUNCATED if fault else 0
    if initial == "s" and state == NOTHING:
        yield KEEP + more, "K", i + 1 << 2 | SYSTEM
    if initial == _INITIAL[after]:
        yield KEEP + more, "K", i + 1 << 2 | after
    else:
        yield REROLE + more, "R", i + 1 << 2 | after


def _back(rows: list[Row], node: int) -> Iterator[tuple[int, str, int]]:
    """The edges that enter a node: (cost, initial, node)."""
    i, state = node >> 2, node & 3
    for before in _BEFORE[state]:
        yield INSERT, "I", i << 2 | before
    if i == 0:
        return
    initial, fault = rows[i - 1]
    yield DELETE, "D", i - 1 << 2 | state
    if fault in ("blank", "duplicate"):
        return
    more = TRUNCATED if fault else 0
    if state == SYSTEM:
        if initial == "s":
            yield KEEP + more, "K", i - 1 << 2 | NOTHING
        return
    for before in _BEFORE[state]:
        if initial == _INITIAL[state]:
            yield KEEP + more, "K", i - 1 << 2 | before
        else:
            yield REROLE + more, "R", i - 1 << 2 | before


def search(rows: list[Row], start: int, goals: tuple[int, ...]) -> Solution | None:
    """The least (cost, audit) that leads from a state over all rows to one of the goals."""
    heaps: tuple[list, list] = ([], [])
    settled: tuple[dict, dict] = ({}, {})
    labels: tuple[dict, dict] = ({}, {})
    edges = _ahead, _back
    sources = [start], [len(rows) << 2 | goal for goal in goals]
    for side in (0, 1):
        for node in sources[side]:
            labels[side][node] = (0, "")
            heapq.heappush(heaps[side], (0, -(node >> 2) if side else 0, node))
    best: Solution | None = None
    while heaps[0] and heaps[1]:
        if best is not None and heaps[0][0][0] + heaps[1][0][0] > best[0]:
            break
        side = int(heaps[1][0][0] < heaps[0][0][0])
        _, _, node = heapq.heappop(heaps[side])
        if node in settled[side]:
            continue
        cost, audit = settled[side][node] = labels[side][node]
        for step, initial, other in edges[side](rows, node):
            total = cost + step
            path = initial + audit if side else audit + initial
            met = settled[1 - side].get(other)
            if met is not None:
                crossing = total + met[0], (met[1] + path if side else path + met[1])
                if best is None or crossing < best:
                    best = crossing
            label = labels[side].get(other)
            if label is None or (total, path) < label:
                labels[side][other] = (total, path)
                if label is None or total < label[0]:
                    used = other >> 2
                    heapq.heappush(heaps[side], (total, -used if side else used, other))
    return best


Table = dict[tuple[int, int], Solution]


def table_of(rows: list[Row]) -> Table:
    """The least (cost, audit) of a block from each state to each."""
    found = {
        (a, b): search(rows, a, (b,)) for a in STATES for b in STATES
        if b in (USER, ASSISTANT) or a in (b, NOTHING)
    }
    return {pair: solution for pair, solution in found.items() if solution is not None}


def product(left: Table, right: Table) -> Table:
    found: Table = {}
    for (a, b), (cost, audit) in left.items():
        for c in STATES:
            tail = right.get((b, c))
            if tail is not None:
                known = found.get((a, c))
                if known is None or cost + tail[0] <= known[0]:
                    joined = cost + tail[0], audit + tail[1]
                    found[a, c] = joined if known is None else min(known, joined)
    return found


class Chain:
    """The product of the tables of adjacent blocks, multiplied pairwise."""

    def __init__(self):
        self.stack: list[tuple[int, Table]] = []

    def add(self, table: Table) -> None:
        rank = 0
        while self.stack and self.stack[-1][0] == rank:
            table, rank = product(self.stack.pop()[1], table), rank + 1
        self.stack.append((rank, table))

    def product(self) -> Table:
        result = self.stack[-1][1]
        for _, table in reversed(self.stack[:-1]):
            result = product(table, result)
        return result


class Repaired:
    """The digest of repaired turns, fed with rows as the audit goes through them."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, NOTHING
        self.sha = hashlib.sha256()

    def _turn(self, role: str, text: str) -> None:
        if self.state != NOTHING:
            self.sha.update(b"\n")
        self.sha.update(f"{role}:{text}".encode())

    def _inserts(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            state = _NEXT[self.state]
            self._turn(_ROLES[state], "")
            self.state, self.at = state, self.at + 1

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return
        state = SYSTEM if edit == "K" and role[:1] == "s" else _NEXT[self.state]
        self._turn(role if edit == "K" else _ROLES[state], text)
        self.state = state

    def digest(self) -> str:
        self._inserts()
        return self.sha.hexdigest()


class Counts:
    """What is counted of adjacent rows, and how it joins at their borders."""

    FIELDS = (
        "blank", "duplicate", "truncated", "illegal", "turns", "least_turn", "largest_turn",
        "last_turn", "first_initial", "last_initial", "first_turn",
    )

    def __init__(self, *values):
        if values:
            for name, value in zip(self.FIELDS, values):
                setattr(self, name, value)
            return
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least_turn = self.largest_turn = self.last_turn = self.first_turn = None
        self.first_initial = self.last_initial = None

    def values(self) -> tuple:
        return tuple(getattr(self, name) for name in self.FIELDS)

    def add(self, turn: int | None, initial: str, fault: str) -> None:
        self.join(Counts(
            int(fault == "blank"), int(fault == "duplicate"), int(fault == "truncated"), 0,
            int(turn is not None), turn, turn, turn, initial, initial, turn,
        ))

    def join(self, after: Counts) -> None:
        """Rows in order of turn, null first."""
        if self.first_initial is None:
            self.first_initial, self.first_turn = after.first_initial, after.first_turn
        else:
            self.illegal += self.last_initial + after.first_initial not in _LEGAL
            self.turns -= after.first_turn is not None and after.first_turn == self.last_turn
        for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, name, getattr(self, name) + getattr(after, name))
        if self.least_turn is None:
            self.least_turn = after.least_turn
        if after.largest_turn is not None:
            self.largest_turn = after.largest_turn
        self.last_turn, self.last_initial = after.last_turn, after.last_initial

    def results(self) -> tuple[int, int, int, int, int]:
        gaps = 0
        if self.turns:
            gaps = self.largest_turn - self.least_turn + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal


_ORDER = "struct<conv_id:bigint,turn:bigint,role:string,digest:binary,row_no:bigint>"
_RESULTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
#: What a task makes of its rows: ``done`` conversations, or for the others the ``chain`` of
#: their rows here (counts, table), and these rows (``rows``) in blocks.
_PARTIAL = (
    "kind string, conv_id bigint, place " + _ORDER + ", block bigint, "
    + ", ".join(f"{name} bigint" for name in _RESULTS)
    + ", audit string, repaired_sha256 string, payload binary"
)
_OUT = (
    "conv_id bigint, " + ", ".join(f"{name} bigint" for name in _RESULTS)
    + ", audit string, repaired_sha256 string"
)
_EMIT_ROWS = 256


class _Segment:
    """The rows of one conversation in one task, as they come."""

    def __init__(self, place: dict, first: bool):
        self.place, self.conv_id, self.edge = place, place["conv_id"], first
        self.counts, self.chain, self.blocks = Counts(), Chain(), 0
        self.rows: list[Row] = []
        self.texts: list[tuple[str, str]] = []

    def add(self, turn: int | None, role: str, text: str, first: bool) -> Iterator[dict]:
        if len(self.rows) == BLOCK_ROWS:
            yield self.block()
        fault = fault_of(text, first)
        self.counts.add(turn, role[:1], fault)
        self.rows.append((role[:1], fault))
        self.texts.append((role, text))

    def block(self) -> dict:
        self.chain.add(table_of(self.rows))
        codec = pa.Codec("zstd", 1)
        plain = json.dumps(self.texts).encode()
        payload = len(plain).to_bytes(8, "little") + codec.compress(plain, asbytes=True)
        self.rows, self.texts = [], []
        self.blocks += 1
        return {"kind": "rows", "conv_id": self.conv_id, "place": self.place,
                "block": self.blocks, "payload": payload}

    def finish(self, last: bool) -> Iterator[dict]:
        if not (self.edge or last or self.blocks):
            cost, audit = search(self.rows, NOTHING, GOALS)
            repaired = Repaired(audit)
            for role, text in self.texts:
                repaired.row(role, text)
            yield {"kind": "done", "conv_id": self.conv_id, "cost": cost, "audit": audit,
                   **dict(zip(_RESULTS, self.counts.results())),
                   "repaired_sha256": repaired.digest()}
            return
        yield self.block()
        table = [[a, b, cost, audit] for (a, b), (cost, audit) in self.chain.product().items()]
        yield {"kind": "chain", "conv_id": self.conv_id, "place": self.place,
               "payload": json.dumps([self.counts.values(), table]).encode()}


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, out = _arrow_partial(), []

    def segments() -> Iterator[dict]:
        segment, is_first = None, False
        for batch in batches:
            for row in batch.to_pylist():
                if row["text"] is None:  # the mark of the row that follows
                    is_first = True
                    continue
                if segment is None or segment.conv_id != row["conv_id"]:
                    if segment is not None:
                        yield from segment.finish(last=False)
                    place = {n: row[n] for n in ("conv_id", "turn", "role", "digest", "row_no")}
                    segment = _Segment(place, first=segment is None)
                yield from segment.add(row["turn"], row["role"], row["text"], is_first)
                is_first = False
        if segment is not None:
            yield from segment.finish(last=True)

    for item in segments():
        out.append(item)
        if len(out) >= _EMIT_ROWS or item["kind"] != "done":
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _arrow_partial() -> pa.Schema:
    place = pa.struct([
        ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
        ("digest", pa.binary()), ("row_no", pa.int64()),
    ])
    return pa.schema([
        ("kind", pa.string()), ("conv_id", pa.int64()), ("place", place), ("block", pa.int64()),
        *((name, pa.int64()) for name in _RESULTS), ("audit", pa.string()),
        ("repaired_sha256", pa.string()), ("payload", pa.binary()),
    ])


def _fold(group: pa.Table) -> pa.Table:
    """The chains of one conversation, from the start to a goal."""
    chains = sorted(
        group.select(["place", "payload"]).to_pylist(),
        key=lambda c: (
            c["place"]["turn"] is not None, c["place"]["turn"] or 0, c["place"]["role"].encode(),
            c["place"]["digest"], c["place"]["row_no"],
        ),
    )
    counts = Counts()
    so_far: Table = {(NOTHING, NOTHING): (0, "")}
    for chain in chains:
        values, table = json.loads(chain["payload"])
        counts.join(Counts(*values))
        so_far = product(so_far, {(a, b): (cost, audit) for a, b, cost, audit in table})
    cost, audit = min(so_far[NOTHING, goal] for goal in GOALS if (NOTHING, goal) in so_far)
    row = dict(zip(_RESULTS, counts.results())) | {
        "conv_id": group.column("conv_id")[0].as_py(), "cost": cost, "audit": audit,
    }
    kinds = [("conv_id", pa.int64()), *((n, pa.int64()) for n in _RESULTS), ("audit", pa.string())]
    return pa.Table.from_pylist([row], pa.schema(kinds))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversation after conversation: its audit, then its rows in order."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    codec, repaired, conv_id = pa.Codec("zstd"), None, None

    def result() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(
            [{"conv_id": conv_id, "repaired_sha256": repaired.digest()}], schema
        )

    for batch in batches:
        for i in range(batch.num_rows):
            payload = batch.column(2)[i].as_py()
            if payload is None:
                if repaired is not None:
                    yield result()
                conv_id, repaired = batch.column(0)[i].as_py(), Repaired(batch.column(1)[i].as_py())
                continue
            size = int.from_bytes(payload[:8], "little")
            for role, text in json.loads(codec.decompress(payload[8:], size, asbytes=True)):
                repaired.row(role, text)
    if repaired is not None:
        yield result()


def repair(conversations: DataFrame) -> DataFrame:
    """A row for each ``conv_id``: what was wrong with it, and its cheapest repair.

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    """
    def or_space(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)

    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        or_space("role"), or_space("text"),
    ).select("*", F.unhex(F.md5("text")).alias("digest"), F.monotonically_increasing_id().alias("row_no"))
    rows = common.written(rows, "turns")
    # The first row of each role and text; a mark of its own goes before it, so no join by a
    # key that many rows may share is needed.
    marks = rows.groupBy("conv_id", "role", "digest").agg(
        F.min(F.struct("turn", "row_no")).alias("first")
    ).select(
        "conv_id", F.col("first.turn").alias("turn"), "role", F.lit(None).cast("string").alias("text"),
        "digest", F.col("first.row_no").alias("row_no"),
    )
    order = ["conv_id", "turn", "role", "digest", "row_no"]
    both = rows.unionByName(marks)
    partial = common.written(
        both.repartitionByRange(*order)
        .sortWithinPartitions(*order, F.col("text").asc_nulls_first())
        .select(*order, "text").mapInArrow(_partial, _PARTIAL),
        "repairs",
    )
    done = partial.filter("kind = 'done'").select("conv_id", *_RESULTS, "audit", "repaired_sha256")
    folded = common.written(
        partial.filter("kind = 'chain'").select("conv_id", "place", "payload")
        .groupBy("conv_id").applyInArrow(_fold, _OUT.removesuffix(", repaired_sha256 string")),
        "audits",
    )
    # One digest of a whole conversation is one stream; it holds the audit and a block.
    empty = F.lit(None)
    stream = folded.select(
        "conv_id", "audit", empty.cast("binary").alias("payload"), empty.cast(_ORDER).alias("place"),
        empty.cast("long").alias("block"),
    ).unionByName(
        partial.filter("kind = 'rows'").select(
            "conv_id", empty.cast("string").alias("audit"), "payload", "place", "block"
        )
    )
    digests = (
        stream.repartition("conv_id").sortWithinPartitions("conv_id", "place", "block")
        .select("conv_id", "audit", "payload")
        .mapInArrow(_digests, "conv_id bigint, repaired_sha256 string")
    )
    chained = folded.alias("f").join(
        digests.alias("d"), F.col("f.conv_id").eqNullSafe(F.col("d.conv_id"))
    ).select("f.*", "d.repaired_sha256")
    return done.unionByName(chained)
