"""Structure repair of conversations: the cheapest edits that make a conversation alternate, by a run-length dynamic programme.

A row is a symbol: what its role begins with (s, u, a or anything else) and whether it has to go, is cut off, or is sound. The programme has four states:
nothing yet, after the system's row, after a user's, after an assistant's (nothing yet and the last may end it). A symbol is a min-plus matrix over them,
with inserts before it; equal symbols in a row are one run, which is advanced by cached binary powers of its matrix. Costs to the end are
carried back over runs, then choices are unrolled from the front: of the cheapest edits the one with the smallest letter, so that the audit is the least.

Rows are dealt by ranges of (conversation, turn, role, hash of the text), so a conversation of any length is many tasks' until its edits are unrolled. A
conversation that lies within one task's rows is settled there, others in chunks: the product of a chunk's matrices is all that the way back needs. On the way
forward a conversation streams through one task, a chunk at a time, as the SHA-256 of a text has to be taken from its beginning.

Edits and their costs: keep 0, rerole (to user or assistant) 1, delete 2, insert an empty row of a user or assistant 5; a cut-off row that stays adds 5.

Defined results: a null role or text is one space. Rows go by turn, nulls first; rows of one turn by role, then by a hash of the text, then by the text. A row
that repeats role and text of an earlier one is a duplicate; of identical rows of one turn all but one are. A null conv_id is a conversation of its own.
Roles count by their first character. Further columns are not read. Conversations without rows left have zeros, an empty audit and the hash of nothing;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
FAR = 1 << 60
#: Rows and characters of a conversation that are looked at together, about.
CHUNK_ROWS, CHUNK_CHARS = 4096, 4_000_000
#: Faults of a row in the order in which they count; GONE marks a row that only says that its conversation exists.
SOUND, BLANK, DUPLICATE, TRUNCATED, GONE = 0, 1, 2, 3, 9
SPACE = r"\x20\x09-\x0D"
SYSTEM, USER, ASSISTANT, OTHER = range(4)
CLASS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: Symbols are a class plus four times what the row's fault means for it.
OF_FAULT = {SOUND: 0, TRUNCATED: 4, BLANK: 8, DUPLICATE: 8}
#: The state after a user or assistant row that continues a state, and after a kept row, by its class.
NEXT = (2, 2, 3, 2)
KEEP = ({SYSTEM: 1, USER: 2}, {USER: 2}, {ASSISTANT: 3}, {USER: 2})
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product."""
    return tuple(tuple(min(x + b[k][j] for k, x in enumerate(row)) for j in range(4)) for row in a)


def _inserts() -> Matrix:
    """What inserts alone cost from state to state."""
    rows = []
    for state in range(4):
        row, at = [FAR] * 4, state
        row[at] = 0
        for n in (1, 2):
            at = NEXT[at]
            row[at] = min(row[at], n * INSERT)
        rows.append(tuple(row))
    return tuple(rows)


INSERTS = _inserts()
UNIT: Matrix = tuple(tuple(0 if i == j else FAR for j in range(4)) for i in range(4))
#: Costs to the end where no row is left: inserts up to a state that may end.
AT_END: Vector = tuple(min(row[0], row[3]) for row in INSERTS)


@lru_cache(maxsize=None)  # symbols times the bits of a length
def power(symbol: int, k: int) -> Matrix:
    """The matrix of 2^k rows of a symbol."""
    if k:
        return times(power(symbol, k - 1), power(symbol, k - 1))
    own, fault = symbol % 4, symbol - symbol % 4
    rows = []
    for state in range(4):
        row = [FAR] * 4
        row[state] = DELETE
        if fault < 8:
            extra = CUT_OFF if fault else 0
            if own in KEEP[state]:
                row[KEEP[state][own]] = min(row[KEEP[state][own]], extra)
            row[NEXT[state]] = min(row[NEXT[state]], REROLE + extra)
        rows.append(tuple(row))
    return times(INSERTS, tuple(rows))


@lru_cache(maxsize=1 << 16)
def back(symbol: int, k: int, costs: Vector) -> tuple[Vector, int]:
    """Costs to the end before 2^k rows of a symbol, from those after them, as differences to the least; and that."""
    found = [min(x + y for x, y in zip(row, costs, strict=True)) for row in power(symbol, k)]
    least = min(found)
    return tuple(x - least for x in found), least


@lru_cache(maxsize=1 << 14)
def forward(symbol: int, k: int, state: int, costs: Vector) -> tuple[str, int]:
    """Edits of 2^k rows of a symbol from a state, with the costs to the end after them, and the state then."""
    if k:
        first, state = forward(symbol, k - 1, state, back(symbol, k - 1, costs)[0])
        second, state = forward(symbol, k - 1, state, costs)
        return first + second, state
    here, least = back(symbol, 0, costs)
    edits, fault = "", symbol - symbol % 4
    while True:
        left = here[state] + least
        if DELETE + costs[state] == left:
            return edits + "D", state
        if INSERT + here[NEXT[state]] + least == left:
            edits, state = edits + "I", NEXT[state]
            continue
        kept = KEEP[state].get(symbol % 4)
        if kept is not None and fault < 8 and (CUT_OFF if fault else 0) + costs[kept] == left:
            return edits + "K", kept
        return edits + "R", NEXT[state]


def pieces(symbols: bytes) -> list[tuple[int, int]]:
    """(symbol, k): runs of equal symbols as powers of two."""
    out = []
    for symbol, run in groupby(symbols):
        n = sum(1 for _ in run)
        out += [(symbol, k) for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]
    return out


def product(symbols: bytes) -> Matrix:
    out = UNIT
    for symbol, k in pieces(symbols):
        out = times(out, power(symbol, k))
    return out


def unroll(symbols: bytes, state: int, costs: Vector) -> tuple[str, int, int]:
    """(edits, state after them, costs from `state` to the end), with the costs to the end after the rows."""
    some, after, total = pieces(symbols), [], min(costs)
    costs = tuple(c - total for c in costs)
    for symbol, k in reversed(some):
        after.append(costs)
        costs, least = back(symbol, k, costs)
        total += least
    total += costs[state]
    edits = []
    for (symbol, k), costs in zip(some, reversed(after), strict=True):
        text, state = forward(symbol, k, state, costs)
        edits.append(text)
    return "".join(edits), state, total


@lru_cache(maxsize=1 << 14)
def settled(symbols: bytes) -> tuple[str, int]:
    """(edits, cost) of a whole conversation."""
    edits, state, cost = unroll(symbols, 0, AT_END)
    return edits + closing(state), cost


def closing(state: int) -> str:
    return "I" * (AT_END[state] // INSERT)


def repaired(edits: str, roles: list[str], texts: list[str], state: int) -> Iterator[tuple[str, str]]:
    """Role and text of the rows that edits leave, from a state."""
    rows = zip(roles, texts, strict=True)
    for edit in edits:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit == "K":
            state = KEEP[state][CLASS[role[:1]]]
        else:
            role, state = "assistant" if state == 2 else "user", NEXT[state]
        yield role, text


class Tally:
    """What is counted along a conversation's rows."""

    FIELDS = ("live", "blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn", "first_class", "last_class")

    def __init__(self):
        self.live = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.first_class = self.last_class = None

    def row(self, turn: int | None, own: int, fault: int) -> None:
        other = Tally()
        other.live, other.blank, other.duplicate, other.truncated = 1, int(fault == BLANK), int(fault == DUPLICATE), int(fault == TRUNCATED)
        other.first_class = other.last_class = own
        if turn is not None:
            other.turns, other.first_turn, other.last_turn = 1, turn, turn
        self.add(other)

    def add(self, later: Tally) -> None:
        """Those of the rows that follow."""
        if not later.live:
            return
        if self.live:
            self.illegal += (self.last_class, later.first_class) not in LEGAL
        else:
            self.first_class = later.first_class
        for name in ("live", "blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + getattr(later, name))
        self.last_class = later.last_class
        if later.turns:
            self.turns += later.turns - (self.last_turn == later.first_turn)
            self.first_turn = later.first_turn if self.first_turn is None else self.first_turn
            self.last_turn = later.last_turn

    @property
    def gaps(self) -> int:
        return self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0

    def stored(self) -> list[int | None]:
        return [getattr(self, f) for f in self.FIELDS]

    @classmethod
    def read(cls, values: list[int | None]) -> Tally:
        out = cls()
        for name, value in zip(cls.FIELDS, values, strict=True):
            setattr(out, name, value)
        return out


REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
#: A row is a settled conversation (report, and its lines, if asked for) or a chunk of one that is not.
CHUNKS = f"conv_id bigint, chunk bigint, report struct<{REPORT}>, lines array<struct<role:string,text:string>>, roles array<string>, texts array<string>, symbols binary, tally array<bigint>, matrix array<bigint>"
LINES = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_REPORT = pa.struct([(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in REPORT.split(", ")])
_CHUNKS = pa.schema([
    ("conv_id", pa.int64()), ("chunk", pa.int64()), ("report", _REPORT), ("lines", LINES), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
    ("symbols", pa.binary()), ("tally", pa.list_(pa.int64())), ("matrix", pa.list_(pa.int64())),
])


def report(tally: Tally, cost: int, audit: str, digest: str) -> dict:
    return {"gaps": tally.gaps, "blank": tally.blank, "duplicate": tally.duplicate, "truncated": tally.truncated, "illegal": tally.illegal, "cost": cost, "audit": audit, "repaired_sha256": digest}


def with_faults(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text, live) with fault, as far as it can be told without the row before, and the hash that puts rows of a turn in order.

    The first turn of each role and text is a grouped minimum over their digests; a conversation's rows need not meet for it.
    """
    rows = rows.withColumns({"role": F.coalesce("role", F.lit(" ")), "text": F.coalesce("text", F.lit(" "))}).withColumn("digest", F.sha1("text"))
    place = F.struct(F.col("turn").isNotNull(), "turn")
    first = rows.filter("live").groupBy("conv_id", "role", "digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    first = first.select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d"), "first")
    joined = rows.join(first, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_d")), "left")
    later = F.coalesce(place != F.col("first"), F.lit(False))
    fault = (
        F.when(~F.col("live"), GONE).when(~F.col("text").rlike(f"[^{SPACE}]"), BLANK).when(later, DUPLICATE)
        .when(~F.col("text").rlike(rf"[.!?][{SPACE}]*\z"), TRUNCATED).otherwise(SOUND)
    )
    return joined.select("conv_id", "turn", "role", "text", fault.alias("fault"), F.xxhash64("text").alias("order"))


def chunks_of(rows: DataFrame, lines: bool, chunk_rows: int) -> DataFrame:
    """Settled conversations and chunks of others, from rows with faults that are dealt and sorted by range."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        roles, texts, symbols, tally, size, own, number = [], [], bytearray(), Tally(), 0, None, 0
        open_, part, last = True, 0, None

        def flush(settle: bool) -> None:
            nonlocal roles, texts, symbols, tally, size, number
            row = dict.fromkeys(_CHUNKS.names) | {"conv_id": own, "chunk": part << 32 | number}
            if settle:
                edits, cost = settled(bytes(symbols)) if len(symbols) <= 64 else settled.__wrapped__(bytes(symbols))
                kept = list(repaired(edits, roles, texts, 0))
                digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode("utf-8", "surrogatepass")).hexdigest()
                row |= {"report": report(tally, cost, edits, digest), "lines": [{"role": r, "text": t} for r, t in kept] if lines else None}
            else:
                row |= {"roles": roles, "texts": texts, "symbols": bytes(symbols), "tally": tally.stored(), "matrix": [x for r in product(bytes(symbols)) for x in r]}
            out.append(row)
            roles, texts, symbols, tally, size, number = [], [], bytearray(), Tally(), 0, number + 1

        started = False
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                for conv, turn, role, text, fault, task in zip(*[c.to_pylist() for c in some.columns], strict=True):
                    if not started or conv != own:
                        if started:
                            flush(settle=not open_)
                        # The first conversation of the task may have begun in the one before.
                        own, open_, part, last, started = conv, not started, task, None, True
                    elif len(roles) >= chunk_rows or size >= CHUNK_CHARS:
                        open_ = True
                        flush(settle=False)
                    if fault == GONE:
                        continue
                    if fault in (SOUND, TRUNCATED) and last == (turn, role, text):
                        fault = DUPLICATE
                    last = turn, role, text
                    kind = CLASS.get(role[:1], OTHER)
                    roles.append(role)
                    texts.append(text)
                    size += len(text)
                    symbols.append(kind + OF_FAULT[fault])
                    tally.row(turn, kind, fault)
                if out:
                    yield pa.RecordBatch.from_pylist(out, _CHUNKS)
                    out.clear()
        if started:  # the last one may go on in the next task
            flush(settle=False)
            yield pa.RecordBatch.from_pylist(out, _CHUNKS)

    keys = ["conv_id", "turn", "role", "order"]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys, "text")
    return dealt.select("conv_id", "turn", "role", "text", "fault", F.spark_partition_id().cast("bigint")).mapInArrow(each, CHUNKS)


def costs_after(chunks: DataFrame) -> DataFrame:
    """(chunk, costs): costs to the end after each chunk, from the products of those that follow in the conversation."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, costs, started = None, AT_END, False
        for batch in batches:
            found = []
            for conv, matrix in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if not started or conv != own:
                    own, costs, started = conv, AT_END, True
                found.append(costs)
                costs = tuple(min(x + y for x, y in zip(matrix[i : i + 4], costs, strict=True)) for i in range(0, 16, 4))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.int64()))], ["chunk", "costs"])

    small = chunks.select("conv_id", "chunk", "matrix").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("chunk"))
    return small.mapInArrow(each, "chunk bigint, costs array<bigint>")


def streamed(chunks: DataFrame, lines: bool) -> DataFrame:
    """Chunks (with costs) of conversations to their repaired lines, if asked for, and a row with each one's report. A task holds a chunk at a time."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, started = None, False
        audit: list[str] = []
        tally, state, cost, digest, first, at = Tally(), 0, 0, hashlib.sha256(), True, 0

        def added(edits: str, roles: list[str], texts: list[str]) -> list[dict]:
            nonlocal first
            kept = list(repaired(edits, roles, texts, state))
            if kept:
                digest.update(("" if first else "\n").encode() + "\n".join(f"{r}:{t}" for r, t in kept).encode("utf-8", "surrogatepass"))
                first = False
            audit.append(edits)
            return [{"role": r, "text": t} for r, t in kept]

        def row(kept: list[dict], done: dict | None) -> dict:
            return dict.fromkeys(_CHUNKS.names) | {"conv_id": own, "chunk": at, "report": done, "lines": kept if lines else None}

        def ended() -> dict:
            kept = added(closing(state), [], [])
            return row(kept, report(tally, cost, "".join(audit), digest.hexdigest()))

        for batch in batches:
            out = []
            for conv, chunk, roles, texts, symbols, counted, costs in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if not started or conv != own:
                    if started:
                        out.append(ended())
                    own, started, audit, tally, state, digest, first = conv, True, [], Tally(), 0, hashlib.sha256(), True
                    cost = None
                edits, after, total = unroll(symbols, state, tuple(costs))
                cost = total if cost is None else cost
                kept, at = added(edits, roles, texts), chunk
                state = after
                tally.add(Tally.read(counted))
                if lines:
                    out.append(row(kept, None))
            if out:
                yield pa.RecordBatch.from_pylist(out, _CHUNKS)
        if started:
            yield pa.RecordBatch.from_pylist([ended()], _CHUNKS)

    dealt = chunks.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return dealt.select("conv_id", "chunk", "roles", "texts", "symbols", "tally", "costs").mapInArrow(each, CHUNKS)


def repair(rows: DataFrame, lines: bool = False, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """A row for each conversation with its report; with `lines`, the lines of the repaired conversation too, long ones in several rows by chunk (report null but in the last).

    rows: conv_id, turn, role, text and, if there, live (false: the row only says that its conversation exists).
    """
    live = F.coalesce(F.col("live"), F.lit(True)) if "live" in rows.columns else F.lit(True)
    plain = rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text", live.alias("live"))
    found = written(chunks_of(written(with_faults(plain), "faults"), lines, chunk_rows), "conversations", arrow_rows=1024)
    whole, rest = found.filter("report IS NOT NULL"), found.filter("report IS NULL")
    joined = rest.join(costs_after(rest), "chunk")
    out = whole.unionByName(written(streamed(joined, lines), "long-conversations", arrow_rows=8))
    return out.select("conv_id", "chunk", "report", "lines") if lines else out.select("conv_id", "report.*")


def damage(rows: DataFrame) -> DataFrame:
    """rows as crc32(conv_id:turn) % 20 damages them: 0 drops a row (live is false then), 1 empties its text, 2 removes ends of sentences, 3 repeats it, 4 makes it the user's."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    at = F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn"))) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    text = F.when(at == 1, "").when(at == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    copies: Column = F.when(at == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", F.when(at == 4, "user").otherwise(role).alias("role"), text.alias("text"), (at != 0).alias("live"), F.explode(copies).alias("copy")).drop("copy")
