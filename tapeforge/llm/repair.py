"""Repair of the structure of conversations by iterative-deepening A*.

A conversation's rows become symbols: a role's initial and the row's first fault. The search edits them (Delete, Insert, Keep,
Rerole, tried in that ASCII order) until the initials read ``(s?(ua)+)?``. It goes depth first under a bound on the cost, which rises by
one until a path is accepted; states that failed with a budget are held in a table. The bound starts from, and paths are cut
by, the exact cost of a relaxed pattern, ``s?(ua)*``: a lower bound that is at most the cost of one pair of turns too low, so a
few bounds do for a conversation of any length and each takes time in proportion to it.

Rows of a conversation meet in one shuffle and are sorted there, spilled as Spark sorts. A task reads a conversation twice from
that order, as rows of two phases: first the symbols, a byte a row, which the search needs whole; then roles and texts, which run
through the digest and aren't gathered. The audit and the digest of a conversation are one row of the result, so a conversation
is one task's stream however long it is.

Defined results: a null role or text is one space, and so is a null conv_id or turn in the text that decides the damage; a null
conv_id is a conversation; rows of one turn stand in order of role and text; a role that begins with no s, u or a has to be reroled
or deleted; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The white space that leaves a text blank, and the signs that end one.
SPACES, ENDS = " \t\n\x0b\x0c\r", ".!?"
INITIALS = "sua"
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
#: Costs of a rerole and an insertion, of a deletion, and of a truncated row that stays.
CHANGE, DELETE, CUT = 2, 3, 1
#: Where the initials stand: before all, after s, after u, after a. What may follow: an initial and where it leads.
FOLLOWS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ACCEPTED = (0, 3)
_OPS = b"DIKR"
_ROLES = {2: "user", 3: "assistant"}
#: The state that an insertion or a rerole leads to; and, by role (s, u, a, other) and state, what keeping does, -1 for nothing.
_NEXT = tuple(max(f.values()) for f in FOLLOWS)
_KEEP = tuple(tuple(f.get(r, -1) for f in FOLLOWS) for r in (*INITIALS, ""))
#: The relaxed pattern has one state for after s and after a.
_RELAXED = (0, 1, 2, 1)
_NEVER = 1 << 30


def symbol(role: int, fault: int) -> int:
    """A row as a number below 16: its role's place in s, u, a, other, and its fault; duplicates count as blank ones."""
    return role * 4 + min(fault, BLANK)


def lower_bounds(symbols: bytes) -> array:
    """For each row and state (before all, after s or a, after u) the least cost from there on under the relaxed pattern."""
    n = len(symbols)
    out = array("i", bytes(12 * (n + 1)))
    for i in range(n, -1, -1):
        if i == n:
            start, closed, asked = 0, 0, _NEVER
        else:
            role, fault = divmod(symbols[i], 4)
            after = out[3 * i + 3 : 3 * i + 6]
            start, closed, asked = (DELETE + x for x in after)
            if fault < BLANK:
                cut = CUT * (fault == TRUNCATED)
                start = min(start, cut + (after[1] if role == 0 else after[2] if role == 1 else CHANGE + after[2]), cut + CHANGE + after[2])
                closed = min(closed, cut + (0 if role == 1 else CHANGE) + after[2])
                asked = min(asked, cut + (0 if role == 2 else CHANGE) + after[1])
        opened = min(asked, CHANGE + closed)
        out[3 * i : 3 * i + 3] = array("i", [min(start, CHANGE + opened), min(closed, CHANGE + asked), opened])
    return out


def _within(symbols: bytes, bounds: array, failed: array, most: int) -> bytes | None:
    """The first accepted path, in ASCII order, of at most this cost."""
    n, i, s, cost, op = len(symbols), 0, 0, 0, 0
    ops, froms = bytearray(), bytearray()
    if bounds[0] > most:
        return None
    while True:
        if i == n and s in ACCEPTED:
            return bytes(ops)
        role, fault = divmod(symbols[i], 4) if i < n else (3, BLANK)
        cut = CUT * (fault == TRUNCATED)
        moved = False
        while op < 4 and not moved:
            at, to, price = i, s, DELETE
            if op == 0:
                at = i + 1
            elif op == 1:
                to, price = _NEXT[s], CHANGE
            elif op == 2:
                at, to, price = i + 1, _KEEP[role][s] if fault < BLANK else -1, cut
            else:
                at, to, price = i + 1, _NEXT[s] if fault < BLANK else -1, CHANGE + cut
            left = most - cost - price
            if at <= n and to >= 0 and bounds[3 * at + _RELAXED[to]] <= left and failed[4 * at + to] < left:
                ops.append(_OPS[op])
                froms.append(s)
                i, s, cost, moved = at, to, cost + price, True
            op += 1
        if moved:
            op = 0
            continue
        failed[4 * i + s] = most - cost
        if not ops:
            return None
        last, s = ops.pop(), froms.pop()
        op = _OPS.index(last)
        if op != 1:
            i -= 1
        cost -= CHANGE if op == 1 else DELETE if op == 0 else CUT * (symbols[i] % 4 == TRUNCATED) + CHANGE * (op == 3)
        op += 1


def search(symbols: bytes, bounds: array | None = None) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits, of these the least in ASCII. ``bounds``: lower bounds as of :func:`lower_bounds`."""
    bounds = lower_bounds(symbols) if bounds is None else bounds
    failed = array("i", [-1]) * (4 * len(symbols) + 4)
    most = bounds[0]
    while (found := _within(symbols, bounds, failed, most)) is None:
        most += 1
    return most, found.decode()


#: Short conversations are much alike.
_searched = functools.lru_cache(1 << 14)(search)


class Conversation:
    """What a task knows of the conversation that it reads."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.symbols, self.counts = conv_id, bytearray(), [0, 0, 0, 0]
        self.gaps = self.illegal = self.at = self.state = 0
        self.turn = self.before = self.audit = None
        self.sha = hashlib.sha256()
        self.empty = True

    def see(self, role: int, fault: int, turn: int | None) -> None:
        """A row of the first phase, in order."""
        if self.before is not None and (self.before, role) not in ((0, 1), (1, 2), (2, 1)):
            self.illegal += 1
        self.before = role
        self.counts[fault] += 1
        self.symbols.append(symbol(role, fault))
        if turn is not None:
            if self.turn is not None and turn > self.turn:
                self.gaps += turn - self.turn - 1
            self.turn = turn

    def _write(self, role: str, text: str) -> None:
        self.sha.update((f"{role}:{text}" if self.empty else f"\n{role}:{text}").encode())
        self.empty = False

    def solve(self) -> None:
        symbols = bytes(self.symbols)
        self.cost, self.audit = (_searched if len(symbols) <= 64 else search)(symbols)

    def _insert(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state = _NEXT[self.state]
            self._write(_ROLES[self.state], "")
            self.at += 1

    def read(self, role: str, text: str) -> None:
        """A row of the second phase, in order."""
        if self.audit is None:
            self.solve()
        self._insert()
        op = self.audit[self.at]
        self.at += 1
        if op == "K":
            self.state = FOLLOWS[self.state][role[:1]]
            self._write(role, text)
        elif op == "R":
            self.state = _NEXT[self.state]
            self._write(_ROLES[self.state], text)

    def row(self) -> tuple:
        if self.audit is None:
            self.solve()
        self._insert()
        return (self.conv_id, self.gaps, self.counts[BLANK], self.counts[DUPLICATE], self.counts[TRUNCATED], self.illegal, self.cost, self.audit, self.sha.hexdigest())


REPAIRED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copy of the rows with their damage; a dropped row stays as one without role and text."""
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(as_text("conv_id"), F.lit(":"), as_text("turn")).cast("binary")) % 20
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), as_text("role").alias("role"), as_text("text").alias("text"), kind.alias("kind"))
    role = F.when(F.col("kind") == 4, "user").when(F.col("kind") > 0, F.col("role"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).when(F.col("kind") > 0, F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", F.when(F.col("kind") > 0, F.col("turn")).alias("turn"), role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))


def _fault(text: Column, again: Column) -> Column:
    core = F.rtrim(text, F.lit(SPACES))
    last = F.right(core, F.lit(1))
    return F.when(core == "", BLANK).when(again, DUPLICATE).when(~last.isin(*ENDS), TRUNCATED).otherwise(FINE)


def repaired(rows: DataFrame) -> DataFrame:
    """A row a conversation of rows as of :func:`damaged`."""
    own = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text", "copy")
    seen = Window.partitionBy("conv_id", "role", "text").orderBy("pos")
    # one shuffle: the windows and the last order need no other
    met = rows.repartition("conv_id").withColumn("pos", F.row_number().over(own)).withColumn("again", F.row_number().over(seen) > 1)
    initial = F.left("role", F.lit(1))
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    none = F.lit(None).cast("string")
    first = F.struct(F.lit(0).alias("phase"), F.when(F.col("role").isNotNull(), role * 4 + _fault(F.col("text"), F.col("again"))).alias("code"), none.alias("role"), none.alias("text"))
    second = F.struct(F.lit(1).alias("phase"), F.lit(None).cast("int").alias("code"), F.col("role"), F.col("text"))
    phases = F.when(F.col("role").isNull(), F.array(first)).otherwise(F.array(first, second))
    stream = met.select("conv_id", "turn", "pos", F.explode(phases).alias("x")).select("conv_id", "x.phase", "pos", "turn", "x.code", "x.role", "x.text").sortWithinPartitions("conv_id", "phase", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for batch in batches:
            for conv_id, phase, _, turn, code, said_by, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = Conversation(conv_id)
                if phase:
                    now.read(said_by, text)
                elif code is not None:
                    now.see(code // 4, code % 4, turn)
            if done:
                yield table(done)
                done = []
        if now is not None:
            yield table([now.row()])

    names, types = zip(*(f.split() for f in REPAIRED.split(", ")), strict=True)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if t == "long" else pa.string()) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=list(names))

    return stream.mapInArrow(run, REPAIRED)


def repair(turns: DataFrame) -> DataFrame:
    """The repair of every conversation after its damage."""
    return repaired(damaged(turns))
