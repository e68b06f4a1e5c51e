"""Repair of conversation structure by a lazily determinised weighted automaton.

Role sequences (s?(ua)+)? are a small automaton; keeping, re-roling, deleting and
inserting rows are its weighted edits.  Read from a conversation's last row to
its first, what is known is one vector: the least cost of the rest from each
state.  Its differences are bounded, so normalised vectors are finitely many;
they are the states of a deterministic automaton whose transitions are computed
when first met and then looked up.  A scan of that table gives the costs; going
back over the rows, from the first to the last, the arcs that are tight spell
the cheapest edits, of equal ones those that come first in ASCII order.

A conversation's rows pass through one task as a stream, sorted and spilled by
Spark: the digest of its text is sequential anyway.  No row but the one at hand
is held; what grows is a conversation's answer, one letter an edit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing written, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after the next user or assistant row, and that row's role.
FOLLOWING = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: The state that a kept row leads to, by state and role initial.
KEPT = {(START, "s"): SYSTEM, **{(q, "ua"[FOLLOWING[q] == ASSISTANT]): FOLLOWING[q] for q in range(4)}}
_FAR = 1 << 20

Vector = tuple[int, int, int, int]


class Row(NamedTuple):
    """What the edits of a row depend on."""

    initial: str  # s, u, a, or empty for any other
    fault: str  # blank, duplicate, truncated or empty


def arcs(row: Row, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of the edits that use up a row, in ASCII order."""
    out = [("D", DELETE, state)]
    if row.fault not in ("blank", "duplicate"):
        extra = TRUNCATED * (row.fault == "truncated")
        if (state, row.initial) in KEPT:
            out.append(("K", KEEP + extra, KEPT[state, row.initial]))
        out.append(("R", REROLE + extra, FOLLOWING[state]))
    return out


def _with_inserts(costs: list[int]) -> Vector:
    """The least costs when rows may also be inserted first."""
    for _ in range(4):
        costs = [min(c, INSERT + costs[FOLLOWING[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


#: Costs of the rest at the end of a conversation: it may end where nothing or an assistant row was written.
END = _with_inserts([0, _FAR, _FAR, 0])


class Automaton:
    """The deterministic automaton over normalised cost vectors, as far as it has been met."""

    def __init__(self):
        self.transitions: dict[tuple[Vector, Row], tuple[Vector, int]] = {}

    def step(self, ahead: Vector, row: Row) -> tuple[Vector, int]:
        """The normalised vector before a row, and what normalising took off."""
        key = ahead, row
        if key not in self.transitions:
            costs = _with_inserts([min(c + ahead[to] for _, c, to in arcs(row, q)) for q in range(4)])
            low = min(costs)
            self.transitions[key] = tuple(c - low for c in costs), low
        return self.transitions[key]

    def edits(self, state: int, row: Row | None, ahead: Vector) -> tuple[str, int]:
        """The first edits in ASCII order that are tight: inserted rows, then the one that uses up the row (at
        the end, None, only inserted ones); and the state after them."""
        here = END if row is None else tuple(c + self.step(ahead, row)[1] for c in self.step(ahead, row)[0])
        done = ""
        while True:
            options = [] if row is None else arcs(row, state)
            options = [o for o in options if o[1] + ahead[o[2]] == here[state]]
            if row is None and state in (START, ASSISTANT):
                return done, state
            if options and options[0][0] == "D" or here[state] != INSERT + here[FOLLOWING[state]]:
                return done + options[0][0], options[0][2]
            done, state = done + "I", FOLLOWING[state]


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: the rows after the damage that crc32(conv_id:turn) modulo 20 tells of
    (0 drops the row, which stays here as `gone`; 1 empties its text; 2 takes out its [.!?]; 3 repeats it; 4 makes
    its role user).  Nulls count as one space."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    rows = conversations.select(
        F.col("conv_id"), F.col("turn").cast("long").alias("turn"), F.when(kind == 4, "user").otherwise(spaced("role")).alias("role"),
        text.alias("text"), (kind == 0).alias("gone"), F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1).cast("int"))).alias("_copy"),
    )
    return rows.drop("_copy")


def _fault(seen: Column) -> Column:
    last = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    return F.when(F.col("gone"), "").when(last == "", "blank").when(seen > 1, "duplicate").when(~last.isin(".", "!", "?"), "truncated").otherwise("")


class _Audit:
    """The answer of one conversation, fed row by row from the first to the last."""

    def __init__(self, conv_id):
        self.conv_id, self.state, self.cost = conv_id, START, None
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.low = self.high = self.last_turn = self.last_initial = None
        self.turns = self.illegal = 0
        self.edits: list[str] = []
        self.written, self.digest = False, hashlib.sha256()

    def _write(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.written else "") + f"{role}:{text}").encode())
        self.written = True

    def _insert(self, n: int) -> None:
        for _ in range(n):
            self.state = FOLLOWING[self.state]
            self._write(ROLES[self.state], "")

    def add(self, automaton: Automaton, turn: int | None, role: str, text: str, row: Row, ahead: Vector, cost: int) -> None:
        if self.cost is None:
            self.cost = cost  # of the whole conversation, since this is its first row
        if turn is not None:
            self.low, self.high = turn if self.low is None else self.low, turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        if row.fault:
            self.faults[row.fault] += 1
        if self.last_initial is not None:
            self.illegal += self.last_initial + role[:1] not in ("su", "ua", "au")
        self.last_initial = role[:1]
        edits, after = automaton.edits(self.state, row, ahead)
        self.edits.append(edits)
        self._insert(len(edits) - 1)
        self.state = after
        if edits[-1] != "D":
            self._write(role if edits[-1] == "K" else ROLES[after], text)

    def row(self, automaton: Automaton) -> tuple:
        if self.cost is not None:
            edits, _ = automaton.edits(self.state, None, END)
            self.edits.append(edits)
            self._insert(len(edits))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.conv_id, gaps, *self.faults.values(), self.illegal, self.cost or 0, "".join(self.edits), self.digest.hexdigest()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows from the last to the first: each gets the vector behind it and the cost from it on."""
    automaton, current, ahead, cost = Automaton(), (), END, 0
    for batch in batches:
        vectors, costs = [], []
        for conv_id, initial, fault, gone in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "initial", "fault", "gone")), strict=True):
            if current != (conv_id,):
                current, ahead, cost = (conv_id,), END, 0
            vectors.append(list(ahead))
            if not gone:
                ahead, low = automaton.step(ahead, Row(initial, fault))
                cost += low
            costs.append(cost + ahead[START])
        columns = [*batch.columns, pa.array(vectors, pa.list_(pa.int32())), pa.array(costs, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "ahead", "cost"])


_ANSWER = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _trace(id_type: pa.DataType):
    names = ["conv_id", *(f.split()[0] for f in _ANSWER.split(", "))]
    types = [id_type, *[pa.int64()] * 6, pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows from the first to the last: one answer for each conversation."""
        automaton, audit, done = Automaton(), None, []
        columns = ("conv_id", "turn", "role", "text", "initial", "fault", "gone", "ahead", "cost")
        answers = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names)
        for batch in batches:
            for conv_id, turn, role, text, initial, fault, gone, ahead, cost in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                if audit is None or audit.conv_id != conv_id:
                    if audit:
                        done.append(audit.row(automaton))
                    audit = _Audit(conv_id)
                if not gone:
                    audit.add(automaton, turn, role, text, Row(initial, fault), tuple(ahead), cost)
            if done:
                yield answers()
                done = []
        if audit:
            done.append(audit.row(automaton))
            yield answers()

    return run


def repair_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation.

    rows: conv_id, turn, role, text without nulls in the last two, and `gone` for rows that only tell that their
    conversation exists; other columns are ignored.  A conversation's rows come by turn, nulls first, then by role
    and text.  A row is blank without a character but white space, else a duplicate if an earlier one has its role and
    text, else truncated if its last such character is none of [.!?].  Role initials must become (s?(ua)+)?: keeping a
    row costs 0, making it user or assistant 1, deleting it 2 (blank rows and duplicates must go), inserting an empty
    row 5; a truncated row that stays costs 5 more.  `audit` has the cheapest edits' initials in order, of equally
    cheap ones the ASCII-least.  `gaps` counts the turns missing between the least and the greatest, `illegal` the
    neighbours whose initials aren't su, ua or au.

    A conversation without rows has zeros, an empty audit and the digest of the empty string; one whose rows all go
    too, but for its counts and cost.  Rows without conv_id are one conversation; an empty table has no rows.  Repeated
    rows are duplicates.  Texts of any length are read whole.
    """
    number = F.col("conv_id").cast("long")
    initial = F.substring("role", 1, 1)
    dealt = rows.select(number.alias("conv_id"), "turn", "role", "text", "gone").repartition("conv_id")
    same = Window.partitionBy("conv_id", "gone", "role", "text").orderBy("turn")
    known = dealt.withColumn("seen", F.row_number().over(same)).withColumn("fault", _fault(F.col("seen"))).withColumn("initial", F.when(initial.isin("s", "u", "a"), initial).otherwise(""))
    backward = known.sortWithinPartitions("conv_id", F.col("turn").desc_nulls_last(), F.desc("role"), F.desc("text"), F.desc("seen"))
    vectors = ", ".join([f"{c} {t}" for c, t in known.dtypes] + ["ahead array<int>", "cost bigint"])
    scanned = backward.mapInArrow(_scan, vectors)
    return scanned.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "seen").mapInArrow(_trace(pa.int64()), f"conv_id long, {_ANSWER}")
