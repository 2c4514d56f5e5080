r"""Conversations repaired into the order of turns that training needs, at the least cost.

A sound conversation is empty, or an optional system row and then user and assistant rows in turn:
role initials ``(s?(ua)+)?``.  Rows are kept, given another role, or deleted, and empty rows are inserted.
The cheapest edits come from a dynamic program over four states (nothing yet, after a system row,
after a user row, after an assistant row).  In each state only one of user and assistant can follow, so the
initials of the edits tell the whole repair, and ties go to the initials that are least as text.

How it runs: one exchange by conversation, rows sorted by turn within the partitions, and
``mapInPandas`` carries the program's state over the Arrow batches.  Per row and state it keeps one byte: the
state that it came from and the edits that led here.  These backpointers, and the rows to be replayed, go to
an unnamed file of the task's own beyond ``SPOOL_BYTES``, so a giant conversation isn't held in memory; the file
ends with the task, and a task that is run again on another executor writes its own.  Which rows repeat an
earlier one is counted before, per conversation, role and text, so no set of seen rows is held either.

Why the program is exact for the ties: when two sequences of edits have used up the same rows and both end with
the edit of a row, neither is the beginning of the other, so their order is settled whatever follows.

Defined cases: a null role or text is one space; rows with a null conversation id are one conversation;
null turns come first; rows of the same turn go by role, then text; repeated rows all count, all but the first as
duplicates; a role is judged by its first character (a role without one has to be given another); an empty table
gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
SPOOL_BYTES = 4 << 20
BATCH_ROWS = 2_000
KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}

# states: nothing yet, after a system, a user, an assistant row
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
NAMES = {USER: "user", ASSISTANT: "assistant"}
TURNED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # the state after an inserted or reroled row
# what brings a state to the end of a sound conversation
CLOSING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
FAULTS = (None, "blank", "duplicate", "truncated")
SOUND_PAIRS = {"su", "ua", "au"}
_FAR = 1 << 60


def _moves(initial: str, fault: str | None) -> list[tuple[int, int, int, int, str]]:
    """(from, to, cost, code, edits) for a row: up to two insertions, then the row's own edit.

    Three insertions lead where one does.  The code says from which state and by which edits, in a byte.
    """
    extra = 1 if fault == "truncated" else 0
    out = []
    for start in range(4):
        state = start
        for inserted in range(3):
            ways = {DELETE: state}
            if fault not in ("blank", "duplicate"):
                ways[REROLE] = TURNED[state]
                if initial in FOLLOWS[state]:
                    ways[KEEP] = FOLLOWS[state][initial]
            for edit, end in ways.items():
                cost = COST[INSERT] * inserted + COST[edit] + (0 if edit == DELETE else extra)
                code = start * 16 + inserted * 4 + "DKR".index(edit)
                out.append((start, end, cost, code, INSERT * inserted + edit))
            state = TURNED[state]
    return out


def _edits(code: int) -> tuple[int, int, str]:
    """(from, insertions, edit) of a code."""
    return code >> 4, code >> 2 & 3, "DKR"[code & 3]


MOVES = {(i, f): _moves(i, f) for i in ("s", "u", "a", "") for f in FAULTS}


class Spool:
    """Byte blocks in the order written, in memory up to a bound and then in an unnamed file of this task."""

    def __init__(self, limit: int):
        self.file, self.sizes = tempfile.SpooledTemporaryFile(max_size=limit), []

    def add(self, block: bytes) -> None:
        self.file.write(block)
        self.sizes.append(len(block))

    def blocks(self, backwards: bool = False) -> Iterator[bytes]:
        ends, at = [], 0
        for size in self.sizes:
            ends.append((at, size))
            at += size
        for start, size in reversed(ends) if backwards else ends:
            self.file.seek(start)
            yield self.file.read(size)


class Repair:
    """The dynamic program over the rows of one conversation; ``SPOOL_BYTES`` bounds what stays in memory."""

    def __init__(self, spool_bytes: int = SPOOL_BYTES):
        self.costs, self.rank = [0, _FAR, _FAR, _FAR], [0, 1, 2, 3]
        self.spool_bytes = spool_bytes
        self.back, self.rows = Spool(spool_bytes), Spool(spool_bytes)
        self.pointers, self.held, self.held_bytes, self.n = bytearray(), [], 0, 0
        self.counts = dict.fromkeys(FAULTS[1:], 0)
        self.illegal, self.gap_turns, self.first, self.turn, self.initial = 0, 0, None, None, None

    def feed(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        said = text.rstrip(SPACES)
        fault = "blank" if not said else "duplicate" if seen else "truncated" if said[-1] not in ENDS else None
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in SOUND_PAIRS:
            self.illegal += 1
        self.initial = initial
        if turn is not None and turn != self.turn:
            self.gap_turns += 1
            self.first, self.turn = turn if self.first is None else self.first, turn
        self._step(initial if initial in ("s", "u", "a") else "", fault)
        self.held.append((role, text))
        self.held_bytes += 8 + len(role) + len(text)
        if self.held_bytes > self.spool_bytes // 4 or len(self.pointers) > self.spool_bytes // 4:
            self._spill()

    def _step(self, initial: str, fault: str | None) -> None:
        best: list[tuple] = [(_FAR, 4, "", 0)] * 4
        costs, rank = self.costs, self.rank
        for start, end, cost, code, edits in MOVES[initial, fault]:
            found = (costs[start] + cost, rank[start], edits, code)
            if found < best[end]:
                best[end] = found
        self.pointers += bytes(b[3] for b in best)
        self.costs = [min(b[0], _FAR) for b in best]
        order = sorted(range(4), key=lambda q: best[q][1:3])
        self.rank = [order.index(q) for q in range(4)]
        self.n += 1

    def _spill(self) -> None:
        self.back.add(bytes(self.pointers))
        self.rows.add(pickle.dumps(self.held))
        self.pointers, self.held, self.held_bytes = bytearray(), [], 0

    def edits(self) -> Iterator[tuple[str, str | None, str | None]]:
        """(edit, role, text) in order; role and text are those after the edit, those of a deleted row before it."""
        state = min((q for q in range(4) if self.costs[q] < _FAR),
                    key=lambda q: (self.costs[q] + COST[INSERT] * CLOSING[q], self.rank[q]))
        last = state
        if self.held:
            self._spill()
        chosen = Spool(self.spool_bytes)
        for block in self.back.blocks(backwards=True):
            codes = bytearray(len(block) // 4)
            for at in range(len(codes) - 1, -1, -1):
                codes[at] = block[4 * at + state]
                state = codes[at] >> 4
            chosen.add(bytes(codes))
        at = START
        for codes, rows in zip(chosen.blocks(backwards=True), self.rows.blocks()):
            for code, (role, text) in zip(codes, pickle.loads(rows)):
                _, inserted, edit = _edits(code)
                for _ in range(inserted):
                    at = TURNED[at]
                    yield INSERT, NAMES[at], ""
                if edit == REROLE:
                    at = TURNED[at]
                    role = NAMES[at]
                elif edit == KEEP:
                    at = FOLLOWS[at][role[:1]]
                yield edit, role, text
        for _ in range(CLOSING[last]):
            at = TURNED[at]
            yield INSERT, NAMES[at], ""

    @property
    def cost(self) -> int:
        return min(c + COST[INSERT] * CLOSING[q] for q, c in enumerate(self.costs))

    @property
    def gaps(self) -> int:
        return 0 if self.first is None else self.turn - self.first + 1 - self.gap_turns


def _conversations(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[int | None, Repair]]:
    """Each conversation of a partition with its rows fed in, over the ends of batches."""
    def rows() -> Iterator[tuple]:
        for frame in frames:
            yield from zip(*[frame[c].tolist() for c in ("conv_id", "has_id", "turn", "has_turn", "role", "text", "seen", "row")])

    for (conv, known), own in groupby(rows(), key=lambda r: r[:2]):
        repair = Repair()
        for _, _, turn, has_turn, role, text, seen, row in own:
            if row:
                repair.feed(turn if has_turn else None, role, text, seen)
        yield (conv if known else None), repair


def _framed(rows: Iterator[tuple], columns: list[str], chars: int = 8 << 20) -> Iterator[pd.DataFrame]:
    """Rows as frames of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, str))
        if len(held) == BATCH_ROWS or size > chars:
            yield _frame(held, columns)
            held, size = [], 0
    if held:
        yield _frame(held, columns)


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=columns)
    frame["conv_id"] = pd.array([r[0] for r in rows], "Int64")
    return frame


REPORT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
EDITS = "conv_id long, place long, edit string, role string, text string"


def _reports(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows() -> Iterator[tuple]:
        for conv, repair in _conversations(frames):
            audit, digest, first = [], hashlib.sha256(), True
            for edit, role, text in repair.edits():
                audit.append(edit)
                if edit != DELETE:
                    digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                    first = False
            yield (conv, repair.gaps, *repair.counts.values(), repair.illegal, repair.cost, "".join(audit), digest.hexdigest())
    yield from _framed(rows(), [c.split()[0] for c in REPORT.split(", ")])


def _listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows() -> Iterator[tuple]:
        for conv, repair in _conversations(frames):
            for place, edit in enumerate(repair.edits()):
                yield conv, place, *edit
    yield from _framed(rows(), [c.split()[0] for c in EDITS.split(", ")])


def _ordered(df: DataFrame, conversations: DataFrame | None) -> DataFrame:
    """The rows by conversation and turn, with ``seen``: an earlier row says the same.

    A conversation of ``conversations`` without a row is one row with ``row`` false.
    """
    blank = F.lit(" ")
    rows = df.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"))
    said = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    rows = rows.withColumn("seen", F.row_number().over(said) > 1).withColumn("row", F.lit(True))
    if conversations is not None:
        none = {"turn": "long", "role": "string", "text": "string"}
        rows = rows.unionByName(conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().select(
            "conv_id", *[F.lit(None).cast(t).alias(c) for c, t in none.items()],
            F.lit(False).alias("seen"), F.lit(False).alias("row")))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text", "seen")]
    return rows.repartition("conv_id").sortWithinPartitions(*order).select(
        F.coalesce("conv_id", F.lit(0)).alias("conv_id"), F.col("conv_id").isNotNull().alias("has_id"),
        F.coalesce("turn", F.lit(0)).alias("turn"), F.col("turn").isNotNull().alias("has_turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "seen", "row")


def repair_reports(df: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``df`` (conv_id, turn, role, text): its faults, the cost, the edits, a digest of the result.

    Conversations listed in ``conversations`` (conv_id) that have no row get a row as well.
    """
    return _ordered(df, conversations).mapInPandas(_reports, REPORT)


def repair_edits(df: DataFrame) -> DataFrame:
    """The edits themselves, a row each: ``place`` in the conversation, K, R, D or I, and the row as it is now (D: as it was)."""
    return _ordered(df, None).mapInPandas(_listed, EDITS)


def repaired(df: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, turn, role, text), turns counted from 0."""
    rows = repair_edits(df).where(F.col("edit") != DELETE)
    turn = F.row_number().over(Window.partitionBy("conv_id").orderBy("place")) - 1
    return rows.select("conv_id", turn.cast("long").alias("turn"), "role", "text")


def damage(df: DataFrame) -> DataFrame:
    """Rows with faults by the checksum of their key: dropped, emptied, without an end, repeated, or said by the user."""
    blank = F.lit(" ")

    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), blank)

    kind = F.pmod(F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))), F.lit(20))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                     shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"))
    return rows.where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")).drop("copy")
