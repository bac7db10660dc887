"""Repair of conversation structure by a dynamic programme with checkpoints.

A conversation should read ``(s?(ua)+)?`` by the initials of its roles. The
cheapest edits (keep, rerole, delete, insert) come from backward costs: for
each row and each of four states (nothing yet, after s, after u, after a) the
least cost of what follows. Only the costs at checkpoints, every ``block``
rows, are stored. Walking forward, the costs of one block are computed again
from its checkpoint, and at each step the least letter among the tight edits is
taken, so of all cheapest edits the ASCII-least come out.

Rows pass twice, sorted, through tasks that hold one block: backward as digests
and one letter each, forward with their texts. A row's letter says which roles
and faults it has, so a block is a short string and equal strings are solved once.
Whether a row repeats an earlier one is found by an aggregate over digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 4096             # rows between two checkpoints
BATCH_ROWS, BATCH_CHARS = 4096, 4 << 20

KEEP, REROLE, DELETE, INSERT, OPEN = 0, 3, 4, 3, 3   # costs; OPEN: a truncated row that stays
BLANKS = " \t\n\v\f\r"
STOPS = [".", "!", "?"]

# States: 0 nothing yet, 1 after s, 2 after u, 3 after a.
_NEXT = (2, 2, 3, 2)                       # the state that a user or assistant row leads to
_ROLE = {2: "user", 3: "assistant"}
_ACCEPTS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "o": {}}


def _closed(v: list[int]) -> list[int]:
    """Costs once rows may be inserted first."""
    one = [min(v[s], INSERT + v[_NEXT[s]]) for s in range(4)]
    return [min(v[s], INSERT + one[_NEXT[s]]) for s in range(4)]


_FAR = 1 << 60
TERMINAL = tuple(_closed([0, _FAR, _FAR, 0]))


def _edits(letter: str, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) for a row other than inserting before it, in ASCII order.

    ``letter``: b blank, d duplicate; else the initial (o: other), in upper case if the row is truncated.
    """
    out = [("D", DELETE, state)]
    if letter not in "bd":
        more = OPEN if letter.isupper() else 0
        to = _ACCEPTS[letter.lower()].get(state)
        if to is not None:
            out.append(("K", KEEP + more, to))
        out.append(("R", REROLE + more, _NEXT[state]))
    return out


_STEPS = {x: [_edits(x, s) for s in range(4)] for x in "suaoSUAObd"}


def costs(letters: str, after: tuple[int, ...]) -> list[tuple[int, ...]]:
    """The backward costs before each row of a block and after its last, which are ``after``."""
    out = [after]
    for x in reversed(letters):
        v = out[-1]
        out.append(tuple(_closed([min(c + v[t] for _, c, t in edits) for edits in _STEPS[x]])))
    return out[::-1]


@lru_cache(1 << 14)
def _short_before(letters: str, after: tuple[int, ...]) -> tuple[int, ...]:
    return costs(letters, after)[0]


def before(letters: str, after: tuple[int, ...]) -> tuple[int, ...]:
    """The backward costs before a block."""
    return _short_before(letters, after) if len(letters) <= 32 else costs(letters, after)[0]


def walk(letters: str, after: tuple[int, ...], state: int, last: bool) -> tuple[list[list[tuple[str, int]]], int]:
    """The ASCII-least tight edits of a block from ``state``: per row its (edit, state after it), inserts before
    it first; the last block has one entry more, the inserts at the end. And the state reached."""
    at = costs(letters, after)
    out = []
    for i, x in enumerate(letters):
        edits = []
        while True:
            here = at[i][state]
            tight = {e: t for e, c, t in _STEPS[x][state] if c + at[i + 1][t] == here}
            if "D" not in tight and INSERT + at[i][_NEXT[state]] == here:
                state = _NEXT[state]
                edits.append(("I", state))
                continue
            edit = min(tight)
            state = tight[edit]
            edits.append((edit, state))
            break
        out.append(edits)
    if last:
        end = []
        while state in (1, 2):
            state = _NEXT[state]
            end.append(("I", state))
        out.append(end)
    return out, state


@lru_cache(1 << 14)
def _short_walk(letters: str, after: tuple[int, ...], state: int, last: bool):
    return walk(letters, after, state, last)


# -- rows ---------------------------------------------------------------------------------------


def damage(turns: DataFrame) -> DataFrame:
    """Test damage of whole conversations, by crc32 of ``conv_id:turn`` (null: one space) modulo 20.

    0 drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it the user's.
    """
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    return (turns.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), kind.alias("_kind"))
            .where("_kind <> 0")
            .select("conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
                    .alias("_copy")).drop("_copy"))


def _binary_digest(c: Column) -> Column:
    return F.unhex(F.sha2(c.cast("binary"), 256))


def _letter() -> Column:
    solid = F.rtrim("text", F.lit(BLANKS))
    first = F.substring("role", 1, 1)
    initial = F.when(first.isin("s", "u", "a"), first).otherwise("o")
    return (F.when(solid == "", "b").when(F.right(solid, F.lit(1)).isin(*STOPS), initial)
            .otherwise(F.upper(initial)))


_BLOCK_FIELDS = ("conv_id long, turn long, role string, digest binary, no long, letters string, after array<long>, "
                 "last boolean")


def _backward(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by conversation, from its last to its first; a block goes out when it is full."""
        names = ("conv_id", "turn", "role", "digest")
        types = (pa.int64(), pa.int64(), pa.string(), pa.binary())
        out: list[tuple] = []
        held: list[str] = []            # letters of the open block, from its end
        pending, letter = None, ""      # the row before is not settled until the next tells if it is a copy
        number, after = 0, TERMINAL

        def close():
            nonlocal number, after
            letters = "".join(reversed(held))
            out.append((*pending, -number, letters, list(after), number == 0))
            after = before(letters, after)
            number += 1
            held.clear()

        def frame() -> pa.RecordBatch:
            cols = list(zip(*out)) or [[]] * 8
            made = [pa.array(c, t) for c, t in zip(cols, (*types, pa.int64(), pa.string(), pa.list_(pa.int64()), pa.bool_()))]
            out.clear()
            return pa.RecordBatch.from_arrays(made, [*names, "no", "letters", "after", "last"])

        for batch in batches:
            for *key, x, later in zip(*(batch.column(n).to_pylist() for n in (*names, "letter", "later"))):
                key = tuple(key)
                if pending is not None:
                    held.append("d" if key == pending and letter != "b" else letter)
                    if key[0] != pending[0] or len(held) >= block:
                        close()
                    if key[0] != pending[0]:
                        number, after = 0, TERMINAL
                pending, letter = key, x if x == "b" or not later else "d"
                if len(out) >= BATCH_ROWS:
                    yield frame()
        if pending is not None:
            held.append(letter)
            close()
        yield frame()
    return run


SCRIPT = ("conv_id long, turn long, edit string, role string, text string, given_role string, fault string, cost long")
_FAULTS = {"b": "blank", "d": "duplicate"}


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks and texts come sorted; a block stands before its first row."""
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64())
    names = [f.split()[0] for f in SCRIPT.split(", ")]
    out: list[tuple] = []
    size = 0
    nothing = object()
    conv, state, planned, end = nothing, 0, [], []   # planned: (letter, edits) of the next rows, last first

    def frame() -> pa.RecordBatch:
        nonlocal size
        made = [pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * len(types), types)]
        out.clear()
        size = 0
        return pa.RecordBatch.from_arrays(made, names)

    def insert(to: int) -> None:
        out.append((conv, None, "I", _ROLE[to], "", None, None, INSERT))

    fields = ("conv_id", "turn", "role", "kind", "letters", "after", "last", "text")
    for batch in batches:
        for c, turn, role, kind, letters, after, last, text in zip(*(batch.column(n).to_pylist() for n in fields)):
            if kind == 0:
                if c != conv:
                    conv, state, planned, end = c, 0, [], []
                solve = _short_walk if len(letters) <= 32 else walk
                edits, state = solve(letters, tuple(after), state, last)
                planned = list(zip(letters, edits))[::-1] + planned
                end = edits[-1] if last else []
                continue
            letter, edits = planned.pop()
            for edit, to in edits:
                if edit == "I":
                    insert(to)
                    continue
                fault = _FAULTS.get(letter) or ("truncated" if letter.isupper() else None)
                cost = DELETE if edit == "D" else (REROLE if edit == "R" else KEEP) + (OPEN if fault else 0)
                out.append((conv, turn, edit, _ROLE[to] if edit == "R" else role, text, role, fault, cost))
            if not planned:
                for _, to in end:
                    insert(to)
                end = []
            size += len(text)
            if len(out) >= BATCH_ROWS or size >= BATCH_CHARS:
                yield frame()
    yield frame()


def repair(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """The cheapest edit script of every conversation, in order: one row per edit.

    ``turns``: conv_id, turn, role, text. Rows of a conversation stand by turn (nulls first), then by role,
    then by the SHA-256 of their text. Columns: conv_id, turn, edit (K keep, R rerole, D delete, I insert), role
    and text after the edit (a deleted row's as they were), given_role (null: inserted), fault (blank,
    duplicate, truncated or null) and cost. The rows that are not deleted are the repaired conversation.

    Null role or text counts as one space; the null conv_id is a conversation. Roles go by their
    first character, and other initials than s, u, a (or none) fit nowhere. Other columns are ignored, an empty
    table gives no rows. A conversation of any length streams through one task, sorted on disk if need be, since
    its edits depend on each other in order; the task holds ``block`` rows' letters.
    """
    space = F.lit(" ")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"))
    rows = rows.withColumn("digest", _binary_digest(F.col("text")))
    same = _binary_digest(F.concat_ws("\n", F.coalesce(F.col("conv_id").cast("string"), space), F.hex("digest"), "role"))
    light = rows.select("conv_id", "turn", "role", "digest", _letter().alias("letter"), same.alias("same"))
    firsts = (light.groupBy("same").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n"))
              .where("n > 1").select("same", "first"))
    later = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    down = (light.join(firsts, "same", "left")
            .select("conv_id", "turn", "role", "digest", "letter", later.alias("later"))
            .repartition("conv_id")
            .sortWithinPartitions("conv_id", F.desc_nulls_last("turn"), F.desc("role"), F.desc("digest")))
    blocks = down.mapInArrow(_backward(block), _BLOCK_FIELDS).withColumn("kind", F.lit(0))
    both = blocks.unionByName(rows.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    return (both.repartition("conv_id")
            .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "digest", "kind", "no")
            .select("conv_id", "turn", "role", "kind", "letters", "after", "last", "text")
            .mapInArrow(_forward, SCRIPT))


REPORT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
_LEGAL = {"su", "ua", "au"}


class _Report:
    """What is told of one conversation, row by row."""

    def __init__(self):
        self.least = self.most = self.turn = self.before = None
        self.turns = self.illegal = self.cost = 0
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.audit: list[str] = []
        self.hash = hashlib.sha256()
        self.any = False

    def add(self, turn, edit, role, text, given_role, fault, cost) -> None:
        self.audit.append(edit)
        self.cost += cost
        if edit != "I":
            if turn is not None:
                self.turns += turn != self.turn
                self.least = turn if self.least is None else self.least
                self.most = self.turn = turn
            if fault:
                self.faults[fault] += 1
            self.illegal += self.before is not None and self.before[:1] + given_role[:1] not in _LEGAL
            self.before = given_role
        if edit != "D":
            self.hash.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
            self.any = True

    def row(self, conv) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


def _report_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in REPORT.split(", ")]
    types = [pa.string() if f.endswith("string") else pa.int64() for f in REPORT.split(", ")]
    nothing = object()
    conv, told, out = nothing, _Report(), []

    def frame() -> pa.RecordBatch:
        made = [pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * len(types), types)]
        out.clear()
        return pa.RecordBatch.from_arrays(made, names)

    for batch in batches:
        for c, *row in zip(*(col.to_pylist() for col in batch.columns)):
            if c != conv:
                if conv is not nothing:
                    out.append(told.row(conv))
                conv, told = c, _Report()
            told.add(*row)
        if len(out) >= BATCH_ROWS:
            yield frame()
    if conv is not nothing:
        out.append(told.row(conv))
    yield frame()


def report(turns: DataFrame, everyone: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per conv_id of ``everyone`` on the repair of ``turns``.

    gaps (missing numbers between the least and the greatest turn), the count of each fault, illegal (adjacent
    role initials other than su, ua, au), cost, audit (the edits), repaired_sha256 (``role:text`` of the repaired
    rows, joined by newlines). A conversation without rows: zeros, empty audit, the empty string's hash.
    The digest follows the edit script in the same task, without another shuffle.
    """
    told = repair(turns, block).mapInArrow(_report_batches, REPORT)
    ids = everyone.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    numbers = [f.split()[0] for f in REPORT.split(", ") if f.endswith("long")][1:]
    return (ids.join(told.withColumnRenamed("conv_id", "_told"), F.col("conv_id").eqNullSafe(F.col("_told")), "left")
            .select("conv_id", *(F.coalesce(n, F.lit(0)).alias(n) for n in numbers),
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")))
