"""Conversation structure repair (11): the cheapest edits to a well-formed dialogue.

Square-root checkpointed dynamic program. The wanted form is a small automaton,
so what is still to be paid from a turn on is a vector of four costs, one a
state. Walking backward, vectors are stored at checkpoints only, one for each
square root of the turns; walking forward, a block's vectors are computed again
from its checkpoint, and of the tight edits the ASCII-least is emitted. A turn is
held as one byte of code, and vectors take memory by the square root.

Turns are range-partitioned by conversation and turn, so a conversation may end
in the middle of a partition and one with a third of all rows fills many. The
conversations inside a partition are worked off there. The first and the last of
a partition may go on in another one; such a segment is written down, and the
same program runs one level higher: a segment is reduced to the matrix of its
costs between states, the matrices of a conversation (at most one a partition)
give the vector at each segment's end, which is a checkpoint, then each segment
tells where it leads from every state, and last it is walked with its state. No
task holds more than a partition, whatever the longest conversation is.

``repair`` gives the repaired turns. ``report`` gives one row a conversation;
its hash covers the whole repaired text in order, so for a conversation of many
partitions one task streams over its rows, holding the audit only.

Defined results: nulls are read as one space, except that a null ``turn`` sorts
first and does not count for gaps. Turns of equal number are taken in the order
of role and text by code point. A null ``conv_id`` is a conversation of its own.
Repeated rows are duplicates after the first. A conversation without rows has
zeros and empty text. Other columns are not read. An empty table gives an empty
one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from math import isqrt
from operator import itemgetter

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskwatch.llm.common import ship, stage

BLANKS = " \t\n\x0b\x0c\r"
#: What each edit costs; an undeleted truncated turn costs more.
KEEP_COST, ROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 1, 2, 5, 5
USER, ASSISTANT = "user", "assistant"

# Faults of a turn, the first that holds.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
# Kinds of role, by its first letter.
KINDS = {"s": 0, "u": 1, "a": 2}
OTHER = 3
LEGAL = frozenset(("su", "ua", "au"))

# The automaton of (s?(ua)+)?: states are the start and the last letter put out.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES = range(4)
NEXT = {(START, 0): AFTER_S, (START, 1): AFTER_U, (AFTER_S, 1): AFTER_U, (AFTER_U, 2): AFTER_A, (AFTER_A, 1): AFTER_U}
NEVER = 1 << 60

# An edit is a letter: D, K, a capital for a new role, a small one for an insert.
NEW_ROLE = {AFTER_U: "U", AFTER_A: "A"}
INSERTED = {AFTER_U: "u", AFTER_A: "a"}
AUDIT = str.maketrans("UAua", "RRII")
ROLES = {"U": USER, "u": USER, "A": ASSISTANT, "a": ASSISTANT}
EDIT_COST = {"D": DELETE_COST, "K": KEEP_COST, "U": ROLE_COST, "A": ROLE_COST, "u": INSERT_COST, "a": INSERT_COST}
#: Rows that a worker gathers before it hands them on, and characters of text.
ROWS, CHARS = 2000, 1 << 22

Vector = tuple[int, ...]


def _wanted(state: int) -> int:
    """The state after the turn that a new role or an insert can give here."""
    return AFTER_A if state == AFTER_U else AFTER_U


def code_of(role: str, fault: int) -> int:
    return KINDS.get(role[:1], OTHER) * 4 + fault


def fault_of(text: str, seen: bool) -> int:
    bare = text.rstrip(BLANKS)
    if not bare:
        return BLANK
    if seen:
        return DUPLICATE
    return SOUND if bare[-1] in ".!?" else TRUNCATED


def _moves(code: int) -> list[list[tuple[str, int, int]]]:
    """By state: edit, cost and next state, the ASCII-least initial first (an insert aside)."""
    kind, fault = divmod(code, 4)
    extra = TRUNCATED_COST if fault == TRUNCATED else 0
    moves = []
    for state in STATES:
        here = [("D", DELETE_COST, state)]
        if fault in (SOUND, TRUNCATED):
            if (state, kind) in NEXT:
                here.append(("K", KEEP_COST + extra, NEXT[state, kind]))
            after = _wanted(state)
            here.append((NEW_ROLE[after], ROLE_COST + extra, after))
        moves.append(here)
    return moves


MOVES = [_moves(code) for code in range(16)]


def _with_inserts(costs: list[int]) -> Vector:
    """Allows inserts before what the costs are of."""
    costs[AFTER_U] = min(costs[AFTER_U], costs[AFTER_A] + INSERT_COST)
    for state in (START, AFTER_S, AFTER_A):
        costs[state] = min(costs[state], costs[AFTER_U] + INSERT_COST)
    return tuple(costs)


#: What is to be paid behind the last turn.
END = _with_inserts([0, NEVER, NEVER, 0])


def back(after: Vector, code: int) -> Vector:
    """The costs before a turn from those behind it."""
    return _with_inserts([min(cost + after[to] for _, cost, to in here) for here in MOVES[code]])


def matrix(codes: bytes) -> list[int]:
    """Least costs of a segment from state to state, row by row."""
    columns = []
    for goal in STATES:
        costs: Vector = tuple(0 if state == goal else NEVER for state in STATES)
        for code in reversed(codes):
            costs = back(costs, code)
        columns.append(costs)
    return [min(columns[goal][state], NEVER) for state in STATES for goal in STATES]


def through(cells: list[int], after: Vector) -> Vector:
    """The costs before a segment from those behind it."""
    return tuple(min(cells[4 * state + goal] + after[goal] for goal in STATES) for state in STATES)


def walk(codes: bytes, end: Vector, state: int, last: bool = True) -> tuple[list[str], int]:
    """The edits at each turn, ASCII-least of the cheapest, and the state behind.

    ``last`` tells that the conversation ends here: what has to be inserted
    behind goes with the last turn.
    """
    n = len(codes)
    step = isqrt(n) + 1
    checkpoints = {n: end}
    costs = end
    for at in range(n - 1, -1, -1):
        costs = back(costs, codes[at])
        if at % step == 0:
            checkpoints[at] = costs
    edits: list[str] = []
    for start in range(0, n, step):
        stop = min(start + step, n)
        block = [checkpoints[stop]]
        for at in range(stop - 1, start - 1, -1):
            block.append(back(block[-1], codes[at]))
        block.reverse()
        for at in range(start, stop):
            here, after, done = block[at - start], block[at - start + 1], ""
            while True:
                due, wanted = here[state], _wanted(state)
                delete, *others = MOVES[codes[at]][state]
                if delete[1] + after[state] != due and here[wanted] + INSERT_COST == due:
                    done, state = done + INSERTED[wanted], wanted
                    continue
                for edit, cost, to in (delete, *others):
                    if cost + after[to] == due:
                        break
                done, state = done + edit, to
                break
            edits.append(done)
    if last and n:
        while state in (AFTER_S, AFTER_U):
            state = _wanted(state)
            edits[-1] += INSERTED[state]
    return edits, state


class Report:
    """One conversation's row, built turn by turn in their order."""

    NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

    def __init__(self) -> None:
        self.low = self.high = None
        self.numbers = self.illegal = self.cost = 0
        self.faults = [0, 0, 0, 0]
        self.before: str | None = None
        self.audit: list[str] = []
        self.hash, self.empty = hashlib.sha256(), True

    def add(self, turn: int | None, role: str, text: str, fault: int, edits: str) -> None:
        if turn is not None and turn != self.high:
            self.low, self.high = (turn if self.low is None else self.low), turn
            self.numbers += 1
        self.faults[fault] += 1
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.illegal += 1
        self.before = role[:1]
        self.audit.append(edits.translate(AUDIT))
        for edit in edits:
            self.cost += EDIT_COST[edit]
            if edit in "KUA":
                self.cost += TRUNCATED_COST if fault == TRUNCATED else 0
                self._put(ROLES.get(edit, role), text)
            elif edit != "D":
                self._put(ROLES[edit], "")

    def _put(self, role: str, text: str) -> None:
        self.hash.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
        self.empty = False

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.numbers
        return gaps, *self.faults[BLANK:], self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest()


def decided(turns: list[tuple[int | None, str, str]]) -> list[tuple[int, str]]:
    """Fault and edits of each turn of a whole conversation in order."""
    seen: set[tuple[str, str]] = set()
    faults = []
    for _, role, text in turns:
        faults.append(fault_of(text, (role, text) in seen))
        seen.add((role, text))
    codes = bytes(code_of(role, fault) for (_, role, _), fault in zip(turns, faults, strict=True))
    return list(zip(faults, walk(codes, END, START)[0], strict=True))


def report_of(turns: list[tuple[int | None, str, str]]) -> tuple:
    made = Report()
    for turn, (fault, edits) in zip(turns, decided(turns), strict=True):
        made.add(*turn, fault, edits)
    return made.row()


# --- Spark ------------------------------------------------------------------

_KEY = "seg long, seq long"
_TURN = "turn long, role string, text string, present boolean"
_REPORT = ", ".join(f"{n} long" for n in Report.NAMES) + ", audit string, repaired_sha256 string"
REPORT_COLUMNS = [*Report.NAMES, "audit", "repaired_sha256"]


def damaged(conversations: DataFrame) -> DataFrame:
    """The table with its planned damage; a dropped row stays as not ``present``."""
    identity = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" "))
    )
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.crc32(identity.cast("binary")) % 20).alias("hit"),
    )
    hit = F.col("hit")
    text = (
        F.when(hit.isin(0, 1), F.lit(""))
        .when(hit == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    return rows.select(
        "conv_id",
        "turn",
        F.when(hit == 4, F.lit(USER)).otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (hit != 0).alias("present"),
        F.explode(F.when(hit == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    ).drop("_copy")


def _in_order(turns: DataFrame) -> DataFrame:
    """Turns sorted over all partitions. Keys are short: of long values they hold a
    beginning, which sorts alike. The row's number spreads repeated rows."""
    short = F.char_length("role") <= 64
    keyed = turns.select(
        "conv_id", "turn", "role", "text", "present",
        F.substring("role", 1, 64).alias("_role"),
        F.when(short, F.substring("text", 1, 64)).alias("_text"),
        F.monotonically_increasing_id().alias("_row"),
    )
    dealt = keyed.repartitionByRange(
        F.col("conv_id").asc(), F.col("turn").asc(), F.col("_role").asc(), F.col("_text").asc_nulls_last(), F.col("_row").asc()
    )
    return dealt.sortWithinPartitions("conv_id", "turn", "role", "text").drop("_role", "_text", "_row")


def _rows(batches: Iterator[pa.RecordBatch], size: int = 512) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, len(batch), size):
            yield from zip(*[c.to_pylist() for c in batch.slice(at, size).columns], strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema, text_at: int) -> Iterator[pa.RecordBatch]:
    """Rows as batches of a bounded number of rows and characters."""
    held: list[tuple] = []
    chars = 0
    for row in rows:
        held.append(row)
        chars += len(row[text_at] or "")
        if len(held) >= ROWS or chars >= CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


def _arrow(conv: pa.DataType, names: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [pair.split() for pair in names.split(", ")]
    return pa.schema([("conv_id", conv), *[(name, kinds[kind]) for name, kind in fields]])


def _identity(conv: object, role: str, text: str) -> bytes:
    return hashlib.sha256(f"{conv!r} {len(role)} {role}{text}".encode()).digest()


_FIRST = f"{_KEY}, {_TURN}, code int, same binary, edits string, {_REPORT}, whole boolean"


def _first_pass(reporting: bool):
    """Whole conversations are finished, as reports or as turns with edits; the
    turns of the first and the last one come back to be decided later."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        conv_type: list[pa.DataType] = []

        def seen_type() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                conv_type[:] = [batch.schema.field(0).type]
                yield batch

        none = (None,) * len(REPORT_COLUMNS)

        def undecided(side: int, turns: Iterator[tuple]) -> Iterator[tuple]:
            for seq, (conv, turn, role, text, present) in enumerate(turns):
                code = code_of(role, fault_of(text, False))
                same = _identity(conv, role, text)
                yield conv, 2 * part + side, seq, turn, role, text, present, code, same, None, *none, False

        def finished(conv: object, held: list[tuple]) -> Iterator[tuple]:
            turns = [t[1:4] for t in held if t[4]]
            if reporting:
                yield conv, 2 * part, 0, None, None, None, None, None, None, None, *report_of(turns), True
                return
            for seq, (turn, (fault, edits)) in enumerate(zip(turns, decided(turns), strict=True)):
                yield conv, 2 * part, seq, *turn, True, code_of(turn[1], fault), None, edits, *none, True

        def out() -> Iterator[tuple]:
            held: tuple | None = None
            for k, (conv, turns) in enumerate(groupby(_rows(seen_type()), key=itemgetter(0))):
                if k == 0:
                    yield from undecided(0, turns)
                    continue
                if held is not None:
                    yield from finished(*held)
                held = conv, list(turns)
            if held is not None:
                yield from undecided(1, held[1])

        rows = out()
        first = next(rows, None)
        if first is not None:

            def again() -> Iterator[tuple]:
                yield first
                yield from rows

            yield from _batches(again(), _arrow(conv_type[0], _FIRST), 5)

    return run


def _first(turns: DataFrame, reporting: bool) -> DataFrame:
    ship(turns.sparkSession)
    kind = turns.schema["conv_id"].dataType.simpleString()
    return stage(_in_order(turns).mapInArrow(_first_pass(reporting), f"conv_id {kind}, {_FIRST}"), "turns")


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A segment's matrix, from (seg, code) in order."""
    for seg, rows in groupby(_rows(batches, 10_000), key=itemgetter(0)):
        cells = matrix(bytes(r[1] for r in rows))
        yield pa.RecordBatch.from_arrays(
            [pa.array([seg], pa.int64()), pa.array([cells], pa.list_(pa.int64()))], names=["seg", "cells"]
        )


def _ends(pdf: pd.DataFrame) -> pd.DataFrame:
    """The costs at the end of each segment of a conversation."""
    pdf = pdf.sort_values("seg", ascending=False)
    end, out = END, []
    for seg, cells in zip(pdf["seg"], pdf["cells"], strict=True):
        out.append((seg, [int(x) for x in end], end is END))
        end = through([int(x) for x in cells], end)
    return pd.DataFrame(out, columns=["seg", "end", "last"])


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where a segment leads from each state, from (seg, code, end) in order."""
    for seg, rows in groupby(_rows(batches, 10_000), key=itemgetter(0)):
        codes, end = bytearray(), END
        for _, code, end in rows:
            codes.append(code)
        exits = [walk(bytes(codes), tuple(end), state, last=False)[1] for state in STATES]
        yield pa.RecordBatch.from_arrays(
            [pa.array([seg], pa.int64()), pa.array([exits], pa.list_(pa.int64()))], names=["seg", "exits"]
        )


def _entries(pdf: pd.DataFrame) -> pd.DataFrame:
    """The state at the start of each segment of a conversation."""
    pdf = pdf.sort_values("seg")
    state, out = START, []
    for seg, exits in zip(pdf["seg"], pdf["exits"], strict=True):
        out.append((seg, state))
        state = int(exits[state])
    return pd.DataFrame(out, columns=["seg", "entry"])


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of each turn, from (seg, seq, code, end, last, entry) in order."""
    for seg, rows in groupby(_rows(batches, 10_000), key=itemgetter(0)):
        codes, numbers, known = bytearray(), [], (END, True, START)
        for _, seq, code, *known in rows:
            codes.append(code)
            numbers.append(seq)
        end, last, entry = known
        edits, _ = walk(bytes(codes), tuple(end), entry, last)
        for at in range(0, len(edits), 10_000):
            here = edits[at : at + 10_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([seg] * len(here), pa.int64()),
                    pa.array(numbers[at : at + 10_000], pa.int64()),
                    pa.array(codes[at : at + 10_000], pa.int32()),
                    pa.array(here, pa.string()),
                ],
                names=["seg", "seq", "code", "edits"],
            )


def _by_segment(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.repartition("seg").sortWithinPartitions("seg", "seq").select(*columns)


def _decide_segments(first: DataFrame) -> DataFrame:
    """The undecided turns of the first pass, decided: same columns, code and edits set.

    Only codes move until the last join; each is a number a turn.
    """
    undecided = first.where(~F.col("whole"))
    there = undecided.where("present").select("conv_id", "seg", "seq", "code", "same")
    at = F.struct("seg", "seq")
    firsts = there.groupBy("same").agg(F.min(at).alias("_first"))
    repeated = (F.col("_first") != at) & (F.col("code") % 4 != BLANK)
    code = F.when(repeated, F.col("code") - F.col("code") % 4 + DUPLICATE).otherwise(F.col("code")).cast("int")
    coded = stage(there.join(firsts, "same").select("conv_id", "seg", "seq", code.alias("code")), "codes")

    owner = coded.select("conv_id", "seg").distinct()
    kind = first.schema["conv_id"].dataType.simpleString()
    cells = _by_segment(coded, "seg", "code").mapInArrow(_matrices, "seg long, cells array<long>")
    ends = owner.join(cells, "seg").groupBy("conv_id").applyInPandas(_ends, "seg long, end array<long>, last boolean")
    ends = stage(owner.join(ends, "seg").select(F.col("conv_id").cast(kind).alias("conv_id"), "seg", "end", "last"), "ends")
    exits = _by_segment(coded.join(ends.select("seg", "end"), "seg"), "seg", "code", "end").mapInArrow(
        _exits, "seg long, exits array<long>"
    )
    entries = ends.join(exits, "seg").groupBy("conv_id").applyInPandas(_entries, "seg long, entry long")
    known = stage(ends.drop("conv_id").join(entries, "seg"), "entries")
    edits = _by_segment(coded.drop("conv_id").join(known, "seg"), "seg", "seq", "code", "end", "last", "entry").mapInArrow(
        _edits, "seg long, seq long, code int, edits string"
    )
    return undecided.drop("code", "edits").join(edits, ["seg", "seq"], "left").select(*first.columns)


def repair(turns: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, place (seg, seq, step), turn, edit, role and text.

    Sorted by conversation and place they are the repaired conversations;
    deleted turns are missing, inserted ones have no turn number.
    """
    first = _first(_with_presence(turns), reporting=False)
    rows = first.where("whole").unionByName(_decide_segments(first).where("present"))
    steps = rows.select("conv_id", "seg", "seq", "turn", "role", "text", F.posexplode(F.split("edits", "")).alias("step", "edit"))
    edit = F.col("edit")
    role = F.when(edit.isin("U", "u"), F.lit(USER)).when(edit.isin("A", "a"), F.lit(ASSISTANT)).otherwise(F.col("role"))
    inserted = edit.isin("u", "a")
    return steps.where(~edit.isin("D", "")).select(
        "conv_id", "seg", "seq", "step",
        F.when(~inserted, F.col("turn")).alias("turn"),
        F.translate("edit", "UAua", "RRII").alias("edit"),
        role.alias("role"),
        F.when(inserted, F.lit("")).otherwise(F.col("text")).alias("text"),
    )


def _with_presence(turns: DataFrame) -> DataFrame:
    """Plain turns as the passes read them; nulls are one space."""
    there: Column = F.col("present") if "present" in turns.columns else F.lit(True)
    return turns.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.coalesce(there, F.lit(True)).alias("present"),
    )


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reports of conversations whose turns come in order."""
    conv_type: list[pa.DataType] = []

    def rows() -> Iterator[tuple]:
        for batch in batches:
            conv_type[:] = [batch.schema.field(0).type]
            yield from _rows(iter([batch]))

    for conv, turns in groupby(rows(), key=itemgetter(0)):
        made = Report()
        for _, turn, role, text, present, code, edits in turns:
            if present:
                made.add(turn, role, text, code % 4, edits)
        yield from _batches(iter([(conv, *made.row())]), _arrow(conv_type[0], _REPORT), 7)


def report(turns: DataFrame) -> DataFrame:
    """One row a conversation: gaps, faults, illegal neighbours, cost, audit and hash."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    first = _first(_with_presence(turns), reporting=True)
    whole = first.where("whole").select("conv_id", *REPORT_COLUMNS)
    split = _decide_segments(first).select("conv_id", "seg", "seq", "turn", "role", "text", "present", "code", "edits")
    ordered = split.repartition("conv_id").sortWithinPartitions("conv_id", "seg", "seq").drop("seg", "seq")
    return whole.unionByName(ordered.mapInArrow(_streamed, f"conv_id {kind}, {_REPORT}"))
