"""Repair of conversations: the cheapest edits that make their roles alternate.

A conversation's turns must read ``system? (user assistant)+``, or be none at all. Four states say
what may come next, so a turn is a 4 x 4 matrix of costs in the (min, +) sense that hangs only on
its role's initial and its fault. Equal neighbours collapse into runs; a run of k turns is the k-th
power of its matrix, put together from cached binary powers. What is left to pay behind each run is
carried from the end to the start, and the choices are then unrolled run by run, halving a run by
the same powers: the ASCII-least of the cheapest audits takes at each step the least initial that
still pays the least in all.

Rows are ranged by conversation and turn. A conversation that lies inside one range is done there,
one at a time. Those that touch a range's border, and long ones, are left open: their blocks of
rows become one matrix each, costs are carried over the blocks backwards and states forwards, and
only then the blocks are unrolled side by side; the digest of a conversation streams its blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from stratafold.llm.common import parts_of, stored, table

INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3
BLOCK_ROWS = 4096
BLOCK_CHARS = 1 << 21
_SPACES = " \t\n\x0b\x0c\r"
_STOPS = ".!?"
_INITIALS = "sua"
_LEGAL = {"su", "ua", "au"}
_FAR = 1 << 60

# States: nothing yet, after the system turn, after a user turn, after an assistant turn.
_ROLES = {2: "user", 3: "assistant"}
_NEXT = (2, 2, 3, 2)  # where an inserted or a rerolled turn leads
_KEEP = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("a", 2): 3, ("u", 3): 2}
_END = (0, 2 * INSERT, INSERT, 0)  # what is left to pay behind the last turn

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


# --- one conversation ------------------------------------------------------------------------------

def symbol_of(role: str, text: str, seen: bool) -> tuple[int, str]:
    """A turn's symbol (0: to be deleted; else by initial and whether it is truncated) and its fault."""
    body = text.strip(_SPACES)
    if not body:
        return 0, "blank"
    if seen:
        return 0, "duplicate"
    cut = body[-1] not in _STOPS
    return 1 + 2 * (_INITIALS + role[:1]).index(role[:1]) + cut if role else 7 + cut, "truncated" if cut else ""


def _initial(symbol: int) -> str:
    return (_INITIALS + "?")[(symbol - 1) // 2]


def _choices(symbol: int, q: int) -> list[tuple[str, int, int]]:
    """Initial, cost and next state of what may be done with a turn itself, in ASCII order."""
    found = [("D", DELETE, q)]
    if symbol:
        late = TRUNCATED * ((symbol - 1) % 2)
        if (_initial(symbol), q) in _KEEP:
            found.append(("K", late, _KEEP[_initial(symbol), q]))
        found.append(("R", REROLE + late, _NEXT[q]))
    return found


def _times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(x + b[k][j] for k, x in enumerate(row)) for j in range(4)) for row in a)


def _apply(a: Matrix, v: Vector) -> Vector:
    return tuple(min(x + y for x, y in zip(row, v)) for row in a)


UNIT: Matrix = tuple(tuple(0 if i == j else _FAR for j in range(4)) for i in range(4))


@lru_cache(maxsize=None)
def power(symbol: int, bits: int) -> Matrix:
    """The matrix of 2 ** bits turns of one symbol, insertions before each included."""
    if bits:
        half = power(symbol, bits - 1)
        return _times(half, half)
    own = [[min([c for _, c, to in _choices(symbol, q) if to == j], default=_FAR) for j in range(4)]
           for q in range(4)]
    return tuple(tuple(min(own[q][j], INSERT + own[_NEXT[q]][j], 2 * INSERT + own[_NEXT[_NEXT[q]]][j])
                       for j in range(4)) for q in range(4))


def runs_of(symbols: Iterable[int]) -> list[tuple[int, int]]:
    return [(symbol, sum(1 for _ in same)) for symbol, same in groupby(symbols)]


def before_run(symbol: int, k: int, after: Vector) -> Vector:
    """What is left to pay before a run, by state, given what is left behind it."""
    for bits in range(k.bit_length()):
        if k >> bits & 1:
            after = _apply(power(symbol, bits), after)
    return after


def matrix_of(runs: list[tuple[int, int]]) -> Matrix:
    """The matrix of some runs in a row."""
    rows = [[_FAR] * 4 for _ in range(4)]
    for j in range(4):
        v: Vector = tuple(0 if i == j else _FAR for i in range(4))
        for symbol, k in reversed(runs):
            v = before_run(symbol, k, v)
        for i in range(4):
            rows[i][j] = v[i]
    return tuple(tuple(min(x, _FAR) for x in row) for row in rows)


def _walk_turn(symbol: int, q: int, after: Vector, edits: list[tuple[str, int]]) -> int:
    here = _apply(power(symbol, 0), after)
    while True:
        delete, *others = _choices(symbol, q)
        insert = ("I", INSERT, _NEXT[q])
        for name, cost, to in (delete, insert, *others):
            if cost + (here if name == "I" else after)[to] == here[q]:
                break
        edits.append((name, to))
        q = to
        if name != "I":
            return q


def _walk_run(symbol: int, k: int, q: int, after: Vector, edits: list[tuple[str, int]]) -> int:
    """Unrolls a run: its later part is the largest power of two below its length."""
    if k == 1:
        return _walk_turn(symbol, q, after, edits)
    bits = (k - 1).bit_length() - 1
    q = _walk_run(symbol, k - (1 << bits), q, _apply(power(symbol, bits), after), edits)
    return _walk_run(symbol, 1 << bits, q, after, edits)


def unrolled(runs: list[tuple[int, int]], q: int, after: Vector, last: bool) -> tuple[list[tuple[str, int]], int]:
    """The edits (initial, state after) of some runs and the state behind them; with ``last`` also
    those behind the last turn."""
    behind = [after]
    for symbol, k in reversed(runs):
        behind.append(before_run(symbol, k, behind[-1]))
    edits: list[tuple[str, int]] = []
    for (symbol, k), after_run in zip(runs, reversed(behind[:-1])):
        q = _walk_run(symbol, k, q, after_run, edits)
    while last and _END[q]:
        q = _NEXT[q]
        edits.append(("I", q))
    return edits, q


def repaired(rows: list[tuple[str, str]], edits: list[tuple[str, int]]) -> Iterator[tuple[str, str, str]]:
    """Edit, role and text of each turn that stays or is put in."""
    at = iter(rows)
    for name, state in edits:
        role, text = (None, "") if name == "I" else next(at)
        if name != "D":
            yield name, role if name == "K" else _ROLES[state], text


@dataclass
class Facts:
    """What is counted over turns in order; two stretches can be put together."""

    rows: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str | None = None
    last: str | None = None
    turns: int = 0
    low: int | None = None
    high: int | None = None

    @classmethod
    def of(cls, rows: list[tuple[int | None, str, str]], faults: list[str]) -> "Facts":
        initials = [role[:1] for _, role, _ in rows]
        turns = [turn for turn, _, _ in rows if turn is not None]
        return cls(len(rows), *(faults.count(name) for name in ("blank", "duplicate", "truncated")),
                   sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:])),
                   initials[0] if rows else None, initials[-1] if rows else None,
                   len(set(turns)), min(turns, default=None), max(turns, default=None))

    def then(self, more: "Facts") -> "Facts":
        """These turns and, in order of turn, some after them."""
        if not more.rows or not self.rows:
            return self if self.rows else more
        both = self.high is not None and more.low is not None
        return Facts(self.rows + more.rows, self.blank + more.blank, self.duplicate + more.duplicate,
                     self.truncated + more.truncated,
                     self.illegal + more.illegal + (self.last + more.first not in _LEGAL),
                     self.first, more.last, self.turns + more.turns - (both and self.high == more.low),
                     self.low if self.low is not None else more.low,
                     more.high if more.high is not None else self.high)

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns

    def counts(self) -> tuple[int, ...]:
        return self.gaps, self.blank, self.duplicate, self.truncated, self.illegal


# --- rows -----------------------------------------------------------------------------------------

def damaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, gone): the rows as the test of the repair damages them, by the crc32 of
    ``conversation:turn``; a dropped row stays as a mark that its conversation exists.

    A null role or text, and a null in the crc's text, is one space. Other columns are not read.
    """
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank(conv_col), F.lit(":"), blank(turn_col)).cast("binary")) % 20
    rows = conversations.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"), blank(role_col).alias("role"),
        blank(text_col).alias("text"), kind.cast("int").alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", _STOPS, "")).otherwise(
        F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        "conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), (F.col("kind") == 0).alias("gone"), F.explode(copies).alias("copy")).drop("copy")


_COUNTS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"


def _schema(conv: T.DataType, ddl: str) -> T.StructType:
    return T.StructType([T.StructField("conv", conv), *T.StructType.fromDDL(ddl)])


class _Out:
    """Rows gathered into batches of bounded size."""

    def __init__(self, schema: T.StructType, text_at: int | None = None):
        self.schema = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema])
        self.text_at, self.rows, self.held = text_at, [], 0

    def add(self, row: tuple) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.held += 100 + (len(row[self.text_at] or "") if self.text_at is not None else 0)
        if self.held > 1 << 22:
            yield self.batch()

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [[] for _ in self.schema]
        self.rows, self.held = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)],
                                          schema=self.schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            yield from zip(*(c.slice(at, 1024).to_pylist() for c in batch.columns))


def _joined(turns: Iterable[tuple[str, str, str]]) -> str:
    return "\n".join(f"{role}:{text}" for _, role, text in turns)


#: Finished conversations (at null, audit set), repaired turns (edit set), and rows left open.
_FIRST = (f"at bigint, turn bigint, role string, text string, gone boolean, edit string, {_COUNTS}, "
          "audit string, repaired_sha256 string")


def _first_pass(rows: DataFrame, with_turns: bool) -> DataFrame:
    """Conversations inside one range, done; the rows of the others, numbered (``at``) so that
    ``at >> 12`` is a block of one conversation and blocks stand in order."""
    parts = parts_of(rows.sparkSession)
    keys = ["conv", "turn", "role", F.substring("text", 1, 64), F.xxhash64("text")]
    ranged = (rows.withColumn("_tie", F.monotonically_increasing_id())
              .repartitionByRange(parts, *keys, "_tie").drop("_tie").sortWithinPartitions(*keys))
    schema = _schema(rows.schema["conv"].dataType, _FIRST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, number = _Out(schema, 4), [TaskContext.get().partitionId() << 28, 0, 0]
        none = (None,) * 9

        def opened(held: list[tuple]) -> Iterator[pa.RecordBatch]:
            for conv, turn, role, text, gone in held:
                if number[1] == BLOCK_ROWS or number[2] > BLOCK_CHARS:
                    number[:] = number[0] + 1, 0, 0
                yield from out.add((conv, number[0] << 12 | number[1], turn, role, text, gone, *none))
                number[1], number[2] = number[1] + 1, number[2] + len(text)

        def done(conv, held: list[tuple]) -> Iterator[pa.RecordBatch]:
            kept = [(turn, role, text) for _, turn, role, text, gone in held if not gone]
            seen: set[tuple[str, str]] = set()
            symbols, faults = [], []
            for _, role, text in kept:
                symbol, fault = symbol_of(role, text, (role, text) in seen)
                seen.add((role, text))
                symbols.append(symbol)
                faults.append(fault)
            runs, left = runs_of(symbols), _END if kept else (0,) * 4
            edits, _ = unrolled(runs, 0, left, True)
            for symbol, k in reversed(runs):
                left = before_run(symbol, k, left)
            turns = list(repaired([row[1:] for row in kept], edits))
            if with_turns:
                for i, (edit, role, text) in enumerate(turns):
                    yield from out.add((conv, (number[0] << 14) + i, None, role, text, None, edit, *none[1:]))
            digest = hashlib.sha256(_joined(turns).encode("utf-8", "replace")).hexdigest()
            yield from out.add((conv, None, None, None, None, None, None, *Facts.of(kept, faults).counts(), left[0],
                                "".join(name for name, _ in edits), digest))

        first, held, size, spilled = True, [], 0, False
        for row in _rows(batches):
            if held and row[0] != held[-1][0]:
                yield from opened(held) if first or spilled else done(held[0][0], held)
                first, held, size, spilled = False, [], 0, False
                number[:] = number[0] + 1, 0, 0
            held.append(row)
            size += len(row[3])
            if len(held) >= BLOCK_ROWS or size > BLOCK_CHARS:
                yield from opened(held[:-1])
                held, size, spilled = held[-1:], 0, True
        yield from opened(held)
        yield out.batch()

    return ranged.select("conv", "turn", "role", "text", "gone").mapInArrow(run, schema)


# --- conversations left open ------------------------------------------------------------------------

_BLOCK = ("block bigint, runs array<struct<symbol:int,k:int>>, matrix array<bigint>, n bigint, blank bigint, "
          "duplicate bigint, truncated bigint, illegal bigint, first string, last string, turns bigint, "
          "low bigint, high bigint")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of each block, from rows sorted by ``at`` (their second column)."""
    for block, rows in groupby(_rows(batches), lambda row: row[1] >> 12):
        yield block, list(rows)


def _block_facts(rows: DataFrame) -> DataFrame:
    schema = _schema(rows.schema["conv"].dataType, _BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(schema)
        for block, held in _blocks(batches):
            kept = [(turn, role, text) for _, _, turn, role, text, gone, _ in held if not gone]
            marks = [symbol_of(role, text, seen) for _, _, _, role, text, gone, seen in held if not gone]
            runs, facts = runs_of(symbol for symbol, _ in marks), Facts.of(kept, [fault for _, fault in marks])
            matrix = [x for line in (matrix_of(runs) if runs else UNIT) for x in line]
            yield from out.add((held[0][0], block, [{"symbol": s, "k": k} for s, k in runs], matrix,
                                *vars(facts).values()))
        yield out.batch()

    return rows.mapInArrow(run, schema)


def _carried_back(blocks: DataFrame) -> DataFrame:
    """From blocks in falling order, what is left to pay behind each, and one row a conversation
    (block null) with its counts and cost."""
    schema = _schema(blocks.schema["conv"].dataType, f"block bigint, after array<bigint>, ends boolean, {_COUNTS}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(schema)
        for conv, own in groupby(_rows(batches), lambda row: row[0]):
            facts, left, ends = Facts(), None, True
            for _, block, matrix, *counts in own:
                now = Facts(*counts)
                if left is None and now.rows:
                    left = _END
                yield from out.add((conv, block, list(left or (0,) * 4), bool(ends and now.rows), *(None,) * 6))
                ends, facts = ends and not now.rows, now.then(facts)
                if left is not None:
                    left = _apply([matrix[i:i + 4] for i in range(0, 16, 4)], left)
            yield from out.add((conv, None, None, None, *facts.counts(), left[0] if left else 0))
        yield out.batch()

    return blocks.mapInArrow(run, schema)


def _carried_on(blocks: DataFrame) -> DataFrame:
    """From blocks in order, each with the state behind it by the state before it, that state."""
    schema = _schema(blocks.schema["conv"].dataType, "block bigint, state int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(schema)
        for conv, own in groupby(_rows(batches), lambda row: row[0]):
            q = 0
            for _, block, states in own:
                yield from out.add((conv, block, q))
                q = states[q]
        yield out.batch()

    return blocks.mapInArrow(run, schema)


def _states_behind(blocks: DataFrame) -> DataFrame:
    """Adds to each block the state behind it, for each state before it."""
    schema = _schema(blocks.schema["conv"].dataType, "block bigint, states array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(schema)
        for conv, block, runs, after in _rows(batches):
            runs = [(run["symbol"], run["k"]) for run in runs]
            # A state from which nothing can be paid is never met.
            yield from out.add((conv, block, [unrolled(runs, q, tuple(after), False)[1] for q in range(4)]))
        yield out.batch()

    return blocks.select("conv", "block", "runs", "after").mapInArrow(run, schema)


def _unrolled_blocks(rows: DataFrame, with_turns: bool) -> DataFrame:
    """The repaired turns of each block as one text, with its audit and, if wanted, each turn.

    A turn has two insertions before it at most, so a block's turns stay below 1 << 14.
    """
    schema = _schema(rows.schema["conv"].dataType,
                     "at bigint, role string, text string, edit string, audit string, n int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(schema, 3)
        for block, held in _blocks(batches):
            conv, (state, after, ends) = held[0][0], held[0][7:]
            kept = [(role, text) for _, _, _, role, text, gone, _, *_ in held if not gone]
            symbols = [symbol_of(role, text, seen)[0] for _, _, _, role, text, gone, seen, *_ in held if not gone]
            edits, _ = unrolled(runs_of(symbols), state, tuple(after), ends)
            turns = list(repaired(kept, edits))
            yield from out.add((conv, block << 14, None, _joined(turns), None, "".join(e for e, _ in edits), len(turns)))
            for i, (edit, role, text) in enumerate(turns if with_turns else ()):
                yield from out.add((conv, (block << 14) + i, role, text, edit, None, None))
        yield out.batch()

    return rows.mapInArrow(run, schema)


def _digests(blocks: DataFrame) -> DataFrame:
    """From the repaired blocks of conversations in order, audit and digest."""
    schema = _schema(blocks.schema["conv"].dataType, "audit string, repaired_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(schema)
        for conv, own in groupby(_rows(batches), lambda row: row[0]):
            digest, audits, begun = hashlib.sha256(), [], False
            for _, _, text, audit, n in own:
                audits.append(audit)
                if n:
                    digest.update((b"\n" if begun else b"") + text.encode("utf-8", "replace"))
                    begun = True
            yield from out.add((conv, "".join(audits), digest.hexdigest()))
        yield out.batch()

    return blocks.select("conv", "at", "text", "audit", "n").mapInArrow(run, schema)


def _open(rows: DataFrame, with_turns: bool) -> tuple[DataFrame, DataFrame]:
    """Summary and repaired turns of the conversations left open."""
    parts = parts_of(rows.sparkSession)
    # Where each role and text stands first in its conversation.
    text = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    firsts = rows.where("not gone").groupBy("conv", text.alias("same")).agg(F.min("at").alias("at")).select(
        "at", F.lit(False).alias("later"))
    rows = stored(rows.join(firsts, "at", "left").select(
        "conv", "at", "turn", "role", "text", "gone", F.coalesce("later", F.lit(True)).alias("seen")),
        "conversation_open")
    block: Column = F.shiftright("at", 12)
    by_block = rows.repartition(parts, block).sortWithinPartitions("at")
    facts = stored(_block_facts(by_block), "conversation_blocks")
    backward = facts.drop("runs").repartition(parts, "conv").sortWithinPartitions("conv", F.desc("block"))
    back = stored(_carried_back(backward), "conversation_back")
    left = back.where("block is not null").select(F.col("block").alias("b"), "after", "ends")
    behind = _states_behind(facts.join(left, facts.block == left.b))
    on = _carried_on(behind.repartition(parts, "conv").sortWithinPartitions("conv", "block"))
    state = stored(on.select(F.col("block").alias("b2"), "state"), "conversation_states")
    placed = rows.join(state.join(left, state.b2 == left.b), block == F.col("b2")).select(
        "conv", "at", "turn", "role", "text", "gone", "seen", "state", "after", "ends")
    made = stored(_unrolled_blocks(placed.repartition(parts, block).sortWithinPartitions("at"), with_turns),
                  "conversation_made")
    digests = _digests(made.where("n is not null").repartition(parts, "conv").sortWithinPartitions("conv", "at"))
    totals = back.where("block is null").drop("block", "after", "ends").withColumnRenamed("conv", "c")
    summary = digests.join(totals, F.col("conv").eqNullSafe(F.col("c"))).drop("c")
    return summary, made.where("n is null").select("conv", "at", "edit", "role", "text")


_SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repair(rows: DataFrame, with_turns: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """A summary of each conversation, and with ``with_turns`` its repaired turns.

    ``rows`` are (conv, turn, role, text, gone) without nulls in role, text and gone, as ``damaged``
    gives them; rows that are gone only say that their conversation exists. Turns stand by number
    (null first), rows of one number by role and text (its first 64 characters, then its hash).
    The summary has gaps, faults (each turn's first: blank, duplicate, truncated), illegal
    neighbours, cost, audit and the SHA-256 of the repaired ``role:text`` lines; no turns give
    zeros, an empty audit and the hash of no text. Rows without a conversation id are one conversation.
    The repaired turns are (conv, at, edit, role, text), in order of ``at``.
    """
    first = stored(_first_pass(rows, with_turns), "conversation_first")
    summary, turns = _open(first.where("at is not null and edit is null").select(
        "conv", "at", "turn", "role", "text", "gone"), with_turns)
    done = first.where("at is null").select("conv", *_SUMMARY)
    summary = done.unionByName(summary.select("conv", *_SUMMARY))
    if not with_turns:
        return summary, None
    return summary, turns.unionByName(first.where("edit is not null").select("conv", "at", "edit", "role", "text"))


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    summary, _ = repair(damaged(table(spark, sf_dir, "conversations")))
    return summary.withColumnRenamed("conv", "conv_id")


def _op13_sql() -> str:
    """The same costs turn by turn from the last one on, each state with its cheapest, then least audit."""
    line = "{role} || ':' || {text} || CASE WHEN {rest} = '' THEN '' ELSE chr(10) || {rest} END"
    pay = "{{'c': {s}.c + {cost}, 'a': '{edit}' || {s}.a, 't': {t}}}"
    far = "{'c': 1000000, 'a': '', 't': ''}"

    def put(state: str, edit: str, cost: str, role: str, text: str) -> str:
        return pay.format(s=state, cost=cost, edit=edit, t=line.format(role=role, text=text, rest=f"{state}.t"))

    def own(q: int) -> str:
        keeps = [(i, to) for (i, at), to in _KEEP.items() if at == q]
        keep = " ".join(f"WHEN initial = '{i}' THEN {put(f's{to}', 'K', 'late', 'role', 'text')}" for i, to in keeps)
        to = _NEXT[q]
        rerole = put(f"s{to}", "R", f"{REROLE} + late", f"'{_ROLES[to]}'", "text")
        delete = pay.format(s=f"s{q}", cost=DELETE, edit="D", t=f"s{q}.t")
        return (f"least({delete}, CASE WHEN must THEN {far} {keep} ELSE {far} END, "
                f"CASE WHEN must THEN {far} ELSE {rerole} END) AS b{q}")

    def inserted(q: int, state: str) -> str:
        return put(state, "I", str(INSERT), f"'{_ROLES[q]}'", "''")

    once = [f"{inserted(_NEXT[q], f'b{_NEXT[q]}')} AS i{q}" for q in range(4)]
    whole = [f"least(b{q}, i{q}, {inserted(_NEXT[q], f'i{_NEXT[q]}')}) AS s{q}" for q in range(4)]
    end = ("{'c': 0, 'a': '', 't': ''} AS s0, {'c': 6, 'a': 'II', 't': 'user:' || chr(10) || 'assistant:'} AS s1, "
           "{'c': 3, 'a': 'I', 't': 'assistant:'} AS s2, {'c': 0, 'a': '', 't': ''} AS s3")
    return rf"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
-- crc32 bit by bit: a byte is put in, then eight shifts (-1) follow.
c AS (SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(k, ''),
        lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 20 AS kind FROM k),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM c WHERE kind <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
f AS (SELECT *, role[1] AS initial, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated'
    ELSE '' END AS fault, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS prior FROM n),
r AS (SELECT conv_id, i, role, text, initial, fault IN ('blank', 'duplicate') AS must,
    CASE WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END AS late FROM f),
g AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (prior IS NOT NULL AND prior || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
w AS (SELECT conv_id, n + 1 AS i, {end} FROM g
    UNION ALL SELECT conv_id, i, {', '.join(whole)} FROM (SELECT *, {', '.join(once)} FROM (
        SELECT r.conv_id, r.i, {', '.join(own(q) for q in range(4))}
        FROM w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i - 1)))
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
    coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
    CAST(coalesce(w.s0.c, 0) AS BIGINT) AS cost, coalesce(w.s0.a, '') AS audit,
    sha256(coalesce(w.s0.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM o.conv_id AND w.i = 1"""


OP13_SQL = _op13_sql()
