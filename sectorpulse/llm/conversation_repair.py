"""Repair of conversation structure by a run-length dynamic program.

A repaired conversation reads, by the initials of its roles, as ``(s?(ua)+)?``:
an automaton with the states start, after s, after u and after a. Every row is
kept (0), given the role that fits (3) or deleted (4); empty turns are inserted
anywhere (3 each). Blank rows and repeats must be deleted, a truncated row that
stays costs 3 more.

What a row can do depends on its symbol alone: must it go, and if not, its
initial and whether it is truncated. The symbol's effect is a min-plus matrix
over the four states, insertions before the row included. Equal consecutive
symbols are collapsed to runs, and a run of any length is advanced through the
binary powers of its symbol's matrix, which a worker computes once. The costs to
the end at the borders of the runs come from one such sweep backward; a forward
walk then takes at each place the edit with the least letter that still reaches
the least cost (every edit leads to one state, so this gives the ASCII-least
audit). Inside a long run the costs are filled in for ``STEP`` rows at a time.

Rows travel by conversation in one sort: first each conversation's symbols, then
its texts, so a task holds the runs and the audit of one conversation and streams
the texts through its digest; no text is collected. The digest of a conversation
reads its rows in order, so one conversation is one task's work.

Defined cases: a null role or text counts as one space; a null turn comes before
all others and rows of one turn are ordered by role and text, repeats adjacent; a
null conversation id is an id of its own; a role that is empty can't be kept;
an empty table gives no rows; extra columns are ignored; numbers are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_width

BLANKS = " \t\n\x0b\x0c\r"     # space and U+0009 to U+000D (fixed values)
# Costs of the edits (fixed values).
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, AFTER_S, AFTER_U, AFTER_A = range(4)
ACCEPTING = (START, AFTER_A)
GO = "D"                 # symbol of a row that must be deleted; others are initial + "." or "!"
STEP = 1024
INF = 1 << 60
IDENTITY = tuple(tuple(0 if p == q else INF for q in range(4)) for p in range(4))


# ------------------------------------------------------------------ the automaton

def _after(state: int, initial: str) -> int | None:
    """State after a turn with this initial, None if it does not fit."""
    if initial == "u":
        return AFTER_U if state != AFTER_U else None
    if initial == "a":
        return AFTER_A if state == AFTER_U else None
    return AFTER_S if initial == "s" and state == START else None


def _fitting(state: int) -> str:
    """The role that a relabelled or inserted turn takes here: only one fits."""
    return "assistant" if state == AFTER_U else "user"


@lru_cache(maxsize=None)
def edits(symbol: str, state: int) -> tuple[tuple[str, int, int], ...]:
    """(letter, cost, next state) of a row's edits from a state, by letter."""
    out = [("D", DELETE, state)]
    if symbol != GO:
        more = TRUNCATED if symbol[1] == "!" else 0
        kept = _after(state, symbol[0])
        if kept is not None:
            out.append(("K", more, kept))
        out.append(("R", REROLE + more, _after(state, _fitting(state)[0])))
    return tuple(out)


def _times(a: tuple, b: tuple) -> tuple:
    """Min-plus product."""
    return tuple(tuple(min(min(a[p][k] + b[k][q] for k in range(4)), INF) for q in range(4)) for p in range(4))


def _apply(a: tuple, v: tuple) -> tuple:
    return tuple(min(min(a[p][q] + v[q] for q in range(4)), INF) for p in range(4))


def _insertions() -> tuple:
    """Least cost from state to state by insertions alone."""
    one = [list(row) for row in IDENTITY]
    for p in range(4):
        one[p][_after(p, _fitting(p)[0])] = INSERT
    step = tuple(map(tuple, one))
    return _times(step, _times(step, step))


INSERTIONS = _insertions()
AT_END = _apply(INSERTIONS, tuple(0 if q in ACCEPTING else INF for q in range(4)))


@lru_cache(maxsize=None)
def power(symbol: str, exponent: int) -> tuple:
    """Matrix of 2**exponent rows of one symbol."""
    if exponent:
        half = power(symbol, exponent - 1)
        return _times(half, half)
    own = [[INF] * 4 for _ in range(4)]
    for p in range(4):
        for _, cost, q in edits(symbol, p):
            own[p][q] = min(own[p][q], cost)
    return _times(INSERTIONS, tuple(map(tuple, own)))


def advance(symbol: str, length: int, behind: tuple) -> tuple:
    """Costs to the end before ``length`` rows of a symbol, from those behind them."""
    for exponent in range(length.bit_length()):
        if length >> exponent & 1:
            behind = _apply(power(symbol, exponent), behind)
    return behind


# ------------------------------------------------------------------ one conversation

def collapse(symbols: Iterator[str]) -> list[list]:
    """Runs [symbol, length]."""
    runs: list[list] = []
    for symbol in symbols:
        if runs and runs[-1][0] == symbol:
            runs[-1][1] += 1
        else:
            runs.append([symbol, 1])
    return runs


def solve(runs: list[list]) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair, the ASCII-least of its audits."""
    borders = [AT_END]
    for symbol, length in reversed(runs):
        borders.append(advance(symbol, length, borders[-1]))
    borders.reverse()
    state, audit = START, []
    for (symbol, length), behind in zip(runs, borders[1:]):
        left = length
        while left:
            block = min(STEP, left)
            ahead = [advance(symbol, left - block, behind)]
            for _ in range(block):
                ahead.append(_apply(power(symbol, 0), ahead[-1]))
            for at in range(block, 0, -1):
                state = _walk(symbol, state, ahead[at], ahead[at - 1], audit)
            left -= block
    while state not in ACCEPTING or AT_END[state]:
        audit.append("I")
        state = _after(state, _fitting(state)[0])
    return borders[0][START], "".join(audit)


def _walk(symbol: str, state: int, before: tuple, behind: tuple, audit: list[str]) -> int:
    """Edits up to and with one row; returns the state behind it."""
    while True:
        cost = before[state]
        inserted = _after(state, _fitting(state)[0])
        options = [(letter, spent + behind[q], q) for letter, spent, q in edits(symbol, state)]
        options.append(("I", INSERT + before[inserted], inserted))
        letter, _, state = min((o for o in options if o[1] == cost), key=lambda o: o[0])
        audit.append(letter)
        if letter != "I":
            return state


class Reading:
    """Digest of a repaired conversation; rows come in order after the audit is known."""

    def __init__(self, audit: str):
        self.edits, self.state = iter(audit), START
        self.digest, self.first = hashlib.sha256(), True

    def _write(self, role: str, text: str) -> None:
        self.digest.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.first = False
        self.state = _after(self.state, role[:1])

    def row(self, role: str | None, text: str | None) -> None:
        for letter in self.edits:
            if letter == "K":
                self._write(role, text)
            elif letter != "D":
                self._write(_fitting(self.state), text if letter == "R" else "")
            if letter != "I":
                return

    def end(self) -> str:
        for _ in self.edits:
            self._write(_fitting(self.state), "")
        return self.digest.hexdigest()


# ------------------------------------------------------------------ rows

def _filled(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) after the contract's damage, with ``copy`` 0 or 1."""
    kind = F.pmod(F.crc32(F.concat(_filled("conv_id"), F.lit(":"), _filled("turn")).cast("binary")), F.lit(20))
    hurt = rows.select("conv_id", "turn", _filled("role").alias("role"), _filled("text").alias("text"), kind.alias("__kind"))
    hurt = hurt.where("__kind <> 0").withColumns({
        "text": F.when(F.col("__kind") == 1, F.lit("")).when(
            F.col("__kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")),
        "role": F.when(F.col("__kind") == 4, F.lit("user")).otherwise(F.col("role"))})
    copies = F.when(F.col("__kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return hurt.withColumn("copy", F.explode(copies)).drop("__kind")


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` with their first fault: blank, duplicate, truncated or null. A repeat is
    found by a window over the rows of one conversation, role and text, so rows are
    dealt by text and not by conversation."""
    earlier = Window.partitionBy("conv_id", "role", F.sha2("text", 256)).orderBy(F.col("turn").asc_nulls_first(), "copy")
    bare = F.rtrim("text", F.lit(BLANKS))
    return rows.withColumn("fault", F.when(bare == "", "blank").when(
        F.row_number().over(earlier) > 1, "duplicate").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated"))


def repair(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every
    conversation of ``ids`` (conv_id); ``rows`` are (conv_id, turn, role, text, copy, fault)."""
    kind = ids.schema["conv_id"].dataType
    initial = F.substring("role", 1, 1)
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), F.lit(GO)).otherwise(
        F.concat(F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("-")),
                 F.when(F.col("fault") == "truncated", F.lit("!")).otherwise(F.lit("."))))
    order = ["turn", "role", "text", "copy"]
    marked = rows.select("conv_id", *order, initial.alias("initial"), "fault", symbol.alias("symbol"))
    none = F.lit(None).cast("string")
    everyone = ids.select("conv_id").unionByName(rows.select("conv_id")).distinct()
    # Pass -1 names the conversation, pass 0 brings its symbols, pass 1 its texts. The texts sort with
    # both, so that equal turns come in one order; only pass 1 sends them on.
    both = (marked.withColumn("pass", F.explode(F.array(F.lit(0), F.lit(1))))
                  .unionByName(everyone.select(
                      "conv_id", *[F.lit(None).cast(marked.schema[c].dataType).alias(c) for c in order],
                      none.alias("initial"), none.alias("fault"), none.alias("symbol"), F.lit(-1).alias("pass"))))
    dealt = (both.repartition(shuffle_width(rows.sparkSession), "conv_id")
                 .sortWithinPartitions("conv_id", "pass", F.col("turn").asc_nulls_first(), "role", "text", "copy")
                 .select("conv_id", "pass", "initial", "fault", "symbol", F.col("turn").cast("long").alias("turn"),
                         F.when(F.col("pass") == 1, F.col("role")).alias("role"),
                         F.when(F.col("pass") == 1, F.col("text")).alias("text")))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = (f"conv_id {kind.simpleString()}, " + ", ".join(f"{c} long" for c in counts)
              + ", audit string, repaired_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Conversation | None = None
        for batch in batches:
            done = []
            ids_ = batch.column(0)
            columns = [batch.column(i).to_pylist() for i in range(1, batch.num_columns)]
            for i, (step, initial, fault, symbol, turn, role, text) in enumerate(zip(*columns)):
                if step == -1:
                    if held is not None:
                        done.append(held)
                    held = _Conversation(ids_.slice(i, 1))
                elif step == 0:
                    held.symbol(symbol, initial, fault, turn)
                else:
                    held.text(role, text)
            if done:
                yield _batch(done)
        if held is not None:
            yield _batch([held])

    def _batch(done: list[_Conversation]) -> pa.RecordBatch:
        made = [c.result() for c in done]
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([c.id for c in done]),
             *(pa.array([m[i] for m in made], pa.int64() if i < 6 else pa.string()) for i in range(8))],
            names=["conv_id", *counts, "audit", "repaired_sha256"])

    return dealt.mapInArrow(run, schema)


class _Conversation:
    """What a task holds of one conversation: counts, runs, then the reading of its texts."""

    def __init__(self, own: pa.Array):
        self.id = own
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.runs = 0, []
        self.before: str | None = None
        self.low = self.high = self.turn = None
        self.turns = 0
        self.cost, self.audit = 0, ""
        self.reading: Reading | None = None

    def symbol(self, symbol: str, initial: str, fault: str | None, turn: int | None) -> None:
        if fault is not None:
            self.counts[fault] += 1
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if turn is not None and turn != self.turn:       # turns come in order
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
            self.turns += 1
        if self.runs and self.runs[-1][0] == symbol:
            self.runs[-1][1] += 1
        else:
            self.runs.append([symbol, 1])

    def _start(self) -> None:
        if self.reading is None:
            self.cost, self.audit = solve(self.runs)
            self.reading = Reading(self.audit)

    def text(self, role: str, text: str) -> None:
        self._start()
        self.reading.row(role, text)

    def result(self) -> tuple:
        self._start()
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (gaps, self.counts["blank"], self.counts["duplicate"], self.counts["truncated"], self.illegal,
                self.cost, self.audit, self.reading.end())
