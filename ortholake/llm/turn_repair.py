"""Operator 12: repair of conversation structure by a square-root checkpointed edit DP.

``repair`` finds the cheapest edits that turn a conversation into ``(system? (user assistant)+)?``:
Keep a row (0), Rerole it to user or assistant (2), Delete it (3; required for blank and
duplicate rows), Insert a user or assistant turn without text anywhere (2); a truncated row that
is not deleted adds 1. Of all cheapest edit lists the one whose initials are ASCII-least is taken.

The state is what has been said last (nothing, system, user, assistant), so each state has one
next role for an inserted or reroled row. Going backward, the cost of finishing from each state is a vector of four numbers; such
vectors are kept only at every ``isqrt(n)``-th row. Walking forward, the vectors of one block are computed
again from its checkpoint, and from each state the ASCII-least edit whose cost is tight is taken. So
memory beside the rows' codes (a byte each) is of the order of the square root.

In Spark, whatever does not depend on neighbours is done where the rows lie: damage, blank and
truncated rows, and duplicates (the first row of a role and text, by a minimum that is combined
within each task). Then each conversation is one sorted stream: first a code per row, from which the
edits are found, then the rows with their texts, which pass by one at a time into the checksum. A checksum is a chain over its
conversation, so this last pass can't be split; it holds no text but the current batch, and a byte per row.

Defined results: null ids, roles and texts count as one space in keys and rows (a null
conversation id is a conversation of its own, a null turn comes first and is no turn number in
``gaps``). Rows of one turn are ordered by role, then by the MD5 of their text; repeated rows
stand together, the later ones being duplicates. A conversation that lost all rows has zeros, an
empty audit and the checksum of the empty text. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ortholake.llm.common import materialise, table

SPACES = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: Role that may follow each state, by its initial and name, and the state it leads to.
NEXT = {NONE: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
FAR = 1 << 60
#: Codes of rows: role initial (s, u, a or another) in the low two bits, then truncated, must go.
INITIALS, OTHER, CUT, MUST_GO = "sua", 3, 4, 8


def code(initial: str, must_go: bool, truncated: bool) -> int:
    return (INITIALS.index(initial) if initial and initial in INITIALS else OTHER) + CUT * truncated + MUST_GO * must_go


def kept_state(state: int, row: int) -> int | None:
    """State after the row is kept, None if it may not be."""
    initial = row & 3
    if row & MUST_GO or initial == OTHER:
        return None
    to = (SYSTEM, USER, ASSISTANT)[initial]
    return to if (to == SYSTEM and state == NONE) or (to != SYSTEM and NEXT[state][0] == to) else None


def with_inserts(v: list[int]) -> list[int]:
    """Costs once turns may be inserted first: in three steps every state has reached every other one it can."""
    for _ in range(3):
        v = [min(v[s], INSERT + v[NEXT[s][0]]) for s in range(4)]
    return v


def before(row: int, after: Sequence[int]) -> list[int]:
    """Costs from each state in front of a row, given those behind it."""
    extra = TRUNCATED if row & CUT else 0
    out = []
    for s in range(4):
        best = DELETE + after[s]
        if not row & MUST_GO:
            best = min(best, REROLE + extra + after[NEXT[s][0]])
            to = kept_state(s, row)
            if to is not None:
                best = min(best, extra + after[to])
        out.append(best)
    return with_inserts(out)


AT_END = with_inserts([0, FAR, FAR, 0])


class Steps:
    """``before`` with its few results remembered: vectors of equal shape differ by a constant."""

    def __init__(self):
        self.known: dict[tuple, tuple] = {}

    def __call__(self, row: int, after: Sequence[int]) -> tuple[int, ...]:
        base = min(after)
        shape = (row, *[x - base for x in after])
        if shape not in self.known:
            self.known[shape] = tuple(before(row, shape[1:]))
        return tuple(x + base for x in self.known[shape])


def repair(rows: bytes, steps: Steps | None = None) -> tuple[int, str]:
    """(cost, audit) of the rows' codes: initials of the cheapest edits, in order, ASCII-least."""
    steps = steps or Steps()
    n, size = len(rows), max(isqrt(len(rows)), 1)
    marks = {n: tuple(AT_END)}
    vector = marks[n]
    for i in range(n - 1, -1, -1):
        vector = steps(rows[i], vector)
        if i % size == 0:
            marks[i] = vector
    cost, state, audit = vector[NONE], NONE, []
    for start in range(0, n, size):
        stop = min(start + size, n)
        block = [marks[stop]]                                  # the block's vectors, last one first
        for i in range(stop - 1, start, -1):
            block.append(steps(rows[i], block[-1]))
        block.append(marks[start])
        block.reverse()
        for i in range(start, stop):
            row, here, after = rows[i], block[i - start], block[i - start + 1]
            extra = TRUNCATED if row & CUT else 0
            while True:
                left = here[state]
                if DELETE + after[state] == left:
                    audit.append("D")
                elif INSERT + here[NEXT[state][0]] == left:
                    audit.append("I")
                    state = NEXT[state][0]
                    continue
                else:
                    to = kept_state(state, row)
                    if to is not None and extra + after[to] == left:
                        audit.append("K")
                        state = to
                    else:
                        audit.append("R")
                        state = NEXT[state][0]
                break
    while state not in (NONE, ASSISTANT):
        audit.append("I")
        state = NEXT[state][0]
    return cost, "".join(audit)


# Spark ----------------------------------------------------------------------------------
def damaged(turns: DataFrame) -> DataFrame:
    """(conv, turn, role, text) after the damage that crc32 of "conversation:turn" decides."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    t = turns.select(F.col("conv_id").alias("conv"), F.col("turn"), space("role").alias("role"), space("text").alias("text"),
                     (F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20).alias("h")).filter("h != 0")
    text = F.when(F.col("h") == 1, F.lit("")).when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("h") == 4, F.lit("user")).otherwise(F.col("role"))
    return t.select("conv", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("h") == 3, 2).otherwise(1)))
                    .alias("_copy")).drop("_copy")


def _solid(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def streams(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """(conv, kind, turn, role, code, text) sorted by conversation: a row of kind 0 for every id,
    the codes of its rows (kind 1), then its rows with their texts (kind 2), in order."""
    rows = materialise(rows.withColumn("uid", F.monotonically_increasing_id()).withColumn("tie", F.md5(F.col("text").cast("binary"))), "turns")
    order = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn", "uid")
    first = rows.groupBy("conv", "role", "text").agg(F.min(order).alias("o")).select("o.uid", F.lit(True).alias("first"))
    blank = _solid(F.col("text")) == ""
    cut = ~blank & ~F.right(_solid(F.col("text")), F.lit(1)).isin(".", "!", "?")
    facts = rows.select("conv", "turn", "role", "tie", "uid", blank.alias("blank"), cut.alias("cut")).join(materialise(first, "first").hint("merge"), "uid", "left")
    copy = ~F.col("blank") & F.col("first").isNull()
    initial = F.substring("role", 1, 1)
    value = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    value = value + F.when(F.col("blank") | copy, MUST_GO).when(F.col("cut"), CUT).otherwise(0) + F.when(F.col("blank"), 16).otherwise(0)
    none = F.lit(None)
    turn, text = rows.schema["turn"].dataType, "string"
    every = ids.select("conv", F.lit(0).alias("kind"), none.cast(turn).alias("turn"), none.cast(text).alias("role"), none.cast(text).alias("tie"),
                       none.cast("long").alias("uid"), F.lit(0).alias("code"), none.cast(text).alias("text"))
    codes = facts.select("conv", F.lit(1).alias("kind"), "turn", "role", "tie", "uid", value.alias("code"), none.cast(text).alias("text"))
    texts = rows.select("conv", F.lit(2).alias("kind"), "turn", "role", "tie", "uid", F.lit(0).alias("code"), "text")
    whole = every.unionByName(codes).unionByName(texts).repartition("conv")
    return whole.sortWithinPartitions("conv", "kind", F.col("turn").asc_nulls_first(), "role", "tie", "uid").select("conv", "kind", "turn", "role", "code", "text")


class Conversation:
    """What is known of the conversation that streams by."""

    def __init__(self, conv):
        self.conv, self.codes, self.blank, self.turns, self.low, self.high = conv, bytearray(), 0, 0, None, None
        self.audit = None
        self.sha, self.lines, self.at, self.state = hashlib.sha256(), 0, 0, NONE

    def add_code(self, turn, value: int) -> None:
        self.blank += value >> 4
        self.codes.append(value & 15)
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn

    def line(self, role: str, text: str) -> None:
        self.sha.update(("\n" * (self.lines > 0) + f"{role}:{text}").encode())
        self.lines += 1

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state, role = NEXT[self.state]
            self.line(role, "")
            self.at += 1

    def add_row(self, steps: Steps, role: str, text: str) -> None:
        self.solve(steps)
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = (SYSTEM, USER, ASSISTANT)[INITIALS.index(role[0])]
            self.line(role, text)
        elif edit == "R":
            self.state, role = NEXT[self.state]
            self.line(role, text)

    def solve(self, steps: Steps) -> None:
        if self.audit is None:
            self.cost, self.audit = repair(bytes(self.codes), steps)

    def result(self, steps: Steps) -> tuple:
        self.solve(steps)
        self.inserts()
        gone = sum(x >= MUST_GO for x in self.codes)
        allowed = {(0, 1), (1, 2), (2, 1)}
        pairs = zip(self.codes, self.codes[1:], strict=False)
        illegal = sum((a & 3, b & 3) not in allowed for a, b in pairs)
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, self.blank, gone - self.blank, sum(x & 12 == CUT for x in self.codes), illegal, self.cost, self.audit, self.sha.hexdigest())


NAMES = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repair_rows(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per id of ``ids`` (conv): the faults of its ``rows`` (conv, turn, role, text; roles
    and texts not null) and the cheapest repair."""
    kind = rows.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, now, done, conv_type = Steps(), None, [], None

        def out():
            cols = list(zip(*done, strict=True))
            types = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=NAMES)

        for b in batches:
            conv_type = b.schema.field("conv").type
            for conv, what, turn, role, value, text in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
                if what == 0:
                    if now is not None:
                        done.append(now.result(steps))
                    now = Conversation(conv)
                elif what == 1:
                    now.add_code(turn, value)
                else:
                    now.add_row(steps, role, text)
            if len(done) >= 1024:
                yield out()
                done.clear()
        if now is not None:
            done.append(now.result(steps))
            yield out()

    counts = ", ".join(f"{c} long" for c in NAMES[1:7])
    return streams(rows, ids).mapInArrow(run, f"conv {kind}, {counts}, audit string, repaired_sha256 string")


def repair_conversations(turns: DataFrame) -> DataFrame:
    """Faults and repair of a table of turns as it is (conv_id, turn, role, text)."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = turns.select(F.col("conv_id").alias("conv"), "turn", space("role"), space("text"))
    return repair_rows(rows, rows.select("conv").distinct()).withColumnRenamed("conv", "conv_id")


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    ids = turns.select(F.col("conv_id").alias("conv")).distinct()
    return repair_rows(damaged(turns), ids).withColumnRenamed("conv", "conv_id")
