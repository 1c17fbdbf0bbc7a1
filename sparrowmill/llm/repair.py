"""Conversation structure repair: a dynamic program over secondary-sorted rows, streamed in Arrow batches.

The rows of a conversation arrive in the order of their turns. The program keeps, for each state of the
grammar `(s?(ua)+)?` of role initials, the cheapest edits that lead there, and writes one small number per
row: how every state was reached. At the end of the conversation these numbers are read backwards for the
edits, and the texts forwards for the repaired conversation. Both wait in memory as long as they are short
and in a file of the task beyond that, so a giant conversation needs a bounded state per task; only its
result cell, the edits of all rows, grows with it.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
STOPS = ".!?"

KEEP, REROLE, DELETE, INSERT = "KRDI"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
FAULTS = ("", "truncated", "blank", "duplicate")

#: The grammar: state -> initial -> next state. 0 nothing yet, 1 system read, 2 user read, 3 assistant read.
MOVES = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
#: Insertions that complete each state; none of the two others is an end.
ENDING = {0: 0, 1: 2, 2: 1, 3: 0}
#: From any state every other one is at most this much dearer to complete (an insertion and a deletion).
SLACK = INSERT_COST + DELETE_COST

SPILL_BYTES = 1 << 20
_STEPS_READ = 1 << 16


def _after_insertions(state: int):
    """States reached by 0, 1 and 2 insertions; the grammar leaves no choice of the role."""
    for count in range(3):
        yield count, state
        state = MOVES[state]["a" if state == 2 else "u"]


class Program:
    """The dynamic program as an automaton made on demand.

    A situation lists, for the states that can still win, the cost above the cheapest and the rank of the
    edits in ASCII order. Costs further than SLACK above the cheapest cannot win, so there are few
    situations and each step is one lookup. Edits that read the same rows and end in one of K, R, D are
    never prefixes of each other, so their rank decides every later comparison.
    """

    start = ((0, 0, 0),)

    def __init__(self):
        self.steps: list[dict] = []  # per step: state -> (state before, edits)
        self.known: dict = {}

    def step(self, situation, initial: str, fault: str):
        """(next situation, cost, number of the step) for one row."""
        key = situation, initial if initial in MOVES[0] or initial == "a" else "", fault
        if key not in self.known:
            self.known[key] = self._make(*key)
        return self.known[key]

    def _make(self, situation, initial, fault):
        must_go = fault in ("blank", "duplicate")
        extra = TRUNCATED_COST if fault == "truncated" else 0
        best: dict[int, tuple] = {}
        for state, cost, rank in situation:
            for count, at in _after_insertions(state):
                spent, edits = cost + count * INSERT_COST, INSERT * count
                found = [(at, spent + DELETE_COST, edits + DELETE)]
                if not must_go:
                    if initial in MOVES[at]:
                        found.append((MOVES[at][initial], spent + extra, edits + KEEP))
                    found += [(MOVES[at][r], spent + extra + REROLE_COST, edits + REROLE) for r in "ua" if r in MOVES[at]]
                for to, total, made in found:
                    best[to] = min(best.get(to, (total, rank, made, state)), (total, rank, made, state))
        least = min(v[0] for v in best.values())
        best = {to: v for to, v in best.items() if v[0] <= least + SLACK}
        order = {edits: n for n, edits in enumerate(sorted({v[1:3] for v in best.values()}))}
        self.steps.append({to: (v[3], v[2]) for to, v in best.items()})
        after = tuple((to, best[to][0] - least, order[best[to][1:3]]) for to in sorted(best))
        return after, least, len(self.steps) - 1

    @staticmethod
    def finish(situation) -> tuple[int, int, str]:
        """(cost, state, edits) of the cheapest end."""
        ends = [(cost + ENDING[q] * INSERT_COST, rank, INSERT * ENDING[q], q) for q, cost, rank in situation]
        cost, _, edits, state = min(ends)
        return cost, state, edits


@cache
def program() -> Program:
    """One automaton per Python worker."""
    return Program()


class Conversation:
    """State of one conversation while its rows stream by."""

    def __init__(self, conv_id):
        self.conv_id, self.cost, self.rows = conv_id, 0, 0
        self.situation = Program.start
        self.counts = dict.fromkeys(FAULTS, 0)
        self.illegal, self.initial = 0, None
        self.turns, self.first, self.last = 0, None, None
        self.steps = tempfile.SpooledTemporaryFile(SPILL_BYTES)
        self.texts = tempfile.SpooledTemporaryFile(SPILL_BYTES)

    def add(self, turn, role: str, text: str, repeats: bool) -> None:
        self.rows += 1
        if turn is not None and turn != self.last:
            self.turns, self.last = self.turns + 1, turn
            self.first = turn if self.first is None else self.first
        body, initial = text.rstrip(SPACES), role[:1]
        fault = "blank" if not body else "duplicate" if repeats else "" if body[-1] in STOPS else "truncated"
        self.counts[fault] += 1
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        self.situation, cost, step = program().step(self.situation, initial, fault)
        self.cost += cost
        self.steps.write(struct.pack("<I", step))
        for part in (role.encode(), text.encode()):
            self.texts.write(struct.pack("<I", len(part)))
            self.texts.write(part)

    def _edits(self) -> tuple[int, str]:
        """Cost and edits, from the steps read backwards."""
        steps = program().steps
        cost, state, ending = Program.finish(self.situation)
        parts, end = [ending], self.rows
        while end:
            start = max(0, end - _STEPS_READ)
            self.steps.seek(4 * start)
            made = []
            for (step,) in reversed(list(struct.iter_unpack("<I", self.steps.read(4 * (end - start))))):
                state, edits = steps[step][state]
                made.append(edits)
            parts.append("".join(reversed(made)))
            end = start
        return self.cost + cost, "".join(reversed(parts))

    def _repaired(self, audit: str) -> str:
        """Digest of the repaired conversation, from the texts read forwards."""
        digest, written = hashlib.sha256(), 0
        alone = (len(audit) - audit.count(DELETE)) % 2  # a system row comes first
        self.texts.seek(0)
        read = self.texts.read
        for edit in audit:
            role = text = b""
            if edit != INSERT:
                role, text = (read(struct.unpack("<I", read(4))[0]) for _ in range(2))
            if edit == DELETE:
                continue
            if edit != KEEP:
                role = b"assistant" if (written - alone) % 2 else b"user"
            digest.update(b"\n" * (written > 0) + role + b":" + text)
            written += 1
        return digest.hexdigest()

    def result(self) -> tuple:
        cost, audit = self._edits()
        repaired = self._repaired(audit)
        self.steps.close()
        self.texts.close()
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        counts = self.counts
        return self.conv_id, gaps, counts["blank"], counts["duplicate"], counts["truncated"], self.illegal, cost, audit, repaired


RESULT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _stream(batches):
    """Conversations one after the other; a row without `there` only names its conversation."""
    held = None
    for pdf in batches:
        done = []
        for conv_id, no_conv, turn, no_turn, role, text, there, repeats in zip(
            *(pdf[c] for c in ("conv_id", "no_conv", "turn", "no_turn", "role", "text", "there", "repeats"))
        ):
            conv_id = None if no_conv else conv_id
            if held is None or held.conv_id != conv_id:
                done += [held.result()] if held else []
                held = Conversation(conv_id)
            if there:
                held.add(None if no_turn else turn, role, text, repeats)
        yield pd.DataFrame(done, columns=RESULT).astype({"conv_id": object})
    if held:
        yield pd.DataFrame([held.result()], columns=RESULT).astype({"conv_id": object})


def damaged(df: DataFrame) -> DataFrame:
    """Conversations with planted faults; a dropped row stays as a row without `there`.

    By crc32 of `conv_id:turn` modulo 20: 0 drops a row, 1 empties its text, 2 takes its stops away, 3 repeats
    it, 4 makes the user speak. Nulls are read as one space.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(space("text"), STOPS, "")).otherwise(space("text"))
    rows = df.select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(space("role")).alias("role"),
        F.when(kind == 0, "").otherwise(text).alias("text"),
        (kind != 0).alias("there"),
        F.when(kind == 3, 2).otherwise(1).alias("_times"),
    )
    times = F.sequence(F.lit(1), F.col("_times"))
    return rows.select("conv_id", "turn", "role", "text", "there", F.explode(times).alias("_time")).drop("_time")


def repair(df: DataFrame, there: Column | None = None) -> DataFrame:
    """One row per conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    `df` has conv_id, turn, role and text; rows where `there` is false take no part but name their
    conversation. Rows follow each other by turn, nulls first; rows of one turn by role and text.

    The first fault of a row counts: blank, duplicate (role and text came earlier), truncated (no stop at the
    end). Edits: keep 0, another role (user or assistant) 3, delete 4, insert an empty user or assistant row 3; 3
    more for each truncated row that stays; blank and duplicate rows must go. `audit` holds the cheapest edits
    that give role initials `(s?(ua)+)?`, the least in ASCII order among equals.

    One shuffle by conversation. Repeats are told by a window over (conversation, role, text) in the same
    partitions, then the partitions are sorted by turn and streamed. A conversation is one stream, as its
    digest asks; a giant one takes time, not memory.

    A null conv_id is a conversation; null role and text are read as one space, so such a row is blank or has an
    illegal role. A role without characters is illegal too. A conversation without rows has zeros, an empty
    audit and the digest of nothing. Extra columns are ignored; an empty table gives an empty result.
    """
    there = F.lit(True) if there is None else there
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = df.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), there.alias("there"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    same = Window.partitionBy("conv_id", "there", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    told = rows.repartition("conv_id").withColumn("repeats", F.row_number().over(same) > 1)
    ordered = told.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "repeats")
    narrow = ordered.select(
        F.coalesce("conv_id", F.lit("0").try_cast(kind)).alias("conv_id"), F.isnull("conv_id").alias("no_conv"),
        F.coalesce(F.col("turn").cast("bigint"), F.lit(0)).alias("turn"), F.isnull("turn").alias("no_turn"),
        "role", "text", "there", "repeats",
    )
    numbers = ", ".join(f"{c} bigint" for c in RESULT[1:7])
    return narrow.mapInPandas(_stream, f"conv_id {kind}, {numbers}, audit string, repaired_sha256 string")
