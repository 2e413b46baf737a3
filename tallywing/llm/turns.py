"""Repair of conversations to a legal order of roles at the least cost of edits.

Rows are dealt by conversation and sorted by turn, and an Arrow batch iterator (``mapInArrow``) reads each conversation as a stream that may
span any number of Arrow batches. What is carried from row to row is small: for each state of the role automaton
the least cost, its place among the others in audit order, and a running hash of the text repaired so far. Costs
relative to the least are few, so a step is looked up once it was worked out. Backpointers take four bytes a row and
go to a spill file of the task beyond ``SPILL`` bytes; digests of rows seen go to sorted spill files in the same way.
A conversation of any length thus needs no more memory than its audit, which is one row of the result. A spill file
belongs to the running task, as Spark's own do: a task that runs again writes its own.

Roles leave as ``s?(ua)+`` or not at all, by initials. Edits: K keeps a row, R gives it the role user or assistant, D
deletes it, I inserts an empty row of either role. Blank rows and repeats of an earlier row have to be deleted.

Defined results: null columns count as one blank, but null turns come first and count in no gap; rows of one turn
are taken by role, then text; an empty role has no initial and is never kept; a null conversation id is one conversation; rows that repeat are rows; a conversation
without rows has zeros and no audit; an empty table gives no rows; other columns are not carried.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallywing.llm.common import free

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
FINE, BLANK, DUPLICATE, CUT = range(4)
WHITE, STOPS = " \t\n\x0b\x0c\r", ".!?"
#: Output states: nothing yet, after system, after user, after assistant.
NONE, SYSTEM, USER, ASSISTANT = range(4)
STEP = {(NONE, "s"): SYSTEM, (NONE, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEXT = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")
SPILL = 8 << 20
#: Digests in a set before they become a sorted run.
HELD = 1 << 18

SCHEMA = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def _inserted(state: int) -> list[tuple[str, int]]:
    """Inserted edits and the state behind them; more than a round of the automaton never pays."""
    out = [("", state)]
    while len(out) < 3 and NEXT[out[-1][1]] != state:
        out.append((out[-1][0] + "I", NEXT[out[-1][1]]))
    return out


@lru_cache(maxsize=1 << 16)
def step(before: tuple, initial: str, fault: int) -> tuple[int, tuple, tuple]:
    """One row. ``before``: per state (cost above the least, place in audit order), or None.

    Gives the rise of the least cost, the same tuples after the row, and per state (state before, edits).
    Edits end with the row's own letter, so none is a prefix of another and audits compare step by step.
    """
    best: dict[int, tuple] = {}
    for state, known in enumerate(before):
        if known is None:
            continue
        cost, place = known
        for edits, at in _inserted(state):
            paid = cost + INSERT * len(edits)
            ways = [(DELETE, edits + "D", at)]
            if fault not in (BLANK, DUPLICATE):
                more = TRUNCATED if fault == CUT else 0
                if (at, initial) in STEP:
                    ways.append((KEEP + more, edits + "K", STEP[at, initial]))
                ways.append((REROLE + more, edits + "R", NEXT[at]))
            for extra, audit, to in ways:
                found = (paid + extra, place, audit, state)
                if to not in best or found < best[to]:
                    best[to] = found
    least = min(b[0] for b in best.values())
    order = sorted({(b[1], b[2]) for b in best.values()})
    after = tuple((best[s][0] - least, order.index(best[s][1:3])) if s in best else None for s in range(4))
    return least, after, tuple((best[s][3], best[s][2]) if s in best else None for s in range(4))


class Spilled:
    """Bytes that are appended, and read back from the end; beyond ``SPILL`` they stand in an unnamed file."""

    def __init__(self):
        self.file = tempfile.SpooledTemporaryFile(max_size=SPILL)
        self.buffer = bytearray()
        self.size = 0

    def append(self, block: bytes) -> None:
        self.buffer += block
        self.size += len(block)
        if len(self.buffer) >= 1 << 16:
            self.file.write(self.buffer)
            self.buffer = bytearray()

    def backwards(self, width: int) -> Iterator[bytes]:
        self.file.write(self.buffer)
        self.buffer = bytearray()
        chunk, at = width << 14, self.size
        while at:
            start = max(0, at - chunk)
            self.file.seek(start)
            data = self.file.read(at - start)
            for i in range(len(data) - width, -1, -width):
                yield data[i : i + width]
            at = start

    def close(self) -> None:
        self.file.close()


class Seen:
    """Which 128-bit digests came up: a set, then sorted runs in unnamed files that are searched in place."""

    def __init__(self):
        self.now: set[bytes] = set()
        self.runs: list[np.ndarray] = []

    def add(self, digest: bytes) -> bool:
        """Whether the digest is new."""
        if digest in self.now or any(self._holds(run, digest) for run in self.runs):
            return False
        self.now.add(digest)
        if len(self.now) >= HELD:
            self._freeze()
        return True

    @staticmethod
    def _holds(run: np.ndarray, digest: bytes) -> bool:
        low, high = 0, len(run)
        while low < high:
            middle = (low + high) // 2
            if run[middle].tobytes() < digest:
                low = middle + 1
            else:
                high = middle
        return low < len(run) and run[low].tobytes() == digest

    def _freeze(self) -> None:
        runs = [sorted(self.now)]
        self.now = set()
        # Runs of like size are merged, so there are few of them however long the conversation.
        while self.runs and len(self.runs[-1]) <= 2 * sum(map(len, runs)):
            runs.append(self.runs.pop())
        total = sum(map(len, runs))
        file = tempfile.TemporaryFile()
        os.truncate(file.fileno(), 16 * total)
        merged = np.memmap(file, dtype="V16", mode="r+", shape=(total,))
        at = 0
        for digest in _merge(runs):
            merged[at] = np.void(digest)
            at += 1
        self.runs.append(merged)


def _merge(runs: list) -> Iterator[bytes]:
    import heapq

    yield from heapq.merge(*((d if isinstance(d, bytes) else d.tobytes() for d in run) for run in runs))


class Conversation:
    """What is known of one conversation while its rows stream by."""

    def __init__(self):
        self.states: tuple = ((0, 0), None, None, None)
        self.hashes: list = [hashlib.sha256(), None, None, None]
        self.empty = [True, None, None, None]
        self.base = 0
        self.back = Spilled()
        self.seen = Seen()
        self.counts = [0, 0, 0, 0]
        self.illegal = 0
        self.before: str | None = None
        self.first = self.last = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.turns += turn != self.last
            self.last = turn
        bare = text.rstrip(WHITE)
        new = self.seen.add(hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "replace"), digest_size=16).digest())
        fault = BLANK if not bare else DUPLICATE if not new else CUT if bare[-1] not in STOPS else FINE
        self.counts[fault] += 1
        initial = role[:1]
        self.illegal += self.before is not None and self.before + initial not in LEGAL
        self.before = initial
        rise, after, back = step(self.states, initial if initial in ("s", "u", "a") else "", fault)
        self.base += rise
        self._write(back, role, text)
        self.states = after

    def _write(self, back: tuple, role: str, text: str) -> None:
        """Backpointers of the row, and the hashes of what its states have repaired."""
        hashes, empty, code = [None] * 4, [None] * 4, bytearray(4)
        for state, known in enumerate(back):
            if known is None:
                continue
            origin, edits = known
            code[state] = origin | (len(edits) - 1) << 2 | "DKR".index(edits[-1]) << 4
            if edits == "D":
                hashes[state], empty[state] = self.hashes[origin], self.empty[origin]
                continue
            out, at = [], origin
            for edit in edits:
                if edit == "D":
                    continue
                at = STEP[at, role[0]] if edit == "K" else NEXT[at]
                out.append(f"{role if edit == 'K' else NAMES[at]}:{'' if edit == 'I' else text}")
            made = self.hashes[origin].copy()
            made.update((("" if self.empty[origin] else "\n") + "\n".join(out)).encode("utf-8", "replace"))
            hashes[state], empty[state] = made, False
        self.hashes, self.empty = hashes, empty
        self.back.append(bytes(code))

    def end(self) -> tuple:
        """Columns of the result."""
        ways = []
        for state, known in enumerate(self.states):
            if known is not None:
                # The end stands after an assistant's row, or after nothing.
                for edits, at in _inserted(state):
                    if at in (NONE, ASSISTANT):
                        ways.append((known[0] + INSERT * len(edits), known[1], edits, state))
        cost, _, edits, state = min(ways)
        made, at, out = self.hashes[state], state, []
        for i in range(len(edits)):
            at = NEXT[at]
            out.append(f"{NAMES[at]}:")
        if out:
            made = made.copy()
            made.update((("" if self.empty[state] else "\n") + "\n".join(out)).encode())
        audit = [edits]
        for code in self.back.backwards(4):
            c = code[state]
            audit.append("I" * (c >> 2 & 3) + "DKR"[c >> 4])
            state = c & 3
        self.back.close()
        gaps = 0 if self.first is None else min(self.last - self.first + 1 - self.turns, (1 << 63) - 1)
        return (gaps, self.counts[BLANK], self.counts[DUPLICATE], self.counts[CUT], self.illegal, self.base + cost,
                "".join(reversed(audit)), made.hexdigest())


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", live_col: str | None = None) -> DataFrame:
    """One row per conversation: its id, faults, ``cost``, ``audit`` and ``repaired_sha256``.

    ``live_col`` names a boolean column that is false on rows which only say that the conversation exists.
    """
    kind = rows.schema[conv_col].dataType.simpleString()
    live = F.col(live_col) if live_col else F.lit(True)
    dealt = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(role_col, F.lit(" ")).alias("role"),
        F.coalesce(text_col, F.lit(" ")).alias("text"), live.alias("live"))
    ordered = dealt.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text")

    names = ["conv", *(c.split()[0] for c in SCHEMA.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, now, done, conv_type = None, None, [], None

        def taken() -> pa.RecordBatch:
            columns = [list(c) for c in zip(*done)]
            types = [conv_type] + [pa.int64()] * 6 + [pa.string()] * 2
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=names)

        for batch in batches:
            conv_type = batch.schema.field("conv").type
            for conv, turn, role, text, is_live in zip(*(batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "live"))):
                if open_ is None or conv != now:
                    if open_ is not None:
                        done.append((now, *open_.end()))
                    open_, now = Conversation(), conv
                    if len(done) >= 1000:
                        yield taken()
                        done = []
                if is_live:
                    open_.add(turn, role, text)
        if open_ is not None:
            done.append((now, *open_.end()))
            yield taken()

    return ordered.mapInArrow(run, f"conv {kind}, {SCHEMA}").withColumnRenamed("conv", conv_col)


def damage(rows: DataFrame, live_col: str = "live", conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Faults planted by a checksum of conversation and turn: dropped, emptied, cut, repeated and mixed-up rows.

    A dropped row stays with ``live_col`` false, so its conversation is not forgotten.
    """
    fault, copy = free(rows, "fault_", "copy_")
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_col).cast("string"), blank), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), blank))
    marked = rows.withColumn(fault, F.crc32(key) % 20)
    text = F.coalesce(text_col, blank)
    return (
        marked.withColumn(text_col, F.when(F.col(fault) == 1, "").when(F.col(fault) == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text))
        .withColumn(role_col, F.when(F.col(fault) == 4, "user").otherwise(F.coalesce(role_col, blank)))
        .withColumn(live_col, F.col(fault) != 0)
        .withColumn(copy, F.explode(F.when(F.col(fault) == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .drop(fault, copy))
