"""Repair of conversation structure at least cost, by divide and conquer over edits.

A conversation should read `(s?(ua)+)?` by the initials of its roles: perhaps a system turn,
then user and assistant in turn. Rows are kept, given another role or deleted, and empty
turns inserted. The states of that pattern are four: nothing yet, after system, after user,
after assistant. A vector of least costs per state moves over the rows from the front and
another from the back; where they meet, the best crossing is chosen and both halves are
solved alike, so that a solution needs no table of all rows. Of equally cheap crossings the
one with the ASCII-least edits so far is taken: forward vectors carry the order of their
edits, which is all that is needed, as none of these strings begins another.

Long conversations are cut into pieces that are weighed and solved in parallel: a piece's
costs from each state to each are a four by four table, and a pass over the tables picks the
states at the cuts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from skyledger.llm import texts
from skyledger.session import stage

# Costs of the edits, and of leaving a truncated row in.
KEEP, REROLE, DELETE, INSERT, LEFT_TRUNCATED = 0, 3, 4, 3, 3

ROWS_PER_PIECE = 100_000
# Costs so far above the least cannot be made up for: any state is within two inserts and a
# deletion of doing as well.
HOPELESS = 40

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
FOLLOWERS = {NOTHING: "su", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
MADE_NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMED = {USER: "user", ASSISTANT: "assistant"}
TO_CLOSE = {NOTHING: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}  # inserts that end a conversation
LEGAL = {"su", "ua", "au"}

# How a row is seen: initial of its role, then its fault.
INITIALS = "sua"
SOUND, TO_DELETE, TRUNCATED = range(3)


class Steps:
    """What one row may do to the state, and how cost vectors move over it.

    A vector holds per state None or (cost above the least, place among the edits' order).
    There are few different ones, so each move is worked out once.
    """

    def __init__(self):
        self.options = [[self._row(code, state) for state in range(4)] for code in range(12)]
        self.forwards: dict = {}
        self.backwards: dict = {}

    @staticmethod
    def _row(code: int, state: int) -> list[tuple[int, int, str]]:
        """(state after, cost, edits): the cheapest, then least, inserts and one edit of the row."""
        initial, fault = (INITIALS + "?")[code // 3], code % 3
        left = LEFT_TRUNCATED if fault == TRUNCATED else 0
        best: dict[int, tuple[int, str]] = {}
        for inserts in range(4):
            found = [(state, DELETE, "D")]
            if fault != TO_DELETE:
                found.append((MADE_NEXT[state], REROLE + left, "R"))
                if initial in FOLLOWERS[state]:
                    found.append((AFTER[initial], KEEP + left, "K"))
            for after, cost, letter in found:
                mine = (cost + inserts * INSERT, "I" * inserts + letter)
                best[after] = min(best.get(after, mine), mine)
            state = MADE_NEXT[state]
        return [(after, cost, edits) for after, (cost, edits) in sorted(best.items())]

    @staticmethod
    def start(state: int) -> tuple:
        return tuple((0, 0) if s == state else None for s in range(4))

    @staticmethod
    def ranked(reached: dict) -> tuple[tuple, int]:
        """A vector of {state: (cost, order of its edits)}, and the least cost taken off it."""
        least = min(cost for cost, _ in reached.values())
        kept = sorted((order, state) for state, (cost, order) in reached.items() if cost - least <= HOPELESS)
        out: list = [None] * 4
        for place, (_, state) in enumerate(kept):
            out[state] = (reached[state][0] - least, place)
        return tuple(out), least

    def forward(self, vector: tuple, code: int) -> tuple[tuple, int]:
        """The vector after a row, and by how much the least cost grew."""
        key = (vector, code)
        if key not in self.forwards:
            reached: dict = {}
            for state, own in enumerate(vector):
                for after, cost, edits in self.options[code][state] if own else ():
                    mine = (own[0] + cost, (own[1], edits))
                    reached[after] = min(reached.get(after, mine), mine)
            self.forwards[key] = self.ranked(reached)
        return self.forwards[key]

    def backward(self, vector: tuple, code: int) -> tuple:
        """Costs from each state before a row to the end, above the least; None where there is no way."""
        key = (vector, code)
        if key not in self.backwards:
            ways = [[cost + vector[after] for after, cost, _ in self.options[code][s] if vector[after] is not None] for s in range(4)]
            least = min(min(w) for w in ways if w)
            self.backwards[key] = tuple(min(w) - least if w and min(w) - least <= HOPELESS else None for w in ways)
        return self.backwards[key]

    def weigh(self, codes: bytes) -> list[list[tuple[int, int] | None]]:
        """Of each state before and after the rows: (least cost, place of its edits among those from that state)."""
        table = []
        for state in range(4):
            vector, total = self.start(state), 0
            for code in codes:
                vector, more = self.forward(vector, code)
                total += more
            table.append([(own[0] + total, own[1]) if own else None for own in vector])
        return table

    def solve(self, codes: bytes, before: int, after: int) -> str:
        """The least of the cheapest edits that lead over the rows from one state to another."""
        if len(codes) == 1:
            return next(edits for state, _, edits in self.options[codes[0]][before] if state == after)
        if not codes:
            return ""
        middle = len(codes) // 2
        ahead = self.start(before)
        for code in codes[:middle]:
            ahead, _ = self.forward(ahead, code)
        back = tuple(0 if s == after else None for s in range(4))
        for code in reversed(codes[middle:]):
            back = self.backward(back, code)
        crossing = min((own[0] + back[s], own[1], s) for s, own in enumerate(ahead) if own and back[s] is not None)[2]
        return self.solve(codes[:middle], before, crossing) + self.solve(codes[middle:], crossing, after)


def steps() -> Steps:
    return texts.once(("repair-steps",), Steps)


def cuts(tables: list) -> tuple[int, list[tuple[int, int]]]:
    """Least cost of a conversation of weighed pieces, and the states before and after each."""
    vector, total, came = Steps.start(NOTHING), 0, []
    for table in tables:
        reached, sources = {}, {}
        for state, own in enumerate(vector):
            for after, way in enumerate(table[state]) if own else ():
                if way:
                    mine = (own[0] + way[0], (own[1], way[1]))
                    if after not in reached or mine < reached[after]:
                        reached[after], sources[after] = mine, state
        vector, more = Steps.ranked(reached)
        total += more
        came.append(sources)
    cost, _, state = min((own[0] + INSERT * TO_CLOSE[s], own[1], s) for s, own in enumerate(vector) if own)
    states = [state]
    for sources in reversed(came):
        states.append(sources[states[-1]])
    states.reverse()
    return total + cost, list(zip(states, states[1:]))


# --- tables

SPACES = " \t\n\x0b\x0c\r"


def damage(turns: DataFrame) -> DataFrame:
    """Turns with planted faults, by the crc32 of `conv_id:turn` modulo 20 (nulls: a blank).

    0 drops a row, 1 empties its text, 2 takes the full stops, exclamation and question
    marks out of it, 3 repeats it, 4 makes its role user; other rows stay as they are.
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")), F.lit(20))
    rows = turns.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"))
    return rows.where("kind != 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def with_faults(turns: DataFrame) -> DataFrame:
    """`conv_id`, `turn`, `role`, `text`, `nth` and `fault`: blank, duplicate, truncated or null, the first that holds.

    A blank text holds white space only, a duplicate's role and text came earlier in its
    conversation, and a truncated text's last character that is no white space does not
    end a sentence. A null role or text is a blank. `nth` counts a conversation's rows of one
    role and text from 1.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    # the same role and text in a conversation: a stream sorted by turn, of which one row is held
    alike = Window.partitionBy("conv_id", "role", "text").orderBy(F.asc_nulls_first("turn"))
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = (F.when(bare == "", "blank").when(F.col("nth") > 1, "duplicate")
             .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated"))
    return rows.withColumn("nth", F.row_number().over(alike)).withColumn("fault", fault)


PIECE = "conv_id long, piece long, start long, codes binary, costs array<long>, illegal long, first string, last string"
PLAN = "piece long, start long, before int, after int, inserts int, cost long, illegal long"


class Repair:
    """The written steps of a repair; `reports` and `turns` read its results.

    turns: `conv_id`, `turn`, `role`, `text`; other columns are left aside. A conversation's
    rows go by `turn` (nulls first), then role and text; rows of a null conv_id are one
    conversation, and repeated rows are duplicates. A role without one of the three
    initials cannot be kept. An empty table has no conversations.

    Rows are range-partitioned by conversation and place, so a conversation of any length
    is spread over pieces of about `rows_per_piece` rows; what a task holds is a byte per row of
    a piece. Only the last step reads a conversation as one stream, as its digest is sequential.
    """

    def __init__(self, turns: DataFrame, rows_per_piece: int = ROWS_PER_PIECE):
        self.marked = stage(with_faults(turns), "faults")
        n = max(1, -(-self.marked.count() // rows_per_piece))
        # rows of one turn may be many too, so they are dealt by the beginning of their text as well
        place = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role")]
        ordered = (self.marked.withColumn("head", F.substring("text", 1, 64))
                   .repartitionByRange(n, *place, F.asc("head")).drop("head").sortWithinPartitions(*place, "text", "nth"))
        row = F.monotonically_increasing_id()
        self.rows = stage(ordered.withColumn("row", row).select(
            "conv_id", "role", "text", "fault", F.shiftright("row", 33).alias("piece"),
            F.col("row").bitwiseAND((1 << 33) - 1).alias("number")), "ordered")
        self.pieces = stage(self._pieces(), "pieces")
        self.audits = stage(self._audits(), "audits")

    def _pieces(self) -> DataFrame:
        """One row per conversation and piece: its rows as bytes, and the costs from state to state."""
        initial = F.substring("role", 1, 1)
        kind = F.when(initial == "s", 0).when(initial == "u", 3).when(initial == "a", 6).otherwise(9)
        fault = F.when(F.col("fault") == "truncated", TRUNCATED).when(F.col("fault").isNotNull(), TO_DELETE).otherwise(SOUND)
        small = self.rows.select("conv_id", "piece", "number", initial.alias("initial"), (kind + fault).alias("code"))
        # a piece's rows lie in one file, but a task may be handed a part of a file
        dealt = small.repartition("piece").sortWithinPartitions("piece", "number")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, now, codes, initials, start, out = steps(), None, bytearray(), [], 0, []

            def finish() -> tuple:
                table = own.weigh(bytes(codes))
                flat = [x for line in table for way in line for x in (way or (-1, -1))]
                broken = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
                return now[0], now[1], start, bytes(codes), flat, broken, initials[0], initials[-1]

            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("conv_id", "piece", "number", "initial", "code")]
                for conv, piece, number, letter, code in zip(*columns):
                    if now != (conv, piece):
                        if now is not None:
                            out.append(finish())
                        now, codes, initials, start = (conv, piece), bytearray(), [], number
                    codes.append(code)
                    initials.append(letter)
                if len(out) >= 10_000:
                    yield _batch(out, PIECE)
                    out = []
            if now is not None:
                out.append(finish())
            yield _batch(out, PIECE)

        return dealt.mapInArrow(run, PIECE)

    def _plan(self) -> DataFrame:
        """The states at the cuts of every conversation; its cost and breaks stand with its last piece."""
        dealt = self.pieces.drop("codes").repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "piece")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, held, out = None, [], []

            def finish() -> None:
                tables = [[[(a, b) if a >= 0 else None for a, b in zip(line[::2], line[1::2])]
                           for line in (x["costs"][i : i + 8] for i in range(0, 32, 8))] for x in held]
                cost, states = cuts(tables)
                broken = sum(x["illegal"] for x in held) + sum(
                    a["last"] + b["first"] not in LEGAL for a, b in zip(held, held[1:]))
                for i, (x, (before, after)) in enumerate(zip(held, states)):
                    final = i == len(held) - 1
                    out.append((x["piece"], x["start"], before, after, TO_CLOSE[after] if final else 0,
                                cost if final else 0, broken if final else 0))

            for batch in batches:
                for x in batch.to_pylist():
                    if held and now != x["conv_id"]:
                        finish()
                        held = []
                    now = x["conv_id"]
                    held.append(x)
                if len(out) >= 10_000:
                    yield _batch(out, PLAN)
                    out = []
            if held:
                finish()
            yield _batch(out, PLAN)

        return dealt.mapInArrow(run, PLAN)

    def _audits(self) -> DataFrame:
        """Initials of the edits of every piece, in order."""
        kept = self.pieces.select("conv_id", "piece", "start", "codes").join(self._plan(), ["piece", "start"])
        schema = "conv_id long, piece long, audit string, cost long, illegal long"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = steps()
            for batch in batches:
                yield _batch([(x["conv_id"], x["piece"], own.solve(x["codes"], x["before"], x["after"]) + "I" * x["inserts"],
                               x["cost"], x["illegal"]) for x in batch.to_pylist()], schema)

        return kept.mapInArrow(run, schema)

    def _streams(self) -> DataFrame:
        """Per piece its edits, then its rows, in order within one task per conversation."""
        edits = self.audits.select("conv_id", "piece", F.lit(-1).cast("long").alias("number"), F.lit(None).cast("string").alias("role"),
                                   F.col("audit").alias("text"), "cost", "illegal")
        rows = self.rows.select("conv_id", "piece", "number", "role", "text", F.lit(0).cast("long").alias("cost"),
                                F.lit(0).cast("long").alias("illegal"))
        return edits.unionByName(rows).repartition("conv_id").sortWithinPartitions(
            F.asc_nulls_first("conv_id"), "piece", "number")

    def turns(self) -> DataFrame:
        """The repaired turns: `conv_id`, `place` from 0, `edit` (K, R or I), `role`, `text`."""
        schema = "conv_id long, place long, edit string, role string, text string"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, place = (), 0
            for rows in _repaired(batches):
                out = []
                for conv, edit, role, text, *_ in rows:
                    if (conv,) != now:
                        now, place = (conv,), 0
                    if edit in ("K", "R", "I"):
                        out.append((conv, place, edit, role, text))
                        place += 1
                yield _batch(out, schema)

        return self._streams().mapInArrow(run, schema)

    def reports(self) -> DataFrame:
        """Per conversation: `conv_id`, `gaps` (turn numbers that are missing), rows that are
        `blank`, `duplicate`, `truncated`, `illegal` (neighbours out of order), `cost`, `audit`
        (initials of the edits) and `repaired_sha256` (of `role:text` lines).
        """
        schema = "conv_id long, illegal long, cost long, audit string, repaired_sha256 string"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, state = (), None
            finish = lambda: (*now, state[0], state[1], "".join(state[2]), state[3].hexdigest())
            for rows in _repaired(batches):
                out = []
                for conv, edit, role, text, cost, illegal in rows:
                    if (conv,) != now:
                        if state:
                            out.append(finish())
                        now, state = (conv,), [0, 0, [], hashlib.sha256(), False]
                    if edit in ("K", "R", "I"):
                        state[3].update(f"{chr(10) if state[4] else ''}{role}:{text}".encode())
                        state[4] = True
                    elif edit is None:
                        state[0] += illegal
                        state[1] += cost
                        state[2].append(text)
                yield _batch(out, schema)
            if state:
                yield _batch([finish()], schema)

        per_turn = self.marked.groupBy("conv_id", "turn").agg(
            *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
        # a null turn is a group of its own, which count() and the extremes pass over
        counts = per_turn.groupBy("conv_id").agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
            *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")])
        told = self._streams().mapInArrow(run, schema).withColumnRenamed("conv_id", "own_id")
        return counts.join(told, F.col("conv_id").eqNullSafe(F.col("own_id"))).select(
            "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], KINDS[kind]) for i, (_, kind) in enumerate(fields)], [name for name, _ in fields])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[tuple]]:
    """For each batch of `_streams`, (conv_id, edit, role, text, cost, illegal) of what becomes of its rows.

    A piece's edits come with edit None and the audit as text. A deleted row comes as D.
    """
    now, state, audit, at, closing = (), NOTHING, "", 0, 0

    def made(conv) -> Iterator[tuple]:
        """Turns inserted before the next row."""
        nonlocal state, at
        while at < len(audit) and audit[at] == "I":
            state = MADE_NEXT[state]
            at += 1
            yield conv, "I", NAMED[state], "", 0, 0

    def walk(columns) -> Iterator[tuple]:
        nonlocal now, state, audit, at, closing
        for conv, number, role, text, cost, illegal in zip(*columns):
            if (conv,) != now:
                now, state = (conv,), NOTHING
            if number < 0:
                audit, at, closing = text, 0, len(text.rstrip("I"))
                yield conv, None, None, text, cost, illegal
                continue
            yield from made(conv)
            letter = audit[at]
            at += 1
            if letter == "K":
                state = AFTER[role[:1]]
            elif letter == "R":
                state = MADE_NEXT[state]
                role = NAMED[state]
            yield conv, letter, role, text, 0, 0
            if at == closing:  # the end of a conversation
                yield from made(conv)

    for batch in batches:
        yield walk([batch.column(c).to_pylist() for c in ("conv_id", "number", "role", "text", "cost", "illegal")])


def repair(turns: DataFrame, rows_per_piece: int = ROWS_PER_PIECE) -> Repair:
    return Repair(turns, rows_per_piece)
