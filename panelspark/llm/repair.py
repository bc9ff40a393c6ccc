"""Conversation structure repair: least edits by Four-Russians block tables."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from hashlib import sha256
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .tables import query, read

#: States of ``(s?(ua)+)?``: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: What a user or assistant turn put in here becomes, and the state after it.
NEXT = (USER, USER, ASSISTANT, USER)
#: How a mark tells the role that an edit gives: of turns put in or rerolled, kept, deleted.
MARK = {USER: "u", ASSISTANT: "a"}
KEPT, DELETED = "=", "-"
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: Symbols: none (fills up blocks), one that must go, then system, user, assistant, other; the same four again if truncated.
NONE, GONE, WHOLE, CUT = 0, 1, 2, 6
SYMBOLS = 10
#: Kinds of roles, by their initial; any other initial is kind 3.
KINDS = "sua"
LEGAL = ((0, 1), (1, 2), (2, 1))
#: Symbols of a block, and rows of a chunk at most.
BLOCK, CHUNK = 4, 1 << 16
SPACES = " \t\n\x0b\x0c\r"


def _kept(symbol: int, state: int) -> int | None:
    """The state after keeping a row, if it may be kept there."""
    if symbol < WHOLE:
        return None
    kind = (symbol - WHOLE) % 4
    if kind == 0:
        return SYSTEM if state == START else None
    if kind == 1:
        return USER if state != USER else None
    if kind == 2:
        return ASSISTANT if state == USER else None
    return None


def _settle(costs: list[int]) -> tuple[int, ...]:
    """Least costs once turns may be put in first."""
    costs = list(costs)
    for _ in range(3):
        costs = [min(c, INSERT + costs[NEXT[s]]) for s, c in enumerate(costs)]
    return tuple(costs)


def _row_costs(symbol: int, rest: tuple[int, ...]) -> list[dict[str, tuple[int, int]]]:
    """For each state the edits of one row: initial -> (cost to the end, state after it)."""
    out = []
    for state in range(STATES):
        edits = {"D": (DELETE + rest[state], state)}
        if symbol >= WHOLE:
            extra = TRUNCATED if symbol >= CUT else 0
            edits["R"] = (REROLE + extra + rest[NEXT[state]], NEXT[state])
            after = _kept(symbol, state)
            if after is not None:
                edits["K"] = (extra + rest[after], after)
        out.append(edits)
    return out


#: Costs from each state to the end of a conversation.
FINAL = _settle([0, 10**6, 10**6, 0])


@dataclass
class Tables:
    """Costs to the end, less the least of them, form few vectors; all tables are indexed by a vector's number.

    ``step``, ``cost``: the vector before one symbol, from the vector after it, and what
    the least cost grows by. ``steps``, ``leave``: the edits with which a state passes the
    symbol (turns put in before it, then what becomes of it), and the state it leaves in.
    ``block_*``: the same for every block of BLOCK symbols, read as a number in base 10.
    """

    vectors: list[tuple[int, ...]]
    step: np.ndarray
    cost: np.ndarray
    steps: list[list[list[tuple[str, str]]]]
    leave: np.ndarray
    block_step: np.ndarray
    block_cost: np.ndarray
    block_leave: np.ndarray

    def fold(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """For each vector at the right end: vector and added cost at the left end; and the vectors right of each block."""
        now, total, right = np.arange(len(self.vectors)), np.zeros(len(self.vectors), np.int64), []
        for block in blocks[::-1].tolist():
            right.append(now)
            total = total + self.block_cost[now, block]
            now = self.block_step[now, block]
        return now, total, right[::-1]

    def exits(self, blocks: np.ndarray, right: list[np.ndarray]) -> np.ndarray:
        """For each vector at the right end and each state at the left end the state at the right end."""
        state = np.tile(np.arange(STATES), (len(self.vectors), 1))
        for block, vectors in zip(blocks.tolist(), right):
            state = self.block_leave[vectors[:, None], block, state]
        return state

    def trace(self, symbols: np.ndarray, vector: int, state: int) -> tuple[list[tuple[str, str]], int]:
        """The ASCII-least edits of each row with their marks, and the state at the end.

        Vectors at block borders come by lookup; a block is then expanded backward from
        its right border, so that every row knows the costs of all that may follow it.
        """
        blocks, border, now = as_blocks(symbols), [], vector
        for block in blocks[::-1].tolist():
            border.append(now)
            now = int(self.block_step[now, block])
        out: list[tuple[str, str]] = []
        for k, now in enumerate(reversed(border)):
            own, after = symbols[k * BLOCK : (k + 1) * BLOCK].tolist(), []
            for symbol in reversed(own):
                after.append(now)
                now = int(self.step[now, symbol])
            for symbol, behind in zip(own, reversed(after)):
                out.append(self.steps[behind][symbol][state])
                state = int(self.leave[behind, symbol, state])
        return out, state


def as_blocks(symbols: np.ndarray) -> np.ndarray:
    """Numbers of the blocks; the last one is filled with NONE, which changes nothing."""
    padded = np.zeros(-(-len(symbols) // BLOCK) * BLOCK, np.int64)
    padded[: len(symbols)] = symbols
    return padded.reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))


@lru_cache(1)
def tables() -> Tables:
    vectors = [tuple(c - min(FINAL) for c in FINAL)]
    number = {vectors[0]: 0}
    step, cost, steps, leave = [], [], [], []
    for rest in vectors:  # grows until no new vector turns up
        rows: list[list] = [[], [], [], []]
        for symbol in range(SYMBOLS):
            if symbol == NONE:
                edits, least = [{"": (c, s)} for s, c in enumerate(rest)], rest
            else:
                edits = _row_costs(symbol, rest)
                least = _settle([min(c for c, _ in e.values()) for e in edits])
            said, ends = [], []
            for state in range(STATES):
                text = marks = ""
                while True:
                    best = {i: s for i, (c, s) in edits[state].items() if c == least[state]}
                    if symbol != NONE and INSERT + least[NEXT[state]] == least[state]:
                        best["I"] = NEXT[state]
                    initial = min(best)
                    state = best[initial]
                    text += initial
                    marks += {"": "", "D": DELETED, "K": KEPT}.get(initial, MARK.get(state, ""))
                    if initial != "I":
                        break
                said.append((text, marks))
                ends.append(state)
            low = min(least)
            vector = tuple(c - low for c in least)
            if vector not in number:
                number[vector] = len(vectors)
                vectors.append(vector)
            for row, x in zip(rows, (number[vector], low, said, ends)):
                row.append(x)
        for table, row in zip((step, cost, steps, leave), rows):
            table.append(row)
    single, grown, left = np.array(step), np.array(cost), np.array(leave)
    codes = np.arange(SYMBOLS**BLOCK)
    digits = [codes // SYMBOLS**k % SYMBOLS for k in range(BLOCK)]  # the last symbol first
    now = np.repeat(np.arange(len(vectors))[:, None], len(codes), axis=1)
    total, behind = np.zeros(now.shape, np.int64), []
    for digit in digits:
        behind.append(now)
        total += grown[now, digit]
        now = single[now, digit]
    state = np.broadcast_to(np.arange(STATES), (*now.shape, STATES))
    for digit, right in zip(reversed(digits), reversed(behind)):
        state = left[right[:, :, None], digit[:, None], state]
    return Tables(vectors, single, grown, steps, left, now, total, state)


#: Edits and marks of turns put in after the last row, by state.
CLOSING = {START: ("", ""), SYSTEM: ("II", "ua"), USER: ("I", "a"), ASSISTANT: ("", "")}


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str], columns: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows with equal keys, over batches in order."""
    n = len(keys)
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in [*keys, *columns])))
    for key, own in groupby(rows, lambda row: row[:n]):
        yield key, [row[n:] for row in own]


def _batches(rows: Iterator[tuple], schema: pa.Schema, weight=lambda row: 1) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded weight."""
    held, heavy = [], 0
    for row in rows:
        held.append(row)
        heavy += weight(row)
        if heavy >= CHUNK:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, heavy = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


LONGS, INTS = pa.list_(pa.int64()), pa.list_(pa.int32())
PORTION = pa.schema(
    [("conv", pa.string()), ("first", pa.int64()), ("rows", LONGS), ("symbols", pa.binary()), ("vector", INTS), ("cost", LONGS)]
    + [("leave", INTS), ("illegal", pa.int64()), ("kind_first", pa.int32()), ("kind_last", pa.int32())]
)
PORTION_SQL = (
    "conv string, first long, rows array<long>, symbols binary, vector array<int>, cost array<long>, leave array<int>, "
    "illegal long, kind_first int, kind_last int"
)
PLACED = pa.schema(
    [("conv", pa.string()), ("place", pa.int64()), ("right", pa.int32()), ("state", pa.int32()), ("closes", pa.bool_())]
    + [("cost", pa.int64()), ("illegal", pa.int64())]
)
PLACED_SQL = "conv string, place long, right int, state int, closes boolean, cost long, illegal long"
EDITED = pa.schema([("place", pa.int64()), ("edits", pa.string()), ("marks", pa.string())])


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation in a chunk, from the chunk's rows in order."""

    def rows() -> Iterator[tuple]:
        for (conv, _), own in _grouped(batches, ["conv", "chunk"], ["place", "symbol", "kind"]):
            places, symbols, kinds = (list(x) for x in zip(*own))
            blocks = as_blocks(np.array(symbols))
            vector, cost, right = tables().fold(blocks)
            leave = tables().exits(blocks, right).reshape(-1)
            illegal = sum(pair not in LEGAL for pair in zip(kinds, kinds[1:]))
            yield conv, places[0], places, bytes(symbols), vector, cost, leave, illegal, kinds[0], kinds[-1]

    return _batches(rows(), PORTION, lambda row: 16 + len(row[3]))


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each portion of a conversation needs of the others: costs behind its right end, the state before its left end."""

    def rows() -> Iterator[tuple]:
        for (conv,), own in _grouped(batches, ["conv"], PORTION.names[1:2] + PORTION.names[4:]):
            now, total, right = 0, 0, []
            for _, vector, cost, *_ in reversed(own):
                right.append(now)
                total, now = total + cost[now], vector[now]
            total += tables().vectors[now][START]
            state, before = START, None
            for k, ((first, _, _, leave, illegal, kind_first, kind_last), behind) in enumerate(zip(own, reversed(right))):
                illegal += before is not None and (before, kind_first) not in LEGAL
                yield conv, first, behind, state, k == len(own) - 1, total, illegal
                state, before, total = leave[behind * STATES + state], kind_last, 0

    return _batches(rows(), PLACED)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits and marks of each row, with the turns put in after the last one."""
    for batch in batches:
        for places, symbols, right, state, closes in zip(*(batch.column(c).to_pylist() for c in ("rows", "symbols", "right", "state", "closes"))):
            steps, end = tables().trace(np.frombuffer(symbols, np.uint8), right, state)
            if closes:
                steps[-1] = tuple(a + b for a, b in zip(steps[-1], CLOSING[end]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((places, *zip(*steps)), EDITED)], schema=EDITED)


class Repaired(NamedTuple):
    """``turns``: conv, place, nth, edit, turn, role, text; ``report``: conv, gaps, blank, duplicate, truncated, illegal, cost."""

    turns: DataFrame
    report: DataFrame


def key_of(conv: Column) -> Column:
    """Ids as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def repair(
    conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> Repaired:
    """Faults of conversations and the cheapest edits after which their roles' initials read ``(s?(ua)+)?``.

    Rows are taken by turn (nulls first), then role and text. A row's first fault counts:
    blank, duplicate (role and text seen before in the conversation), truncated (it does
    not end in ``.``, ``!`` or ``?``). Keeping a row costs 0, Reroling it to user or
    assistant 3, Deleting it 4, Inserting an empty turn of user or assistant 3. Blank and
    duplicate rows must go; a truncated row that stays costs 3 more. Of several cheapest
    ways the one whose initials are least in ASCII order is taken.

    ``turns`` has a row for each edit: (conv, place, nth) is its order, ``edit`` its initial,
    ``role`` and ``text`` what the row then holds (a deleted row what it held). ``conv`` is
    the id as text after ``=``, empty for a null id (see :func:`key_of`).

    Rows are dealt by ranges of all their columns, so a conversation of any size, and any
    number of equal rows, is spread over tasks. Chunks of 65,536 rows are folded through
    the block tables for every cost vector that may follow them, which makes them
    independent of each other; one short row for each chunk then says which vector and
    state it has, and chunks are traced apart from each other again.

    Null roles and texts count as one space; rows without an id form one conversation;
    an empty table gives no rows; other columns are ignored.
    """
    rows = conversations.select(
        key_of(F.col(conv_col)).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
    )
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text"]
    dealt = rows.withColumn("apart", F.monotonically_increasing_id()).repartitionByRange(*order, "apart")
    ordered = dealt.drop("apart").sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    ordered = stored(ordered, "turns")

    bare, initial = F.rtrim("text", F.lit(SPACES)), F.left("role", F.lit(1))
    slim = ordered.select(
        *("conv", "turn", "place"),
        F.when(bare == "", "blank").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated").alias("fault"),
        reduce(lambda kind, k: F.when(initial == KINDS[k], k).otherwise(kind), range(len(KINDS)), F.lit(len(KINDS))).alias("kind"),
        F.sha2("role", 256).alias("h1"),
        F.sha2("text", 256).alias("h2"),
    )
    first = slim.groupBy("conv", "h1", "h2").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    slim = slim.drop("h1", "h2").join(first, "place", "left")
    fault = F.when(F.col("fault") == "blank", "blank").when(F.col("first").isNull(), "duplicate").otherwise(F.col("fault"))
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(F.col("fault") == "truncated", CUT + F.col("kind"))
    marked = slim.withColumn("fault", fault).withColumn("symbol", symbol.otherwise(WHOLE + F.col("kind"))).drop("first")
    marked = stored(marked.withColumn("chunk", F.floor(F.col("place") / CHUNK)), "marked")

    in_chunks = marked.select("conv", "chunk", "place", "symbol", "kind").repartition("chunk").sortWithinPartitions("place")
    portions = stored(in_chunks.mapInArrow(_portions, PORTION_SQL), "portions")
    by_conv = portions.drop("rows", "symbols").repartition("conv").sortWithinPartitions("conv", "first")
    placed = stored(by_conv.mapInArrow(_composed, PLACED_SQL), "placed")
    known = placed.select(F.col("place").alias("first"), "right", "state", "closes")
    edited = portions.select("first", "rows", "symbols").join(known, "first").mapInArrow(_edited, "place long, edits string, marks string")

    split = edited.select("place", F.posexplode(F.split("edits", "")).alias("nth", "edit"), "marks")
    mark = F.substring("marks", F.col("nth") + 1, F.lit(1))
    turns = ordered.join(split, "place").select(
        *("conv", "place", "nth", "edit"),
        F.when(F.col("edit") != "I", F.col("turn")).alias("turn"),
        F.when(mark == "u", "user").when(mark == "a", "assistant").otherwise(F.col("role")).alias("role"),
        F.when(F.col("edit") != "I", F.col("text")).otherwise("").alias("text"),
    )
    counted = marked.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        *(F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")),
    )
    summed = placed.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"))
    return Repaired(turns, counted.join(summed, "conv"))


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The audit and the hash of the repaired turns of each conversation, from its edits in order."""

    def rows() -> Iterator[tuple]:
        lines = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("conv", "edit", "line"))))
        for conv, own in groupby(lines, lambda row: row[0]):
            audit, code, more = [], sha256(), b""
            for _, edit, line in own:
                audit.append(edit)
                if edit != "D":
                    code.update(more + line.encode())
                    more = b"\n"
            yield conv, "".join(audit), code.hexdigest()

    return _batches(rows(), pa.schema([("conv", pa.string()), ("audit", pa.string()), ("repaired_sha256", pa.string())]))


def digests(turns: DataFrame) -> DataFrame:
    """(conv, audit, repaired_sha256); one task reads a conversation's edits one after the other, as the hash asks for."""
    line = F.concat_ws(":", "role", "text").alias("line")
    ordered = turns.select("conv", "place", "nth", "edit", line).repartition("conv").sortWithinPartitions("conv", "place", "nth")
    return ordered.mapInArrow(_digested, "conv string, audit string, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults planted by crc32 of ``conv_id:turn``; nulls are one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), code.alias("code"))
    rows = rows.where("code != 0").select(
        *("conv_id", "turn"),
        F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("code") == 3, 2).otherwise(1).alias("times"),
    )
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("col")


@query("op12_conversation_repair")
def op12(spark, folder):
    conversations = read(spark, folder, "conversations")
    turns, report = repair(damaged(conversations))
    said = report.join(digests(turns), "conv")
    asked = conversations.select("conv_id").distinct().withColumn("conv", key_of(F.col("conv_id")))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return asked.join(said, "conv", "left").select(
        "conv_id",
        *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(sha256().hexdigest())).alias("repaired_sha256"),
    )
