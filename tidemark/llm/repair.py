"""Conversation structure repair by Four-Russians block tables.

A repaired conversation has the role initials ``(s?(ua)+)?``: four states (nothing yet, after system, after user, after
assistant). A row becomes one of nine symbols: a role initial with a complete or truncated text, or a row that has to go.
What the rest of a conversation costs at best from each state is a vector of four numbers; less their least, only a few
vectors exist. So one table, made beforehand, takes a vector behind any block of ``BLOCK`` symbols to the vector before it, and
a conversation is worked through from its end, a lookup per block. The edits are then read off forwards: each block is
expanded again from the vector behind it, and of the edits that keep the cost least, the first by ASCII is taken. As every
choice is made with the whole rest of the cost known, ties come out least as whole strings.

Rows are gathered into pieces of at most ``PIECE_ROWS`` rows or about ``PIECE_BYTES``, in order, wherever Spark's range
partitioning has put them. A conversation within one piece is finished there. The pieces of one that is longer, or lies
across a border of partitions, carry their own table of vectors; two scans over these short rows (from the end, then from
the start) give each piece its vector behind and its state before, and the pieces are edited on their own. So a conversation
may hold any share of the rows. Equal rows of one turn are counted before they are shuffled.

Defined results: a null role or text is one space; null conversation ids are one conversation; null turns come first. Rows of
one turn are ordered by role, then text. Repeated rows are duplicates. Roles other than those that begin with s, u or a can
only be given a role or deleted. A gap count beyond a long is null. Other columns of the table are not looked at.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import lookup
from tidemark.session import materialize

# Costs of the edits; a truncated row that is not deleted costs more.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
# White space, and ends of a complete text.
SPACES, ENDS = " \t\n\x0b\x0c\r", (".", "!", "?")

BLOCK = 4
PIECE_ROWS = 4096
PIECE_BYTES = 8 << 20

BLANK, DUPLICATE, CUT = 1, 2, 3              # faults
GONE = 8                                     # symbol of a row that has to go; others: 2 * initial + truncated
SYMBOLS = 9
OTHER = 3                                    # initial beyond s, u, a
_AFTER = (2, 2, 3, 2)                        # state after a user or assistant that the state before calls for
_END = (0, 2 * INSERT, INSERT, 0)            # cost of ending in each state
_TAIL = ("", "II", "I", "")
_ROLES = ("user", "user", "assistant", "user")
_LEGAL = {(0, 1), (2, 1), (1, 2)}            # neighbouring initials


# -- tables --------------------------------------------------------------------------------------------------------

def _kept(state: int, symbol: int) -> int | None:
    """State after keeping a row, if it may follow."""
    initial = symbol // 2
    fits = {0: state == 0, 1: state != 2, 2: state == 2}
    return initial + 1 if symbol != GONE and fits.get(initial) else None


def _options(state: int, symbol: int) -> list[tuple[str, int, int]]:
    """Edits of a row in ASCII order: letter, cost, next state."""
    found = [("D", DELETE, state)]
    if symbol != GONE:
        more = TRUNCATED * (symbol % 2)
        if _kept(state, symbol) is not None:
            found.append(("K", more, _kept(state, symbol)))
        found.append(("R", REROLE + more, _AFTER[state]))
    return found


def _before(after: tuple[int, ...], symbol: int) -> list[int]:
    """Costs before a row, inserts included, from the costs after it."""
    costs = [min(cost + after[to] for _, cost, to in _options(state, symbol)) for state in range(4)]
    for _ in range(3):
        costs = [min(c, INSERT + costs[_AFTER[state]]) for state, c in enumerate(costs)]
    return costs


@dataclass
class Tables:
    vectors: list[tuple[int, ...]]
    step: np.ndarray       # vector before a symbol, by vector behind it and symbol
    gain: np.ndarray       # what the least cost grows by
    jump: np.ndarray       # the same for blocks
    jump_gain: np.ndarray
    edits: list            # edits of a row and the state after it, by vector behind it, symbol and state


@cache
def tables() -> Tables:
    vectors, number, step, gain, edits = [_END], {_END: 0}, [], [], []
    for vector in vectors:                   # grows until no new one turns up
        to, by, read = [], [], []
        for symbol in range(SYMBOLS):
            costs = _before(vector, symbol)
            least = min(costs)
            normal = tuple(c - least for c in costs)
            if normal not in number:
                number[normal] = len(vectors)
                vectors.append(normal)
            to.append(number[normal])
            by.append(least)
            read.append([_read(vector, symbol, costs, state) for state in range(4)])
        step.append(to)
        gain.append(by)
        edits.append(read)
    step, gain = np.array(step), np.array(gain)
    jump, jump_gain = np.arange(len(vectors))[:, None], np.zeros((len(vectors), 1), int)
    for _ in range(BLOCK):                   # a symbol before the block so far
        jump, jump_gain = (np.swapaxes(step[jump], 1, 2).reshape(len(vectors), -1),
                           np.swapaxes(jump_gain[:, :, None] + gain[jump], 1, 2).reshape(len(vectors), -1))
    return Tables(vectors, step, gain, jump, jump_gain, edits)


def _read(after: tuple[int, ...], symbol: int, costs: list[int], state: int) -> tuple[str, int]:
    found = ""
    while True:
        rest = costs[state]
        fitting = [(letter, to) for letter, cost, to in _options(state, symbol) if cost + after[to] == rest]
        if INSERT + costs[_AFTER[state]] == rest:
            fitting.append(("I", None))
        letter, to = min(fitting)
        found += letter
        if to is not None:
            return found, to
        state = _AFTER[state]


def _blocks(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols before the first whole block, and the numbers of the blocks."""
    lead = len(codes) % BLOCK
    powers = SYMBOLS ** np.arange(BLOCK - 1, -1, -1)
    return codes[:lead], codes[lead:].reshape(-1, BLOCK).astype(np.int64) @ powers


def backwards(codes: np.ndarray, behind: int) -> tuple[list[int], int, int]:
    """Vector behind each block (the first of them: behind the leading symbols), vector before all, growth of the cost."""
    made = tables()
    lead, blocks = _blocks(codes)
    borders, at, cost = [behind], behind, 0
    for block in blocks[::-1].tolist():
        cost += int(made.jump_gain[at, block])
        at = int(made.jump[at, block])
        borders.append(at)
    for symbol in lead[::-1].tolist():
        cost += int(made.gain[at, symbol])
        at = int(made.step[at, symbol])
    return borders[::-1], at, cost


def through(codes: np.ndarray) -> np.ndarray:
    """Vector before the symbols, for each vector behind them."""
    made = tables()
    lead, blocks = _blocks(codes)
    at = np.arange(len(made.vectors))
    for block in blocks[::-1]:
        at = made.jump[at, block]
    for symbol in lead[::-1]:
        at = made.step[at, symbol]
    return at


def trace(codes: np.ndarray, borders: list[int], state: int) -> tuple[list[str], int]:
    """Edits of each row from a state on, and the state after the last."""
    made = tables()
    lead = len(codes) % BLOCK
    found = []
    for border, (start, end) in zip(borders, itertools.pairwise([0, *range(lead, len(codes) + 1, BLOCK)])):
        block = codes[start:end].tolist()
        behind = [border]
        for symbol in block[:0:-1]:
            behind.append(int(made.step[behind[-1], symbol]))
        for symbol, vector in zip(block, behind[::-1]):
            edits, state = made.edits[vector][symbol][state]
            found.append(edits)
    return found, state


def edited(codes: np.ndarray, edits: list[str], messages: list[tuple[str, str]], state: int,
           last: bool) -> tuple[list[tuple[str, str]], int]:
    """Repaired messages and the cost of the edits. ``messages``: role and text of the rows that need not go."""
    rest, out, cost = iter(messages), [], 0
    for symbol, letters in zip(codes.tolist(), edits):
        role, text = next(rest) if symbol != GONE else ("", "")
        for letter in letters:
            if letter == "D":
                cost += DELETE
            elif letter == "K":
                out.append((role, text))
                cost, state = cost + TRUNCATED * (symbol % 2), symbol // 2 + 1
            else:
                out.append((_ROLES[state], text if letter == "R" else ""))
                cost += REROLE + TRUNCATED * (symbol % 2) if letter == "R" else INSERT
                state = _AFTER[state]
    for _ in _TAIL[state] if last else "":
        out.append((_ROLES[state], ""))
        cost, state = cost + INSERT, _AFTER[state]
    return out, cost


def _split(audit: str) -> list[str]:
    """Edits of each row: inserts, then one of D, K, R."""
    found, start = [], 0
    for i, letter in enumerate(audit, 1):
        if letter != "I":
            found.append(audit[start:i])
            start = i
    return found


# -- counts --------------------------------------------------------------------------------------------------------

@dataclass
class Tally:
    """Counts over neighbouring rows, which can be joined."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    low: int | None = None
    high: int | None = None
    first: int | None = None
    last: int | None = None

    def add(self, turn: int | None, initial: int, fault: int, n: int) -> None:
        """``n`` equal rows; the first has the fault, the others are duplicates if they are not blank."""
        again = 0 if fault == BLANK else n - 1
        self.join(Tally(n if fault == BLANK else 0, again + (fault == DUPLICATE), int(fault == CUT), n - 1,
                        int(turn is not None), turn, turn, initial, initial))

    def join(self, other: Tally) -> None:
        if other.first is None:
            return
        self.illegal += other.illegal + (self.last is not None and (self.last, other.first) not in _LEGAL)
        self.turns += other.turns - (self.high is not None and self.high == other.low)
        self.blank += other.blank
        self.duplicate += other.duplicate
        self.truncated += other.truncated
        self.low = other.low if self.low is None else self.low
        self.high = self.high if other.high is None else other.high
        self.first = other.first if self.first is None else self.first
        self.last = other.last

    def gaps(self) -> int | None:
        found = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return found if found < 1 << 63 else None


_TALLY = ("blank:long,duplicate:long,truncated:long,illegal:long,turns:long,low:long,high:long,first:int,last:int")
_MESSAGES = "array<struct<role:string,text:string>>"
_ARROW_MESSAGES = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_ARROW_TALLY = pa.struct([(name, pa.int32() if name in ("first", "last") else pa.int64()) for name in Tally.__annotations__])


def _emitted(rows: Iterator[dict], schema: pa.Schema, size=lambda row: 1, limit: int = 1024) -> Iterator[pa.RecordBatch]:
    held, used = [], 0
    for row in rows:
        held.append(row)
        used += size(row)
        if used >= limit:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, used = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _as_messages(messages: list[tuple[str, str]]) -> list[dict]:
    return [{"role": role, "text": text} for role, text in messages]


# -- rows ----------------------------------------------------------------------------------------------------------

def damage(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` and ``copies`` of rows damaged by the hash of their conversation and turn.

    Of twenty, one is dropped (0 copies, so that its conversation stays known), one loses its text, one its ends of sentences,
    one is repeated and one becomes the user's."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text, role = shown("text"), shown("role")
    return rows.select(
        "conv_id", "turn", F.when(case == 4, "user").otherwise(role).alias("role"),
        F.when(case == 1, "").when(case == 2, F.translate(text, "".join(ENDS), "")).otherwise(text).alias("text"),
        F.when(case == 0, 0).when(case == 3, 2).otherwise(1).alias("copies"))


def _classified(rows: DataFrame) -> DataFrame:
    """Distinct rows with ``n`` (copies), ``fault`` and ``initial``, and the dropped ones (``n`` 0, one a conversation)."""
    there = F.col("copies") > 0
    counted = rows.select(
        "conv_id", F.when(there, F.col("turn").cast("long")).alias("turn"),
        *[F.when(there, F.coalesce(F.col(c).cast("string"), F.lit(" "))).otherwise("").alias(c) for c in ("role", "text")],
        F.col("copies").cast("long").alias("copies"))
    counted = counted.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("n"))
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    same = [F.xxhash64(F.lit(seed), F.col("conv_id").isNull(), "conv_id", F.length("role"), "role", "text") for seed in (1, 2)]
    counted = materialize(counted.select(
        "*", (end == "").alias("blank"), F.right(end, F.lit(1)).isin(*ENDS).alias("ended"),
        *[h.alias(f"same{i}") for i, h in enumerate(same)]), "conversation-rows")
    # a role and text at several turns: all but the first are duplicates
    again = (counted.where((F.col("n") > 0) & ~F.col("blank")).groupBy("same0", "same1")
             .agg(F.count(F.lit(1)).alias("turns"), F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("unset"))
             .where("turns > 1").select("same0", "same1", F.when(~F.col("unset"), F.col("least")).alias("first_turn"),
                                        F.lit(True).alias("again")))
    flagged = lookup(counted, again, ["same0", "same1"], spread="turn")
    fault = (F.when(F.col("blank"), BLANK)
             .when(F.col("again") & ~F.col("turn").eqNullSafe(F.col("first_turn")), DUPLICATE)
             .when(~F.col("ended"), CUT).otherwise(0))
    begins = F.substring("role", 1, 1)
    initial = F.when(begins == "s", 0).when(begins == "u", 1).when(begins == "a", 2).otherwise(OTHER)
    return flagged.select("conv_id", "turn", "role", "text", "n", fault.alias("fault"), initial.alias("initial"))


# -- pieces --------------------------------------------------------------------------------------------------------

class _Piece:
    def __init__(self):
        self.codes, self.messages, self.tally, self.bytes = bytearray(), [], Tally(), 0

    def row(self, conv, part: int, number: int, whole: bool) -> dict:
        codes = np.frombuffer(bytes(self.codes), np.uint8)
        made = {"conv_id": conv, "part": part, "number": number, "whole": whole, "tally": asdict(self.tally)}
        if not whole:
            return made | {"cost": None, "audit": None, "messages": _as_messages(self.messages), "codes": bytes(self.codes),
                           "jump": through(codes).tolist()}
        borders, at, cost = backwards(codes, 0)
        edits, state = trace(codes, borders, 0)
        messages, _ = edited(codes, edits, self.messages, 0, True)
        return made | {"cost": cost + tables().vectors[at][0], "audit": "".join(edits) + _TAIL[state],
                       "messages": _as_messages(messages), "codes": None, "jump": None}


def _pieces(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[dict]:
    part, number = TaskContext.get().partitionId(), 0
    piece, held, begun, open_ = _Piece(), None, False, True     # the first conversation may have begun before
    for batch in batches:
        for conv, turn, role, text, n, fault, initial in zip(*(c.to_pylist() for c in batch.columns)):
            if begun and conv != held:
                yield piece.row(held, part, number, not open_)
                piece, number, open_ = _Piece(), number + 1, False
            held, begun = conv, True
            code = GONE if fault in (BLANK, DUPLICATE) else 2 * initial + (fault == CUT)
            while n > 0:
                some = min(n, most - len(piece.codes))
                piece.codes += bytes([code]) + bytes([GONE]) * (some - 1)
                piece.tally.add(turn, initial, fault, some)
                if code != GONE:
                    piece.messages.append((role, text))
                    piece.bytes += len(role) + len(text)
                n -= some
                code, fault = GONE, fault if fault == BLANK else DUPLICATE
                if len(piece.codes) >= most or piece.bytes >= PIECE_BYTES:
                    yield piece.row(held, part, number, False)
                    piece, number, open_ = _Piece(), number + 1, True
    if begun:
        yield piece.row(held, part, number, False)              # and the last may go on behind


def _scan(pieces: DataFrame, columns: list[str], run, made: str, downwards: bool = False) -> DataFrame:
    """``run`` over the short rows of pieces, each conversation's in order."""
    order = [F.col("part"), F.col("number")]
    return (pieces.select("conv_id", "part", "number", *columns).repartition("conv_id")
            .sortWithinPartitions("conv_id", *[c.desc() if downwards else c for c in order]).mapInArrow(run, made))


def _vectors_behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[dict]:
        held, at, begun = None, 0, False
        for batch in batches:
            for conv, part, number, jump in zip(*(c.to_pylist() for c in batch.columns)):
                last = not begun or conv != held
                held, at, begun = conv, 0 if last else at, True
                yield {"part": part, "number": number, "behind": at, "last": last}
                at = jump[at]

    return _emitted(rows(), pa.schema([("part", pa.int32()), ("number", pa.int32()), ("behind", pa.int32()),
                                       ("last", pa.bool_())]))


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of a piece and the state after it, for each state before it."""
    def rows() -> Iterator[dict]:
        for batch in batches:
            for conv, part, number, codes, behind in zip(*(c.to_pylist() for c in batch.columns)):
                symbols = np.frombuffer(codes, np.uint8)
                borders, _, _ = backwards(symbols, behind)
                found = [trace(symbols, borders, state) for state in range(4)]
                yield {"conv_id": conv, "part": part, "number": number, "audits": ["".join(edits) for edits, _ in found],
                       "after": [state for _, state in found]}

    first = next(batches, None)
    if first is None:
        return iter(())
    batches = itertools.chain([first], batches)
    return _emitted(rows(), pa.schema([first.schema.field("conv_id"), ("part", pa.int32()), ("number", pa.int32()),
                                       ("audits", pa.list_(pa.string())), ("after", pa.list_(pa.int32()))]))


def _states_before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[dict]:
        held, state, begun = None, 0, False
        for batch in batches:
            for conv, part, number, after in zip(*(c.to_pylist() for c in batch.columns)):
                state = state if begun and conv == held else 0
                held, begun = conv, True
                yield {"part": part, "number": number, "state": state}
                state = after[state]

    return _emitted(rows(), pa.schema([("part", pa.int32()), ("number", pa.int32()), ("state", pa.int32())]))


def _weight(row: dict) -> int:
    return 256 + sum(len(m["role"]) + len(m["text"]) + 64 for m in row["messages"])


def repair(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Repaired pieces of conversations: ``conv_id``, ``part`` and ``number`` (the order of the pieces of a conversation),
    ``whole`` (the conversation's only piece), ``tally`` (what was found), ``cost``, ``audit`` (the edits) and ``messages``.

    ``rows`` has ``conv_id``, ``turn``, ``role``, ``text`` and ``copies`` (1 for a plain row; 0 for one that is gone).
    """
    key = rows.schema["conv_id"].dataType.simpleString()
    ordered = (_classified(rows).repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32))
               .sortWithinPartitions("conv_id", "turn", "role", "text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema([
            first.schema.field("conv_id"), ("part", pa.int32()), ("number", pa.int32()), ("whole", pa.bool_()),
            ("tally", _ARROW_TALLY), ("cost", pa.int64()), ("audit", pa.string()), ("messages", _ARROW_MESSAGES),
            ("codes", pa.binary()), ("jump", pa.list_(pa.int32()))])
        yield from _emitted(_pieces(itertools.chain([first], batches), piece_rows), schema, _weight, PIECE_BYTES)

    pieces = materialize(ordered.mapInArrow(
        cut, f"conv_id {key}, part int, number int, whole boolean, tally struct<{_TALLY}>, cost long, audit string, "
             f"messages {_MESSAGES}, codes binary, jump array<int>"), "conversation-pieces")
    open_ = pieces.where("NOT whole")
    behind = materialize(_scan(open_, ["jump"], _vectors_behind, "part int, number int, behind int, last boolean", True),
                         "vectors-behind")
    traced = materialize(open_.join(behind, ["part", "number"]).select("conv_id", "part", "number", "codes", "behind").mapInArrow(
        _traced, f"conv_id {key}, part int, number int, audits array<string>, after array<int>"), "piece-edits")
    before = _scan(traced, ["after"], _states_before, "part int, number int, state int")
    ready = (open_.drop("cost", "audit").join(behind.drop("behind"), ["part", "number"]).join(before, ["part", "number"])
             .join(traced.select("part", "number", "audits"), ["part", "number"])
             .withColumn("audit", F.col("audits")[F.col("state")])
             .select("conv_id", "part", "number", "whole", "tally", "messages", "codes", "state", "audit", "last"))

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                row = one.to_pylist()[0]
                raw = [(m["role"], m["text"]) for m in row["messages"]]
                codes = np.frombuffer(row["codes"], np.uint8)
                edits = _split(row["audit"])
                messages, cost = edited(codes, edits, raw, row["state"], row["last"])
                state = _state_after(codes, edits, row["state"])
                audit = row["audit"] + (_TAIL[state] if row["last"] else "")
                yield pa.RecordBatch.from_arrays(
                    [*(one.column(c) for c in ("conv_id", "part", "number", "whole", "tally")), pa.array([cost], pa.int64()),
                     pa.array([audit], pa.string()), pa.array([_as_messages(messages)], _ARROW_MESSAGES)],
                    names=["conv_id", "part", "number", "whole", "tally", "cost", "audit", "messages"])

    mended = ready.mapInArrow(edit, f"conv_id {key}, part int, number int, whole boolean, tally struct<{_TALLY}>, cost long, "
                                    f"audit string, messages {_MESSAGES}")
    return pieces.where("whole").drop("codes", "jump").unionByName(mended)


def _state_after(codes: np.ndarray, edits: list[str], state: int) -> int:
    for symbol, letters in zip(codes.tolist(), edits):
        for letter in letters:
            if letter == "K":
                state = symbol // 2 + 1
            elif letter != "D":
                state = _AFTER[state]
    return state


# -- a row per conversation ----------------------------------------------------------------------------------------

_NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def digests(repaired: DataFrame) -> DataFrame:
    """A row per conversation: ``conv_id``, counts, ``cost``, ``audit`` and ``repaired_sha256`` (of ``role:text`` lines).

    The digest of a conversation in several pieces is fed piece by piece, in order, so no more than one is held.
    """
    key = repaired.schema["conv_id"].dataType.simpleString()
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"]))
    tally = F.col("tally")
    whole = repaired.where("whole").select(
        "conv_id", F.when(tally["low"].isNull(), F.lit(0).cast("long")).otherwise(
            F.expr("try_subtract(try_add(try_subtract(tally.high, tally.low), 1L), tally.turns)")).alias("gaps"),
        *[tally[name].alias(name) for name in _NAMES[1:-1]], "cost", "audit",
        F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))
    ordered = (repaired.where("NOT whole").select(
        "conv_id", "part", "number", "tally", "cost", "audit", F.size("messages").alias("n"),
        F.array_join(lines, "\n").alias("text")).repartition("conv_id").sortWithinPartitions("conv_id", "part", "number"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return

        def rows() -> Iterator[dict]:
            held = None
            for batch in itertools.chain([first], batches):
                for conv, _, _, tally, cost, audit, n, text in zip(*(c.to_pylist() for c in batch.columns)):
                    if held is not None and held[0] != conv:
                        yield _digest(*held)
                        held = None
                    if held is None:
                        held = [conv, Tally(), 0, [], hashlib.sha256(), 0]
                    held[1].join(Tally(**tally))
                    held[2] += cost
                    held[3].append(audit)
                    if n:
                        held[4].update((("\n" if held[5] else "") + text).encode())
                        held[5] += n
            if held is not None:
                yield _digest(*held)

        yield from _emitted(rows(), pa.schema([first.schema.field("conv_id"), *((name, pa.int64()) for name in _NAMES),
                                               ("audit", pa.string()), ("repaired_sha256", pa.string())]))

    split = ordered.mapInArrow(run, f"conv_id {key}, {', '.join(f'{name} long' for name in _NAMES)}, audit string, "
                                    "repaired_sha256 string")
    return whole.unionByName(split)


def _digest(conv, tally: Tally, cost: int, audits: list[str], sha, _: int) -> dict:
    return {"conv_id": conv, "gaps": tally.gaps(), "blank": tally.blank, "duplicate": tally.duplicate,
            "truncated": tally.truncated, "illegal": tally.illegal, "cost": cost, "audit": "".join(audits),
            "repaired_sha256": sha.hexdigest()}
