"""Conversation structure repair: the cheapest edits that make roles alternate.

Rows become symbols: what the role's initial is and what is wrong with the row. The
cost of a symbol is a min-plus matrix over the four states of the wanted form
``(s?(ua)+)?``, insertions in front of the row included. Runs of one symbol are collapsed;
the costs to go at the bounds of runs follow from the binary powers of the symbol's matrix,
which a worker keeps. Choices are then unrolled from the front, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlytics.llm.common import once, text_slices

WHITE = " \t\n\v\f\r"
ENDS = (".", "!", "?")
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
FAULTS = ("blank", "duplicate", "truncated")
DAMAGE = 20  # remainders; 0 to 4 damage a row

_FAR = 1 << 60
_BLOCK = 256
_BLOCKS_KEPT = 20_000
_BATCH_CHARS = 4 << 20
# States: nothing yet, after s, after u, after a. One role leads on from each.
_NEXT, _ROLE = (2, 2, 3, 2), ("user", "user", "assistant", "user")
_KEEP = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
_FINAL = (0, _FAR, _FAR, 0)

Symbol = tuple[str, bool]  # the initial or "" (none that fits) or "D" (must go), and whether truncated
Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def _product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(map(int.__add__, row, column)) for column in zip(*b, strict=True)) for row in a)


def _applied(a: Matrix, g: Vector) -> Vector:
    return tuple(min(map(int.__add__, row, g)) for row in a)


def _insertions() -> Matrix:
    """Cost of going from state to state by insertions alone."""
    step = tuple(tuple(0 if p == q else INSERT if q == _NEXT[p] else _FAR for q in range(4)) for p in range(4))
    return _product(step, _product(step, step))


_INSERT = _insertions()
_END = _applied(_INSERT, _FINAL)


class Repairer:
    """Cheapest edits of symbol sequences; powers of matrices and unrolled blocks are kept."""

    def __init__(self) -> None:
        self.powers: dict[Symbol, list[Matrix]] = {}
        self.blocks: dict[tuple[Symbol, int, Vector, int], tuple[str, int]] = {}

    @staticmethod
    def step(symbol: Symbol) -> Matrix:
        """Cost from state to state: insertions, then the row's own edit."""
        initial, truncated = symbol
        rows = [[DELETE if p == q else _FAR for q in range(4)] for p in range(4)]
        if initial != "D":
            more = TRUNCATED if truncated else 0
            for p in range(4):
                rows[p][_NEXT[p]] = min(rows[p][_NEXT[p]], REROLE + more)
                q = _KEEP.get(initial, (None,) * 4)[p]
                if q is not None:
                    rows[p][q] = min(rows[p][q], more)
        return _product(_INSERT, tuple(map(tuple, rows)))

    def before(self, symbol: Symbol, number: int, after: Vector) -> Vector:
        """Cost to go before ``number`` equal rows, from the cost after them."""
        powers = self.powers.setdefault(symbol, [self.step(symbol)])
        bit = 0
        while number:
            if bit == len(powers):
                powers.append(_product(powers[-1], powers[-1]))
            if number & 1:
                after = _applied(powers[bit], after)
            number, bit = number >> 1, bit + 1
        return after

    def solve(self, runs: list[tuple[Symbol, int]]) -> tuple[int, str]:
        """Least cost, and the ASCII-least audit of that cost."""
        ahead = [_END]
        for symbol, number in reversed(runs):
            ahead.append(self.before(symbol, number, ahead[-1]))
        audit: list[str] = []
        state = 0
        for (symbol, number), after in zip(runs, ahead[-2::-1], strict=True):
            while number:
                block = min(number, _BLOCK)
                number -= block
                edits, state = self._unrolled(symbol, state, self.before(symbol, number, after), block)
                audit.append(edits)
        while not (_FINAL[state] == 0 and _END[state] == 0):
            audit.append("I")
            state = _NEXT[state]
        return ahead[-1][0], "".join(audit)

    def _unrolled(self, symbol: Symbol, state: int, after: Vector, block: int) -> tuple[str, int]:
        """Edits of a block of equal rows, and the state after it. They depend on how the
        costs after it differ only, which soon repeats in a long run."""
        least = min(after)
        key = (symbol, state, tuple(cost - least for cost in after), block)
        if key not in self.blocks:
            if len(self.blocks) == _BLOCKS_KEPT:
                self.blocks.clear()
            costs = [after]
            for _ in range(block):
                costs.append(self.before(symbol, 1, costs[-1]))
            edits: list[str] = []
            for at in range(block, 0, -1):
                state = self._edit(symbol, state, costs[at], costs[at - 1], edits)
            self.blocks[key] = "".join(edits), state
        return self.blocks[key]

    @staticmethod
    def _edit(symbol: Symbol, state: int, here: Vector, after: Vector, audit: list[str]) -> int:
        """The edits at one row, least letter first: the state after it."""
        initial, truncated = symbol
        more = TRUNCATED if truncated else 0
        while True:
            if here[state] == DELETE + after[state]:
                audit.append("D")
                return state
            following = _NEXT[state]
            if here[state] == INSERT + here[following]:
                audit.append("I")
                state = following
                continue
            kept = _KEEP.get(initial, (None,) * 4)[state]
            if kept is not None and here[state] == more + after[kept]:
                audit.append("K")
                return kept
            audit.append("R")
            return following


def faults(rows: list[tuple[str, str]]) -> list[str | None]:
    """First fault of each row of (role, text)."""
    seen: set[tuple[str, str]] = set()
    found: list[str | None] = []
    for row in rows:
        end = row[1].rstrip(WHITE)[-1:]
        found.append("blank" if not end else "duplicate" if row in seen else None if end in ENDS else "truncated")
        seen.add(row)
    return found


def repaired(rows: list[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    out, state, at = [], 0, 0
    for edit in audit:
        if edit == "D":
            at += 1
        elif edit == "I":
            out.append((_ROLE[state], ""))
            state = _NEXT[state]
        else:
            role, text = rows[at]
            at += 1
            out.append((role if edit == "K" else _ROLE[state], text))
            state = _KEEP[role[0]][state] if edit == "K" else _NEXT[state]
    return out


def gaps(turns: list[int | None]) -> int:
    known = [t for t in turns if t is not None]
    return min(max(known) - min(known) + 1 - len(set(known)), 2**63 - 1) if known else 0


def examine(turns: list[int | None], rows: list[tuple[str, str]], repairer: Repairer) -> dict:
    """All results of one conversation, its rows in order."""
    wrong = faults(rows)
    symbols = [
        ("D", False) if fault in ("blank", "duplicate")
        else (role[:1] if role[:1] in _KEEP else "", fault == "truncated")
        for (role, _), fault in zip(rows, wrong, strict=True)
    ]
    cost, audit = repairer.solve([(symbol, sum(1 for _ in same)) for symbol, same in groupby(symbols)])
    initials = [role[:1] for role, _ in rows]
    legal = {("s", "u"), ("u", "a"), ("a", "u")}
    return {
        "gaps": gaps(turns), **{fault: wrong.count(fault) for fault in FAULTS},
        "illegal": sum(pair not in legal for pair in zip(initials, initials[1:], strict=False)),
        "cost": cost, "audit": audit,
        "turns": [{"role": role, "text": text} for role, text in repaired(rows, audit)],
    }


_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_NUMBERS = ("gaps", *FAULTS, "illegal", "cost")
_SCHEMA = pa.schema([
    ("conv_id", pa.int64()), *[(k, pa.int64()) for k in _NUMBERS], ("audit", pa.string()), ("turns", _TURNS),
])
_SQL = (
    f"conv_id bigint, {', '.join(f'{k} bigint' for k in _NUMBERS)}, audit string, "
    "turns array<struct<role:string,text:string>>"
)


def repair(
    turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", gone_col: str | None = None,
) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit (edits' initials: keep,
    rerole, delete, insert) and the repaired turns, one row per conversation.

    Rows go by (turn, role, text), a null turn first, so that ties have one order; rows
    with a null id are one conversation with a null id. Null roles and texts are one
    space. Rows where ``gone_col`` is true only make sure that their conversation is
    reported: without other rows its numbers are 0, its audit and turns empty. Other
    columns are ignored, whatever their names; an empty table gives no rows. One shuffle by conversation,
    sorted outside Python; a task holds one conversation at a time, which is one row of the result.
    """
    source = turns.select(
        turns[conv_col].cast("long").alias("conv_id"), turns[turn_col].cast("long").alias("turn"),
        F.coalesce(turns[role_col].cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(turns[text_col].cast("string"), F.lit(" ")).alias("text"),
        (F.coalesce(turns[gone_col], F.lit(False)) if gone_col else F.lit(False)).alias("gone"),
    )
    ordered = source.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = once(("repair",), Repairer)
        out, size = [], 0
        for conv_id, numbers, rows in _conversations(batches):
            out.append({"conv_id": conv_id} | examine(numbers, rows, repairer))
            size += 1000 + sum(len(text) for _, text in rows)
            if size >= _BATCH_CHARS:
                yield pa.RecordBatch.from_pylist(out, _SCHEMA)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, _SCHEMA)

    return ordered.mapInArrow(run, _SQL)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list, list]]:
    """Conversations of a sorted stream, which may go on from batch to batch."""
    first, now, numbers, rows = True, None, [], []
    for batch in text_slices(batches):
        for conv_id, turn, role, text, gone in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if first or conv_id != now:
                if not first:
                    yield now, numbers, rows
                first, now, numbers, rows = False, conv_id, [], []
            if not gone:
                numbers.append(turn)
                rows.append((role, text))
    if not first:
        yield now, numbers, rows


def damaged(turns: DataFrame) -> DataFrame:
    """Conversation rows, damaged by crc32(``conv_id:turn``) % 20; ``gone`` marks dropped ones.

    0 drops the row, 1 empties its text, 2 removes its ``.``, ``!`` and ``?``, 3 repeats it, 4 sets
    the role user. Nulls are one space.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % DAMAGE
    text = F.coalesce("text", space)
    return turns.select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.array_repeat(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")
