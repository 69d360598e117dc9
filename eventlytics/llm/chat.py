"""Chat formatting: conversations as one text with a loss mask, by Spark expressions only.

The turns of a conversation are collected as structs and sorted, adjacent turns of one
role are merged (a run is a slice of the turns, aggregated into one block), and blocks
are concatenated. Control strings of the template that stand in a text or role are
escaped by one backslash more after their first character, so the text
is read back exactly: ``[INST]`` is written ``[\\INST]``, and ``[\\INST]`` is ``[\\\\INST]``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlytics.llm.marks import check_marks

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """``begin``, then a block for each run of turns: what opens it, texts with ``between``
    between them, what closes it. An empty opening string is allowed for one role. Roles that
    ``roles`` doesn't name stand between the two marks of ``other`` in front of their texts,
    and are closed by its third. Texts of the roles in ``trained`` are under the loss mask."""

    begin: str = "<s>"
    roles: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "system": ("[SYSTEM_PROMPT]", "[/SYSTEM_PROMPT]"), "user": ("[INST]", "[/INST]"), "assistant": ("", "</s>"),
    })
    other: tuple[str, str, str] = ("[ROLE]", "[/ROLE]", "[/TURN]")
    between: str = "[NEXT]"
    trained: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        if sum(not opening for opening, _ in self.roles.values()) > 1:
            raise ValueError("only one role may open with nothing")
        check_marks(self.marks, ESCAPE)

    @property
    def marks(self) -> list[str]:
        pairs = [m for pair in self.roles.values() for m in pair if m]
        return [self.begin, *pairs, *self.other, self.between]

    def _replaced(self, text: Column, run: str, by: str) -> Column:
        """Every mark with ``run`` after its first character, and ``by`` in place of that run."""
        ends: dict[str, list[str]] = {}
        for mark in self.marks:
            ends.setdefault(mark[0], []).append(re.escape(mark[1:]))
        return reduce(
            lambda done, first: F.regexp_replace(
                done, f"({re.escape(first)}){run}({'|'.join(ends[first])})", f"$1{by}$3"
            ),
            ends, text,
        )

    def escaped(self, text: Column) -> Column:
        return self._replaced(text, r"(\\*)", r"\\$2")

    def unescaped(self, text: Column) -> Column:
        return self._replaced(text, r"\\(\\*)", "$2")

    def opening(self, role: Column) -> Column:
        named = F.concat(F.lit(self.other[0]), self.escaped(role), F.lit(self.other[1]))
        return _by_role(role, {r: F.lit(a) for r, (a, _) in self.roles.items()}, named)

    def closing(self, role: Column) -> Column:
        return _by_role(role, {r: F.lit(b) for r, (_, b) in self.roles.items()}, F.lit(self.other[2]))

    @property
    def block(self) -> str:
        """Regular expression of one block; the role that opens with nothing comes last."""
        first, second, end = map(re.escape, self.other)
        marked = [f"{re.escape(a)}.*?{re.escape(b)}" for a, b in self.roles.values() if a]
        bare = [f".*?{re.escape(b)}" for a, b in self.roles.values() if not a]
        return "(?s)" + "|".join([*marked, f"{first}.*?{second}.*?{end}", *bare])


def _by_role(role: Column, named: dict[str, Column], otherwise: Column) -> Column:
    return F.coalesce(*[F.when(role == r, value) for r, value in named.items()], otherwise)


def format_chats(
    turns: DataFrame, template: Template = Template(), *, conv_col: str = "conv_id",
    turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """conv_id, formatted, and ``pieces``: array of (text, trained) whose texts make up
    ``formatted``; the loss mask is what stands in trained pieces.

    One row per conversation; rows with a null id are one conversation with a null id.
    Turns go by (turn, role, text), a null turn first, so that ties have one order;
    repeated rows are turns of their own. Null roles and texts are empty. Other
    columns are ignored, whatever their names. An empty table gives no rows. One shuffle by
    conversation; work and memory are proportional to a conversation's text, which is one value
    of the result and so holds at most what a Spark row holds (2 GB).
    """
    runs = merged_turns(
        turns.select(
            turns[conv_col].alias("conv_id"), turns[turn_col].alias("turn"),
            turns[role_col].cast("string").alias("role"), turns[text_col].cast("string").alias("text"),
        )
    )

    def piece(text: Column, trained: Column) -> Column:
        return F.struct(text.alias("text"), trained.alias("trained"))

    def block(run: Column) -> Column:
        role, no = run["role"], F.lit(False)
        texts = F.transform(run["texts"], lambda text, at: F.array(
            piece(F.when(at == 0, template.opening(role)).otherwise(template.between), no),
            piece(template.escaped(text), role.isin(*template.trained)),
        ))
        return F.concat(F.flatten(texts), F.array(piece(template.closing(role), no)))

    pieces = F.concat(
        F.array(piece(F.lit(template.begin), F.lit(False))), F.flatten(F.transform("runs", block))
    )
    return runs.select("conv_id", pieces.alias("pieces")).select(
        "conv_id", F.array_join(F.col("pieces")["text"], "").alias("formatted"), "pieces"
    )


def merged_turns(turns: DataFrame) -> DataFrame:
    """conv_id, runs: array of (role, texts), one for each run of adjacent turns of one role."""
    known = F.struct("turn", *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")])
    collected = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(known)).alias("turns"))
    turn = F.col("turns")
    starts = F.filter(
        F.sequence(F.lit(0), F.size(turn) - 1),
        lambda i: (i == 0) | (F.get(turn, i)["role"] != F.get(turn, i - 1)["role"]),
    )
    ends = F.concat(F.slice("starts", 2, F.size("starts")), F.array(F.size(turn)))
    runs = F.transform(
        F.arrays_zip(F.col("starts").alias("start"), F.col("ends").alias("stop")),
        lambda run: F.struct(
            F.get(turn, run["start"])["role"].alias("role"),
            F.slice(turn, run["start"] + 1, run["stop"] - run["start"])["text"].alias("texts"),
        ),
    )
    return collected.withColumn("starts", starts).withColumn("ends", ends).select("conv_id", runs.alias("runs"))


def read_back(formatted: Column, template: Template = Template()) -> Column:
    """Turns of a formatted conversation, in order: array of (role, text)."""
    body = F.substring(formatted, len(template.begin) + 1, 2**31 - 1)
    blocks = F.regexp_extract_all(body, F.lit(template.block), F.lit(0))
    first, second, end = template.other

    def cut(block: Column, opening: int, closing: int) -> Column:
        return F.substr(block, F.lit(opening + 1), F.length(block) - F.lit(opening + closing))

    def turns(role: Column, texts: Column) -> Column:
        each = F.split(texts, re.escape(template.between))
        return F.transform(each, lambda t: F.struct(role.alias("role"), template.unescaped(t).alias("text")))

    def named(block: Column) -> Column:
        inside = F.split(cut(block, len(first), len(end)), re.escape(second))
        return turns(template.unescaped(inside[0]), inside[1])

    def read(block: Column) -> Column:
        marked = [(a, b, r) for r, (a, b) in template.roles.items() if a]
        bare = [(a, b, r) for r, (a, b) in template.roles.items() if not a]
        found = [
            F.when(block.startswith(a), turns(F.lit(r), cut(block, len(a), len(b)))) for a, b, r in marked
        ]
        found.append(F.when(block.startswith(first), named(block)))
        found += [turns(F.lit(r), cut(block, 0, len(b))) for _, b, r in bare]
        return F.coalesce(*found)

    return F.flatten(F.transform(blocks, read))


def loss_text(pieces: Column, template: Template = Template()) -> Column:
    """What stands under the loss mask, unescaped, nothing between."""
    trained = F.filter(pieces, lambda p: p["trained"])
    return F.array_join(F.transform(trained, lambda p: template.unescaped(p["text"])), "")
