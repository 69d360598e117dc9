"""Fill-in-the-middle: documents cut in three and written prefix, suffix, middle.

A batch of texts becomes an Arrow list array of units (code points, words or lines), which
is flattened with the index of each unit's parent; a unit's ordinal within its text
tells its role. Units are filtered by role, lists rebuilt from what is left, and the
pieces joined and put together by ``binary_join``. Texts longer than ``PART_BYTES`` go
through as several lists, so memory beside the texts is bounded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlytics.llm.common import id_and_text, text_slices
from eventlytics.llm.marks import check_marks

MARKS = ("<P>", "<S>", "<M>")  # of prefix, suffix and middle
UNITS = ("character", "word", "line")
PLAIN_FROM = 90  # of 100: documents from here on stay plain
SPM_BELOW = 20  # of 100 of the others: suffix first
PART_BYTES = 1 << 20
SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def unit_starts(data: np.ndarray, start: int, stop: int, text_start: int, unit: str) -> np.ndarray:
    """Which bytes of a text's part start a unit: a code point, a word with the white space
    after it (white space in front of the first word is a unit), or a line with its line feed."""
    here = data[start:stop]
    if unit == "character":
        return (here & 0xC0) != 0x80
    before = np.concatenate([data[start - 1 : start] if start > text_start else [10], here[:-1]])
    if unit == "line":
        return before == 10

    def space(x: np.ndarray) -> np.ndarray:
        return (x == 32) | ((x >= 9) & (x <= 13))

    starts = space(before) & ~space(here)
    if start == text_start and len(starts):
        starts[0] = True
    return starts


class Parts:
    """Texts as parts of at most about ``PART_BYTES`` that end with a code point."""

    def __init__(self, texts: pa.StringArray, unit: str) -> None:
        self.buffer = texts.buffers()[2] or pa.py_buffer(b"")
        self.data = np.frombuffer(self.buffer, np.uint8)
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        self.unit, self.bounds, self.first = unit, [], [0]  # (start, stop, start of text), parts before each text
        self.number = np.zeros(len(texts), np.int64)  # units of each text
        self.base: list[int] = []  # ordinal of each part's first unit
        for text, (start, stop) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
            at = start
            while at < stop:
                end = min(at + PART_BYTES, stop)
                while end < stop and self.data[end] & 0xC0 == 0x80:
                    end += 1
                starts = unit_starts(self.data, at, end, start, unit)
                self.bounds.append((at, end, start))
                # a part that begins within a unit goes on with its ordinal
                self.base.append(int(self.number[text]) - (not starts[0]))
                self.number[text] += np.count_nonzero(starts)
                at = end
            self.first.append(len(self.bounds))

    def pieces(self, cuts: np.ndarray) -> list[pa.Array]:
        """Prefix, middle and suffix of every text; ``cuts``: ordinals where the latter two begin."""
        part_cuts = np.repeat(cuts, np.diff(self.first), axis=0)
        done: list[list[pa.Array]] = [[], [], []]
        at = 0
        while at < len(self.bounds):
            size, end = 0, at
            while end < len(self.bounds) and (end == at or size < PART_BYTES):
                size += self.bounds[end][1] - self.bounds[end][0]
                end += 1
            for role, joined in enumerate(self._block(at, end, part_cuts[at:end])):
                done[role].append(joined)
            at = end
        lists = pa.array(self.first, pa.int32())
        return [
            pc.binary_join(pa.ListArray.from_arrays(lists, pa.concat_arrays([*role, pa.array([], pa.string())])), "")
            for role in done
        ]

    def _block(self, at: int, end: int, cuts: np.ndarray) -> list[pa.Array]:
        starts = [np.flatnonzero(self._starts(i)).astype(np.int32) + self.bounds[i][0] for i in range(at, end)]
        lists = np.concatenate([[0], np.cumsum([len(s) for s in starts])]).astype(np.int32)
        offsets = np.concatenate([*starts, [self.bounds[end - 1][1]]]).astype(np.int32)
        # the parts of a block lie side by side, so a unit ends where the next one starts
        units = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), self.buffer)
        split = pa.ListArray.from_arrays(pa.array(lists), units)
        flat, parent = pc.list_flatten(split), pc.list_parent_indices(split)
        base = pa.array(np.array(self.base[at:end]) - lists[:-1])
        ordinal = pc.add(pa.array(np.arange(len(flat))), pc.take(base, parent))
        low, high = (pc.take(pa.array(cuts[:, i]), parent) for i in range(2))
        roles = [
            pc.less(ordinal, low),
            pc.and_(pc.greater_equal(ordinal, low), pc.less(ordinal, high)),
            pc.greater_equal(ordinal, high),
        ]
        out = []
        for role in roles:
            kept = np.bincount(pc.filter(parent, role).to_numpy(), minlength=end - at)
            rebuilt = np.concatenate([[0], np.cumsum(kept)]).astype(np.int32)
            out.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(rebuilt), pc.filter(flat, role)), ""))
        return out

    def _starts(self, part: int) -> np.ndarray:
        starts = unit_starts(self.data, *self.bounds[part], self.unit)
        starts[0] = True
        return starts


def transform(
    texts: pa.StringArray, draws: list[np.ndarray], unit: str = UNITS[0], marks: tuple[str, str, str] = MARKS,
    plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW,
) -> list[pa.Array]:
    """n, form, prefix_chars, middle_chars and output of every text; four draws for each."""
    parts = Parts(texts, unit)
    number = parts.number
    ends = np.stack([draws[0] % (number + 1), draws[1] % (number + 1)], axis=1)
    ends.sort(axis=1)
    prefix, middle, suffix = parts.pieces(ends)
    marked = pc.match_substring_regex(texts, "|".join(map(re.escape, marks)))
    plain = pc.or_(pc.or_(pc.equal(pc.binary_length(texts), 0), marked), pa.array(draws[2] % 100 >= plain_from))
    spm = pa.array(draws[3] % 100 < spm_below)
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    p, s, m = (pc.binary_join_element_wise(k, x, "") for k, x in zip(marks, (prefix, suffix, middle), strict=True))
    first, second = pc.if_else(spm, s, p), pc.if_else(spm, p, s)
    output = pc.if_else(plain, texts, pc.binary_join_element_wise(first, second, m, ""))
    lengths = [pc.if_else(plain, pa.scalar(None, pa.int64()), pc.cast(pc.utf8_length(x), pa.int64())) for x in (prefix, middle)]
    return [pa.array(number), form, *lengths, output]


def fill_in_middle(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", seed: str = "1:", unit: str = UNITS[0],
    marks: tuple[str, str, str] = MARKS, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW,
) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars (code points; null if
    plain), output. One row per row; no shuffle.

    The draws h1 to h4 are the first 8-digit groups of the hex sha256 of ``seed`` and the id
    as text (a null id: no text), so equal ids draw alike, whatever their texts. Null
    texts count as empty; empty texts and those that hold a mark stay plain. Texts are
    cut whole, however long. Other columns are ignored, whatever their names.
    """
    check_marks(list(marks))
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    source = id_and_text(docs, id_col, text_col).select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            drawn = [batch.column(f"h{i}").to_numpy() for i in range(1, 5)]
            columns = transform(batch.column("text"), drawn, unit, marks, plain_from, spm_below)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    return source.select("*", *draws).mapInArrow(run, SCHEMA)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text again. Texts hold no mark where the form is not plain, so marks split it."""
    parts = F.split(output, "|".join(map(re.escape, marks)))
    return (
        F.when(form == "psm", F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2))))
        .when(form == "spm", F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1))))
        .otherwise(output)
    )
