"""Secret scans: fixed shapes, and strings that a tokenizer finds hard to write.

Prose takes few tokens a character, random strings many. A run of letters,
digits and ``+/_-`` of 20 characters or more that holds letters and has at most 1.9
characters a token counts as random, unless it is a known digest (bare hex of a
digest's length), a UUID or an identifier whose parts are each plain letters or
plain digits; one part of letters alone counts if no token of it has five or more.
Where a whole run does not count, its parts between ``/``, ``_`` and ``-`` and then
every 20 characters of what is left are judged alike, digests and UUIDs left out.
Of the latter, those with more than three separators are names of short words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlytics.llm.byte_bpe import ByteEncoder
from eventlytics.llm.common import id_and_text, once, text_slices, texts_of

KINDS = ("assign", "access", "hex", "random")
MIN_LENGTH = 20
MAX_RATIO = 1.9
#: The shapes of the base kinds and the lengths of bare digests in hex.
ASSIGN = r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)

_ASSIGN, _ACCESS, _HEX = re.compile(ASSIGN), re.compile(ACCESS), re.compile(HEX)
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_UUID = r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
_KNOWN = re.compile(
    "|".join(rf"[0-9a-fA-F]{{{n}}}" for n in DIGEST_LENGTHS) + f"|{_UUID}"
)
_KNOWN_PART = re.compile(rf"(?<![A-Za-z0-9])(?:{_KNOWN.pattern})(?![A-Za-z0-9])")
_PART = re.compile(r"[A-Za-z0-9+]+")
_SEPARATORS = 3
_WORD_LETTERS = 5  # a token of so many letters is taken for a known word
_NAME = re.compile(r"(?:[A-Za-z]+|[0-9]+)(?:[+/_-]+(?:[A-Za-z]+|[0-9]+|$))*")

Span = tuple[int, str, int]  # start, kind, end


class Scanner:
    def __init__(self, vocabulary: str, min_length: int = MIN_LENGTH, max_ratio: float = MAX_RATIO) -> None:
        encoder = once(("byte_bpe", vocabulary), lambda: ByteEncoder(vocabulary))
        self.encode, self.min_length, self.max_ratio = encoder.fast, min_length, max_ratio
        self.words = {i for token, i in encoder.ranks.items() if len(token) >= _WORD_LETTERS and token.isalpha()}
        run = r"[A-Za-z0-9+/_-]"
        self.runs = re.compile(rf"(?<!{run}){run}{{{min_length},}}")

    def random(self, run: str) -> bool:
        plain = run.isalpha()
        if not plain and (not any(map(str.isalpha, run)) or _KNOWN.fullmatch(run) or _NAME.fullmatch(run)):
            return False
        ids = self.encode(run)
        return len(run) <= self.max_ratio * len(ids) and not (plain and self.words.intersection(ids))

    def _dense(self, piece: str) -> bool:
        return sum(map(piece.count, "/_-")) <= _SEPARATORS and self.random(piece)

    def pieces(self, run: str) -> list[tuple[int, int]]:
        """What counts as random in a run: all of it, or disjoint pieces in order."""
        if self.random(run):
            return [(0, len(run))]
        known = [] if _KNOWN.fullmatch(run) else [m.span() for m in _KNOWN_PART.finditer(run)]
        if not known and (_KNOWN.fullmatch(run) or len(run) == self.min_length):
            return []
        parts = [m.span() for m in _PART.finditer(run)]
        found = [
            (a, b) for a, b in parts
            if b - a >= self.min_length and (a, b) not in known and self.random(run[a:b])
        ]
        closed = sorted(known + found)
        for a, b in _outside(0, len(run), closed):
            at = a
            while at + self.min_length <= b:
                if not self._dense(run[at : at + self.min_length]):
                    at += 1
                    continue
                end = at + self.min_length
                # whole parts: a key is not cut where it touches a readable one
                start = min([x for x, y in parts if x <= at < y], default=at)
                while end < b and self._dense(run[end + 1 - self.min_length : end + 1]):
                    end += 1
                end = max([y for x, y in parts if x < end <= y], default=end)
                found.append((max(start, a), min(end, b)))
                at = found[-1][1]
        return sorted(found)

    def spans(self, text: str) -> list[Span]:
        """By start, then kind as listed; random ones are trimmed to where no other span lies."""
        low = text.lower()
        found: list[Span] = []
        if any(word in low for word in _WORDS):
            found += [
                (m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12
            ]
        found += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text)]
        found += [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]
        base = sorted((start, end) for start, _, end in found)
        for m in self.runs.finditer(text):
            for a, b in self.pieces(m[0]):
                a, b = a + m.start(), b + m.start()
                near = [(start, end) for start, end in base if start < b and a < end]
                found += [
                    (x, "random", y) for x, y in _outside(a, b, near) if any(map(str.isalnum, text[x:y]))
                ]
        return sorted(found, key=lambda s: (s[0], KINDS.index(s[1])))


def _outside(start: int, end: int, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What sorted spans leave of start to end."""
    out = []
    for a, b in spans:
        if a > start:
            out.append((start, a))
        start = max(start, b)
    return out + [(start, end)] if start < end else out


def blanked(text: str, spans: list[Span], mark: str) -> str:
    """The text with each run of overlapping spans replaced by ``mark``."""
    out, at, until = [], 0, -1
    for start, _, end in spans:
        if start >= until:
            out += [text[at:start], mark]
        until = max(until, end)
        at = until
    return "".join(out) + text[at:]


def scan(
    docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text",
    min_length: int = MIN_LENGTH, max_ratio: float = MAX_RATIO,
) -> DataFrame:
    """doc_id, spans: array of (kind, start, end) over code points, end exclusive.

    One row per row, whole texts; null and empty texts have no spans. No shuffle.
    """
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = ("secrets", vocabulary, min_length, max_ratio)
        scanner = once(key, lambda: Scanner(vocabulary, min_length, max_ratio))
        for batch in text_slices(batches):
            spans = [
                [{"kind": k, "start": a, "end": b} for a, k, b in scanner.spans(text)] for text in texts_of(batch)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(spans, spans_type)], ["doc_id", "spans"]
            )

    source = id_and_text(docs, id_col, text_col).select(F.col("doc_id").cast("long"), "text")
    return source.mapInArrow(run, "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>")


def redact(
    docs: DataFrame, vocabulary: str, *, text_col: str = "text", mark: str = "<secret>",
    min_length: int = MIN_LENGTH, max_ratio: float = MAX_RATIO,
) -> DataFrame:
    """The same rows and columns, with every span of the text replaced by ``mark``.

    Null texts stay null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = ("secrets", vocabulary, min_length, max_ratio)
        scanner = once(key, lambda: Scanner(vocabulary, min_length, max_ratio))
        for batch in text_slices(batches, text_col):
            texts = [
                t if t is None else blanked(t, scanner.spans(t), mark)
                for t in batch.column(text_col).to_pylist()
            ]
            at = batch.schema.get_field_index(text_col)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
