"""Texts of a page's elements, found for a whole Arrow batch of pages at a time.

Nesting is as in ``markup``: in pages whose tags are closed in turn the n-th opening tag
of a depth belongs to its n-th closing tag, here by sorting the tags of all pages of a
batch at once. Pages with comments, scripts, quoted or stray brackets, or tags
left open go through a stack one by one.

A path is a sequence of steps (name, class, nth): each takes the elements of a name, and
of a class if one is given, inside those of the step before (the page at first), all of
them or the nth of each.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from eventlytics.operators.markup import HOLDERS, LEFT_OPEN, TOKEN, VOID

# Functions that run in tasks travel with the job: workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Step = tuple[str, str | None, int | None]
#: A text or null of one element; a list of texts; such lists by elements of the first step.
KINDS = {"first": StringType(), "all": ArrayType(StringType()), "grouped": ArrayType(ArrayType(StringType()))}

_SLICE = 4 << 20
_WIDTH = 8
_CLASS = rb"(?is)^<[^\s>]+(?:\s[^>]*?)?\sclass\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
_ENTITIES = ((b"&lt;", b"<"), (b"&gt;", b">"), (b"&quot;", b'"'), (b"&#39;", b"'"), (b"&nbsp;", b" "), (b"&amp;", b"&"))


def texts(
    pages: DataFrame, fields: Mapping[str, tuple[str, Sequence[Step]]], html_col: str = "html", keep: Sequence[str] = ("page_id",)
) -> DataFrame:
    """keep and the raw texts (tags left out, entities as they are) of every field's path."""
    names = sorted({step[0] for _, path in fields.values() for step in path} | set(HOLDERS))
    if set(names) & set(VOID) or any(len(name) >= _WIDTH for name in names):
        raise ValueError(f"elements that can't be scanned: {names}")
    kept = pages.select(*keep, html_col)
    schema = StructType([f for f in kept.schema.fields[:-1]] + [StructField(c, KINDS[kind]) for c, (kind, _) in fields.items()])
    scan = _Scanner(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html = batch.column(batch.num_columns - 1).cast(pa.large_string()).fill_null("")
            ends = np.cumsum(np.diff(_offsets(html)))
            at = 0
            while at < len(html):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _SLICE, "right")))
                found = scan.batch(html.slice(at, to - at))
                columns = [batch.column(i).slice(at, to - at) for i in range(batch.num_columns - 1)]
                columns += [_column(kind, found.follow(path), to - at) for kind, path in fields.values()]
                yield pa.RecordBatch.from_arrays(columns, schema.names)
                at = to

    return kept.mapInArrow(run, schema)


def _offsets(html: pa.Array) -> np.ndarray:
    return np.frombuffer(html.buffers()[1], np.int64)[html.offset : html.offset + len(html) + 1]


def _lists(counts: np.ndarray, values: pa.Array) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _column(kind: str, found: tuple[np.ndarray, np.ndarray, list[bytes]], size: int) -> pa.Array:
    outer, item, made = found
    values = pa.array(made, pa.binary()).cast(pa.string())
    page = outer[item]
    if kind == "first":
        place = np.full(size, -1)
        place[page[::-1]] = np.arange(len(page))[::-1]
        return values.take(pa.array(place, mask=place < 0))
    if kind == "all":
        return _lists(np.bincount(page, minlength=size), values)
    return _lists(np.bincount(outer, minlength=size), _lists(np.bincount(item, minlength=len(outer)), values))


def _class(tag: bytes) -> tuple[bytes, ...]:
    """A tag's class as written, then its words."""
    found = re.match(_CLASS, tag)
    if not found:
        return ()
    value = found[1][1:-1] if found[1][:1] in b"\"'" else found[1]
    for entity, char in _ENTITIES if b"&" in value else ():
        value = value.replace(entity, char)
    return (value, *re.split(rb"\s+", value))


def _stack(page: str, wanted: set[str]) -> tuple[list[bytes], list[tuple[int, int, int, int, str]]]:
    """(tokens, elements (number, last, start, stop, name)) of one page."""
    tokens = [m[0] for m in re.finditer(TOKEN, page, re.ASCII)]
    tags = []
    for at, token in enumerate(tokens):
        found = re.match(r"</?([a-z][a-z0-9-]*)", token, re.ASCII | re.IGNORECASE)
        if found and found[1].lower() in wanted:
            tags.append((at, found[1].lower(), token.startswith("</")))

    def fold(in_turn: bool) -> list | None:
        open_, done, opened = [], [], 0

        def close(kept: int, stop: int) -> None:
            done.extend((number, opened - 1, start, stop, name) for number, start, name in open_[kept:])
            del open_[kept:]

        for at, name, closes in tags:
            back = next((k for k, e in enumerate(reversed(open_), 1) if e[2] == name), 0)
            if closes and in_turn and back != 1:
                return None
            held = any(e[2] in HOLDERS for e in open_[len(open_) - back + 1 :])
            if back and (closes or not in_turn and name in LEFT_OPEN and not held):
                close(len(open_) - back, at)
            if not closes:
                open_.append((opened, at, name))
                opened += 1
        if open_ and in_turn:
            return None
        close(0, len(tokens))
        return sorted(done)

    elements = fold(True)
    return [t.encode() for t in tokens], fold(False) if elements is None else elements


class _Scanner:
    def __init__(self, names: Sequence[str]):
        self.names = list(names)
        self.codes = np.array([int.from_bytes(n.encode().ljust(_WIDTH, b"\0"), "little") for n in names], np.uint64)
        self.order = np.argsort(self.codes)
        self.classes: dict[bytes, int] = {}
        self.values: list[tuple[bytes, ...]] = []

    def known(self, tags: Sequence[bytes]) -> dict[bytes, int]:
        """Tags and the place of their class in ``values``."""
        for tag in set(tags) - self.classes.keys():
            self.classes[tag] = len(self.values)
            self.values.append(_class(tag))
        return self.classes

    def batch(self, html: pa.Array) -> _Found:
        if len(self.values) > 100_000:
            self.classes, self.values = {}, []
        return _Found(self, html)


class _Found:
    """The elements of a batch of pages, by page and number."""

    def __init__(self, scanner: _Scanner, html: pa.Array):
        self.scanner = scanner
        offsets = _offsets(html)
        self.raw = raw = html.buffers()[2].slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes() if html.buffers()[2] else b""
        self.offsets = offsets = offsets - offsets[0]
        size, buf = len(html), np.frombuffer(raw, np.uint8)
        begin, shut = np.flatnonzero(buf == 60), np.flatnonzero(buf == 62)
        page = np.searchsorted(offsets, begin, "right") - 1
        odd = np.zeros(size, bool)
        # a tag ends at the next ">", before the next "<" and inside its page
        limit = np.minimum(np.append(begin[1:], len(raw)), offsets[page + 1])
        end = np.append(shut, len(raw))[np.searchsorted(shut, begin)]
        simple = end < limit
        spots = begin[:, None] + np.arange(1, _WIDTH + 2)
        heads = np.append(buf, np.zeros(_WIDTH + 2, np.uint8))[spots]
        closes = heads[:, 0] == 47
        heads = np.where(closes[:, None], heads[:, 1:], heads[:, :-1])
        upper = (heads >= 65) & (heads <= 90)
        heads = np.where(upper, heads | 32, heads)
        letters = (heads >= 97) & (heads <= 122)
        simple &= letters[:, 0]
        simple &= ~((heads[:, :6] == np.frombuffer(b"script", np.uint8)).all(1) | (heads[:, :5] == np.frombuffer(b"style", np.uint8)).all(1))
        counts = []
        for mark in (34, 39):
            marks = np.flatnonzero(buf == mark)
            counts.append(np.searchsorted(marks, end) - np.searchsorted(marks, begin))
        simple &= (counts[0] % 2 == 0) & (counts[1] % 2 == 0) & ((counts[0] == 0) | (counts[1] == 0))
        odd[page[~simple]] = True
        in_name = letters | ((heads >= 48) & (heads <= 57)) | (heads == 45)
        heads = heads * np.logical_and.accumulate(in_name, 1)
        code = np.ascontiguousarray(heads).view(np.uint64)[:, 0]
        place = np.minimum(np.searchsorted(scanner.codes[scanner.order], code), len(scanner.names) - 1)
        name = scanner.order[place]
        wanted = scanner.codes[name] == code
        # what is left of the batch without its tags, and where
        length = np.where(simple, end + 1 - begin, 0)
        self.begin, self.before = begin, np.concatenate([[0], np.cumsum(length)])
        edge = np.zeros(len(raw) + 1, np.int8)
        edge[begin[simple]] += 1
        edge[end[simple] + 1] -= 1
        self.plain = buf[np.cumsum(edge[:-1], dtype=np.int8) == 0].tobytes()
        self._pair(odd, *[x[wanted] for x in (page, begin, end, closes, name)])
        self.hits: dict[tuple[str, str | None], np.ndarray] = {}
        self.classed: dict[str, np.ndarray] = {}
        self.odd = {}
        for p in np.flatnonzero(odd):
            text = raw[offsets[p] : offsets[p + 1]].decode()
            self.odd[int(p)] = _stack(text, set(scanner.names))

    def _pair(self, odd, page, begin, end, closes, name) -> None:
        size = len(odd)
        first = np.searchsorted(page, np.arange(size + 1))
        i = np.arange(len(page)) - first[page]
        opened = np.cumsum(~closes) - ~closes  # opening tags before
        n = opened - np.append(opened, 0)[first[page]] if len(page) else opened
        depth = np.where(closes, i - 2 * (i - n) - 1, 2 * n - i)
        per_page = np.bincount(page, weights=np.where(closes, -1, 1), minlength=size)
        odd |= per_page != 0
        fine = ~odd[page]
        spread = int(i.max(initial=0)) + 2
        key = page * (2 * spread) + depth + spread
        opens, ends = (np.flatnonzero(fine & side) for side in (~closes, closes))
        opens, ends = (rows[np.argsort(key[rows], kind="stable")] for rows in (opens, ends))
        bad = (depth[opens] != depth[ends]) | (name[opens] != name[ends]) | (i[opens] >= i[ends])
        odd[page[opens[bad]]] = True
        good = ~odd[page[opens]]
        opens, ends = opens[good], ends[good]
        by_number = np.argsort(opens)
        opens, ends = opens[by_number], ends[by_number]
        self.page, self.name = page[opens], name[opens]
        self.tag, self.start, self.stop = begin[opens], end[opens] + 1, begin[ends]
        self.inside = (i[ends] - i[opens] - 1) >> 1

    def _hits(self, step: Step) -> np.ndarray:
        """Elements of a step's name and class, found once."""
        name, cls, _ = step
        if (name, cls) not in self.hits:
            rows = np.flatnonzero(self.name == self.scanner.names.index(name))
            if cls is not None:
                wanted = cls.encode()
                classes = self._classes(name, rows)
                has = np.fromiter((wanted in v for v in self.scanner.values), bool, len(self.scanner.values))
                rows = rows[has[classes]]
            self.hits[name, cls] = rows
        return self.hits[name, cls]

    def _classes(self, name: str, rows: np.ndarray) -> np.ndarray:
        if name not in self.classed:
            tags = [self.raw[a:b] for a, b in zip(self.tag[rows].tolist(), self.start[rows].tolist())]
            known = self.scanner.known(tags)
            self.classed[name] = np.fromiter(map(known.__getitem__, tags), np.int64, len(tags))
        return self.classed[name]

    def follow(self, path: Sequence[Step]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """(page of each element of the first step, that element and the text of each of the last)."""
        rows = self._hits(path[0])
        parent = self.page[rows]
        rows = rows[_nth(parent, path[0][2])]
        outer = np.arange(len(rows))
        pages = self.page[rows]
        for step in path[1:]:
            hits = self._hits(step)
            low = np.searchsorted(hits, rows + 1)
            count = np.searchsorted(hits, rows + self.inside[rows], "right") - low
            parent = np.repeat(np.arange(len(rows)), count)
            at = np.arange(len(parent)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
            chosen = _nth(parent, step[2])
            rows, outer = hits[at][chosen], outer[parent][chosen]
        start, stop = (self._left(x[rows]).tolist() for x in (self.start, self.stop))
        made = [self.plain[a:b] for a, b in zip(start, stop)]
        return self._with_odd(path, pages, outer, made) if self.odd else (pages, outer, made)

    def _left(self, spot: np.ndarray) -> np.ndarray:
        return spot - self.before[np.searchsorted(self.begin, spot)]

    def _with_odd(self, path, pages, outer, made):
        pages, outer = pages.tolist(), outer.tolist()
        for page, (tokens, elements) in self.odd.items():
            current = [(None, 0, len(elements))]
            for depth, (name, cls, nth) in enumerate(path):
                following = []
                for group, low, high in current:
                    inside = [e for e in elements[low:high] if e[4] == name and (cls is None or cls.encode() in _class(tokens[e[2]]))]
                    for e in inside if nth is None else inside[nth : nth + 1]:
                        if depth == 0:
                            group = len(pages)
                            pages.append(page)
                        following.append((group, e[0] + 1, e[1] + 1, e))
                last, current = following, [x[:3] for x in following]
            for group, _, _, e in last:
                outer.append(group)
                made.append(b"".join(t for t in tokens[e[2] + 1 : e[3]] if not t.startswith(b"<") or len(t) == 1))
        pages, outer = np.array(pages, np.int64), np.array(outer, np.int64)
        order = np.argsort(pages, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        outer = place[outer]
        items = np.argsort(outer, kind="stable")
        return pages[order], outer[items], [made[i] for i in items.tolist()]


def _nth(parent: np.ndarray, nth: int | None) -> np.ndarray:
    """Which of the sorted rows to keep: all, or the nth of each parent."""
    if nth is None:
        return np.ones(len(parent), bool)
    return np.arange(len(parent)) - np.searchsorted(parent, parent) == nth
