"""Packing of token sequences: bounded-space online best fit.

Every partition keeps a fixed number of open windows. A document's full windows
are sequences of their own; its rest goes to the open window that it fills best.
If none has room the fullest is emitted. What is still open at the end of the
partitions is merged sixteen partitions at a time until nothing is left.
"""

from __future__ import annotations

import zlib
from bisect import insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlytics.llm.byte_bpe import ByteEncoder
from eventlytics.llm.common import id_and_text, once, text_slices, texts_of
from eventlytics.operators.scale import shared_checkpoint

WINDOW = 2048
OPEN_WINDOWS = 16
FAN_IN = 16
END_ID = 1

_PIECE = pa.struct([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
])
_ROW = pa.schema([("task", pa.int64()), ("pieces", pa.list_(_PIECE)), ("open", pa.list_(_PIECE))])
_PIECE_SQL = (
    "struct<doc_id:bigint,start:bigint,length:bigint,ids:binary,ids_crc32:bigint,"
    "doc_tokens:bigint,sequence_id:bigint,offset:bigint>"
)
_ROW_SQL = f"task bigint, pieces array<{_PIECE_SQL}>, open array<{_PIECE_SQL}>"


class Windows:
    """Open windows of one task; ``done`` holds the pieces of emitted ones."""

    def __init__(self, window: int, slots: int, first_id: int) -> None:
        self.window, self.slots, self.next_id = window, slots, first_id
        self.open: list[tuple[int, int, list[dict]]] = []  # (room, order, pieces), by room
        self.done: list[dict] = []
        self.order = 0

    def emit(self, pieces: list[dict]) -> None:
        offset = 0
        for piece in pieces:
            piece["sequence_id"], piece["offset"] = self.next_id, offset
            offset += piece["length"]
        self.next_id += 1
        self.done += pieces

    def fullest(self) -> int:
        """Room of the fullest window, if no further one may be opened; else 0."""
        return self.open[0][0] if len(self.open) == self.slots else 0

    def fits(self, length: int) -> bool:
        return bool(self.open) and self.open[-1][0] >= length

    def place(self, piece: dict) -> None:
        length = piece["length"]
        at = next((i for i, w in enumerate(self.open) if w[0] >= length), None)
        if at is None:
            if len(self.open) == self.slots:
                self.emit(self.open.pop(0)[2])
            room, order, pieces = self.window, self.order, []
            self.order += 1
        else:
            room, order, pieces = self.open.pop(at)
        pieces.append(piece)
        if room == length:
            self.emit(pieces)
        else:
            insort(self.open, (room - length, order, pieces), key=lambda w: w[:2])

    def left(self) -> list[dict]:
        return [piece for _, _, pieces in self.open for piece in pieces]


def _packer(vocabulary: str, window: int, slots: int, end_id: int | None, payload: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        encoder = once(("byte_bpe", vocabulary), lambda: ByteEncoder(vocabulary))
        end = b"" if end_id is None else np.uint32(end_id).tobytes()
        windows = Windows(window, slots, task << 32)

        def piece(doc_id: int, ids: bytes, start: int, stop: int) -> dict:
            part = ids[4 * start : 4 * stop]
            return {
                "doc_id": doc_id, "start": start, "length": stop - start,
                "ids": part if payload == "ids" else None, "ids_crc32": zlib.crc32(part),
                "doc_tokens": len(ids) // 4, "sequence_id": None, "offset": None,
            }

        for batch in text_slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
                ids = encoder.encode(text) + end
                total, start = len(ids) // 4, 0
                while total - start >= window:
                    windows.emit([piece(doc_id, ids, start, start + window)])
                    start += window
                # one cut more where the window to be emitted would stay emptier than 1/32
                room = windows.fullest()
                if total > start + room and room > window // 32 and not windows.fits(total - start):
                    windows.place(piece(doc_id, ids, start, start + room))
                    start += room
                if total > start:
                    windows.place(piece(doc_id, ids, start, total))
            yield pa.RecordBatch.from_pylist([{"task": task, "pieces": windows.done, "open": []}], _ROW)
            windows.done = []
        yield pa.RecordBatch.from_pylist([{"task": task, "pieces": [], "open": windows.left()}], _ROW)

    return run


def _merger(window: int, slots: int, level: int, last: bool) -> Callable:
    def run(key: tuple[pa.Scalar], rows: pa.Table) -> pa.Table:
        task = key[0].as_py()
        tasks = sorted(zip(rows["task"].to_pylist(), rows["open"].to_pylist(), strict=True))
        pieces = [p for _, part in tasks for p in part]
        pieces.sort(key=lambda p: -p["length"])  # stable: ties stay in task order
        # ids of level n lie above those of all levels before
        windows = Windows(window, len(pieces) + 1 if last else slots, (level << 56) + (task << 32))
        for piece in pieces:
            windows.place(piece)
        if last:
            for _, _, rest in windows.open:
                windows.emit(rest)
            windows.open = []
        return pa.Table.from_pylist([{"task": task, "pieces": windows.done, "open": windows.left()}], _ROW)

    return run


def pack(
    docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text",
    window: int = WINDOW, open_windows: int = OPEN_WINDOWS, end_id: int | None = END_ID,
    payload: str = "ids",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset.

    ``ids`` holds little-endian unsigned 32-bit ids, or null with payload
    "crc32". A null or empty text is its end id alone (no piece if ``end_id`` is
    None). Rows that repeat are packed each for itself; ids may be null. An
    empty table gives no rows. Sequence ids are unique, not dense. A task holds
    ``open_windows`` windows and one text; a merge, sixteen times as many windows.

    Pieces of the first pass are written to the checkpoint folder, so a task
    that runs again can't number them anew.
    """
    source = id_and_text(docs, id_col, text_col).select(F.col("doc_id").cast("long"), "text")
    tasks = source.rdd.getNumPartitions()
    state = shared_checkpoint(
        source.mapInArrow(_packer(vocabulary, window, open_windows, end_id, payload), _ROW_SQL)
    )
    found = [state.select(F.explode("pieces").alias("p"))]
    level = 1
    while True:
        last = tasks <= FAN_IN
        groups = state.filter(F.size("open") > 0).select(
            F.floor(F.col("task") / FAN_IN).cast("long").alias("group"), "task", "open"
        )
        state = groups.groupBy("group").applyInArrow(_merger(window, open_windows, level, last), _ROW_SQL)
        if not last:
            state = shared_checkpoint(state)
        found.append(state.select(F.explode("pieces").alias("p")))
        if last:
            break
        tasks, level = -(-tasks // FAN_IN), level + 1
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select("p.*")
