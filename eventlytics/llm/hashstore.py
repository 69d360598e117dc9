"""Sorted arrays of 64-bit hashes with values, in files that workers map.

Tasks write one file per shard into the folder of ``spark.checkpoint.dir``. A
shard is a range of hashes, so the files in order are one sorted array. A local
or mounted folder is memory-mapped; from another store a reader holds one shard
at a time. Names are new for every attempt: only files named by rows of finished
tasks are ever read, so a task that runs twice does no harm.
"""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import unquote, urlparse
from uuid import uuid4

import numpy as np
from pyspark.sql import SparkSession

from eventlytics.operators.scale import checkpoint_dir

MIN_SHARDS = 64
APART = 255


def new_folder(spark: SparkSession, name: str) -> str:
    checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid4().hex}"


def shards_for(partitions: int) -> int:
    """One per partition of the input, which bounds what one holds."""
    return max(MIN_SHARDS, partitions)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _local(uri: str) -> str | None:
    parsed = urlparse(uri)
    return unquote(parsed.path) if parsed.scheme in ("", "file") else None


def _remote(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_shard(folder: str, shard: int, keys: np.ndarray, values: np.ndarray) -> str:
    """File of one shard: its keys, then its values by row (unsigned 32-bit). Returns its place."""
    return _write(folder, shard, keys.astype("<u8").tobytes() + np.ascontiguousarray(values, "<u4").tobytes())


def _write(folder: str, shard: int, data: bytes) -> str:
    uri = f"{folder}/{shard:06d}-{uuid4().hex}.bin"
    path = _local(uri)
    if path is None:
        store, path = _remote(uri)
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with store.open_output_stream(path) as out:
            out.write(data)
    else:
        import os

        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as out:
            out.write(data)
    return uri


def write_packed(folder: str, shard: int, keys: np.ndarray, values: np.ndarray) -> str:
    """Like ``write_shard`` for a ``PackedReader``: 7 to 8 bytes a key where few rows of values differ.

    An index over the first bits (16 or more, about 4 to 8 keys each) leaves 48 bits of a key. The
    255 most frequent rows of at most four values are a byte each, others stand apart. No keys: no file.
    """
    n, width = values.shape
    if not n:
        return ""
    bits = 16
    while bits < 40 and int(keys[-1]) - int(keys[0]) >> 63 - bits <= n >> 2:
        bits += 1
    top = keys >> np.uint64(64 - bits)
    buckets = np.arange(int(top[0]), int(top[-1]) + 2, dtype=np.uint64)
    short = np.minimum(values, 0xFFFF).astype(np.uint64)
    row = np.bitwise_or.reduce(short << (np.arange(width, dtype=np.uint64) * np.uint64(16)), axis=1)
    _, first, which, often = np.unique(row, return_index=True, return_inverse=True, return_counts=True)
    often[(short[first] == 0xFFFF).any(axis=1)] = 0  # may stand for several rows
    chosen = np.argsort(-often, kind="stable")[:APART]
    chosen = chosen[often[chosen] > 0]
    code = np.full(len(first), APART, np.uint8)
    code[chosen] = np.arange(len(chosen))
    codes = code[which]
    apart = np.flatnonzero(codes == APART)
    head = [n, width, bits, int(top[0]), len(buckets) - 1, len(chosen), len(apart), 0]
    parts = [
        np.array(head, "<u8"), np.searchsorted(top, buckets).astype("<u4"), (keys >> np.uint64(16)).astype("<u4"),
        values[first[chosen]].astype("<u4"), apart.astype("<u4"), values[apart].astype("<u4"),
        keys.astype("<u2"), codes,
    ]
    return _write(folder, shard, b"".join(x.tobytes() for x in parts))


@dataclass
class Store:
    """``files``: shard -> (place, number of keys)."""

    shards: int
    width: int
    files: dict[int, tuple[str, int]]


class Reader:
    def __init__(self, store: Store) -> None:
        self.store = store
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _shard(self, shard: int) -> tuple[np.ndarray, np.ndarray] | None:
        if shard in self.open:
            return self.open[shard]
        uri, count = self.store.files.get(shard, ("", 0))
        if not count:
            return None
        path, width = _local(uri), self.store.width
        if path is not None:
            keys = np.memmap(path, "<u8", "r", 0, (count,))
            values = np.memmap(path, "<u4", "r", 8 * count, (count, width))
            self.open[shard] = np.asarray(keys), np.asarray(values)
            return self.open[shard]
        store, path = _remote(uri)
        with store.open_input_file(path) as file:
            data = file.read()
        return np.frombuffer(data, "<u8", count), np.frombuffer(data, "<u4", offset=8 * count).reshape(count, width)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Values of each key (rows of zeros for unknown ones)."""
        order = np.argsort(keys)
        asked = keys[order]
        found = np.zeros((len(keys), self.store.width), np.uint32)
        shards = shard_of(asked, self.store.shards)
        cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(asked)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = self._shard(int(shards[a])) if b > a else None
            if part is None:
                continue
            at = np.minimum(np.searchsorted(part[0], asked[a:b]), len(part[0]) - 1)
            hit = part[0][at] == asked[a:b]
            found[a:b][hit] = part[1][at[hit]]
        out = np.empty_like(found)
        out[order] = found
        return out


class Packed:
    """One file of ``write_packed``."""

    def __init__(self, data: np.ndarray) -> None:
        head = data[:64].view("<u8")
        n, self.width, self.bits, self.first, self.buckets, rows, apart, _ = map(int, head)
        self.n, place = n, 64

        def part(size: int, kind: str = "<u4") -> np.ndarray:
            nonlocal place
            start, place = place, place + size * np.dtype(kind).itemsize
            return data[start:place].view(kind)

        self.starts, self.middle = part(self.buckets + 1), part(n)
        self.table = part(rows * self.width).reshape(rows, self.width)
        self.apart, self.others = part(apart), part(apart * self.width).reshape(apart, self.width)
        self.last, self.codes = part(n, "<u2"), part(n, "u1")

    def find(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the keys asked for are there, their values)."""
        bucket = (asked >> np.uint64(64 - self.bits)) - np.uint64(self.first)  # wraps below the first
        inside = np.flatnonzero(bucket < self.buckets)
        bucket, asked = bucket[inside].astype(np.int64), asked[inside]
        middle, last = (asked >> np.uint64(16)).astype(np.uint32), asked.astype(np.uint16)
        at, end = self.starts[bucket].astype(np.int64), self.starts[bucket + 1].astype(np.int64)
        todo = np.flatnonzero(at < end)
        low, high = at[todo], end[todo]
        while len(todo):  # first place whose middle bits aren't less
            half = low + high >> 1
            less = self.middle[half] < middle[todo]
            low, high = np.where(less, half + 1, low), np.where(less, high, half)
            left = low < high
            at[todo[~left]] = low[~left]
            todo, low, high = todo[left], low[left], high[left]
        todo = np.flatnonzero(at < end)
        todo = todo[self.middle[at[todo]] == middle[todo]]
        hits = [todo[:0]]
        while len(todo):  # seldom more than once: keys that differ in the last bits only
            same = self.last[at[todo]] == last[todo]
            hits.append(todo[same])
            todo = todo[~same]
            at[todo] += 1
            todo = todo[at[todo] < end[todo]]
            todo = todo[self.middle[at[todo]] == middle[todo]]
        hit = np.concatenate(hits)
        codes = self.codes[at[hit]]
        plain = codes != APART
        values = np.empty((len(hit), self.width), np.uint32)
        values[plain] = self.table[codes[plain]]
        values[~plain] = self.others[np.searchsorted(self.apart, at[hit[~plain]])]
        return inside[hit], values


class PackedReader:
    def __init__(self, store: Store) -> None:
        self.store = store
        self.open: dict[int, Packed] = {}

    def _shard(self, shard: int) -> Packed | None:
        if shard in self.open:
            return self.open[shard]
        uri, _ = self.store.files.get(shard, ("", 0))
        if not uri:
            return None
        path = _local(uri)
        if path is not None:
            self.open[shard] = Packed(np.asarray(np.memmap(path, np.uint8, "r")))
            return self.open[shard]
        store, path = _remote(uri)
        with store.open_input_file(path) as file:
            return Packed(np.frombuffer(file.read(), np.uint8))

    def find(self, keys: np.ndarray, owners: np.ndarray | None = None) -> np.ndarray:
        """Values of each key (rows of zeros for unknown ones). ``owners``: hashes by which
        the keys were dealt to shards, if not by themselves."""
        shards = shard_of(keys if owners is None else owners, self.store.shards)
        if self.store.shards <= 1 << 16:
            shards = shards.astype(np.uint16)  # numpy sorts these by digits
        order = np.argsort(shards, kind="stable")
        shards = shards[order]
        found = np.zeros((len(keys), self.store.width), np.uint32)
        cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = self._shard(int(shards[a])) if b > a else None
            if part is not None:
                hit, values = part.find(keys[order[a:b]])
                found[order[a:b][hit]] = values
        return found


def write_array(folder: str, values: np.ndarray) -> str:
    """A file of unsigned 64-bit numbers, to be read in parts. Returns its place."""
    return write_shard(folder, 0, values, np.zeros((0, 1), np.uint32))


class Array:
    def __init__(self, uri: str) -> None:
        path = _local(uri)
        if path is not None:
            self.values = np.memmap(path, "<u8", "r") if _size(path) else np.zeros(0, np.uint64)
        else:
            store, path = _remote(uri)
            with store.open_input_file(path) as file:
                self.values = np.frombuffer(file.read(), "<u8")

    def part(self, start: int, length: int) -> np.ndarray:
        return np.asarray(self.values[start : start + length])


def _size(path: str) -> int:
    import os

    return os.path.getsize(path)
