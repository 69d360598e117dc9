"""Substring deduplication over sliding spans of sentences.

A sentence ends at an end mark, a comma, colon or semicolon (of several scripts),
or a line end. It is cut further behind every word whose hash is the least among
its neighbours, three on either side in the same sentence: only the words around
a place decide, so a passage is cut alike wherever it stands, whatever precedes
it. In scripts without spaces a character is a word, and counts half. From every
sentence on, the shortest run of at least three sentences and twenty words is
hashed. Runs are joined over the whole table by shuffling packed hashes: the owner
of a range of hashes keeps those that occur more than once, with their first place
(smallest id, then position), as a sorted array. A second pass removes every
sentence that lies in a repeated run which is not the first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from uuid import uuid4
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlytics.llm.common import fresh_name, from_planes, id_and_text, once, text_slices, texts_of, to_planes
from eventlytics.llm.hashstore import Reader, Store, new_folder, shard_of, shards_for, write_shard

RUN_SENTENCES = 3
RUN_WORDS = 20
NEIGHBOURS = 3
FLUSH_RUNS = 2_000_000
_MARKS = ".!?,;:\n\u3002\uff0c\uff01\uff1f\uff1b\uff1a\u3001\u061f\u060c\u061b\u0964\u0965"
#: Thai to Tibetan, Myanmar, Khmer, Han with kana, and Han of the higher planes
_UNSPACED = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u2e80-\u2fff\u3003-\u30ff\u31f0-\u31ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_SENTENCE = re.compile(rf"[^{_MARKS}]*(?:[{_MARKS}]+|\Z)")
_WORD = re.compile(rf"\s*(?:[{_UNSPACED}]|[^\s{_UNSPACED}]+)")
_CHARACTER = re.compile(f"[{_UNSPACED}]")
_NO_WORD = re.compile(f"[{_UNSPACED}{_MARKS}]")
_FACTOR = 0x9E3779B97F4A7C15


class Hashes(dict):
    """Hashes of words as met in texts, each computed once for a batch."""

    def __missing__(self, word: str) -> int:
        value = self[word] = crc32(word.strip().lower().encode())
        return value


def sentences(text: str, hashes: Hashes | None = None) -> list[str]:
    """Pieces that make up the text again when joined."""
    hashes = Hashes() if hashes is None else hashes
    out: list[str] = []
    spaced = text.isascii() or not _CHARACTER.search(text)
    for piece in _SENTENCE.findall(text):
        if not piece:
            continue
        if spaced and len(piece.split()) <= 2 * NEIGHBOURS:
            out.append(piece)
            continue
        words = _WORD.findall(piece)
        order = [hashes[w] for w in words]
        begin = 0
        for i in range(NEIGHBOURS, len(words) - NEIGHBOURS):
            if order[i] <= min(order[i - NEIGHBOURS : i + NEIGHBOURS + 1]):
                out.append("".join(words[begin : i + 1]))
                begin = i + 1
        # white space behind the last word belongs to no word
        out.append("".join(words[begin:]) + piece[len(piece.rstrip()) :])
    return out


def half_words(piece: str) -> int:
    """Twice the number of words; a character of a script without spaces counts one."""
    if piece.isascii():
        return 2 * len(piece.split())
    characters = len(_CHARACTER.findall(piece))
    return characters + 2 * len((_NO_WORD.sub(" ", piece) if characters else piece).split())


class Runs:
    """All runs of a batch of texts: ``keys``, and the text and the sentences each spans."""

    def __init__(self, texts: list[str]) -> None:
        from xxhash import xxh64_intdigest

        hashes = Hashes()
        self.parts = [sentences(t, hashes) for t in texts]
        words = [x.lower().split() for part in self.parts for x in part]
        length = np.fromiter((half_words(x) for part in self.parts for x in part), np.int64, len(words))
        hashes = np.fromiter((xxh64_intdigest(" ".join(w)) for w in words), np.uint64, len(words))
        sizes = np.fromiter(map(len, self.parts), np.int64, len(texts))
        # sentences without words take no part
        at = np.flatnonzero(length)
        owner = np.repeat(np.arange(len(texts)), sizes)[at]
        begins = np.cumsum(sizes) - sizes
        length, hashes = length[at], hashes[at]
        count = len(at)
        total = np.concatenate([[0], np.cumsum(length)])
        start = np.arange(count)
        stop = np.maximum(start + RUN_SENTENCES, np.searchsorted(total, total[:-1] + 2 * RUN_WORDS))
        inside = stop <= np.searchsorted(owner, owner, side="right")
        start, stop = start[inside], stop[inside]
        with np.errstate(over="ignore"):
            power = np.full(count + 1, _FACTOR, np.uint64)
            power[0] = 1
            power = np.cumprod(power, dtype=np.uint64)
            back = np.full(count + 1, pow(_FACTOR, -1, 1 << 64), np.uint64)
            back[0] = 1
            back = np.cumprod(back, dtype=np.uint64)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * back[:-1], dtype=np.uint64)])
            keys = (sums[stop] - sums[start]) * power[start]
            keys ^= keys >> np.uint64(31)
            self.keys = keys * np.uint64(0xD6E8FEB86659FD93)
        self.text = owner[start]
        self.first = at[start] - begins[self.text]  # sentence numbers inside the text
        self.last = at[stop - 1] - begins[self.text]


_SCHEMA = "shard int, keys binary, ids binary, places binary, many binary"
_ARROW = pa.schema([
    ("shard", pa.int32()), *((x, pa.binary()) for x in ("keys", "ids", "places", "many"))
])


def _known_id(doc_id: Column, text: Column) -> Column:
    """The id, or for a row without one a number made from its text, above 2^62."""
    made = F.lit(1 << 62) + F.pmod(F.xxhash64(text.cast("string")), F.lit(1 << 61))
    return F.coalesce(doc_id.cast("long"), made)


def _ids(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return np.array(batch.column(column).to_numpy(zero_copy_only=False), np.int64)


def _earliest(keys: np.ndarray, ids: np.ndarray, places: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, ...]:
    """One row per key: its first place, and whether there are more."""
    order = np.lexsort([places, ids, keys])
    keys, ids, places, many = (x[order] for x in (keys, ids, places, many))
    new = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    if not len(at):
        return keys, ids, places, many
    counts = np.diff(np.concatenate([at, [len(keys)]]))
    more = np.maximum(np.maximum.reduceat(many, at), (counts > 1).astype(np.uint32))
    return keys[at], ids[at], places[at], more


def _collector(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            keys, ids, places, many = _earliest(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held.clear()
            owner = shard_of(keys, shards)
            cuts = [0, *(np.flatnonzero(np.diff(owner)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b > a:
                    yield pa.RecordBatch.from_pylist([{
                        "shard": int(owner[a]), "keys": to_planes(keys[a:b]),
                        "ids": to_planes(ids[a:b].view(np.uint64)), "places": to_planes(places[a:b]),
                        "many": to_planes(many[a:b]),
                    }], _ARROW)

        for batch in text_slices(batches):
            runs = Runs(texts_of(batch))
            held.append((
                runs.keys, _ids(batch, "doc_id")[runs.text], runs.first.astype(np.uint32),
                np.zeros(len(runs.keys), np.uint32),
            ))
            if sum(len(x[0]) for x in held) >= FLUSH_RUNS:
                yield from flush()
        if held:
            yield from flush()

    return run


def _owner(folder: str):
    def run(key: tuple[pa.Scalar], rows: pa.Table) -> pa.Table:
        parts = [rows[x].to_pylist() for x in ("keys", "ids", "places", "many")]
        kinds = (np.uint64, np.uint64, np.uint32, np.uint32)
        columns = [np.concatenate([from_planes(x, k) for x in part]) for part, k in zip(parts, kinds, strict=True)]
        keys, ids, places, many = _earliest(columns[0], columns[1].view(np.int64), *columns[2:])
        again = many > 0
        shard, ids = key[0].as_py(), ids[again].view(np.uint64)
        values = np.stack([(ids >> np.uint64(32)), ids & np.uint64(0xFFFFFFFF), places[again] + 1], 1)
        place = write_shard(folder, shard, keys[again], values.astype(np.uint32))
        return pa.table({
            "shard": pa.array([shard], pa.int32()), "place": pa.array([place], pa.string()),
            "n": pa.array([int(again.sum())], pa.int64()),
        })

    return run


def repeated_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> Store:
    """First places of the runs that occur more than once, as sorted arrays."""
    source = id_and_text(docs, id_col, text_col).select(
        _known_id(F.col("doc_id"), F.col("text")).alias("doc_id"), "text"
    )
    shards = shards_for(source.rdd.getNumPartitions())
    folder = new_folder(docs.sparkSession, "runs")
    files = (
        source.mapInArrow(_collector(shards), _SCHEMA).groupBy("shard")
        .applyInArrow(_owner(folder), "shard int, place string, n bigint").collect()
    )
    return Store(shards, 3, {r["shard"]: (r["place"], r["n"]) for r in files})


def without_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with their text cut down, and n_sentences, n_removed (long).

    Sentences inside a repeated run are removed unless the run is the first of
    its kind. Null texts stay null, and texts without a word as they are. Rows that share an id
    and a text count as the same place and keep it. A row without an id comes after
    those with one below 2^62 and has a number made from its text for an id: such rows
    lose what another text has before them, and equal ones stay alike. Columns named
    like the two added ones are replaced.
    """
    store = repeated_runs(docs, id_col=id_col, text_col=text_col)
    shared = docs.sparkSession.sparkContext.broadcast(vars(store))  # names of files
    name, own = uuid4().hex, fresh_name("own_id_", docs)
    kept = [c for c in docs.columns if c not in ("n_sentences", "n_removed")]
    out = T.StructType([
        *(T.StructField(f.name, T.StringType() if f.name == text_col else f.dataType) for f in docs.schema if f.name in kept),
        T.StructField("n_sentences", T.LongType()), T.StructField("n_removed", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = once(("runs", name), lambda: Reader(Store(**shared.value)))
        for batch in text_slices(batches, text_col):
            texts = texts_of(batch, text_col)
            runs = Runs(texts)
            found = reader.find(runs.keys).astype(np.uint64)
            ids = _ids(batch, own)[runs.text]
            first = ((found[:, 0] << np.uint64(32)) | found[:, 1]).view(np.int64)
            # places are stored one higher, so that a row of zeros is an unknown run
            place = runs.first.astype(np.uint64) + np.uint64(1)
            again = (found[:, 2] > 0) & ((first != ids) | (found[:, 2] != place))
            gone = [np.zeros(len(part) + 1, np.int64) for part in runs.parts]
            for t, a, b in zip(runs.text[again], runs.first[again], runs.last[again], strict=True):
                gone[t][a] += 1
                gone[t][b + 1] -= 1
            new, removed = [], []
            nulls = batch.column(text_col).is_null().to_pylist()
            for text, part, marks, null in zip(texts, runs.parts, gone, nulls, strict=True):
                out_of = np.cumsum(marks)[:-1] > 0
                removed.append(int(out_of.sum()))
                new.append(None if null else text if not removed[-1] else "".join(
                    x for x, g in zip(part, out_of, strict=True) if not g
                ))
            columns = [pa.array(new, pa.string()) if c == text_col else batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([len(p) for p in runs.parts], pa.int64()), pa.array(removed, pa.int64())],
                [*kept, "n_sentences", "n_removed"],
            )

    source = docs.select(
        *(docs[c].cast("string").alias(c) if c == text_col else docs[c] for c in kept),
        _known_id(docs[id_col], docs[text_col]).alias(own),
    )
    return source.mapInArrow(run, out)
