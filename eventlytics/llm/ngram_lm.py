"""Interpolated modified Kneser-Ney n-gram model over whole corpora.

First the words are counted by the owners of hash ranges and numbered, the more
frequent the smaller. Then tasks send each shard its distinct n-grams as numbers,
sorted and compressed, with counts. The owner of a shard adds them up, writes
them as a packed hash array and passes on the n-grams without their first word,
from which the next order's continuation counts come. N-grams of three words or
more lie with their context (all words but the last), so their owner also writes
what is known of each context (total and number of words seen once, twice, more);
those of two are dealt by both words, as one word may be too frequent, and their
contexts are passed on too. No n-gram passes the driver, which sees file names
and sums. The source is read once for the words and once for the n-grams.

Below the highest order an n-gram is a context unless the end token is its last
word. So only n-grams whose count isn't 1 and those with the end are written; the
others are found among the contexts.

Scoring maps the files. A text is preceded by ``order - 1`` start marks and
followed by one end token, which is predicted like a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlytics.llm.common import from_planes, id_and_text, mix, once, text_slices, texts_of, to_planes
from eventlytics.llm.hashstore import (
    Array, PackedReader, Reader, Store, new_folder, shard_of, shards_for, write_array, write_packed, write_shard,
)

ORDER = 3
FLUSH_TOKENS = 4_000_000

_SCHEMA = "kind string, level int, shard int, words array<binary>, counts array<binary>, places array<string>, sums array<bigint>"
_ARROW = pa.schema([
    ("kind", pa.string()), ("level", pa.int32()), ("shard", pa.int32()),
    ("words", pa.list_(pa.binary())), ("counts", pa.list_(pa.binary())),
    ("places", pa.list_(pa.string())), ("sums", pa.list_(pa.int64())),
])


@dataclass
class Model:
    """Stores by (kind, level), sums of the raw counts, and per level count-of-count sums."""

    name: str
    order: int
    stores: dict[tuple[str, int], Store]
    tokens: int = 0
    distinct: int = 0
    levels: dict[int, list[int]] = field(default_factory=dict)  # total, n1, n2, n3, n4, types

    def discounts(self, level: int) -> np.ndarray:
        """What counts of 0, 1, 2 and 3 or more lose (Chen and Goodman, 1998)."""
        _, n1, n2, n3, n4, _ = self.levels.get(level, [0] * 6)
        if not (n1 and n2 and n3 and n4):
            return np.array([0.0, 0.5, 1.0, 1.5])  # too few n-grams to estimate from
        y = n1 / (n1 + 2 * n2)
        lost = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        return np.clip(lost, 0, [0, 1, 2, 3])


def hashed(text: str) -> np.ndarray:
    """Hashes of the words, A-Z lower-cased; words end at ASCII white space."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


def _marks() -> tuple[np.uint64, np.uint64]:
    """(start, end): hashes of strings that can't be words."""
    from xxhash import xxh64_intdigest

    return np.uint64(xxh64_intdigest(b" ")), np.uint64(xxh64_intdigest(b""))


def _stream(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes with marks of all texts, number of predicted tokens of each)."""
    start, end = _marks()
    lead, tail = np.full(order - 1, start, np.uint64), np.array([end], np.uint64)
    parts, sizes = [], []
    for text in texts:
        words = hashed(text)
        parts += [lead, words, tail]
        sizes.append(len(words) + 1)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.array(sizes, np.int64)


def _predicted(sizes: np.ndarray, order: int) -> np.ndarray:
    """Places of predicted tokens in a stream."""
    starts = np.cumsum(sizes + order - 1) - sizes
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def chain(words: list[np.ndarray]) -> np.ndarray:
    key = words[0]
    for more in words[1:]:
        key = mix(key, more)
    return key


def _sums(keys: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(place of each distinct key's first row, keys sorted, each column added up by key)."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    added = [np.add.reduceat(c[order], new) if len(new) else c[:0] for c in columns]
    return order[new], keys[new], added


def _packed(values: np.ndarray) -> bytes:
    """Width of a number, bytes in all, compressed planes."""
    short = values.astype(np.uint32) if values.max() < 1 << 32 else values
    planes = to_planes(short)
    return bytes([short.itemsize]) + len(planes).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    planes = pa.decompress(data[9:], int.from_bytes(data[1:9], "little"), "zstd", asbytes=True)
    return from_planes(planes, np.uint32 if data[0] == 4 else np.uint64)


def _order(owners: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """Order by owner, then words: of one number for all, if 64 bits hold them."""
    bits = [int(x.max()).bit_length() for x in words]
    if int(owners.max()).bit_length() + sum(bits) > 64:
        return np.lexsort([*reversed(words), owners])
    key = owners
    for x, width in zip(words, bits, strict=True):
        key = key << np.uint64(width) | x
    return np.argsort(key)


def _rows(kind: str, level: int, owners: np.ndarray, words: list[np.ndarray],
          counts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Sorted words cut into the shards of their owners, the first by differences; counts go along."""
    order = _order(owners, words[:2])
    owners = owners[order]
    cuts = [0, *(np.flatnonzero(np.diff(owners)) + 1).tolist(), len(owners)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            first, *others = (w[order[a:b]] for w in words)
            first = np.concatenate([first[:1], np.diff(first)])
            yield pa.RecordBatch.from_pylist([{
                "kind": kind, "level": level, "shard": int(owners[a]),
                "words": [_packed(w) for w in (first, *others)],
                "counts": [_packed(c[order[a:b]].astype(np.uint64)) for c in counts],
            }], _ARROW)


def _columns(rows: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(words, counts) of the rows of one shard."""
    first, *others = zip(*rows["words"].to_pylist(), strict=True)
    words = [np.concatenate([np.cumsum(_unpacked(x), dtype=np.uint64) for x in first])]
    words += [np.concatenate([_unpacked(x) for x in column]) for column in others]
    counts = zip(*rows["counts"].to_pylist(), strict=True)
    return words, [np.concatenate([_unpacked(x) for x in column]).astype(np.int64) for column in counts]


def _file_row(kind: str, level: int, shard: int, places: list[str], sums: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{
        "kind": f"{kind}-file", "level": level, "shard": shard, "places": places, "sums": sums,
    }], _ARROW)


def _word_counter(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            yield from _rows("raw", 0, shard_of(keys, shards), [keys], [n])

        for batch in text_slices(batches):
            held.append(_stream(texts_of(batch), 1)[0])
            if sum(map(len, held)) >= FLUSH_TOKENS:
                yield from flush()
        if held:
            yield from flush()

    return run


def _word_reducer(folder: str):
    """Writes hash -> (count, place among the shard's words by falling count), and the hashes by place."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        (shard,) = (k.as_py() for k in key)
        (words,), counts = _columns(rows)
        _, keys, (n,) = _sums(words, *counts)
        order = np.argsort(-n, kind="stable")
        place = np.empty(len(n), np.int64)
        place[order] = np.arange(len(n))
        places = [
            write_shard(f"{folder}/raw-0", shard, keys, np.stack([n, place], 1)),
            write_array(f"{folder}/words-{shard:06d}", keys[order]),
        ]
        return pa.Table.from_batches([_file_row("raw", 0, shard, places, [int(n.sum()), len(n)])], _ARROW)

    return run


class Words:
    """Numbers of the words of the raw store (0: the start mark), and back."""

    def __init__(self, raw: Store, by_place: dict[int, str]) -> None:
        self.raw, self.by_place, self.shards = Reader(raw), by_place, np.uint64(raw.shards)
        self.arrays: dict[int, Array] = {}

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        distinct, which = np.unique(hashes, return_inverse=True)
        start, _ = _marks()
        found = self.raw.find(distinct)
        if (found[:, 0] == 0)[distinct != start].any():
            raise ValueError("the source gave other words when it was read again")
        ids = found[:, 1].astype(np.uint64) * self.shards + shard_of(distinct, int(self.shards)) + np.uint64(1)
        return np.where(distinct == start, np.uint64(0), ids)[which]

    def hashes(self, numbers: np.ndarray) -> np.ndarray:
        distinct, which = np.unique(numbers, return_inverse=True)
        out = np.full(len(distinct), _marks()[0], np.uint64)
        known = np.flatnonzero(distinct)
        place, shard = np.divmod(distinct[known] - np.uint64(1), self.shards)
        order = np.argsort(shard, kind="stable")
        cuts = [0, *(np.flatnonzero(np.diff(shard[order])) + 1).tolist(), len(order)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                here = int(shard[order[a]])
                if here not in self.arrays:
                    self.arrays[here] = Array(self.by_place[here])
                out[known[order[a:b]]] = self.arrays[here].values[place[order[a:b]].astype(np.int64)]
        return out[which]


def _owner(words: list[np.ndarray]) -> np.ndarray:
    """Hash by which n-grams are dealt: their context's, if that is two words or more."""
    return chain(words[:-1] if len(words) > 2 else words)


def _filed(grams: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Key under which an n-gram lies with its owner: 16 bits of the owner's range, 48 of its own."""
    return owners & np.uint64(0xFFFF << 48) | grams >> np.uint64(16)


def _counter(order: int, shards: int, words_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        sizes: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            stream = np.concatenate(held)
            at = _predicted(np.concatenate(sizes), order)
            held.clear()
            sizes.clear()
            first, _, (n,) = _sums(chain([stream[at - i] for i in range(order - 1, -1, -1)]), np.ones(len(at), np.int64))
            at = at[first]
            owners = shard_of(_owner([stream[at - i] for i in range(order - 1, -1, -1)]), shards)
            numbers = words_of().numbers(stream)
            yield from _rows("gram", order, owners, [numbers[at - i] for i in range(order - 1, -1, -1)], [n])

        for batch in text_slices(batches):
            stream, size = _stream(texts_of(batch), order)
            held.append(stream)
            sizes.append(size)
            if sum(map(len, held)) >= FLUSH_TOKENS:
                yield from flush()
        if held:
            yield from flush()

    return run


def _reducer(folder: str, order: int, shards: int, words_of):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        kind, level, shard = (k.as_py() for k in key)
        if kind.endswith("-file"):  # of an order that is done
            return rows
        numbers, counts = _columns(rows)
        words = [words_of().hashes(w) for w in numbers]
        if kind == "context":
            _, keys, known = _sums(chain(words), *counts)
            place = write_packed(f"{folder}/context-{level}", shard, keys, np.stack(known, 1))
            return pa.Table.from_batches([_file_row("context", level, shard, [place], [len(keys)])], _ARROW)
        owners, keys = _owner(words), chain(words)
        first, keys, (n,) = _sums(_filed(keys, owners) if level > 2 else keys, *counts)
        words, numbers = [w[first] for w in words], [w[first] for w in numbers]
        listed = slice(None) if level == order else (n != 1) | (words[-1] == _marks()[1])
        place = write_packed(f"{folder}/gram-{level}", shard, keys[listed], n[listed, None])
        sums = [int(n.sum()), *(int((n == i).sum()) for i in (1, 2, 3, 4)), len(keys)]
        out = [_file_row("gram", level, shard, [place], sums)]
        if level > 1:
            classes = [n == 1, n == 2, n >= 3]
            first, contexts, known = _sums(chain(words[:-1]), n, *(c.astype(np.int64) for c in classes))
            if level > 2:
                place = write_packed(f"{folder}/context-{level}", shard, contexts, np.stack(known, 1))
                out.append(_file_row("context", level, shard, [place], [len(contexts)]))
            else:
                out += _rows("context", level, shard_of(contexts, shards), [numbers[0][first]], known)
            first, _, (lefts,) = _sums(chain(words[1:]), np.ones(len(n), np.int64))
            owners = shard_of(_owner([w[first] for w in words[1:]]), shards)
            out += _rows("gram", level - 1, owners, [w[first] for w in numbers[1:]], [lefts])
        return pa.Table.from_batches(out, _ARROW)

    return run


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> Model:
    """Count the whole table; null texts count as empty ones (an end token alone).

    The table is read twice and must give the same texts again.
    """
    source = id_and_text(docs, id_col, text_col).select("text")
    shards = shards_for(source.rdd.getNumPartitions())
    folder = new_folder(docs.sparkSession, "ngrams")
    model = Model(uuid4().hex, order, {})
    raw, by_place = Store(shards, 2, {}), {}
    rows = source.mapInArrow(_word_counter(shards), _SCHEMA)
    for row in rows.groupBy("shard").applyInArrow(_word_reducer(folder), _SCHEMA).select("shard", "places", "sums").collect():
        raw.files[row["shard"]] = row["places"][0], row["sums"][1]
        by_place[row["shard"]] = row["places"][1]
        model.tokens, model.distinct = model.tokens + row["sums"][0], model.distinct + row["sums"][1]
    if raw.files:
        model.stores["raw", 0] = raw
    shared = docs.sparkSession.sparkContext.broadcast((model.name, vars(raw), by_place))  # names of files

    def words_of() -> Words:
        name, store, places = shared.value
        return once(("ngram words", name), lambda: Words(Store(**store), places))

    rows = source.mapInArrow(_counter(order, shards, words_of), _SCHEMA)
    for _ in range(order):
        rows = rows.groupBy("kind", "level", "shard").applyInArrow(_reducer(folder, order, shards, words_of), _SCHEMA)
    for row in rows.select("kind", "level", "shard", "places", "sums").collect():
        kind, level = row["kind"].removesuffix("-file"), row["level"]
        store = model.stores.setdefault((kind, level), Store(shards, 4 if kind == "context" else 1, {}))
        store.files[row["shard"]] = row["places"][0], row["sums"][-1]
        if kind == "gram":
            old = model.levels.get(level, [0] * 6)
            model.levels[level] = [a + b for a, b in zip(old, row["sums"], strict=True)]
    return model


class Grams:
    """Counts of n-grams: those listed, else 1 if the n-gram is a context of the next level."""

    def __init__(self, level: int, listed: PackedReader, contexts: PackedReader | None) -> None:
        self.level, self.listed, self.contexts = level, listed, contexts

    def find(self, grams: np.ndarray, owners: np.ndarray | None = None, known: np.ndarray | None = None) -> np.ndarray:
        """Counts by the n-grams' hashes; from three words on with those of their contexts.

        ``known``: which of them are contexts of the next level, if that was already asked.
        """
        if self.level > 2:
            found = self.listed.find(_filed(grams, owners), owners)
        else:
            found = self.listed.find(grams)
        if self.contexts is not None:
            rest = np.flatnonzero(found[:, 0] == 0)
            found[rest, 0] = self.contexts.find(grams[rest])[:, 0] > 0 if known is None else known[rest]
        return found


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model = model
        none = Store(1, 1, {}), Store(1, 4, {})
        contexts = {k: PackedReader(model.stores.get(("context", k), none[1])) for k in range(2, model.order + 1)}
        self.readers = {("raw", 0): Reader(model.stores.get(("raw", 0), Store(1, 2, {})))}
        self.readers |= {("context", k): reader for k, reader in contexts.items()}
        for k in range(1, model.order + 1):
            listed = PackedReader(model.stores.get(("gram", k), none[0]))
            self.readers["gram", k] = Grams(k, listed, contexts.get(k + 1))
        self.lost = {k: model.discounts(k) for k in range(1, model.order + 1)}

    def _left(self, counts: np.ndarray, level: int) -> np.ndarray:
        return np.maximum(counts - self.lost[level][np.minimum(counts, 3)], 0)

    def scores(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """(tokens, known tokens, base score, model score) of each text."""
        model = self.model
        stream, sizes = _stream(texts, model.order)
        at = _predicted(sizes, model.order)
        distinct, place = np.unique(stream, return_inverse=True)
        raw = self.readers["raw", 0].find(distinct)[:, 0].astype(np.int64)
        base = np.log10((raw + 0.5) / (model.tokens + 0.5 * (model.distinct + 1)))
        starts = np.cumsum(sizes) - sizes
        known_tokens = np.add.reduceat((raw > 0).astype(np.int64)[place[at]], starts)
        base_score = np.add.reduceat(base[place[at]], starts)

        p = np.full(len(at), 1 / (model.distinct + 1))
        grams = owners = stream  # hashes of the n-grams that end at each place of the stream, of their contexts
        for level in range(1, model.order + 1):
            # an n-gram is a context one token further on, so what is known of both is found at once
            if level < model.order:
                keys, place = np.unique(grams, return_inverse=True)
                own = np.empty_like(keys)
                own[place] = owners
                known = self.readers["context", level + 1].find(keys)
                counts = self.readers["gram", level].find(keys, own, known[:, 0] > 0)
                counts = counts[place[at], 0].astype(np.int64)
            else:
                counts = self.readers["gram", level].find(grams[at], owners[at])[:, 0].astype(np.int64)
            if level == 1:
                total, n1, n2, _, _, types = model.levels.get(1, [0] * 6)
                if total:
                    spare = self.lost[1][1:] @ [n1, n2, types - n1 - n2] / total
                    p = self._left(counts, 1) / total + spare * p
            else:
                p = self._left(counts, level) / seen + spare * p
            if level < model.order:
                total = known[:, 0].astype(np.int64)
                seen = np.maximum(total, 1)
                spare = np.where(total > 0, known[:, 1:].astype(np.int64) @ self.lost[level + 1][1:] / seen, 1.0)
                seen, spare = seen[place[at - 1]], spare[place[at - 1]]
                owners = np.concatenate([grams[:1], grams[:-1]])
                grams = mix(owners, stream)
        return sizes, known_tokens, base_score, np.add.reduceat(np.log10(p), starts)


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score, perplexity of every whole text.

    Scores are log10 probabilities; the base is add-half smoothed unigrams. A
    null text is scored as an empty one. Rows may repeat; none are dropped.
    """
    shared = docs.sparkSession.sparkContext.broadcast(  # names of files, no counts
        vars(model) | {"stores": {k: vars(s) for k, s in model.stores.items()}}
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = shared.value
        stores = {k: Store(**s) for k, s in data["stores"].items()}
        scorer = once(("ngrams", data["name"]), lambda: Scorer(Model(**(data | {"stores": stores}))))
        for batch in text_slices(batches):
            tokens, known, base, scores = scorer.scores(texts_of(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, (tokens, known, base, scores, 10 ** (-scores / tokens)))],
                ["doc_id", "n_tokens", "n_known", "base_score", "score", "perplexity"],
            )

    source = id_and_text(docs, id_col, text_col).select(F.col("doc_id").cast("long"), "text")
    return source.mapInArrow(
        run, "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double, perplexity double"
    )
