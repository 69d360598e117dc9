"""Language identification by partial matching (PPM, escape method C).

Each language has a tree of byte contexts of up to three bytes with the counts
of what followed them. A byte costs minus log2 of its probability in the longest
known context; where it was not seen there, an escape is paid and the next
shorter context is asked, without the bytes already ruled out. Below the empty
context all bytes left are alike. The statistics stay as fitted, so a text's
code length is one sum of table entries; the shortest one names the language.

How long the code of a text may be is measured: each half of the sample is coded by
what the other half teaches. A text is strange when its bits a byte are more than
``MARGIN`` deviations above the mean of its best language; the deviation joins that
among learned texts with ``BYTE_SPREAD / sqrt(bytes)``, so that short texts may vary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlytics.llm.common import (
    fresh_name,
    from_planes,
    id_and_text,
    once,
    smallest,
    text_slices,
    texts_of,
    to_planes,
)

ORDER = 3
TEXTS_PER_LANGUAGE = 1000
UNDETERMINED = "und"
MARGIN = 4.0
BYTE_SPREAD = 4.0  # bits; above that of single bytes, as neighbours depend on each other
LEAST_SPREAD = 0.1
LEAST_TEXTS = 8  # fewer measured texts than these give no limit
WEIGHT_BYTES = 4096  # a longer text counts no more than one of this length
_SHARDS = 16
_PAD = b"\n" * ORDER


@dataclass
class Counts:
    """Per language, the keys (four bytes, first one highest) and counts of what was seen."""

    name: str
    languages: list[str]
    keys: list[np.ndarray]
    counts: list[np.ndarray]
    #: language -> mean and deviation of the bits a byte of texts that were not learned
    rates: dict[str, tuple[float, float]] = field(default_factory=dict)


def _grams(texts: list[str]) -> np.ndarray:
    """Each byte with the three before it, as one number; a text begins after line ends."""
    data = np.frombuffer(b"".join(_PAD + t.encode() for t in texts), np.uint8).astype(np.uint32)
    keys = data[ORDER:].copy()
    for i in range(ORDER):
        keys |= data[i : len(data) - ORDER + i] << np.uint32(8 * (ORDER - i))
    sizes = np.array([len(t.encode()) + ORDER for t in texts])
    pad = (np.cumsum(sizes)[:-1, None] + np.arange(ORDER) - ORDER).ravel()
    return np.delete(keys, pad) if len(texts) > 1 else keys


def fit(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    texts_per_language: int = TEXTS_PER_LANGUAGE, spread: bool = False,
) -> Counts:
    """Context statistics from a bounded sample: the ``texts_per_language`` rows of each
    language with the smallest hash of their id (rows that repeat an id count once).

    Rows without text or language teach nothing. The driver receives the counts
    of the sample, one small row per language and sixteenth of the contexts (of either
    half, with ``spread``: then the bits a byte of the sample are measured too).
    """
    rows = id_and_text(docs, id_col, text_col, docs[lang_col].cast("string").alias("lang")).withColumn(
        "at", F.xxhash64("doc_id")
    ).filter(F.col("lang").isNotNull() & (F.length("text") > 0))
    cuts = {
        r["lang"]: r["cut"]
        for r in smallest(rows.select("lang", "at").distinct(), "lang", ["at"], texts_per_language)
        .groupBy("lang").agg(F.max("at").alias("cut")).collect()
    }
    if not cuts:
        return Counts(uuid4().hex, [], [], [])
    limit = F.element_at(F.create_map(*[F.lit(x) for pair in cuts.items() for x in pair]), F.col("lang"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list[np.ndarray]] = {}
        for batch in text_slices(batches):
            for key, texts in _by_part(batch).items():
                old = found.get(key, [np.zeros(0, np.uint32), np.zeros(0, np.int64)])
                found[key] = _add(*old, *np.unique(_grams(texts), return_counts=True))
        for key, (keys, counts) in found.items():
            for shard in range(_SHARDS):
                own = keys % _SHARDS == shard
                if own.any():
                    yield _packed(*key, shard, keys[own], counts[own])

    def merge(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        keys = np.concatenate([from_planes(x, np.uint32) for x in rows["keys"].to_pylist()])
        counts = np.concatenate([from_planes(x, np.uint32) for x in rows["counts"].to_pylist()])
        none = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return pa.Table.from_batches([_packed(*(k.as_py() for k in key), *_add(*none, keys, counts))])

    schema = "lang string, half int, shard int, keys binary, counts binary"
    half = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int") if spread else F.lit(0)
    sample = rows.filter(F.col("at") <= limit).select("lang", "text", half.alias("half"))
    merged = sample.mapInArrow(count, schema).groupBy("lang", "half", "shard").applyInArrow(merge, schema).collect()
    languages = sorted(cuts)
    parts: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}
    for key in {(r["lang"], r["half"]) for r in merged}:
        own = [r for r in merged if (r["lang"], r["half"]) == key]
        keys, counts = (np.concatenate([from_planes(bytes(r[x]), np.uint32) for r in own]) for x in ("keys", "counts"))
        parts[key] = keys, counts
    whole = [
        _add(*(np.concatenate([parts[x, h][i] for h in (0, 1) if (x, h) in parts]) for i in (0, 1)),
             np.zeros(0, np.uint32), np.zeros(0, np.int64))
        for x in languages
    ]
    model = Counts(uuid4().hex, languages, [k for k, _ in whole], [c for _, c in whole])
    if spread:
        model.rates = _rates(sample, model.name, parts)
    return model


def _by_part(batch: pa.RecordBatch) -> dict[tuple[str, int], list[str]]:
    by: dict[tuple[str, int], list[str]] = {}
    for lang, half, text in zip(batch["lang"].to_pylist(), batch["half"].to_pylist(), texts_of(batch), strict=True):
        by.setdefault((lang, half), []).append(text)
    return by


def _rates(sample: DataFrame, name: str, parts: dict) -> dict[str, tuple[float, float]]:
    """Mean and deviation of the bits a byte of each text of the sample, learned from the half without it."""
    shared = sample.sparkSession.sparkContext.broadcast(parts)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = once(("ppm", name, "halves"), dict)
        for batch in text_slices(batches, limit=2 << 20):
            for (lang, half), texts in _by_part(batch).items():
                other = lang, 1 - half
                if other not in shared.value:
                    continue
                if other not in trees:
                    trees[other] = Tree(*shared.value[other])
                raw = [t.encode() for t in texts]
                sizes = np.array([len(t) for t in raw])
                data = np.frombuffer(b"".join(_PAD + t for t in raw), np.uint8)
                rate = trees[other].bits(data, np.cumsum(sizes + ORDER)) / sizes
                weight = np.minimum(sizes, WEIGHT_BYTES)
                yield pa.RecordBatch.from_pylist([{
                    "lang": lang, "n": len(texts), "w": float(weight.sum()),
                    "s": float(weight @ rate), "q": float(weight @ rate**2),
                }])

    sums = (
        sample.mapInArrow(measure, "lang string, n bigint, w double, s double, q double")
        .groupBy("lang").agg(*(F.sum(c).alias(c) for c in "nwsq")).collect()  # one small row a language
    )
    out = {}
    for r in sums:
        if r["n"] >= LEAST_TEXTS:
            mean = r["s"] / r["w"]
            out[r["lang"]] = mean, max(max(r["q"] / r["w"] - mean**2, 0.0) ** 0.5, LEAST_SPREAD)
    return out


def _add(keys: np.ndarray, counts: np.ndarray, more: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    joined, place = np.unique(np.concatenate([keys, more]), return_inverse=True)
    return joined, np.bincount(place, np.concatenate([counts, n]), len(joined)).astype(np.int64)


def _packed(lang: str, half: int, shard: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "lang": pa.array([lang], pa.string()), "half": pa.array([half], pa.int32()), "shard": pa.array([shard], pa.int32()),
        "keys": pa.array([to_planes(np.ascontiguousarray(keys, np.uint32))], pa.binary()),
        "counts": pa.array([to_planes(np.ascontiguousarray(counts, np.uint32))], pa.binary()),
    })


class Tree:
    """Costs in bits of every byte in every known context of one language.

    Bytes that never occurred share one class: they cost the same everywhere.
    A context is a number in base ``width``, the nearest byte being the lowest digit;
    ``lookup`` leads a context of ``ORDER`` bytes to the row of its longest known end.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray) -> None:
        seen = np.unique(keys.view(np.uint8))  # as a byte or before one
        self.classes = np.zeros(256, np.int64)
        self.classes[seen] = np.arange(1, len(seen) + 1)
        self.width = width = len(seen) + 1
        symbol = self.classes[keys & 255]
        context, lookup = np.zeros(len(keys), np.int64), np.zeros(1, np.int64)
        tables, parents, first = [], [], 0
        for order in range(ORDER + 1):
            if order:
                digit = self.classes[(keys >> np.uint32(8 * order)) & 255]
                context = context + digit * width ** (order - 1)
                lookup = np.tile(lookup, width)
            known, place = np.unique(context, return_inverse=True)
            table = np.zeros((len(known), width), np.float32)
            np.add.at(table, (place, symbol), counts)
            tables.append(table)
            parents.append(lookup[known])
            lookup[known] = first + np.arange(len(known))
            first += len(known)
        self.lookup = lookup.astype(np.int32)
        self.costs = self._costs(tables, np.concatenate(parents), 256 - len(seen)).ravel()

    @staticmethod
    def _costs(tables: list[np.ndarray], parents: np.ndarray, unseen: int) -> np.ndarray:
        every = np.concatenate(tables)
        weight = np.ones(every.shape[1])  # bytes in a class
        weight[0] = unseen
        orders = np.repeat(np.arange(len(tables)), [len(t) for t in tables])
        out = np.zeros_like(every)
        for begin in range(0, len(every), 2048):
            rows = np.arange(begin, min(begin + 2048, len(every)))
            top = orders[rows]
            left = np.ones((len(rows), len(weight)), bool)  # neither coded nor ruled out
            paid, cost = np.zeros(len(rows)), np.zeros((len(rows), len(weight)))
            for step in range(len(tables)):
                found = np.where(left & (top >= step)[:, None], every[rows], 0)
                total, kinds = found.sum(1), (found > 0).sum(1)
                asked = kinds > 0  # a context that can only repeat what is ruled out is skipped
                sums = np.where(asked, total + kinds, 1)
                coded = found > 0
                bits = np.log2(np.where(coded, found, 1) / sums[:, None])
                cost = np.where(coded, paid[:, None] - bits, cost)
                paid = paid - np.log2(np.where(asked, kinds, 1) / sums)
                left &= ~coded
                rows = parents[rows]
            remaining = np.maximum((left * weight).sum(1), 1)
            cost = np.where(left, (paid + np.log2(remaining))[:, None], cost)
            out[begin : begin + len(cost)] = cost
        return out

    def bits(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Code lengths of texts, each after ``ORDER`` line ends, that end at ``ends``."""
        symbols = self.classes[data]
        context = np.zeros(len(symbols) - ORDER, np.int64)
        for i in range(ORDER):
            context = context * self.width + symbols[i : len(symbols) - ORDER + i]
        cost = self.costs[self.lookup[context] * self.width + symbols[ORDER:]]
        # the line ends between two texts cost nothing
        sums = np.concatenate([[0.0], np.cumsum(cost, dtype=np.float64)])
        starts = np.concatenate([[0], ends[:-1]])
        return sums[np.maximum(ends - ORDER, starts)] - sums[starts]


class Judge:
    def __init__(self, model: Counts) -> None:
        self.trees = [Tree(k, c) for k, c in zip(model.keys, model.counts, strict=True)]
        self.names = np.array([*model.languages, UNDETERMINED], object)
        # a language that was not measured sets no limit
        self.rates = np.array([model.rates.get(x, (np.inf, 1.0)) for x in model.languages]).reshape(-1, 2)

    def __call__(self, texts: list[str], spoken: list[bool]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, strange or not) of each text; ``spoken``: it has a letter."""
        none = len(self.trees)
        best, score, strange = np.full(len(texts), none), np.zeros(len(texts)), np.zeros(len(texts), bool)
        if self.trees and texts:
            raw = [t.encode() for t in texts]
            data = np.frombuffer(b"".join(_PAD + t for t in raw), np.uint8)
            ends = np.cumsum([len(t) + ORDER for t in raw])
            bits = np.stack([tree.bits(data, ends) for tree in self.trees])
            best = bits.argmin(0)
            score = 1 / np.exp2(np.maximum(bits.min(0) - bits, -1000)).sum(0)
            sizes = np.maximum([len(t) for t in raw], 1)
            mean, deviation = self.rates[best].T
            strange = bits.min(0) / sizes > mean + MARGIN * np.sqrt(deviation**2 + BYTE_SPREAD**2 / sizes)
        und = ~np.array(spoken, bool)
        best[und], score[und] = none, 0.0
        return self.names[best], score, strange


def _judged(docs: DataFrame, model: Counts, text_col: str, schema: object, make: Callable) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # as large as the sample allows
    name, spoken = model.name, fresh_name("spoken_", docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = once(("ppm", name), lambda: Judge(Counts(**shared.value)))
        for batch in text_slices(batches, text_col, limit=2 << 20):
            yield make(batch, *judge(texts_of(batch, text_col), batch.column(spoken).to_pylist()))

    letters = F.coalesce(docs[text_col].rlike(r"\p{L}"), F.lit(False))
    return docs.select("*", letters.alias(spoken)).mapInArrow(run, schema)


def predict(
    docs: DataFrame, model: Counts, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, lang_pred, score (share of the language among all, given equal priors).

    Whole texts are scored. Null texts, texts without a letter, and all texts if
    nothing was learned, get "und" and score 0. Rows that repeat are alike; ties
    between languages go to the name that sorts first.
    """

    def make(batch: pa.RecordBatch, lang: np.ndarray, score: np.ndarray, strange: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
            ["doc_id", "lang_pred", "score"],
        )

    source = id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return _judged(source, model, "text", "doc_id bigint, lang_pred string, score double", make)


def keep_known(docs: DataFrame, model: Counts, *, text_col: str = "text", min_score: float = 0.5) -> DataFrame:
    """The rows, as they are, whose language is determined with at least ``min_score``, unless
    their code is too long for it (only where ``fit`` has measured the ``spread``)."""
    names = docs.columns

    def make(batch: pa.RecordBatch, lang: np.ndarray, score: np.ndarray, strange: np.ndarray) -> pa.RecordBatch:
        good = pa.array((lang != UNDETERMINED) & (score >= min_score) & ~strange)
        return batch.select(names).filter(good)

    return _judged(docs, model, text_col, docs.schema, make)
