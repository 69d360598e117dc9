"""Toxicity by bags of subwords: averaged embeddings under a linear softmax.

A word is itself and its character n-grams (3 to 5, with word bounds), hashed to
rows of one embedding matrix; a passage of up to 24 words is the mean of its
words' means, and a softmax of two classes sits on top. Both matrices are
learned together in numpy from the labels of documents: a document is as toxic
as its worst passage, so the passage that scores highest carries the gradient.
Words never seen, such as misspellings, share n-grams with known ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlytics.llm.common import id_and_text, once, smallest, text_slices, texts_of

BUCKETS = 1 << 16
DIM = 8
PASSAGE = 24
SAMPLE_PER_CLASS = 2500
LONGEST_SAMPLE = 200_000  # bytes of a text that may teach
STEPS = 400  # batches at least; five passes at least
RATE = 0.3
BATCH = 64
KNOWN_WORDS = 300_000
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def subwords(word: str) -> list[int]:
    """Rows of a word: itself and its n-grams of 3 to 5 characters, bounds marked."""
    marked = f"<{word}>"
    grams = [marked[i : i + n] for n in (3, 4, 5) for i in range(len(marked) - n + 1)]
    return [crc32(g.encode()) % BUCKETS for g in dict.fromkeys([marked, *grams])]


def worst(scores: np.ndarray, passage: int = PASSAGE) -> tuple[float, int]:
    """(mean, start) of the passage with the highest mean; one shorter than ``passage`` if need be."""
    if len(scores) <= passage:
        return (float(scores.mean()) if len(scores) else 0.0), 0
    sums = np.concatenate([[0.0], np.cumsum(scores, dtype=np.float64)])
    means = (sums[passage:] - sums[:-passage]) / passage
    at = int(means.argmax())
    return float(means[at]), at


@dataclass
class Model:
    """``rows``: what each subword adds to the logit, the softmax's two outputs taken together."""

    name: str
    rows: np.ndarray
    bias: float


class _Words:
    """Distinct words of the sample and their subwords, end to end."""

    def __init__(self, texts: list[str]) -> None:
        index: dict[str, int] = {}
        self.docs = [
            np.array([index.setdefault(w, len(index)) for w in words_of(t)], np.int64) for t in texts
        ]
        parts = [subwords(w) for w in index]
        self.counts = np.array([len(p) for p in parts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])[:-1]
        self.flat = np.array([g for p in parts for g in p], np.int64)

    def rows(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(subword rows of the words, end to end; where each word's begin)."""
        counts = self.counts[words]
        starts = np.concatenate([[0], np.cumsum(counts)])[:-1]
        within = np.arange(counts.sum()) - np.repeat(starts, counts)
        return self.flat[np.repeat(self.starts[words], counts) + within], starts

    def means(self, table: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Of each word, the mean of its subwords' entries in ``table``."""
        if not len(words):
            return np.zeros((0, *table.shape[1:]))
        rows, starts = self.rows(words)
        counts = self.counts[words].reshape(-1, *[1] * (table.ndim - 1))
        return np.add.reduceat(table[rows], starts) / counts


def train(texts: list[str], toxic: list[int], seed: int = 7) -> Model:
    """Adagrad over the documents in shuffled batches; the same sample gives the same model."""
    rng = np.random.default_rng(seed)
    words, label = _Words(texts), np.array(toxic, np.int64)
    embedding = rng.uniform(-0.01, 0.01, (BUCKETS, DIM))  # rows never trained say next to nothing
    output, bias = rng.normal(0, 0.5, (DIM, 2)), np.zeros(2)
    seen = [np.full(x.shape, 1e-2) for x in (embedding, output, bias)]
    epochs = max(5, -(-STEPS * BATCH // len(texts))) if texts else 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for begin in range(0, len(order), BATCH):
            batch = order[begin : begin + BATCH]
            chosen = [words.docs[i] for i in batch]
            if epoch:  # the first pass takes whole documents, so that the worst passage means something
                known, place = np.unique(np.concatenate(chosen), return_inverse=True)
                score = words.means(embedding @ (output[:, 1] - output[:, 0]), known)[place]
                ends = np.cumsum([len(own) for own in chosen])
                at = [worst(score[end - len(own) : end])[1] for own, end in zip(chosen, ends, strict=True)]
                chosen = [own[i : i + PASSAGE] for own, i in zip(chosen, at, strict=True)]
            of = np.repeat(np.arange(len(batch)), [len(own) for own in chosen])
            used, place = np.unique(np.concatenate(chosen), return_inverse=True)
            size = np.maximum(np.bincount(of, minlength=len(batch)), 1)
            # how much each distinct word weighs in each document of the batch
            share = np.zeros((len(batch), len(used)))
            np.add.at(share, (of, place), 1 / size[of])
            hidden = share @ words.means(embedding, used)
            logits = hidden @ output + bias
            wrong = np.exp(logits - logits.max(1, keepdims=True))
            wrong /= wrong.sum(1, keepdims=True)
            wrong[np.arange(len(batch)), label[batch]] -= 1  # gradient of the logits
            per_word = share.T @ (wrong @ output.T) / words.counts[used][:, None]
            rows, _ = words.rows(used)
            distinct, place = np.unique(rows, return_inverse=True)
            back = np.repeat(per_word, words.counts[used], axis=0)
            change = np.stack([np.bincount(place, back[:, k], len(distinct)) for k in range(DIM)], 1)
            steps = ((embedding, distinct, change), (output, slice(None), hidden.T @ wrong), (bias, slice(None), wrong.sum(0)))
            for (matrix, at, gradient), past in zip(steps, seen, strict=True):
                past[at] += gradient**2
                matrix[at] -= RATE * gradient / np.sqrt(past[at])
    rows = embedding @ (output[:, 1] - output[:, 0])
    return Model(uuid4().hex, rows.astype(np.float32), float(bias[1] - bias[0]))


def fit(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", per_class: int = SAMPLE_PER_CLASS, longest: int = LONGEST_SAMPLE,
) -> Model:
    """A model of the ``per_class`` labelled documents of each class with the smallest hash of their id.

    Labels may repeat (the highest counts) or be null (ignored), or have no document. Of
    documents that share an id the one with the least text counts; texts of more than
    ``longest`` bytes teach nothing. The sample's texts are the only rows that reach the driver,
    ``2 * per_class * longest`` bytes at most.
    """
    known = labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("y"))
    known = known.filter(F.col("y").isin(0, 1)).groupBy("doc_id").agg(F.max("y").alias("y"))
    chosen = smallest(known.withColumn("at", F.xxhash64("doc_id")), "y", ["at", "doc_id"], per_class)
    source = id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    # at most 2 * per_class rows of two numbers
    found = source.filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= longest).join(F.broadcast(chosen.select("doc_id", "y")), "doc_id")
    rows = found.groupBy("doc_id", "y").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"] or ""))
    return train([r["text"] or "" for r in rows], [r["y"] for r in rows])


class Scorer:
    def __init__(self, rows: np.ndarray, bias: float) -> None:
        self.rows, self.bias = rows.tolist(), bias
        self.known: dict[str, float] = {}

    def _word(self, word: str) -> float:
        grams = subwords(word)
        value = sum(map(self.rows.__getitem__, grams)) / len(grams)
        if len(self.known) >= KNOWN_WORDS:
            self.known.clear()
        self.known[word] = value
        return value

    def logit(self, text: str) -> float:
        get, new = self.known.get, self._word
        scores = [x if (x := get(w)) is not None else new(w) for w in words_of(text)]
        return worst(np.array(scores, np.float64))[0] + self.bias


def score(
    docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, score: probability that the worst passage of the whole text is toxic.

    One row per row. Texts without words, null ones included, get the score of the bias.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # as large as BUCKETS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = shared.value
        scorer = once(("toxicity", data["name"]), lambda: Scorer(data["rows"], data["bias"]))
        for batch in text_slices(batches):
            logits = np.array([scorer.logit(text) for text in texts_of(batch)])
            scores = 1 / (1 + np.exp(-np.clip(logits, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    source = id_and_text(docs, id_col, text_col).select(F.col("doc_id").cast("long"), "text")
    return source.mapInArrow(run, "doc_id bigint, score double")
