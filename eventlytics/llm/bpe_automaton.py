"""BPE by a tokenization automaton (Berglund, Martens and van der Merwe, 2024).

``compile_merges`` starts from one state with a loop for every single symbol and
applies the merge gadget for each merge (l, r) in order: the target of ``l``
loses its ``r`` arc (it is split off first if other tokens lead to it), and
every state with an ``l`` arc gets an arc for the merged token, to the old
target of ``r``. The result is deterministic and accepts exactly the token
sequences that merging would give, so a word has one path: it is found by
walking the arcs from left to right. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlytics.llm.byte_bpe import byte_letters
from eventlytics.llm.common import id_and_text, once, text_slices, texts_of

FINAL = 256  # symbols from here on are bytes that end a word
CACHED_CHUNKS = 250_000
#: The vocabulary's pattern of words, and white space on which libraries differ.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_UNSURE_SPACE = "\x1c\x1d\x1e\x1f"


@dataclass
class Automaton:
    """``arcs``: bit (state, class of token); tokens of one class have arcs from the same states."""

    arcs: np.ndarray
    token_class: np.ndarray
    target: np.ndarray
    children: dict[int, int]  # trie over symbols: node * 512 + symbol -> node
    token_at: list[int]  # node -> token, or -1
    labels: list[str]  # id -> label, for decoding
    added: dict[str, int]


def _bit(row: np.ndarray, i: int) -> np.ndarray:
    return (row[..., i >> 3] >> (i & 7)) & 1


def apply_merges(size: int, base: list[int], merges: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(bits of arcs by state and token, target state of each token) after all gadgets."""
    bits = np.zeros((1024, (size + 7) // 8), np.uint8)
    for token in base:
        bits[0, token >> 3] |= 1 << (token & 7)
    target, leading, states = np.zeros(size, np.int32), [len(base)], 1
    for left, right, whole in merges:
        state, onward = int(target[left]), int(target[right])
        if not _bit(bits[state], right):
            continue  # no path has left before right any more
        if state == 0 or leading[state] > 1 or left == right:
            if states == len(bits):
                bits = np.concatenate([bits, np.zeros_like(bits[: states // 2])])
            bits[states] = bits[state]
            leading[state] -= 1
            leading.append(1)
            target[left] = state = states
            states += 1
        bits[state, right >> 3] &= 255 - (1 << (right & 7))
        target[whole] = onward
        leading[onward] += 1
        bits[:states, whole >> 3] |= _bit(bits[:states], left) << (whole & 7)
    return bits[:states], target


@lru_cache(maxsize=2)
def compile_merges(path: str) -> Automaton:
    """The automaton of a tokenizers file with byte-level words and a word-end suffix."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, letters = spec["model"], byte_letters()
    vocab, suffix = model["vocab"], model["end_of_word_suffix"]
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
    base = [vocab[x] for c in letters for x in (c, c + suffix) if x in vocab]
    size = max(vocab.values()) + 1
    bits, target = apply_merges(size, base, merges)
    by_token = np.packbits(np.unpackbits(bits, axis=1, bitorder="little")[:, :size], axis=0).T
    rows = np.ascontiguousarray(by_token).view(np.dtype((np.void, by_token.shape[1]))).ravel()
    _, first, token_class = np.unique(rows, return_index=True, return_inverse=True)
    per_class = np.unpackbits(by_token[first], axis=1)[:, : len(bits)]
    arcs = np.packbits(per_class.T, axis=1, bitorder="little")

    children: dict[int, int] = {}
    token_at = [-1]
    names = {i: t for t, i in vocab.items()}
    for token in {*base, *(whole for _, _, whole in merges)}:
        name = names[token]
        ends = name.endswith(suffix)
        symbols = [letters[c] for c in (name.removesuffix(suffix) if ends else name)]
        if ends:
            symbols[-1] += FINAL
        node = 0
        for symbol in symbols:
            node = children.setdefault(node << 9 | symbol, len(token_at))
            if node == len(token_at):
                token_at.append(-1)
        token_at[node] = token
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    names |= {i: t for t, i in added.items()}
    labels = [names.get(i, "") for i in range(max(names) + 1)]
    return Automaton(arcs, token_class.astype(np.int32), target, children, token_at, labels, added)


class Coder:
    """Encodes and decodes with the tables of an automaton."""

    def __init__(self, tables: Automaton) -> None:
        import regex

        self.tables, self.labels, self.added = tables, tables.labels, tables.added
        self.words = regex.compile(PATTERN)
        self.split = re.compile(f"({'|'.join(map(re.escape, sorted(self.added, key=len, reverse=True)))})")
        self.known: dict[str, bytes] = {}
        # children of a node as a row over symbols, for nodes that have any
        parents = sorted({key >> 9 for key in tables.children})
        self.row = np.zeros(len(tables.token_at), np.int32)
        self.row[parents] = np.arange(1, len(parents) + 1)
        self.child = np.zeros((len(parents) + 1, 2 * FINAL), np.int32)
        keys = np.fromiter(tables.children, np.int64, len(tables.children))
        self.child[self.row[keys >> 9], keys & 511] = np.fromiter(tables.children.values(), np.int64)
        self.token_at = np.array(tables.token_at, np.int32)

    def paths(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of the words' only paths, one after another; tokens per word).

        All words take a step at once: from position ``i`` of each, in the state
        that its path so far has reached, along the trie of token labels.
        """
        tables = self.tables
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        starts = ends - lengths
        symbols = np.frombuffer(b"".join(words), np.uint8).astype(np.int32)
        symbols[ends - 1] += FINAL
        # of the token that ends at a position: itself, its length, the state after it
        token, width, state = (np.zeros(len(symbols), np.int32) for _ in range(3))
        for i in range(int(lengths.max(initial=0))):
            going = np.flatnonzero(lengths > i)
            at, end = starts[going] + i, ends[going]
            before = state[at - 1] if i else np.zeros(len(at), np.int32)
            node = np.zeros(len(at), np.int32)
            step = 0
            while len(at):
                node = self.child[self.row[node], symbols[at]]
                found = self.token_at[node]
                group = tables.token_class[found]
                arc = (tables.arcs[before, group >> 3] >> (group & 7)) & 1
                hit = np.flatnonzero((node > 0) & (found >= 0) & (arc > 0))
                place, tok = at[hit], found[hit]
                token[place], width[place], state[place] = tok, step + 1, tables.target[tok]
                step += 1
                on = np.flatnonzero((node > 0) & (at + 1 < end))
                at, end, before, node = at[on] + 1, end[on], before[on], node[on]
        used = np.zeros(len(symbols), bool)
        at, start = ends - 1, starts
        while len(at):
            used[at] = True
            at = at - width[at]
            on = np.flatnonzero(at >= start)
            at, start = at[on], start[on]
        sums = np.concatenate([[0], np.cumsum(used)])
        return token[used], sums[ends] - sums[starts]

    def _normal(self, text: str) -> str:
        if not text.isascii():
            # letter by letter: a final sigma is no case of its own
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def _chunks(self, text: str) -> list[str]:
        text = self._normal(text)
        # no word spans white space; where libraries differ on that, take the words themselves
        return self.words.findall(text) if any(c in text for c in _UNSURE_SPACE) else text.split()

    def _learn(self, chunks: set[str]) -> None:
        new = [c for c in chunks if c not in self.known]
        if len(self.known) + len(new) > CACHED_CHUNKS:
            self.known.clear()
            new = list(chunks)
        parts = [self.words.findall(c) for c in new]
        words = [w.encode() for part in parts for w in part]
        tokens, counts = self.paths(words)
        per_word = np.concatenate([[0], np.cumsum(counts)])
        cuts = 4 * per_word[np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])]
        data = tokens.astype("<u4").tobytes()
        cuts = cuts.tolist()
        self.known.update((c, data[a:b]) for c, a, b in zip(new, cuts[:-1], cuts[1:], strict=True))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        parts: list[list[list[str] | int]] = []
        for text in texts:
            if any(token in text for token in self.added):
                cut = self.split.split(text)
                parts.append([self.added[x] if x in self.added else self._chunks(x) for x in cut])
            else:
                parts.append([self._chunks(text)])
        self._learn({c for part in parts for x in part if isinstance(x, list) for c in x})
        known = self.known.__getitem__
        return [
            b"".join([np.uint32(x).tobytes() if isinstance(x, int) else b"".join(map(known, x)) for x in part])
            for part in parts
        ]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        """The labels of the arcs; the vocabulary's file has no decoder that joins them."""
        return " ".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_decode(
    docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text",
    digests: bool = False,
) -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian unsigned 32-bit) and decoded text.

    With ``digests``, ids_sha256 and decoded_sha256 stand in place of the two.
    One row per row, in any order; a null text counts as empty, which has no ids
    and decodes to ''. Only the automaton's tables are sent to the executors;
    their size is the vocabulary's. No shuffle.
    """
    path = vocabulary
    tables = docs.sparkSession.sparkContext.broadcast(vars(compile_merges(path)))
    kinds = ("ids_sha256 string, decoded_sha256 string", "ids binary, decoded string")
    schema = f"doc_id bigint, n_tokens bigint, {kinds[0] if digests else kinds[1]}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        coder = once(("word_bpe", path), lambda: Coder(Automaton(**tables.value)))
        for batch in text_slices(batches, limit=4 << 20):
            ids = coder.encode_all(texts_of(batch))
            texts = map(coder.decode, ids)
            if digests:
                first = pa.array([sha256(x).hexdigest() for x in ids], pa.string())
                second = pa.array([sha256(x.encode()).hexdigest() for x in texts], pa.string())
            else:
                first, second = pa.array(ids, pa.binary()), pa.array(list(texts), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), first, second],
                [f.split(" ")[0] for f in schema.split(", ")],
            )

    source = id_and_text(docs, id_col, text_col).select(F.col("doc_id").cast("long"), "text")
    return source.mapInArrow(run, schema)
