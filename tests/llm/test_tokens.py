"""Packing and BPE against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from eventlytics.llm import bpe_automaton, packing
from eventlytics.llm.bpe_automaton import Automaton, Coder, apply_merges, compile_merges
from eventlytics.llm.byte_bpe import ByteEncoder
from eventlytics.llm.queries import QUERIES

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = ["a", " ", "  ", "\n", "\t", "'s", "'", "s", "ll", "é", "é", "1", "!", "...", "<|endoftext|>", "the",
          "THE", "Ｆ", "　", "\x1c", "世界", "\r\n", "\U0001f642", "Σ", "ς", "İ", "ﬁ",
          "\x85", "​", "\x00", "Ⅷ", "½", "_", "aaaa", "<|startoftext|>"]


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 9))) for _ in range(n)]


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


def test_byte_ids_equal_the_library():
    own, library = ByteEncoder(BYTES), Tokenizer.from_file(BYTES)
    for text in texts(3000, 1):
        assert ids(own.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_automaton_equals_the_library():
    own, library = Coder(compile_merges(WORDS)), Tokenizer.from_file(WORDS)
    many = texts(3000, 2)
    for text, data in zip(many, own.encode_all(many), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids(data) == want
        assert own.decode(data) == library.decode(want, skip_special_tokens=False)


def test_gadgets_accept_merge_results_only():
    """Every pair of arcs allowed by the automaton, against merging by hand."""
    merges = [("a", "b"), ("b", "c"), ("a", "a"), ("ab", "c"), ("c", "a"), ("aa", "b")]
    names = ["a", "b", "c", *(x + y for x, y in merges)]
    at = {t: i for i, t in enumerate(names)}
    bits, target = apply_merges(len(names), [0, 1, 2], [(at[x], at[y], at[x + y]) for x, y in merges])

    def merged(text):
        out = list(text)
        for pair in merges:
            i, new = 0, []
            while i < len(out):
                if tuple(out[i : i + 2]) == pair:
                    new.append(out[i] + out[i + 1])
                    i += 2
                else:
                    new.append(out[i])
                    i += 1
            out = new
        return out

    rng = random.Random(5)
    for _ in range(2000):
        text = "".join(rng.choice("abc") for _ in range(rng.randint(1, 9)))
        state = 0
        for token in merged(text):
            assert bits[state, at[token] >> 3] >> (at[token] & 7) & 1
            state = target[at[token]]
    real = [t for t in names if merged(t) == [t]]  # others never come out of merging
    for x in real:
        for y in real:
            allowed = bits[target[at[x]], at[y] >> 3] >> (at[y] & 7) & 1
            assert bool(allowed) == (merged(x + y) == [x, y])


def test_encode_decode_rows(spark):
    rows = [(1, None, 5), (2, "", 5), (3, "Hello  world", 5), (3, "Hello  world", 5), (None, "x" * 3000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    out = bpe_automaton.encode_decode(docs, WORDS).collect()
    library = Tokenizer.from_file(WORDS)
    assert len(out) == 5
    for r in out:
        text = {1: "", 2: "", 3: "Hello  world", None: "x" * 3000}[r.doc_id]
        assert ids(bytes(r.ids)) == library.encode(text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids(bytes(r.ids)))
    assert bpe_automaton.encode_decode(docs.limit(0), WORDS).count() == 0
    assert isinstance(compile_merges(WORDS), Automaton)


def sequences(rows):
    by = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        by.setdefault(r.sequence_id, []).append(r)
    return by


def check_pieces(rows, want):
    """Every id in one piece, offsets gapless, sums of ids right."""
    for pieces in sequences(rows).values():
        at = 0
        for p in pieces:
            assert p.offset == at
            at += p.length
        assert at <= 2048
    docs = {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
    assert docs.keys() == want.keys()
    for doc_id, pieces in docs.items():
        at = 0
        for p in sorted(pieces, key=lambda r: r.start):
            part = np.array(want[doc_id][at : at + p.length], "<u4").tobytes()
            assert (p.start, p.ids_crc32, p.doc_tokens) == (at, zlib.crc32(part), len(want[doc_id]))
            at += p.length
        assert at == len(want[doc_id])


def test_packing_of_a_table(spark, small):
    library = Tokenizer.from_file(BYTES)
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    want = {r.doc_id: library.encode(r.text or "", add_special_tokens=False).ids + [1] for r in docs}
    rows = QUERIES["op8_packing"](spark, small).collect()
    check_pieces(rows, want)
    used = sum(r.length for r in rows)
    assert used > 0.9 * 2048 * len(sequences(rows))


def test_packing_over_many_partitions(spark):
    library = Tokenizer.from_file(BYTES)
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["one", "two", "three"]) for _ in range(rng.randint(0, 900)))) for i in range(300)]
    rows += [(300, None), (301, ""), (302, "word " * 9000)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, offset int").repartition(40)
    out = packing.pack(docs, BYTES, open_windows=4).collect()
    check_pieces(out, {i: library.encode(t or "", add_special_tokens=False).ids + [1] for i, t in rows})
    assert all(len(r.ids) == 4 * r.length for r in out)
    assert sum(r.length for r in out) > 0.9 * 2048 * len(sequences(out))
    assert packing.pack(docs.limit(0), BYTES).count() == 0


def test_windows_emit_the_fullest():
    windows = packing.Windows(10, 2, 0)
    for n in (6, 7, 5, 4):
        windows.place({"length": n})
    # 6 and 7 are open; 5 fits neither, so 7 goes; then 4 fills 6
    assert [(p["length"], p["sequence_id"], p["offset"]) for p in windows.done] == [(7, 0, 0), (6, 1, 0), (4, 1, 6)]


def test_long_runs_of_one_kind():
    own, library = ByteEncoder(BYTES), Tokenizer.from_file(BYTES)
    for text in (" " * 1_200_000, "a" * 100_000 + "\n" * 150_000 + "b", "x" * 300_000):
        assert ids(own.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_long_white_space_is_packed(spark):
    rows = [(1, " " * 2_000_000), (2, "\n" * 1_100_000 + "end")]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), BYTES, payload="crc32").collect()
    assert {r.doc_id for r in out} == {1, 2}
    for doc, text in rows:
        n = len(Tokenizer.from_file(BYTES).encode(text, add_special_tokens=False).ids) + 1
        mine = sorted((r.start, r.length) for r in out if r.doc_id == doc)
        assert sum(length for _, length in mine) == n == next(r.doc_tokens for r in out if r.doc_id == doc)
