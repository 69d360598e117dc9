"""Queries over whole tables: held-out labels, digests of the tokenizers library, planted vectors."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from eventlytics.llm.queries import QUERIES


def test_op6_finds_held_out_toxic_documents(spark, tmp_path):
    """Held-out documents spell the toxic words as no learned document does."""
    rng = random.Random(30)
    plain = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    docs, labels = [], []
    for i in range(900):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 120))]
        toxic = i % 3 == 0
        if toxic:
            held = zlib.crc32(str(i).encode()) % 5 == 0
            words[rng.randrange(len(words))] = rng.choice(["zorglint", "zorglamp"] if held else ["zorgling", "zorglift", "zorglump", "zorglent"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = QUERIES["op6_toxicity"](spark, str(tmp_path)).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out) and len(out) == 900
    held = [r for r in out if r.held_out]
    found = [r.predicted for r in held if r.doc_id % 3 == 0]
    flagged = [r.predicted for r in held if r.doc_id % 3]
    one, zero = ([r.score for r in held if (r.doc_id % 3 == 0) == toxic] for toxic in (True, False))
    above = np.mean(np.array(one)[:, None] > np.array(zero)[None, :])
    # measured when written: 0.84 of 50 found with spellings that no learned document holds
    assert len(found) > 30 and np.mean(found) > 0.8
    assert np.mean(flagged) < 0.05 and above > 0.95


def test_op10_digests_equal_the_library(spark, small):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    want = {}
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[r.doc_id] = (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        )
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op10_bpe_automaton"](spark, small).collect()}
    assert got == want


def test_op3_on_a_table_with_links(spark, tmp_path):
    """The given embeddings, with copies near to and just outside the threshold planted among them."""
    rng = np.random.default_rng(31)
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    vectors = [np.array(r.embedding, np.float64) for r in rows]
    for base in range(0, 40, 2):
        for noise in (0.0, 0.02, 0.3, 0.35):
            v = vectors[base]
            step = rng.normal(size=len(v))
            step -= v * (step @ v) / (v @ v)
            vectors.append((v + step * (noise * np.linalg.norm(v) / np.linalg.norm(step))) * rng.uniform(0.1, 5))
    table = [(i, v.tolist(), "x") for i, v in enumerate(vectors)]
    n = len(table)
    table += [(n, None, "x"), (n + 1, [0.0] * len(vectors[0]), "x"), (n + 2, [float("nan")] * len(vectors[0]), "x")]
    spark.createDataFrame(table, "vec_id long, embedding array<double>, label string").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r.vec_id: r for r in QUERIES["op3_cover_tree"](spark, str(tmp_path)).collect()}
    unit = np.stack(vectors) / np.linalg.norm(np.stack(vectors), axis=1)[:, None]
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    root = np.arange(n)
    for _ in range(n):
        new = np.minimum(root, np.where(near, root[None, :], n).min(1))
        if (new == root).all():
            break
        root = new
    assert near.sum() > 80
    for i in range(n):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (near[i].sum(), root[i], root[i] == i)
    assert all((got[n + k].n_links, got[n + k].component_id, got[n + k].kept) == (0, n + k, True) for k in range(3))
