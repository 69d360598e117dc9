"""What the operators share: worker values, column names, samples."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlytics.llm import hashstore, language, repeats, toxicity
from eventlytics.llm.common import fresh_name, once


def test_one_value_of_a_kind_is_kept():
    made = []

    def build(key):
        return once(key, lambda: made.append(key) or key)

    for key in (("a", 1), ("a", 1), ("b", 1), ("a", 2), ("b", 1), ("a", 1)):
        assert build(key) == key
    assert made == [("a", 1), ("b", 1), ("a", 2), ("a", 1)]


def test_helper_columns_clash_with_nothing(spark):
    rows = [(i, f"the cat number {i} sat on the mat and slept there", "en") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    odd = docs.select("*", *[F.lit("x").alias(c) for c in ("spoken_", "Spoken__", "own_id_", "gone_", "salt_", "at")])
    assert fresh_name("spoken_", odd) == "spoken___"
    model = language.fit(odd, spread=True)
    kept = language.keep_known(odd, model)
    assert kept.columns == odd.columns and kept.count() == 30
    out = repeats.without_repeats(odd)
    assert out.columns == [*odd.columns, "n_sentences", "n_removed"] and out.count() == 30


def test_ids_that_repeat_teach_once(spark):
    """An id of many rows, and a text too long to teach, don't reach the driver."""
    docs = spark.range(100_000).selectExpr("id % 2 AS doc_id", "IF(id % 2 = 0, 'kind words here', 'awful nasty words') AS text")
    labels = spark.createDataFrame([(0, 0), (1, 1), (2, 1)], "doc_id long, toxic int")
    long = spark.createDataFrame([(2, "awful " * 100_000)], "doc_id long, text string")
    seen = []
    train, toxicity.train = toxicity.train, lambda texts, labels: seen.append((texts, labels))
    try:
        toxicity.fit(docs.unionByName(long), labels)
    finally:
        toxicity.train = train
    assert seen == [(["kind words here", "awful nasty words"], [0, 1])]


@pytest.mark.parametrize("width", [1, 4])
@pytest.mark.parametrize("n", [1, 50, 20_000])
def test_packed_store_gives_what_was_written(tmp_path, n, width):
    rng = np.random.default_rng(n)
    top = np.uint64(2**64 - 1)
    near = rng.integers(0, 2**64, 50, np.uint64)  # keys that differ in the last bits, and crowded ones
    keys = np.unique(np.concatenate([
        rng.integers(0, 2**64, n, np.uint64), near, near ^ np.uint64(1), near ^ np.uint64(0xFFFF),
        np.arange(n, dtype=np.uint64) * np.uint64(3), np.array([0, 1, top, top - np.uint64(1)], np.uint64),
    ]))
    # few rows of values, many, and ones of more than 16 bits
    values = rng.choice([1, 1, 1, 2, 3, 300, 65534, 65535, 65536, 2**32 - 1], (len(keys), width))
    values[: len(keys) // 3] = rng.integers(0, 5000, (len(keys) // 3, width))
    store = hashstore.Store(3, width, {})
    owner = hashstore.shard_of(keys, 3)
    for shard in range(3):
        own = owner == shard
        store.files[shard] = hashstore.write_packed(f"{tmp_path}/a", shard, keys[own], values[own]), int(own.sum())
    asked = np.concatenate([keys, keys + np.uint64(1), keys ^ np.uint64(2), rng.integers(0, 2**64, 500, np.uint64)])
    asked = rng.permutation(np.concatenate([asked, asked[:100]]))
    known = dict(zip(keys.tolist(), values.tolist(), strict=True))
    found = hashstore.PackedReader(store).find(asked)
    assert found.tolist() == [known.get(k, [0] * width) for k in asked.tolist()]


def test_packed_store_without_keys(tmp_path):
    place = hashstore.write_packed(f"{tmp_path}/a", 0, np.zeros(0, np.uint64), np.zeros((0, 1), np.int64))
    reader = hashstore.PackedReader(hashstore.Store(1, 1, {0: (place, 0)}))
    assert place == "" and reader.find(np.arange(3, dtype=np.uint64)).tolist() == [[0]] * 3
    assert reader.find(np.zeros(0, np.uint64)).shape == (0, 1)
