"""A stored table and its refreshes."""

import pytest
from pyspark.sql import functions as F

from eventlytics.operators.store import Store
from tests.conftest import values


def files(df):
    return {r[0] for r in df.select("_metadata.file_path").distinct().collect()}


def test_only_touched_buckets_are_written(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/t", ("k",), buckets=16)
    rows = spark.range(400).selectExpr("id % 40 AS k", "id AS x")
    assert store.version() == 0 and store.create(rows) == 1
    old = {b: files(store.read(buckets=[b])) for b in range(16)}
    fresh = spark.createDataFrame([(3, -1), (99, -2)], "k long, x long")
    stale = spark.createDataFrame([(3,), (5,), (3,)], "k long")
    assert store.refresh(fresh, stale) == 2
    want = [(i % 40, i) for i in range(400) if i % 40 not in (3, 5)] + [(3, -1), (99, -2)]
    assert values(store.read()) == sorted(want)
    touched = {r[0] for r in spark.createDataFrame([(3,), (5,), (99,)], "k long").select(store.bucket()).collect()}
    for b in range(16):
        now = files(store.read(buckets=[b]))
        assert (now == old[b]) == (b not in touched), b
    assert values(store.read(1)) == sorted((i % 40, i) for i in range(400))
    gone = {r[0].split("/t/")[1] for r in store.unreferenced().collect()}
    assert gone == {f.split("/t/")[1] for b in touched for f in old[b]}
    assert store.unreferenced(2).collect() == []


def test_other_buckets_are_not_read(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/t", ("k",), buckets=8)
    store.create(spark.range(100).selectExpr("id AS k"))
    plan = store.read(buckets=[1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket_" in plan.split("PartitionFilters")[1]
    assert len(files(store.read())) == 8


def test_an_interrupted_refresh_changes_nothing(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/t", ("k",), buckets=4)
    store.create(spark.range(20).selectExpr("id AS k", "'old' AS x"))
    broken = spark.range(1, 2).selectExpr("id AS k", "raise_error('lost') AS x").select("k", F.col("x").cast("string"))
    with pytest.raises(Exception, match="lost"):
        store.refresh(broken, spark.createDataFrame([(1,)], "k long"))
    assert store.version() == 1 and values(store.read()) == sorted((i, "old") for i in range(20))
    store._write(spark.createDataFrame([(7, "half")], "k long, x string"), 2)  # died before the switch
    assert values(store.read()) == sorted((i, "old") for i in range(20))
    assert store.refresh(spark.createDataFrame([(1, "new")], "k long, x string"), spark.createDataFrame([(1,)], "k long")) == 2
    assert values(store.read()) == sorted((i, "new" if i == 1 else "old") for i in range(20))


def test_two_refreshes_at_once(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/t", ("k",), buckets=4)
    store.create(spark.range(8).selectExpr("id AS k"))
    store._switch(store.generations(), 2)  # another one was quicker
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        store._switch(store.generations(), 2)


def test_null_keys_several_keys_and_nothing_to_do(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/t", ("a", "b"), buckets=4)
    schema = "a long, b string, x int"
    store.create(spark.createDataFrame([(1, None, 0), (None, None, 1), (1, "q", 2)], schema))
    none = spark.createDataFrame([], schema)
    assert store.refresh(none, none) == 1
    store.refresh(spark.createDataFrame([(1, None, 9)], schema), spark.createDataFrame([(1, None, 0), (None, None, 0)], schema))
    assert values(store.read()) == [(1, None, 9), (1, "q", 2)]
    store.refresh(none, store.read())
    assert store.read().collect() == []
    with pytest.raises(ValueError):
        Store(spark, f"{tmp_path}/none", ("a",)).read()
