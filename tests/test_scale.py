"""Exact quantiles, dense ids, kept rows and small loads."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventlytics.operators import incremental, profile, scale
from tests.conftest import values


@pytest.mark.parametrize("accuracy", [50, 20_000])
def test_quantiles_are_exact(spark, accuracy):
    rng = random.Random(7)
    data = {"a": [rng.lognormvariate(0, 2) for _ in range(3000)], "b": [float(rng.randrange(5)) for _ in range(2000)],
            "c": [1.0], "d": [3.0, 1.0]}
    rows = [(g, x) for g, xs in data.items() for x in xs] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    out = {r.g: list(r)[1:] for r in scale.exact_quantiles(df, ["g"], "x", probs, accuracy).collect()}
    for g, xs in data.items():
        assert out[g] == pytest.approx(list(np.quantile(xs, probs)), rel=1e-12)
    everything = [x for xs in data.values() for x in xs]
    total = scale.exact_quantiles(df, [], "x", [0.5], accuracy).first()[0]
    assert total == pytest.approx(float(np.quantile(everything, 0.5)), rel=1e-12)


def test_brackets_are_narrowed(spark, monkeypatch):
    """A coarse sketch over many distinct values, and few rows allowed in order."""
    df = spark.range(200_000, numPartitions=4).select(
        (F.col("id") % 2).cast("string").alias("g"), F.pmod(F.xxhash64("id"), F.lit(10**9)).cast("double").alias("x")
    )
    sizes, narrow = [], scale._too_wide

    def watched(near, groups, limit, accuracy):
        inside = near.filter("v_ BETWEEN lo AND hi").groupBy(*groups, "q").count()
        sizes.append(max(r["count"] for r in inside.collect()))
        return narrow(near, groups, limit, accuracy)

    monkeypatch.setattr(scale, "_too_wide", watched)
    for groups in (["g"], []):
        sizes.clear()
        out = scale.exact_quantiles(df, groups, "x", [0.1, 0.5, 0.99], accuracy=50, ordered_rows=500).collect()
        assert sizes[0] > 10_000 and sizes[-1] <= 500 and len(sizes) > 2
        frame = df.toPandas()
        for r in out:
            own = frame[frame.g == r.g] if groups else frame
            assert list(r)[len(groups):] == pytest.approx(list(np.quantile(own.x, [0.1, 0.5, 0.99])), rel=1e-12)


def test_dense_ids_follow_key_order(spark):
    names = [f"n{i:03d}" for i in range(100)]
    df = spark.createDataFrame([(n,) for n in random.Random(1).sample(names, 100)], "name string")
    out = scale.dense_ids(df, "name", chunk_rows=7).orderBy("name").collect()
    assert [r.id for r in out] == list(range(100))


def test_keep_first_is_cut_before_the_shuffle(spark, capsys):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id")
    kept = scale.keep_first(df, ["k"], ["id"])
    assert values(kept) == [(0, 0), (1, 1), (2, 2)]
    scale.keep_first(df, ["k"], ["id"]).explain()
    plan = capsys.readouterr().out
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_merge_prefers_the_earlier_source(spark):
    a = spark.createDataFrame([("x", dt.date(2024, 1, 1), "old")], "event_name string, event_date date, source string")
    b = spark.createDataFrame([("x", dt.date(2024, 1, 1), "new", 5), ("y", None, "new", 6)],
                              "event_name string, event_date date, source string, n int")
    out = incremental.newest_first(incremental.merge_sources([a, b], order=["source"])).collect()
    assert [(r.event_name, r.source, r.n) for r in out] == [("x", "old", None), ("y", "new", 6)]


def test_refresh_replaces_incomplete_keys(spark):
    feed = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    parents = spark.createDataFrame([("a",), ("b",)], "k string")
    children = spark.createDataFrame([("a", 1)], "k string, v int")
    stale = incremental.keys_to_load(feed, parents, children, "k")
    assert values(stale) == [("b", "incomplete"), ("c", "new")]
    store = spark.createDataFrame([("a", 1), ("b", 9)], "k string, v int")
    fresh = spark.createDataFrame([("b", 2), ("c", 3)], "k string, v int")
    assert values(incremental.refresh(store, fresh, stale, "k")) == [("a", 1), ("b", 2), ("c", 3)]


def test_box_and_histogram(spark):
    df = spark.createDataFrame([("a", float(x)) for x in [1, 2, 3, 4, 100]] + [("b", 5.0), ("b", None)], "g string, x double")
    out = {r.g: r for r in profile.box(df, "g", "x").collect()}
    assert (out["a"].q1, out["a"].median, out["a"].q3) == (2.0, 3.0, 4.0)
    assert (out["a"].whisker_low, out["a"].whisker_high, out["a"].outliers) == (1.0, 4.0, 1)
    bins = profile.histogram(df, "x", 3).orderBy("bin").collect()
    assert [r.n for r in bins] == [5, 0, 1]
    same = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert sum(r.n for r in profile.histogram(same, "x", 4).collect()) == 2


def test_metrics_and_stability(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "y double, p double")
    row = profile.regression_metrics(df, "y", "p").first()
    assert row.mse == pytest.approx(1.25 / 3) and row.mae == pytest.approx(0.5) and row.test_size == 3
    assert row.r2 == pytest.approx(1 - 1.25 / (14 / 3))
    empty = profile.regression_metrics(df.filter("y > 9"), "y", "p").first()
    assert tuple(empty) == (0.0, 0.0, 0.0, 0.0, 0)
    folds = spark.createDataFrame([(0.4,), (0.5,)], "r2 double")
    assert profile.stability(folds, "r2").first().stability == "stable"


def test_correlations_use_rows_that_know_both(spark):
    rng = np.random.default_rng(4)
    table = pd.DataFrame(rng.normal(1e6, 1.0, (400, 3)), columns=list("abc"))
    table["b"] += table["a"]
    table.loc[::3, "c"] = np.nan
    table.loc[::7, "a"] = np.nan
    table["flat"], table["empty"] = 2.0, np.nan
    rows = [tuple(None if np.isnan(x) else float(x) for x in r) for r in table.itertuples(index=False)]
    df = spark.createDataFrame(rows, "a double, b double, c double, flat double, empty double").repartition(3)
    out = {(r.a, r.b): r.r for r in profile.correlations(df, list(table.columns)).collect()}
    want = table.corr()
    for (a, b), r in out.items():
        expected = want.loc[a, b]
        assert (r is None) == bool(np.isnan(expected)), (a, b)
        assert r is None or r == pytest.approx(expected, abs=1e-9)
    top = profile.top_correlations(df, "a", ["b", "c", "flat"], 1).collect()
    assert {(r.a, r.b) for r in top} == {("a", "a"), ("a", "b"), ("b", "b")}


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


def _plan_after(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_are_split_against_reduced_sides(spark):
    from eventlytics.operators import linkage, matchups

    old = {k: spark.conf.get(k, None) for k in SKEW}
    for k, x in SKEW.items():
        spark.conf.set(k, x)
    try:
        fights = spark.range(40_000, numPartitions=8).select(
            F.col("id").alias("fight_id"), F.when(F.col("id") % 100 > 0, "hot").otherwise("n5").alias("fighter1_name"),
            F.concat(F.lit("n"), F.col("id").cast("string")).alias("fighter2_name"),
        )
        fighters = spark.range(2_000).select(
            F.col("id").alias("fighter_id"),
            F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("n"), F.col("id").cast("string"))).alias("fighter_name"),
        )
        joined = matchups.role_join(
            fights, matchups.unique_entities(fighters), "fighter_name", {"fighter1_name": "_1"}, ["fighter_id"]
        )
        assert "skew=true" in _plan_after(joined)
        assert joined.filter("fighter_id_1 = 0").count() == 39_600
        source = fighters.withColumnRenamed("fighter_name", "fighter1_name")
        named = linkage.lookup_by_name(fights, source, "fighter1_name", {"fighter_id": "found"}, ["fighter_id"])
        assert "skew=true" in _plan_after(named)
    finally:
        for k, x in old.items():
            spark.conf.unset(k) if x is None else spark.conf.set(k, x)


def test_shared_table_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, "x", [1.5]), (1, "x", [1.5]), (None, None, None)], "a int, `b c` string, d array<double>")
    out = scale.shared_table(df)
    assert out.dtypes == df.dtypes and values(out) == values(df)
    none = scale.shared_table(df.filter("a = 2"))
    assert none.dtypes == df.dtypes and none.isEmpty()
