"""Model training and validation on event features."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlytics.catalog import scans
from eventlytics.catalog import views as v
from eventlytics.catalog.registry import query
from eventlytics.functions import categories, dates
from eventlytics.operators import history, learning, rollup, scale
from eventlytics.sources import files

FEATURES = ("num_fights", "num_title_fights", "has_title", "day_of_week", "month", "is_saturday",
            "days_since_last", "is_vegas", "is_usa", "is_ppv")
# small settings: the queries show the flow, the defaults serve real training
SMALL = {"gbt": {"maxDepth": 3, "maxIter": 4}, "rf": {"maxDepth": 4, "numTrees": 6}}


def frame(spark, sf):
    """Event features with the mean order value of the day as label."""
    place, day = F.col("location"), F.col("event_date")
    label = v.table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("event_date")).agg(
        (F.avg("o_totalprice") / 500000).alias("sell_through")
    )
    events = rollup.attach(v.cards(spark, sf), [rollup.card_counts(v.bouts(spark, sf))])
    out = history.days_since_previous(events.join(label, "event_date"))
    return out.withColumns(
        {
            "year": F.year(day), "month": F.month(day), "day_of_week": dates.day_of_week(day),
            "is_saturday": dates.is_saturday(day), "is_vegas": categories.is_vegas(categories.city(place)),
            "is_usa": categories.is_usa(categories.country(place)), "is_ppv": categories.is_ppv(F.col("event_type")),
        }
    )


def prepared(spark, sf):
    df, features, _ = learning.prepare(frame(spark, sf), FEATURES, products=True)
    return df, features


@query(
    "m1_assembled_vector",
    """SELECT strftime(o_orderdate, '%Y-%m-%d') AS event_id, CAST(count(*) AS DOUBLE) AS first,
      CAST(month(o_orderdate) AS DOUBLE) AS second FROM orders GROUP BY o_orderdate""",
)
def assembled_vector(spark, sf):
    from pyspark.ml.functions import vector_to_array

    days = v.table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count("*").alias("n"), F.first(F.month("o_orderdate")).alias("month")
    )
    out = learning.assembler(["n", "month"]).transform(days)
    values = out.select(F.col("day").cast("string").alias("event_id"), vector_to_array("features").alias("f"))
    return values.select("event_id", F.get("f", 0).alias("first"), F.get("f", 1).alias("second"))


@query(
    "m2_temporal_split",
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) < 2000 THEN 'train' ELSE 'test' END AS part FROM orders""",
)
def temporal_split(spark, sf):
    df = v.table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    train, test = learning.split_by_year(df, 2000)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test"))).drop("year")


def _fitted(spark, sf, model):
    df, features = prepared(spark, sf)
    df = scale.shared_checkpoint(df)
    train, test = learning.split_by_year(df, 2000)
    return learning.train(train, features, model, validate=False, **SMALL[model]), test, features, df


# How trees grow is no matter of SQL; the queries show what must hold of any model.
TEST_ROWS = v.with_(v.BOUTS, v.CARDS, """labels AS (SELECT CAST(o_orderdate AS DATE) AS event_date,
  avg(o_totalprice) / 500000 AS sell_through FROM orders GROUP BY 1)""",
    "test AS (SELECT * FROM cards JOIN labels USING (event_date) WHERE year(event_date) >= 2000)")
METRICS_SQL = TEST_ROWS + "SELECT count(*) AS test_size, true AS consistent FROM test"
PREDICTIONS_SQL = TEST_ROWS + "SELECT event_name, round(sell_through, 6) AS sell_through, true AS usable FROM test"


def _metrics_hold(metrics):
    """Test size, and whether the errors fit each other."""
    fits = (
        (F.abs(F.col("mse") - F.col("rmse") ** 2) < 1e-9) & (F.col("mae") <= F.col("rmse") + 1e-12)
        & (F.col("mae") >= 0) & (F.col("r2") <= 1)
    )
    return metrics.select(F.col("test_size").cast("long").alias("test_size"), fits.alias("consistent"))


def _predictions_hold(rows, low=None, high=None, also=None):
    """Label, and whether the prediction is a number (and in the range of the labels learned)."""
    usable = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    if low is not None:
        usable &= F.col("prediction").between(low - 1e-9, high + 1e-9)
    if also is not None:
        usable &= also
    return rows.select("event_name", F.round("sell_through", 6).alias("sell_through"), usable.alias("usable"))


@query("m3_boosted_trees", METRICS_SQL)
def boosted_trees(spark, sf):
    model, test, _, _ = _fitted(spark, sf, "gbt")
    return _metrics_hold(learning.evaluate(model, test))


@query("m4_random_forest", METRICS_SQL)
def random_forest(spark, sf):
    model, test, _, _ = _fitted(spark, sf, "rf")
    return _metrics_hold(learning.evaluate(model, test))


@query("m5_cross_validation", METRICS_SQL)
def cross_validation(spark, sf):
    df, features = prepared(spark, sf)
    train, test = learning.split_by_year(df, 2000)
    small = {"maxDepth": [2, 3], "numTrees": [3, 5]}
    model = learning.train(train, features, "rf", validate=True, grid=small, **SMALL["rf"])
    return _metrics_hold(learning.evaluate(model, test))


@query(
    "m7_feature_importances",
    TEST_ROWS + "SELECT feature, true AS is_share, true AS sums_to_one FROM (VALUES "
    + ", ".join(f"('{f}')" for f in FEATURES) + """) AS f(feature) WHERE (SELECT count(*) FROM test) > 0""",
)
def feature_importances(spark, sf):
    df, _ = prepared(spark, sf)
    train, _ = learning.split_by_year(scale.shared_checkpoint(df), 2000)
    table = learning.importances(learning.train(train, FEATURES, "rf", validate=False, **SMALL["rf"]), FEATURES, train)
    total = table.agg(F.sum("importance").alias("total"))
    return table.join(F.broadcast(total)).select(  # one row
        "feature", F.col("importance").between(0, 1).alias("is_share"),
        (F.abs(F.col("total") - 1) < 1e-9).alias("sums_to_one"),
    )


@query("t4_top_importances", TEST_ROWS + """SELECT CAST(i AS INTEGER) AS place, true AS in_order FROM range(9) AS t(i)
  WHERE (SELECT count(*) FROM test) > 0""")
def top_importances(spark, sf):
    model, test, features, _ = _fitted(spark, sf, "rf")
    top = learning.importances(model, features, test).limit(9)
    # one partition, in the order the operator gave it
    listed = top.agg(F.collect_list(F.struct((-F.col("importance")).alias("i"), "feature")).alias("l"))
    places = listed.select(F.posexplode("l").alias("place", "x"), "l")
    return places.select("place", (F.greatest(F.get("l", F.col("place") - 1)["i"], F.lit(-1.0)) <= F.col("x.i")).alias("in_order"))


@query("m8_predictions", PREDICTIONS_SQL)
def predictions(spark, sf):
    model, test, _, _ = _fitted(spark, sf, "gbt")
    return _predictions_hold(learning.predictions(model, test, ["event_name", "sell_through"]))


@query("s8_saved_model", PREDICTIONS_SQL)
def saved_model(spark, sf):
    model, test, _, df = _fitted(spark, sf, "rf")
    path = scans.scratch(spark, "model")
    files.save_model(model, path)
    ends = df.filter("year < 2000").agg(F.min("sell_through").alias("a"), F.max("sell_through").alias("z")).first()
    both = _saved_and_loaded(model, path, test)
    held = _predictions_hold(both, ends["a"], ends["z"], F.col("prediction") == F.col("saved"))
    return held


def _saved_and_loaded(model, path, test):
    """Predictions of a model, as ``saved``, and of the one read back."""
    before = model.transform(test).withColumnRenamed("prediction", "saved").drop("features")
    return learning.predictions(files.load_model(path), before, ["event_name", "sell_through", "saved"])


@query(
    "m9_rolling_years",
    TEST_ROWS.replace(" WHERE year(event_date) >= 2000", "") + """SELECT CAST(y AS INTEGER) AS test_year,
      count(*) AS test_size, true AS consistent FROM test, (VALUES (1999), (2000), (2001)) AS t(y)
    WHERE year(event_date) >= y GROUP BY y""",
)
def rolling_years(spark, sf):
    df, features = prepared(spark, sf)
    folds = learning.rolling(scale.shared_checkpoint(df), features, (1999, 2000, 2001), "gbt", **SMALL["gbt"])
    kept = folds.select("test_year", "rmse", "mae", "mse", "r2", "test_size")
    held = kept.withColumn("consistent", (F.abs(F.col("mse") - F.col("rmse") ** 2) < 1e-9) & (F.col("r2") <= 1))
    return held.select("test_year", F.col("test_size").cast("long").alias("test_size"), "consistent")


@query("m10_model_comparison", TEST_ROWS + """SELECT run, true AS finite FROM (VALUES ('gbt'), ('rf')) AS t(run)
  WHERE (SELECT count(*) FROM test) > 0""")
def model_comparison(spark, sf):
    paths = {}
    for name in ("gbt", "rf"):
        model, test, features, _ = _fitted(spark, sf, name)
        paths[name] = scans.scratch(spark, name)
        files.write_metrics(learning.evaluate(model, test), paths[name], {"num_features": len(features)})
    finite = ~F.isnan("r2") & (F.col("rmse") > 0) & (F.col("mae") > 0)
    return learning.compare_runs(spark, paths).select("run", F.coalesce(finite, F.lit(False)).alias("finite"))


# -- the results themselves; SQL can't make them, tests compute them another way ------

MEASURES = ("test_size", "rmse", "mae", "mse", "r2")


@query("m3_metric_values")
def boosted_trees_metrics(spark, sf):
    model, test, _, _ = _fitted(spark, sf, "gbt")
    return learning.evaluate(model, test).select(*MEASURES)


@query("m4_metric_values")
def random_forest_metrics(spark, sf):
    model, test, _, _ = _fitted(spark, sf, "rf")
    return learning.evaluate(model, test).select(*MEASURES)


@query("m5_metric_values")
def cross_validation_metrics(spark, sf):
    df, features = prepared(spark, sf)
    train, test = learning.split_by_year(df, 2000)
    small = {"maxDepth": [2, 3], "numTrees": [3, 5]}
    model = learning.train(train, features, "rf", validate=True, grid=small, **SMALL["rf"])
    forest = model.stages[-1]
    return learning.evaluate(model, test).select(
        *MEASURES, F.lit(forest.getNumTrees).alias("num_trees"), F.lit(forest.getOrDefault("maxDepth")).alias("max_depth")
    )


@query("m7_importance_values")
def importance_values(spark, sf):
    model, test, features, _ = _fitted(spark, sf, "rf")
    return learning.importances(model, features, test)


@query("t4_importance_values")
def top_importance_values(spark, sf):
    return importance_values(spark, sf).limit(9)


@query("m8_prediction_values")
def prediction_values(spark, sf):
    model, test, features, _ = _fitted(spark, sf, "gbt")
    return learning.predictions(model, test, ["event_name", "sell_through", *features])


@query("s8_prediction_values")
def saved_model_values(spark, sf):
    model, test, _, _ = _fitted(spark, sf, "rf")
    path = scans.scratch(spark, "model")
    files.save_model(model, path)
    return _saved_and_loaded(model, path, test)


@query("m9_metric_values")
def rolling_years_metrics(spark, sf):
    df, features = prepared(spark, sf)
    return learning.rolling(df, features, (1999, 2000, 2001), "gbt", **SMALL["gbt"])


@query("m10_metric_values")
def model_comparison_values(spark, sf):
    paths = {}
    for name in ("gbt", "rf"):
        model, test, features, _ = _fitted(spark, sf, name)
        paths[name] = scans.scratch(spark, name)
        files.write_metrics(learning.evaluate(model, test), paths[name], {"num_features": len(features)})
    return learning.compare_runs(spark, paths)
