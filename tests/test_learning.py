"""Results of models, computed another way: metrics from predictions, predictions from printed trees."""

import re

import numpy as np
import pytest

from eventlytics.catalog import QUERIES
from eventlytics.catalog.learning import FEATURES, MEASURES, SMALL, _fitted, prepared
from eventlytics.operators import learning, scale

SMALLEST = "/root/testdata/sf0.001"


def measured(rows):
    y, p = (np.array([float(r[c]) for r in rows]) for c in ("sell_through", "prediction"))
    mse = float(((y - p) ** 2).mean())
    return {"test_size": len(rows), "rmse": mse**0.5, "mae": float(abs(y - p).mean()), "mse": mse,
            "r2": 1 - mse / float(((y - y.mean()) ** 2).mean())}


def tree(text):
    """A printed tree as nested (feature, limit, low, high) or a number."""
    lines = [line.strip() for line in text.splitlines() if re.search("If|Else|Predict", line)]

    def read():
        line = lines.pop(0)
        if line.startswith("Predict"):
            return float(line.split(":")[1])
        feature, limit = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        low = read()
        assert lines.pop(0).startswith("Else")
        return int(feature), float(limit), low, read()

    return read()


def walk(node, row):
    while isinstance(node, tuple):
        node = node[2] if row[node[0]] <= node[1] else node[3]
    return node


@pytest.fixture(scope="module")
def predicted(spark):
    return QUERIES["m8_prediction_values"](spark, SMALLEST).collect()


def test_metrics_follow_from_predictions(spark, predicted):
    row = QUERIES["m3_metric_values"](spark, SMALLEST).first()
    want = measured(predicted)
    assert {k: pytest.approx(want[k]) for k in MEASURES} == row.asDict()


def test_predictions_follow_from_the_trees(spark):
    for name in ("gbt", "rf"):
        model, test, features, _ = _fitted(spark, SMALLEST, name)
        forest = model.stages[-1]
        trees = [tree(t.toDebugString) for t in forest.trees]
        weights = forest.treeWeights if name == "gbt" else [1 / len(trees)] * len(trees)
        rows = learning.predictions(model, test, features).collect()
        assert rows
        for r in rows:
            values = [float(r[f]) for f in features]
            assert r["prediction"] == pytest.approx(sum(w * walk(t, values) for w, t in zip(weights, trees)))


def test_importances_follow_from_the_forest(spark):
    model, test, features, _ = _fitted(spark, SMALLEST, "rf")
    got = [tuple(r) for r in learning.importances(model, features, test).collect()]
    single = np.mean([t.featureImportances.toArray() for t in model.stages[-1].trees], axis=0)
    want = dict(zip(features, single / single.sum()))
    assert {f for f, _ in got} == set(features) and sum(i for _, i in got) == pytest.approx(1)
    assert all(i == pytest.approx(want[f]) for f, i in got)
    assert [i for _, i in got] == sorted((i for _, i in got), reverse=True)
    used = {features[n] for t in model.stages[-1].trees for n in map(int, re.findall(r"feature (\d+)", t.toDebugString))}
    assert {f for f, i in got if i > 0} == used and set(FEATURES) <= set(features)
    top = [tuple(r) for r in QUERIES["t4_importance_values"](spark, SMALLEST).collect()]
    assert top == got[:9]


def test_years_at_once_equal_years_one_by_one(spark):
    df, features = prepared(spark, SMALLEST)
    df = scale.shared_checkpoint(df)
    years = (1999, 2000, 2001)
    got = {r["test_year"]: r for r in learning.rolling(df, features, years, "gbt", at_once=3, **SMALL["gbt"]).collect()}
    assert list(got) == list(years)
    for year in years:
        train, test = learning.split_by_year(df, year)
        model = learning.train(train, features, "gbt", validate=False, **SMALL["gbt"])
        want = measured(learning.predictions(model, test, ["sell_through"]).collect())
        assert {k: pytest.approx(want[k]) for k in MEASURES} == {k: got[year][k] for k in MEASURES}
    with pytest.raises(ValueError):
        learning.rolling(df, features, (1900,), "gbt", **SMALL["gbt"])


def test_saved_models_and_runs(spark):
    rows = QUERIES["s8_prediction_values"](spark, SMALLEST).collect()
    assert rows and all(r.saved == r.prediction for r in rows)
    runs = {r.run: r for r in QUERIES["m10_metric_values"](spark, SMALLEST).collect()}
    forest = QUERIES["m4_metric_values"](spark, SMALLEST).first()
    assert runs["rf"].r2 == pytest.approx(forest.r2) and runs["rf"].mae == pytest.approx(forest.mae)
    best = QUERIES["m5_metric_values"](spark, SMALLEST).first()
    assert best.num_trees in (3, 5) and best.max_depth in (2, 3) and best.mse == pytest.approx(best.rmse**2)
