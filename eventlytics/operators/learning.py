"""Regression on event features: split, train, validate, explain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlytics.functions.frames import interactions, pick_features
from eventlytics.operators.profile import regression_metrics
from eventlytics.operators.scale import shared_checkpoint
from eventlytics.sources import files

# Feature lists, products, model settings and grids.
BASE_FEATURES = (
    "num_fights", "num_title_fights", "has_title", "num_rematches", "has_rivalry",
    "avg_exp", "avg_win_rate", "max_exp", "day_of_week", "month", "is_saturday",
    "days_since_last", "is_vegas", "is_usa", "is_ppv",
)
EXTERNAL_FEATURES = (
    "avg_combined_pagerank", "max_combined_pagerank", "avg_pagerank_diff",
    "avg_network_size", "num_same_community_fights", "avg_betting_spread",
    "max_betting_spread", "num_competitive_fights", "num_heavy_favorites",
    "avg_buzz_7d", "max_buzz_7d", "avg_buzz_diff", "reddit_sentiment",
    "reddit_hype", "reddit_engagement", "reddit_comments",
)
MORE_FEATURES = (
    "avg_reach_diff", "avg_height_diff", "avg_age_diff", "min_betting_spread", "total_buzz_7d",
)
PRODUCTS = {
    "title_vegas_interaction": ("has_title", "is_vegas"),
    "ppv_pagerank_interaction": ("is_ppv", "avg_combined_pagerank"),
    "competitive_buzz_interaction": ("num_competitive_fights", "avg_buzz_7d"),
    "title_hype_interaction": ("has_title", "reddit_hype"),
    "rematch_usa_interaction": ("num_rematches", "is_usa"),
}
FOLDS, SEED = 3, 42
LABEL, PREDICTION = "sell_through", "prediction"
METRICS = "test_year int, test_size long, rmse double, mae double, mse double, r2 double"


@dataclass(frozen=True)
class Spec:
    """A model family with its settings and its search grid."""

    estimator: type
    settings: dict
    grid: dict = field(default_factory=dict)


SPECS = {
    "gbt": Spec(
        GBTRegressor,
        {"maxDepth": 6, "maxIter": 100, "stepSize": 0.05},
        {"maxDepth": [5, 7], "maxIter": [50, 100]},
    ),
    "gbt_improved": Spec(
        GBTRegressor,
        {"maxDepth": 7, "maxIter": 100, "stepSize": 0.1},
        {"maxDepth": [7, 10, 12], "maxIter": [100, 150], "stepSize": [0.05, 0.1]},
    ),
    "rf": Spec(
        RandomForestRegressor,
        {"numTrees": 100, "maxDepth": 10},
        {"numTrees": [100, 150], "maxDepth": [10, 12]},
    ),
}


def prepare(
    df: DataFrame, wanted: Sequence[str] = BASE_FEATURES + EXTERNAL_FEATURES, products: bool = True
) -> tuple[DataFrame, list[str], list[str]]:
    """(frame, features, missing): present features with NULL as 0, plus products."""
    present, missing = pick_features(df, wanted)
    df = df.fillna(0, present)
    made: list[str] = []
    if products:
        df, made = interactions(df, PRODUCTS)
    rest = [c for c in (LABEL, "year", "event_date", "event_name", "event_id") if c in df.columns]
    return df.select(*present, *made, *rest), present + made, missing


def split_by_year(
    df: DataFrame, year: int, column: str = "year", exact: bool = False, when_empty: str = "error"
) -> tuple[DataFrame, DataFrame]:
    """Train before ``year``, test from it on (``exact``: that year only).

    ``when_empty`` says what an empty part leads to: an "error", a "random" 80/20
    split, or the "same" rows in both parts. One small aggregate decides.
    """
    if when_empty not in ("error", "random", "same"):
        raise ValueError(f"unknown choice: {when_empty}")
    train = df.filter(F.col(column) < year)
    test = df.filter(F.col(column) == year if exact else F.col(column) >= year)
    n = df.agg(
        F.count_if(F.col(column) < year).alias("train"),
        F.count_if(F.col(column) == year if exact else F.col(column) >= year).alias("test"),
    ).first()
    if n["train"] and n["test"]:
        return train, test
    if when_empty == "error":
        raise ValueError(f"no rows before {year} or none to test on")
    return (df, df) if when_empty == "same" else tuple(df.randomSplit([0.8, 0.2], seed=SEED))


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features")


def regressor(model: str, label: str = LABEL, **overrides):
    """The estimator of a model family, with its settings."""
    spec = SPECS[model]
    return spec.estimator(
        featuresCol="features", labelCol=label, predictionCol=PREDICTION, seed=SEED,
        **{**spec.settings, **overrides},
    )


def train(
    df: DataFrame,
    features: Sequence[str],
    model: str = "gbt",
    validate: bool = True,
    label: str = LABEL,
    parallelism: int = 4,
    grid: dict | None = None,
    **overrides,
) -> PipelineModel:
    """Fit a pipeline, by 3-fold grid search where ``validate`` is set."""
    spec, estimator = SPECS[model], regressor(model, label, **overrides)
    flow = Pipeline(stages=[assembler(features), estimator])
    data = df.select(*features, label).persist()
    try:
        if validate:
            choices = ParamGridBuilder()
            for name, values in (grid or spec.grid).items():
                choices = choices.addGrid(getattr(estimator, name), values)
            search = CrossValidator(
                estimator=flow,
                estimatorParamMaps=choices.build(),
                evaluator=RegressionEvaluator(labelCol=label, predictionCol=PREDICTION, metricName="rmse"),
                numFolds=FOLDS,
                seed=SEED,
                parallelism=parallelism,
            )
            return search.fit(data).bestModel
        return flow.fit(data)
    finally:
        data.unpersist()


def predictions(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    return model.transform(df).select(*keep, PREDICTION)


def evaluate(model: PipelineModel, test: DataFrame, label: str = LABEL) -> DataFrame:
    """One row of rmse, mae, mse, r2 and test size from one pass."""
    return regression_metrics(model.transform(test), label, PREDICTION)


def importances(model: PipelineModel, features: Sequence[str], df: DataFrame) -> DataFrame:
    """(feature, importance), largest first."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(features, values)]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def rolling(
    df: DataFrame,
    features: Sequence[str],
    years: Sequence[int] = (2020, 2021, 2022, 2023, 2024),
    model: str = "gbt_improved",
    exact: bool = False,
    at_once: int = 4,
    **overrides,
) -> DataFrame:
    """Metrics per test year, ``at_once`` years at a time in one session.

    The input is assembled and written once; every year fits and is measured from a thread of
    its own that takes over the caller's job group and other properties. The metrics
    of a year, one row, are all that reaches the driver.
    """
    data = assembler(features).transform(df.select(*features, LABEL, "year").dropna(subset=[LABEL]))
    data = shared_checkpoint(data.select("year", "features", LABEL))

    def fold(year: int) -> dict:
        train_df, test_df = split_by_year(data, year, exact=exact)
        train_df = train_df.persist()
        try:
            fitted = regressor(model, **overrides).fit(train_df)
            metrics = regression_metrics(fitted.transform(test_df), LABEL, PREDICTION).first()
        finally:
            train_df.unpersist()
        return metrics.asDict() | {"test_year": year}

    target = inheritable_thread_target(df.sparkSession)(fold)
    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        rows = [done.result() for done in [pool.submit(target, year) for year in years]]
    return df.sparkSession.createDataFrame(rows, METRICS)


def compare_runs(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(run, r2, rmse, mae) of saved metrics."""
    out = None
    for run, path in paths.items():
        row = files.read_json(spark, path, "r2 double, rmse double, mae double").withColumn("run", F.lit(run))
        out = row if out is None else out.unionByName(row)
    return out.select("run", "r2", "rmse", "mae")
