"""Train, validate and summarise models on the event features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlytics.operators import learning, linkage, profile
from eventlytics.operators.scale import shared_checkpoint
from eventlytics.plans.etl import typed_attendance
from eventlytics.sources import files

LABEL_FILES = ("attendance", "attendance_full", "ufc_attendance_sample")
# Linkage strategies of the two model variants.
BASE_LINKS = ("name_date", "date", "type_date")
IMPROVED_LINKS = ("name_date", "number", "date")


def labelled_events(
    spark: SparkSession, data: str, strategies: Sequence[str] = BASE_LINKS
) -> DataFrame:
    """Event features with the label the cascade finds for them."""
    feats = files.read_parquet(spark, f"{data}/features/event_features")
    raw = files.first_available(
        files.read_csv, spark, [f"{data}/external/{f}.csv" for f in LABEL_FILES]
    )
    if raw is None:
        raise FileNotFoundError(f"no label file under {data}/external")
    return linkage.link_labels(feats, typed_attendance(raw), strategies=strategies)


def run(
    spark: SparkSession,
    data: str,
    out: str,
    test_year: int = 2024,
    validate: bool = True,
    model: str = "gbt",
    improved: bool = False,
    **overrides,
) -> DataFrame:
    """Fit, evaluate and save one model; returns its metrics row.

    The base variant uses interaction products, the improved one the longer
    feature list and deeper trees.
    """
    links = IMPROVED_LINKS if improved else BASE_LINKS
    wanted = learning.BASE_FEATURES + learning.EXTERNAL_FEATURES
    wanted += learning.MORE_FEATURES if improved else ()
    df, features, _ = learning.prepare(labelled_events(spark, data, links), wanted, products=not improved)
    df = df.persist()
    train_df, test_df = learning.split_by_year(df, test_year)
    name = "gbt_improved" if improved and model == "gbt" else model
    fitted = learning.train(train_df, features, name, validate, **overrides)
    metrics = learning.evaluate(fitted, test_df)
    folder = f"{out}/models/{name}"
    files.save_model(fitted, f"{folder}/model")
    files.write_metrics(metrics, f"{folder}/metrics", {"num_features": len(features)})
    files.write_lines(spark, features, f"{folder}/features_used")
    files.write_csv(
        learning.predictions(fitted, test_df, ["event_name", learning.LABEL]), f"{folder}/predictions"
    )
    files.write_csv(learning.importances(fitted, features, df), f"{folder}/importances")
    df.unpersist()
    return files.read_json(
        spark, f"{folder}/metrics",
        "rmse double, mae double, mse double, r2 double, test_size bigint, num_features int",
    )


def rolling(
    spark: SparkSession,
    data: str,
    years: Sequence[int] = (2020, 2021, 2022, 2023, 2024),
    exact: bool = False,
    **overrides,
) -> tuple[DataFrame, DataFrame]:
    """(metrics per test year, mean, deviation and stability of r2)."""
    wanted = learning.BASE_FEATURES + learning.EXTERNAL_FEATURES + learning.MORE_FEATURES
    df, features, _ = learning.prepare(
        labelled_events(spark, data, IMPROVED_LINKS), wanted, products=False
    )
    folds = learning.rolling(shared_checkpoint(df), features, years, exact=exact, **overrides)
    return folds, profile.stability(folds, "r2")


def summaries(spark: SparkSession, data: str, out: str) -> None:
    """The tables behind the usual charts, written as CSV."""
    df = labelled_events(spark, data).persist()
    label = learning.LABEL
    numeric = [f for f in learning.BASE_FEATURES + learning.EXTERNAL_FEATURES if f in df.columns]
    tables = {
        "histogram": profile.histogram(df, label),
        "center": profile.mean_and_median(df, label),
        "by_year": profile.yearly_mean(df, "event_date", label),
        "by_type": profile.box(df, "event_type", label),
        "by_place": profile.box(
            df.withColumn("place", F.when(F.col("is_vegas") == 1, "Las Vegas").otherwise("Other Locations")),
            "place", label,
        ),
        "by_title": profile.box(
            df.withColumn("title", F.when(F.col("has_title") == 1, "Has Title Fight").otherwise("No Title Fight")),
            "title", label,
        ),
        "correlation": profile.top_correlations(df, label, numeric),
    }
    for name, table in tables.items():
        files.write_csv(table, f"{out}/summaries/{name}")
    df.unpersist()
