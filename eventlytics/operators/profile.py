"""Summaries of a table: profile, histogram, box, correlation, residuals."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlytics.functions.categories import stability_class
from eventlytics.operators.scale import broadcast_checked, exact_quantiles, shared_checkpoint

BINS = 30
WHISKER = 1.5
QUARTILES = (0.25, 0.5, 0.75)


def head(df: DataFrame, order: Sequence[str], n: int = 100) -> DataFrame:
    """First rows in a stated order (a sample file)."""
    return df.orderBy(*order).limit(n)


def first_entities(df: DataFrame, key: str, n: int) -> DataFrame:
    """First distinct keys in order; caps a list of work items."""
    return df.select(key).distinct().orderBy(key).limit(n)


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, known values, minimum, maximum, mean and distinct count per column."""
    # numeric columns; all measures but the distinct counts come from one pass
    measures = {
        "rows": lambda c: F.count("*"),
        "known": F.count,
        "lowest": lambda c: F.min(F.col(c).cast("double")),
        "highest": lambda c: F.max(F.col(c).cast("double")),
        "mean": lambda c: F.avg(F.col(c).cast("double")),
    }
    wide = df.agg(
        *[f(c).alias(f"{m}_{i}") for i, c in enumerate(columns) for m, f in measures.items()]
    )
    as_rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), *[F.col(f"{m}_{i}").alias(m) for m in measures])
            for i, c in enumerate(columns)
        ]
    )
    base = wide.select(F.explode(as_rows).alias("r")).select("r.*")
    return base.join(distinct_counts(df, columns), "column", "left").fillna(0, ["distinct"])


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, distinct): values are de-duplicated before they are counted."""
    long = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in columns])
        ).alias("r")
    ).select("r.*").filter(F.col("v").isNotNull())
    return long.distinct().groupBy("column").agg(F.count("*").alias("distinct"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def histogram(df: DataFrame, value: str, bins: int = BINS) -> DataFrame:
    """(bin, low, high, n): equal bins over the range, the maximum in the last.

    Empty bins are kept. The range is a one-row aggregate read as a scalar.
    """
    known = df.filter(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    edge = known.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("e"))
    ranged = known.withColumn("e", edge.scalar())
    width = (F.col("e.hi") - F.col("e.lo")) / bins
    at = F.least(F.floor((F.col("v") - F.col("e.lo")) / width), F.lit(bins - 1))
    at = F.when(width > 0, at).otherwise(0).cast("int")
    counts = ranged.groupBy(at.alias("bin")).agg(F.count("*").alias("n"))
    grid = edge.select("e", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin",
        (F.col("e.lo") + width * F.col("bin")).alias("low"),
        (F.col("e.lo") + width * (F.col("bin") + 1)).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def mean_and_median(df: DataFrame, value: str) -> DataFrame:
    mean = df.agg(F.avg(value)).scalar()
    return exact_quantiles(df, [], value, [0.5]).select(mean.alias("mean"), F.col("q0").alias("median"))


def yearly_mean(df: DataFrame, date: str, value: str) -> DataFrame:
    known = df.filter(F.col(date).isNotNull() & F.col(value).isNotNull())
    return known.groupBy(F.year(date).alias("year")).agg(F.avg(value).alias("mean"))


def box(df: DataFrame, category: str, value: str) -> DataFrame:
    """Quartiles, whisker ends inside 1.5 · IQR, count and outliers per category."""
    known = df.filter(F.col(category).isNotNull() & F.col(value).isNotNull())
    # a row per category: counted and broadcast, or the rows of a category would meet
    quartiles = broadcast_checked(
        exact_quantiles(known, [category], value, QUARTILES).select(
            category, F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3")
        )
    )
    reach = (F.col("q3") - F.col("q1")) * WHISKER
    low, high = F.col("q1") - reach, F.col("q3") + reach
    inside = F.when(F.col(value).between(low, high), F.col(value))
    return (
        known.select(category, value).join(quartiles, category)
        .groupBy(category, "q1", "median", "q3")
        .agg(
            F.min(inside).alias("whisker_low"),
            F.max(inside).alias("whisker_high"),
            F.count("*").alias("n"),
            (F.count("*") - F.count(inside)).alias("outliers"),
        )
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, r) for every unordered pair; a constant column gives NULL.

    Each pair uses the rows that know both values. The sums behind all pairs are
    matrix products over Arrow batches, one small row per task; Spark adds them
    up. Values are taken relative to the column means to keep their precision.
    """
    names, width = list(columns), len(columns)
    data = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    means = [m or 0.0 for m in data.agg(*[F.avg(c) for c in data.columns]).first()]

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((4, width, width))
        for batch in batches:
            x = batch.to_numpy(dtype=float) - means
            known = ~np.isnan(x)
            x, known = np.where(known, x, 0.0), known.astype(float)
            # rows knowing both, sum of a, sum of a squared, sum of a times b
            total += (known.T @ known, x.T @ known, (x * x).T @ known, x.T @ x)
        yield pd.DataFrame({"s": [total.ravel()]})

    added = (
        data.mapInPandas(sums, "s array<double>")
        .select(F.posexplode("s").alias("at", "x"))
        .groupBy("at").agg(F.sum("x").alias("x"))
    )
    table = added.agg(F.map_from_entries(F.collect_list(F.struct("at", "x"))).alias("m"))

    def entry(part: int, i: int, j: int) -> Column:
        return F.try_element_at("m", F.lit((part * width + i) * width + j))

    pairs = [
        F.struct(
            F.lit(a).alias("a"), F.lit(b).alias("b"),
            *[entry(part, *at).alias(n) for n, part, at in (
                ("n", 0, (i, j)), ("sa", 1, (i, j)), ("sb", 1, (j, i)),
                ("qa", 2, (i, j)), ("qb", 2, (j, i)), ("p", 3, (i, j)),
            )],
        )
        for i, a in enumerate(names) for j, b in enumerate(names) if i <= j
    ]
    rows = table.select(F.explode(F.array(*pairs)).alias("x")).select("x.*")
    spread_a = F.col("qa") - F.try_divide(F.col("sa") * F.col("sa"), F.col("n"))
    spread_b = F.col("qb") - F.try_divide(F.col("sb") * F.col("sb"), F.col("n"))
    shared = F.col("p") - F.try_divide(F.col("sa") * F.col("sb"), F.col("n"))
    # a spread within rounding of zero means a constant column
    varies = (spread_a > F.col("qa") * 1e-13) & (spread_b > F.col("qb") * 1e-13)
    r = F.when(varies, shared / F.sqrt(spread_a) / F.sqrt(spread_b))
    return rows.select("a", "b", r.alias("r"))


def top_correlations(df: DataFrame, label: str, columns: Sequence[str], n: int = 15) -> DataFrame:
    """Matrix of the label and the ``n`` columns closest to it, in long form."""
    # read three times below, and no longer than the square of the column count
    matrix = shared_checkpoint(correlations(df, [label, *[c for c in columns if c != label]]))
    # the label is first in the list, so it is always on the left of its pairs
    near = (
        matrix.filter((F.col("a") == label) & (F.col("b") != label) & F.col("r").isNotNull())
        .orderBy(F.desc(F.abs("r")), "b").limit(n).select(F.col("b").alias("name"))
    )
    names = near.unionByName(near.sparkSession.range(1).select(F.lit(label).alias("name")))
    return matrix.join(names.withColumnRenamed("name", "a"), "a", "left_semi").join(
        names.withColumnRenamed("name", "b"), "b", "left_semi"
    ).select("a", "b", "r")


def residuals(df: DataFrame, actual: str = "sell_through", predicted: str = "prediction") -> DataFrame:
    return df.withColumn("residual", F.col(actual) - F.col(predicted))


def stability(folds: DataFrame, metric: str) -> DataFrame:
    """Mean, population deviation and stability class of a metric over folds."""
    out = folds.agg(F.avg(metric).alias("mean"), F.stddev_pop(metric).alias("std"))
    return out.withColumn("stability", stability_class(F.col("std")))


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """rmse, mae, mse, r2 and row count from one pass; zeros for no rows."""
    error = F.col(actual) - F.col(predicted)
    sums = df.agg(
        F.count("*").alias("test_size"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(actual).alias("spread"),
    )
    r2 = F.when(F.col("spread") > 0, 1 - F.col("mse") / F.col("spread"))
    return sums.select(
        F.coalesce(F.sqrt("mse"), F.lit(0.0)).alias("rmse"),
        F.coalesce("mae", F.lit(0.0)).alias("mae"),
        F.coalesce("mse", F.lit(0.0)).alias("mse"),
        F.coalesce(r2, F.lit(0.0)).alias("r2"),
        "test_size",
    )
