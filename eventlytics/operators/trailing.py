"""Trailing-window features of a daily series at given focal dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Windows in days, and what an entity without points gets.
WEEK, MONTH = 7, 30
DEFAULTS = {"avg_7d": 25.0, "avg_30d": 25.0, "peak_7d": 30.0, "direction": 0}
SMALLEST_TREND = 4


def daily_series(points: DataFrame, entity: str, date: str, value: str) -> DataFrame:
    """Points reduced to one row per (entity, day): sum, count and peak."""
    return points.filter(F.col(value).isNotNull()).groupBy(
        F.col(entity).alias("entity"), F.col(date).alias("day")
    ).agg(
        F.sum(F.col(value).cast("double")).alias("total_"),
        F.count("*").alias("points_"),
        F.max(F.col(value).cast("double")).alias("peak_"),
    )


def trend_direction(values: Column) -> Column:
    """1 if the later half of an ordered array averages higher, else -1.

    The first half has floor(n / 2) values; under four values the answer is 0.
    """
    n = F.size(values)
    half = F.floor(n / 2).cast("int")

    def mean(part: Column) -> Column:
        return F.aggregate(part, F.lit(0.0), lambda a, x: a + x) / F.size(part)

    first, second = F.slice(values, 1, half), F.slice(values, half + 1, n - half)
    return F.when(n < SMALLEST_TREND, 0).when(mean(second) > mean(first), 1).otherwise(-1)


def trailing_features(series: DataFrame, focal: DataFrame) -> DataFrame:
    """Features per distinct (entity, day) of ``focal`` over ``daily_series`` rows.

    Points and focal days are merged into one ordered table per entity and read
    through range frames, both ends inclusive. There is one row per entity and
    calendar day at most, and no row is repeated for a window it falls into.
    """
    wanted = focal.filter(F.col("day").isNotNull()).select("entity", "day").distinct()
    merged = series.withColumn("focal_", F.lit(0)).unionByName(
        wanted.withColumn("focal_", F.lit(1)), allowMissingColumns=True
    ).groupBy("entity", "day").agg(
        F.max("focal_").alias("focal_"),
        *[F.max(c).alias(c) for c in ("total_", "points_", "peak_")],
    ).withColumn("at_", F.unix_date("day"))
    ordered = Window.partitionBy("entity").orderBy("at_")
    week, month = ordered.rangeBetween(-WEEK, 0), ordered.rangeBetween(-MONTH, 0)
    mean = F.col("total_") / F.col("points_")
    out = merged.select(
        "entity", "day", "focal_",
        (F.sum("total_").over(week) / F.sum("points_").over(week)).alias("avg_7d"),
        (F.sum("total_").over(month) / F.sum("points_").over(month)).alias("avg_30d"),
        F.max("peak_").over(week).alias("peak_7d"),
        F.collect_list(mean).over(month).alias("days_"),
    ).filter("focal_ = 1")
    return out.withColumn("direction", trend_direction(F.col("days_"))).select(
        "entity", "day", *[F.coalesce(c, F.lit(v)).alias(c) for c, v in DEFAULTS.items()]
    )


def contest_buzz(fights: DataFrame, series: DataFrame) -> DataFrame:
    """Trailing features of both sides of each contest and their combinations."""
    sides = fights.select(
        F.explode(F.array("fighter1_name", "fighter2_name")).alias("entity"),
        F.col("event_date").alias("day"),
    )
    features = trailing_features(series, sides)
    out = fights
    names = {"avg_7d": "avg_search_7d", "avg_30d": "avg_search_30d",
             "peak_7d": "peak_search_7d", "direction": "trend_direction"}
    for i in (1, 2):
        side = features.select(
            F.col("entity").alias(f"fighter{i}_name"), F.col("day").alias("event_date"),
            *[F.col(a).alias(f"f{i}_{b}") for a, b in names.items()],
        )
        out = out.join(side, [f"fighter{i}_name", "event_date"], "left")
        out = out.withColumns(
            {f"f{i}_{b}": F.coalesce(f"f{i}_{b}", F.lit(DEFAULTS[a])) for a, b in names.items()}
        )
    return out.withColumns(
        {
            "combined_buzz_7d": F.col("f1_avg_search_7d") + F.col("f2_avg_search_7d"),
            "combined_buzz_30d": F.col("f1_avg_search_30d") + F.col("f2_avg_search_30d"),
            "max_peak_search": F.greatest("f1_peak_search_7d", "f2_peak_search_7d"),
            "buzz_differential": F.abs(F.col("f1_avg_search_7d") - F.col("f2_avg_search_7d")),
        }
    )
