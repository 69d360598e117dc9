"""Roll-ups of contests, pairings, sources and comments to their parents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlytics.functions.categories import sentiment_category
from eventlytics.functions.sentiment import hype_score

# Roll-up of external columns as (input, function, output).
EXTERNAL = (
    ("combined_pagerank", "avg", "avg_combined_pagerank"),
    ("combined_pagerank", "max", "max_combined_pagerank"),
    ("pagerank_differential", "avg", "avg_pagerank_diff"),
    ("combined_network_size", "avg", "avg_network_size"),
    ("same_community", "sum", "num_same_community_fights"),
    ("betting_spread", "avg", "avg_betting_spread"),
    ("betting_spread", "max", "max_betting_spread"),
    ("betting_spread", "min", "min_betting_spread"),
    ("is_competitive", "sum", "num_competitive_fights"),
    ("has_heavy_favorite", "sum", "num_heavy_favorites"),
    ("pre_event_buzz_7d", "avg", "avg_buzz_7d"),
    ("pre_event_buzz_7d", "max", "max_buzz_7d"),
    ("pre_event_buzz_7d", "sum", "total_buzz_7d"),
    ("buzz_differential", "avg", "avg_buzz_diff"),
)
FUNCTIONS = {"avg": F.avg, "max": F.max, "min": F.min, "sum": F.sum, "count": F.count, "std": F.stddev}


def adaptive_rollup(
    df: DataFrame, keys: Sequence[str], spec: Sequence[tuple[str, str, str]] = EXTERNAL
) -> DataFrame | None:
    """Aggregate the columns that exist; None if none of them does."""
    cols = [FUNCTIONS[fn](c).alias(out) for c, fn, out in spec if c in df.columns]
    return df.groupBy(*keys).agg(*cols) if cols else None


def _flag(name: str) -> Column:
    return F.col(name).cast("int")


def card_counts(fights: DataFrame) -> DataFrame:
    """Contests, title contests and the class of the first title contest."""
    titled = F.when(F.col("is_title_fight"), F.col("fight_id"))
    return fights.groupBy("event_id").agg(
        F.count("*").alias("num_fights"),
        F.sum(_flag("is_title_fight")).alias("num_title_fights"),
        F.max(_flag("is_title_fight")).alias("has_title"),
        F.min_by("weight_class", titled).alias("title_weight_class"),
    )


def matchup_rollup(matchups: DataFrame) -> DataFrame:
    """Rematch counts and mean differences, both from one pass."""
    return matchups.groupBy("event_id").agg(
        F.sum("is_rematch").alias("num_rematches"),
        F.max("is_rivalry").alias("has_rivalry"),
        F.avg("reach_diff").alias("avg_reach_diff"),
        F.avg("height_diff").alias("avg_height_diff"),
        F.avg("age_diff").alias("avg_age_diff"),
    )


def experience_rollup(fighter_feats: DataFrame, n: int = 5) -> DataFrame:
    return fighter_feats.groupBy("event_id").agg(
        F.avg("total_fights").alias("avg_exp"),
        F.avg(f"win_rate_last{n}").alias("avg_win_rate"),
        F.max("total_fights").alias("max_exp"),
    )


def attach(parent: DataFrame, rollups: Sequence[DataFrame | None], key: str = "event_id") -> DataFrame:
    """Left joins of roll-ups, each unique on the key, to their parent."""
    for r in rollups:
        if r is not None:
            parent = parent.join(r, key, "left")
    return parent


def entity_summary(series: DataFrame, entity: str, value: str) -> DataFrame:
    """Mean, maximum and sample deviation per entity."""
    return series.groupBy(entity).agg(
        F.avg(value).alias(f"avg_{value}"),
        F.max(value).alias(f"max_{value}"),
        F.stddev(value).alias("search_volatility"),
    )


def sentiment_rollup(comments: DataFrame, key: str = "event_name") -> DataFrame:
    """Comment scores per event, with range, hype and category."""
    out = comments.groupBy(key).agg(
        F.avg("polarity").alias("avg_sentiment"),
        F.stddev("polarity").alias("sentiment_std"),
        F.min("polarity").alias("min_sentiment"),
        F.max("polarity").alias("max_sentiment"),
        F.avg("subjectivity").alias("avg_subjectivity"),
        F.sum("score").alias("total_engagement"),
        F.avg("score").alias("avg_comment_score"),
        F.max("score").alias("top_comment_score"),
        F.count("comment_text").alias("comment_count"),
    )
    return derive_sentiment(out)


def derive_sentiment(df: DataFrame) -> DataFrame:
    """Columns that follow from the aggregates."""
    mean = F.col("avg_sentiment")
    return df.withColumns(
        {
            "sentiment_range": F.col("max_sentiment") - F.col("min_sentiment"),
            "hype_score": hype_score(mean, F.col("total_engagement")),
            "sentiment_category": sentiment_category(mean),
        }
    )
