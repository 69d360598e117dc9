"""Keeping a stored table up to date with a feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlytics.operators.scale import keep_first


def key_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of the left table that the right table does not have."""
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), list(keys), "left_anti")


def keys_to_load(
    feed: DataFrame, parents: DataFrame, children: DataFrame, key: str
) -> DataFrame:
    """New keys (in the feed only) and incomplete ones (parent without child)."""
    new = key_difference(feed, parents, [key]).withColumn("reason", F.lit("new"))
    incomplete = key_difference(parents, children, [key]).withColumn("reason", F.lit("incomplete"))
    return new.unionByName(incomplete)


def refresh(store: DataFrame, fresh: DataFrame, stale_keys: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of stale keys dropped from the store, the fresh rows added; null keys are equal."""
    keys = [key] if isinstance(key, str) else list(key)
    stale = stale_keys.select(*[F.col(k).alias(f"stale_{k}_") for k in keys]).distinct()
    on = [store[k].eqNullSafe(stale[f"stale_{k}_"]) for k in keys]
    kept = store.join(stale, on, "left_anti")
    return fresh.unionByName(kept.select(*fresh.columns))


def merge_sources(
    sources: Sequence[DataFrame], keys: Sequence[str] = ("event_name", "event_date"),
    order: Sequence[str] = (),
) -> DataFrame:
    """Sources with differing columns as one table, earlier sources preferred.

    Of several rows with one key the first source wins, inside a source the
    first by ``order``.
    """
    merged = None
    for rank, s in enumerate(sources):
        s = s.withColumn("source_rank_", F.lit(rank))
        merged = s if merged is None else merged.unionByName(s, allowMissingColumns=True)
    return keep_first(merged, keys, ["source_rank_", *order]).drop("source_rank_")


def newest_first(df: DataFrame, date: str = "event_date", ties: Sequence[str] = ()) -> DataFrame:
    """Full sort by date descending, unknown dates last."""
    return df.orderBy(F.col(date).desc_nulls_last(), *ties)


def first_seen(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """Distinct keys with the position they were first seen at."""
    return df.groupBy(*keys).agg(F.min(position).alias(position))
