"""Record linkage of labels to events: names, numbers and near dates.

Each strategy is an equi lookup. The label side is first reduced to the one
best label per lookup key (nearest day, then smallest name, then smallest
label), so no strategy ever forms all pairs of a key and every event gets at
most one label. A day tolerance is turned into an equi key by repeating each
label on the days it may match.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlytics.functions.categories import base_event_type
from eventlytics.functions.text import contest_number, non_empty, normalize_name
from eventlytics.operators.scale import keep_first, shared_checkpoint, splittable

# Series that may be linked by series and date alone.
SERIES = (
    "ufc fight night", "the ultimate fighter", "ufc on fox",
    "ufc on espn", "ufc on fuel tv", "ufc on fx",
)
STRATEGIES = ("name_date", "number", "date", "type_date")
DAYS = 1


def with_match_keys(df: DataFrame, name: str = "event_name") -> DataFrame:
    """Add the lookup keys made from a name."""
    c = F.col(name)
    # a map names the long expression once, where isin would repeat it
    known = F.create_map(*[F.lit(s) for s in SERIES for _ in range(2)])
    return df.withColumns(
        {
            "name_key": normalize_name(c),
            "number_key": non_empty(contest_number(c)),
            "series_key": F.try_element_at(known, base_event_type(c)),
        }
    )


def on_near_days(df: DataFrame, date: str = "event_date", days: int = DAYS) -> DataFrame:
    """Repeat each row on every day within the tolerance (``match_date``)."""
    reach = F.sequence(F.date_sub(date, days), F.date_add(date, days))
    return df.withColumn("match_date", F.explode(reach)).withColumn(
        "gap_", F.abs(F.datediff("match_date", F.col(date)))
    )


def _lookup(labels: DataFrame, keys: dict[str, str], near: bool, label: str, tag: str) -> DataFrame:
    """Best label per key; ``keys`` maps event columns to label columns."""
    rows = on_near_days(labels) if near else labels.withColumn("gap_", F.lit(0))
    order = (["gap_"] if near else ["event_date"]) + ["event_name", label]
    best = F.min(F.struct(*order))
    picked = rows.groupBy(*[F.col(v).alias(k) for k, v in keys.items()]).agg(best.alias("best_"))
    present = picked.filter(" AND ".join(f"{k} IS NOT NULL" for k in keys))
    return present.select(*keys, F.col("best_").getField(label).alias(f"{tag}_"))


LOOKUPS = {
    "name_date": ({"name_key": "name_key", "event_date": "match_date"}, True),
    "number": ({"number_key": "number_key"}, False),
    "date": ({"event_date": "match_date"}, True),
    "type_date": ({"series_key": "series_key", "event_date": "match_date"}, True),
}


def link_labels(
    events: DataFrame,
    labels: DataFrame,
    label: str = "sell_through",
    strategies: Sequence[str] = STRATEGIES,
) -> DataFrame:
    """Events that find a label, with the label and the strategy that found it.

    ``labels`` holds event_name, event_date and the label. A later strategy
    only serves events the earlier ones left without a label.
    """
    # every strategy reads the feed, so it is keyed once
    feed = shared_checkpoint(
        with_match_keys(labels.filter(F.col(label).isNotNull()).select("event_name", "event_date", label))
    )
    out = with_match_keys(events)
    # events without a number or series must not meet in one task; '?…' matches nothing
    apart = F.concat(F.lit("?"), F.col("event_id").cast("string"))
    out = out.withColumns({k: F.coalesce(k, apart) for k in ("number_key", "series_key")})
    for s in strategies:
        keys, near = LOOKUPS[s]
        out = out.join(_lookup(feed, keys, near, label, s), list(keys), "left")
    found = [F.when(F.col(f"{s}_").isNotNull(), F.lit(s)) for s in strategies]
    return (
        out.withColumn(label, F.coalesce(*[F.col(f"{s}_") for s in strategies]))
        .withColumn("strategy", F.coalesce(*found))
        .filter(F.col(label).isNotNull())
        .select(*events.columns, label, "strategy")
    )


def interval_matches(
    left: DataFrame, right: DataFrame, key: str, value: str, date: str = "event_date", days: int = DAYS
) -> DataFrame:
    """Left rows with what an interval join on key and near dates would find.

    Adds the number of right rows with an equal key and a date at most ``days``
    apart, and their lowest and highest value. The right side is summed up per
    (key, day) first, so no pairs are formed however often a key occurs.
    """
    near = on_near_days(right.withColumnRenamed(date, "other_date"), "other_date", days)
    found = near.groupBy(key, F.col("match_date").alias(date)).agg(
        F.count("*").alias("matches"), F.min(value).alias("lowest"), F.max(value).alias("highest")
    )
    return left.join(found, [key, date], "left").fillna(0, ["matches"])


def unmatched(events: DataFrame, matched: DataFrame, key: str = "event_id") -> DataFrame:
    return events.join(matched.select(key).distinct(), key, "left_anti")


def lookup_by_names(
    fights: DataFrame, source: DataFrame, columns: dict[str, str], order: Sequence[str]
) -> DataFrame:
    """Left join on both normalised side names, the source reduced to one row each.

    ``columns`` maps source columns to output names; ``order`` says which of
    several source rows of a pair counts.
    """
    keys = ["f1_name_norm", "f2_name_norm"]
    named = {
        k: normalize_name(F.col(n)) for k, n in zip(keys, ("fighter1_name", "fighter2_name"))
    }
    side = keep_first(source.withColumns(named), keys, order).select(
        *keys, *[F.col(a).alias(b) for a, b in columns.items()]
    )
    base = fights.drop(*columns.values()).withColumns(named)
    return base.join(splittable(side), keys, "left")


def lookup_by_name(
    df: DataFrame, source: DataFrame, name: str, columns: dict[str, str], order: Sequence[str]
) -> DataFrame:
    """Left join on one normalised name, the source reduced to one row per name."""
    key = f"{name}_norm"
    side = keep_first(source.withColumn(key, normalize_name(F.col(name))), [key], order).select(
        key, *[F.col(a).alias(b) for a, b in columns.items()]
    )
    return df.withColumn(key, normalize_name(F.col(name))).join(splittable(side), key, "left")
