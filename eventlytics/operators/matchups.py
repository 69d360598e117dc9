"""Features of a pairing: earlier meetings and physical differences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventlytics.functions.text import pair_high, pair_low
from eventlytics.operators.scale import keep_first, splittable


def pair_history(
    fights: DataFrame, one: str = "fighter1_name", two: str = "fighter2_name", date: str = "event_date"
) -> DataFrame:
    """Meetings of the same two entities on strictly earlier dates.

    Counts per (pair, date) are combined before the shuffle; the running sum
    then has at most one row per calendar day and pair, whatever the volume.
    """
    pairs = fights.withColumns(
        {
            "pair1": pair_low(F.col(one), F.col(two)),
            "pair2": pair_high(F.col(one), F.col(two)),
        }
    )
    keys = ["pair1", "pair2", date]
    daily = pairs.filter(F.col(date).isNotNull()).groupBy(*keys).agg(F.count("*").alias("n_"))
    earlier = (
        Window.partitionBy("pair1", "pair2").orderBy(date).rowsBetween(Window.unboundedPreceding, -1)
    )
    prior = daily.select(*keys, F.sum("n_").over(earlier).alias("times_fought"))
    met = F.coalesce("times_fought", F.lit(0))
    return pairs.join(prior, keys, "left").withColumns(
        {
            "times_fought": met,
            "is_rematch": (met > 0).cast("int"),
            "is_rivalry": (met >= 2).cast("int"),
        }
    )


def role_join(
    df: DataFrame, dimension: DataFrame, key: str, roles: dict[str, str], columns: list[str]
) -> DataFrame:
    """Join one dimension once per role, its columns suffixed by the role.

    ``roles`` maps a fact column to a suffix. The dimension must hold each key
    once, so the row count of ``df`` never changes. Spark broadcasts it where
    its measured size allows and splits skewed join keys otherwise.
    """
    for fact_key, suffix in roles.items():
        renamed = splittable(dimension).select(
            F.col(key).alias(fact_key), *[F.col(c).alias(f"{c}{suffix}") for c in columns]
        )
        df = df.join(renamed, fact_key, "left")
    return df


def unique_entities(fighters: DataFrame, key: str = "fighter_name") -> DataFrame:
    """One row per name: the first by id (namesakes must not multiply rows)."""
    order = [F.col("fighter_id")] if "fighter_id" in fighters.columns else [F.col(key)]
    return keep_first(fighters, [key], order)


def matchup_features(fights: DataFrame, fighters: DataFrame) -> DataFrame:
    """Rematch and rivalry flags plus reach, height and age differences."""
    body = unique_entities(fighters)
    df = role_join(
        pair_history(fights), body, "fighter_name",
        {"fighter1_name": "_1", "fighter2_name": "_2"},
        ["height_inches", "reach_inches", "dob"],
    )
    age_days = F.datediff("event_date", "dob_1") - F.datediff("event_date", "dob_2")
    return df.select(
        "fight_id", "event_id", "fighter1_name", "fighter2_name",
        "is_rematch", "is_rivalry", "is_title_fight",
        F.abs(F.col("reach_inches_1") - F.col("reach_inches_2")).alias("reach_diff"),
        F.abs(F.col("height_inches_1") - F.col("height_inches_2")).alias("height_diff"),
        (F.abs(age_days) / F.lit(365.25)).alias("age_diff"),
    )


def natural_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on all common columns, NULL equal to NULL."""
    common = [c for c in left.columns if c in right.columns]
    on = F.lit(True)
    for c in common:
        on = on & F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`"))
    extra = [f"r.`{c}`" for c in right.columns if c not in common]
    return left.alias("l").join(right.alias("r"), on).select("l.*", *extra)
