"""Group roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlytics.catalog import histories as h
from eventlytics.catalog import views as v
from eventlytics.catalog.registry import query
from eventlytics.operators import graph, history, matchups, profile, rollup
from eventlytics.operators.scale import shared_checkpoint


@query(
    "a1_card_rollup",
    v.with_(v.BOUTS) + """SELECT event_id, count(*) AS num_fights, CAST(sum(CAST(is_title_fight AS INTEGER)) AS BIGINT)
      AS num_title_fights, arg_min(weight_class, fight_id) FILTER (WHERE is_title_fight) AS title_weight_class
    FROM bouts GROUP BY event_id""",
)
def card_rollup(spark, sf):
    return rollup.card_counts(v.bouts(spark, sf)).drop("has_title")


@query(
    "a2_flags_per_event",
    v.with_(v.BOUTS, h.PAIRS, v.FIGHTERS, h.MATCHUPS) + """SELECT event_id,
      CAST(sum(is_rematch) AS BIGINT) AS num_rematches, max(is_rivalry) AS has_rivalry,
      CAST(sum(CAST(is_title_fight AS INTEGER)) AS BIGINT) AS num_title_fights,
      max(CAST(is_title_fight AS INTEGER)) AS has_title FROM matchups GROUP BY event_id""",
)
def flags_per_event(spark, sf):
    pairs = matchups.pair_history(v.bouts(spark, sf))
    title = F.col("is_title_fight").cast("int")
    return pairs.groupBy("event_id").agg(
        F.sum("is_rematch").alias("num_rematches"), F.max("is_rivalry").alias("has_rivalry"),
        F.sum(title).alias("num_title_fights"), F.max(title).alias("has_title"),
    )


@query(
    "a3_means_per_event",
    v.with_(v.BOUTS, v.STATS, h.APPEARANCES, h.HISTORY, h.PAIRS, v.FIGHTERS, h.MATCHUPS)
    + """SELECT m.*, avg_exp, avg_win_rate, max_exp FROM (
      SELECT event_id, round(avg(reach_diff), 6) AS avg_reach_diff, round(avg(height_diff), 6) AS avg_height_diff,
        round(avg(age_diff), 6) AS avg_age_diff FROM matchups GROUP BY event_id) m
    JOIN (SELECT event_id, round(avg(total_fights), 6) AS avg_exp, round(avg(win_rate_last5), 6) AS avg_win_rate,
        max(total_fights) AS max_exp FROM history GROUP BY event_id) USING (event_id)""",
)
def means_per_event(spark, sf):
    fights = v.bouts(spark, sf)
    pairs = rollup.matchup_rollup(matchups.matchup_features(fights, v.fighters(spark, sf)))
    feats = rollup.experience_rollup(history.fighter_features(fights, v.stats(spark, sf)))
    out = pairs.drop("num_rematches", "has_rivalry").join(feats, "event_id")
    means = [c for c in out.columns if c.startswith("avg_")]
    return out.withColumns({c: F.round(c, 6) for c in means})


@query(
    "a4_adaptive_rollup",
    v.with_(v.SIDES, v.ODDS) + """SELECT fighter1_name, round(avg(fighter1_odds), 6) AS avg_betting_spread,
      max(fighter1_odds) AS max_betting_spread, min(fighter1_odds) AS min_betting_spread,
      CAST(sum(CAST(fighter2_odds > 0 AS INTEGER)) AS BIGINT) AS num_competitive_fights
    FROM odds GROUP BY fighter1_name""",
)
def adaptive_rollup(spark, sf):
    df = v.odds(spark, sf).select(
        "fighter1_name", F.col("fighter1_odds").alias("betting_spread"),
        (F.col("fighter2_odds") > 0).cast("int").alias("is_competitive"),
    )
    out = rollup.adaptive_rollup(df, ["fighter1_name"])
    return out.withColumn("avg_betting_spread", F.round("avg_betting_spread", 6))


@query(
    "a5_entity_summary",
    """SELECT user_id, round(avg(value), 8) AS avg_value, max(value) AS max_value,
      round(stddev_samp(value), 8) AS search_volatility FROM events GROUP BY user_id""",
)
def entity_summary(spark, sf):
    out = rollup.entity_summary(v.table(spark, sf, "events"), "user_id", "value")
    return out.withColumns({c: F.round(c, 8) for c in ("avg_value", "search_volatility")})


@query(
    "a7_group_counts",
    v.with_(v.BOUTS) + """SELECT fighter1_name AS src_name, fighter2_name AS dst_name, count(*) AS fight_count
    FROM bouts GROUP BY ALL""",
)
def group_counts(spark, sf):
    return graph.name_edges(v.bouts(spark, sf))


@query(
    "a8_share_of_maximum",
    """SELECT o_custkey, round(count(*) / (SELECT max(n) FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey)), 6)
      AS share FROM orders GROUP BY o_custkey""",
)
def share_of_maximum(spark, sf):
    counts = v.table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return graph.share_of_max(counts, "n", "share").select("o_custkey", F.round("share", 6).alias("share"))


@query(
    "a9_distinct_and_value_counts",
    """SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY event_type""",
)
def distinct_and_value_counts(spark, sf):
    df = v.table(spark, sf, "events")
    # users are made distinct per type first, so no type is gathered in one task
    users = df.select("event_type", "user_id").distinct().groupBy("event_type").agg(F.count("user_id").alias("users"))
    return profile.value_counts(df, "event_type").join(users, "event_type")


EVENT_FEATURES = (
    v.with_(v.BOUTS, v.STATS, h.APPEARANCES, h.HISTORY, h.PAIRS, v.FIGHTERS, h.MATCHUPS, v.CARDS) + """
    SELECT c.event_id, c.event_name, c.event_date, c.event_type, num_fights, num_title_fights, has_title,
      num_rematches, has_rivalry, avg_exp, avg_win_rate, max_exp, avg_reach_diff, avg_height_diff, avg_age_diff,
      CAST(dayofweek(c.event_date) + 1 AS INTEGER) AS day_of_week, CAST(month(c.event_date) AS INTEGER) AS month,
      CAST(dayofweek(c.event_date) = 6 AS INTEGER) AS is_saturday,
      CAST(date_diff('day', lag(c.event_date) OVER (PARTITION BY event_type ORDER BY c.event_date, c.event_id),
        c.event_date) AS INTEGER) AS days_since_last,
      CAST(location LIKE 'Las Vegas%' AS INTEGER) AS is_vegas,
      CASE WHEN location <> 'Berlin' THEN CAST(location LIKE '%USA' AS INTEGER) END AS is_usa,
      CAST(event_type = 'PPV' AS INTEGER) AS is_ppv
    FROM cards c LEFT JOIN (SELECT event_id, count(*) AS num_fights,
        CAST(sum(CAST(is_title_fight AS INTEGER)) AS BIGINT) AS num_title_fights,
        max(CAST(is_title_fight AS INTEGER)) AS has_title FROM bouts GROUP BY event_id) f USING (event_id)
    LEFT JOIN (SELECT event_id, CAST(sum(is_rematch) AS BIGINT) AS num_rematches, max(is_rivalry) AS has_rivalry,
        round(avg(reach_diff), 6) AS avg_reach_diff, round(avg(height_diff), 6) AS avg_height_diff,
        round(avg(age_diff), 6) AS avg_age_diff FROM matchups GROUP BY event_id) m USING (event_id)
    LEFT JOIN (SELECT event_id, round(avg(total_fights), 6) AS avg_exp, round(avg(win_rate_last5), 6) AS avg_win_rate,
        max(total_fights) AS max_exp FROM history GROUP BY event_id) x USING (event_id)"""
)


def feature_inputs(spark, sf):
    """Events, contests, pairings and entity histories."""
    from eventlytics.functions import categories

    place = F.col("location")
    fights = shared_checkpoint(v.bouts(spark, sf))
    events = v.cards(spark, sf).withColumns(
        {"city": categories.city(place), "country": categories.country(place), "year": F.year("event_date")}
    )
    return (
        events, fights, matchups.matchup_features(fights, v.fighters(spark, sf)),
        history.fighter_features(fights, v.stats(spark, sf)),
    )


@query("event_features", EVENT_FEATURES)
def event_features(spark, sf):
    from eventlytics.plans.features import event_features as build

    out = build(*feature_inputs(spark, sf))
    means = [c for c in out.columns if c.startswith("avg_")]
    return out.drop("city", "country", "year").withColumns({c: F.round(c, 6) for c in means})
