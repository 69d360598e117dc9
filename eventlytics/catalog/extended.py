"""Contests, events and event features with all external sources.

The sources are made from the given tables: network measures of suppliers, lines of most
contests, buzz of most, comments on two thirds of the events, names partly in capitals.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlytics.catalog import rollups
from eventlytics.catalog import views as v
from eventlytics.catalog.joins import NORM
from eventlytics.catalog.registry import query
from eventlytics.operators.rollup import EXTERNAL
from eventlytics.plans import etl, features

DAY = "CAST(date_diff('day', DATE '1990-01-01', event_date) AS BIGINT)"
SOURCES = f"""nodes AS (SELECT s_name AS name, (s_suppkey % 17) / 10 AS pagerank_score, s_suppkey % 23 AS num_opponents,
    s_suppkey % 5 AS community_id FROM supplier WHERE s_suppkey % 13 <> 0),
lines AS (SELECT fight_id, {NORM.format('fighter1_name')} AS k1, {NORM.format('fighter2_name')} AS k2,
    fighter1_odds, fighter2_odds, (fight_id % 40) / 100 AS odds_spread, CAST(fight_id % 3 = 0 AS INTEGER) AS competitive,
    CAST(fight_id % 4 = 0 AS INTEGER) AS heavy, (fight_id % 50) / 100 AS p1, (fight_id % 60) / 100 AS p2
  FROM odds WHERE fight_id % 6 <> 0),
searched AS (SELECT {NORM.format('fighter1_name')} AS k1, {NORM.format('fighter2_name')} AS k2, event_date,
    CAST(fight_id % 90 AS DOUBLE) AS b7, CAST(fight_id % 80 AS DOUBLE) AS b30, CAST(fight_id % 100 AS DOUBLE) AS peak,
    CAST(fight_id % 31 AS DOUBLE) AS gap FROM bouts WHERE fight_id % 5 <> 0),
comments AS (SELECT {NORM.format('event_name')} AS k, (n % 21 - 10) / 10 AS mood, (n % 9) / 10 AS spread,
    (n % 7) / 10 AS hype, n % 500 AS engagement, n % 60 AS comments
  FROM (SELECT event_name, {DAY} AS n FROM cards) WHERE n % 3 <> 0),
sided AS (SELECT b.*, {NORM.format('fighter1_name')} AS k1, {NORM.format('fighter2_name')} AS k2,
    coalesce(x.pagerank_score, 0) + coalesce(y.pagerank_score, 0) AS combined_pagerank,
    abs(coalesce(x.pagerank_score, 0) - coalesce(y.pagerank_score, 0)) AS pagerank_differential,
    coalesce(x.num_opponents, 0) + coalesce(y.num_opponents, 0) AS combined_network_size,
    CAST(x.community_id = y.community_id AS INTEGER) AS same_community
  FROM bouts b LEFT JOIN nodes x ON x.name = fighter1_name LEFT JOIN nodes y ON y.name = fighter2_name)"""


def _first(source: str, order: str) -> str:
    return f"(SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY k1, k2 ORDER BY {order}) = 1)"


def sources(spark, sf):
    """The external sources by name."""
    key, fight = F.col("s_suppkey"), F.col("fight_id")
    nodes = v.table(spark, sf, "supplier").filter(key % 13 != 0).select(
        F.col("s_name").alias("name"), (key % 17 / 10).alias("pagerank_score"),
        (key % 23).alias("num_opponents"), (key % 5).alias("community_id"),
    )
    lines = v.odds(spark, sf).filter(fight % 6 != 0).withColumns({
        "fighter1_name": F.upper("fighter1_name"), "odds_spread": fight % 40 / 100,
        "is_competitive_matchup": (fight % 3 == 0).cast("int"), "has_heavy_favorite": (fight % 4 == 0).cast("int"),
        "fighter1_implied_prob": fight % 50 / 100, "fighter2_implied_prob": fight % 60 / 100,
    }).drop("fight_id")
    measures = {"combined_buzz_7d": 90, "combined_buzz_30d": 80, "max_peak_search": 100, "buzz_differential": 31}
    buzz = v.bouts(spark, sf).filter(fight % 5 != 0).select(
        "fighter1_name", F.lower("fighter2_name").alias("fighter2_name"), "event_date",
        *[(fight % m).cast("double").alias(c) for c, m in measures.items()],
    )
    n = F.datediff("event_date", F.lit("1990-01-01").cast("date")).cast("bigint")
    comments = v.cards(spark, sf).filter(n % 3 != 0).select(
        F.upper("event_name").alias("event_name"), ((n % 21 - 10) / 10).alias("avg_sentiment"),
        (n % 9 / 10).alias("sentiment_std"), (n % 7 / 10).alias("hype_score"),
        (n % 500).alias("total_engagement"), (n % 60).alias("comment_count"),
    )
    return {"graph": nodes, "betting": lines, "buzz": buzz, "sentiment": comments}


FIRST_LINE = _first("lines", "odds_spread, competitive, heavy, p1, p2")
FIRST_BUZZ = _first("searched", "event_date, b7, b30, peak, gap")
FUNCTIONS = {"avg": "round(avg({}), 6)", "max": "max({})", "min": "min({})", "sum": "CAST(sum({}) AS BIGINT)"}
DOUBLES = {"total_buzz_7d": "sum(pre_event_buzz_7d)"}  # a sum of doubles stays one
ROLLED = ", ".join(f"{DOUBLES.get(out, FUNCTIONS[fn].format(c))} AS {out}" for c, fn, out in EXTERNAL)
NUMBERS = [c for c in features.EVENT_COLUMNS if c not in ("event_id", "event_name", "event_date", "event_type", "city", "country", "year")]


@query(
    "event_features_extended",
    v.with_(v.BOUTS, v.ODDS, v.CARDS, SOURCES, f"""full_fights AS (
      SELECT s.*, coalesce(l.odds_spread, 0.1) AS betting_spread, coalesce(competitive, 1) AS is_competitive,
        coalesce(heavy, 0) AS has_heavy_favorite, coalesce(b7, 50) AS pre_event_buzz_7d, coalesce(gap, 0) AS buzz_differential
      FROM sided s LEFT JOIN {FIRST_LINE} l USING (k1, k2) LEFT JOIN {FIRST_BUZZ} z USING (k1, k2)),
    rolled AS (SELECT event_id, {ROLLED} FROM full_fights GROUP BY event_id),
    base AS ({rollups.EVENT_FEATURES})""") + f"""SELECT base.event_id, base.event_name, event_date, event_type,
      {", ".join(f"coalesce({c}, 0) AS {c}" for c in NUMBERS)},
      {", ".join(f"coalesce({out}, 0) AS {out}" for _, _, out in EXTERNAL)},
      coalesce(mood, 0.0) AS reddit_sentiment, coalesce(hype, 0.5) AS reddit_hype,
      coalesce(engagement, 100) AS reddit_engagement, coalesce(comments, 50) AS reddit_comments
    FROM base LEFT JOIN rolled USING (event_id) LEFT JOIN comments ON k = {NORM.format('base.event_name')}""",
)
def event_features_extended(spark, sf):
    """One row an event with every roll-up that models are trained on."""
    out = features.extended_event_features(*rollups.feature_inputs(spark, sf), sources(spark, sf))
    means = [c for c in out.columns if c.startswith("avg_")]
    return out.drop("city", "country", "year").withColumns({c: F.round(c, 6) for c in means})


@query(
    "fights_enriched",
    v.with_(v.BOUTS, v.ODDS, v.CARDS, SOURCES) + f"""SELECT s.fight_id, l.fighter1_odds AS f1_closing_odds,
      l.fighter2_odds AS f2_closing_odds, p1 AS f1_implied_prob, p2 AS f2_implied_prob,
      coalesce(odds_spread, 0.1) AS betting_spread, coalesce(competitive = 1, true) AS is_competitive,
      coalesce(heavy = 1, false) AS has_heavy_favorite, coalesce(b7, 50) AS pre_event_buzz_7d, b30 AS pre_event_buzz_30d,
      peak AS peak_search_interest, gap AS buzz_differential, round(combined_pagerank, 6) AS combined_pagerank,
      round(pagerank_differential, 6) AS pagerank_differential, combined_network_size, same_community
    FROM sided s
    LEFT JOIN {_first("lines", "fighter1_odds, fighter2_odds, p1, p2, odds_spread, competitive, heavy")} l USING (k1, k2)
    LEFT JOIN {_first("searched", "b7, b30, peak, gap")} z USING (k1, k2)""",
)
def fights_enriched(spark, sf):
    out = etl.enrich_fights(v.bouts(spark, sf), sources(spark, sf))
    return out.select(
        "fight_id", "f1_closing_odds", "f2_closing_odds", "f1_implied_prob", "f2_implied_prob", "betting_spread",
        "is_competitive", "has_heavy_favorite", *features.BUZZ_COLUMNS.values(),
        F.round("combined_pagerank", 6).alias("combined_pagerank"),
        F.round("pagerank_differential", 6).alias("pagerank_differential"), "combined_network_size", "same_community",
    )


@query(
    "events_enriched",
    v.with_(v.BOUTS, v.ODDS, v.CARDS, SOURCES) + f"""SELECT event_id, coalesce(mood, 0.0) AS reddit_sentiment,
      coalesce(hype, 0.5) AS reddit_hype, coalesce(engagement, 100) AS reddit_engagement, comments AS reddit_comments,
      spread AS sentiment_variance
    FROM cards LEFT JOIN comments ON k = {NORM.format('event_name')}""",
)
def events_enriched(spark, sf):
    out = etl.enrich_events(v.cards(spark, sf), sources(spark, sf)["sentiment"])
    return out.select("event_id", *features.SENTIMENT_COLUMNS.values(), "sentiment_variance")
