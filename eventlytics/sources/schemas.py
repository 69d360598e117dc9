"""Explicit schemas; raw columns are all text and typed by our own cleaning."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# Headers of the raw files.
RAW = {
    "events": ("EVENT", "URL", "DATE", "LOCATION"),
    "fight_details": ("EVENT", "BOUT", "URL"),
    "fight_results": (
        "EVENT", "BOUT", "OUTCOME", "WEIGHTCLASS", "METHOD", "ROUND", "TIME",
        "TIME FORMAT", "REFEREE", "DETAILS", "URL",
    ),
    "fight_stats": (
        "EVENT", "BOUT", "ROUND", "FIGHTER", "KD", "SIG.STR.", "SIG.STR. %",
        "TOTAL STR.", "TD", "TD %", "SUB.ATT", "REV.", "CTRL", "HEAD", "BODY",
        "LEG", "DISTANCE", "CLINCH", "GROUND",
    ),
    "fighter_details": ("FIRST", "LAST", "NICKNAME", "URL"),
    "fighter_tott": ("FIGHTER", "HEIGHT", "WEIGHT", "REACH", "STANCE", "DOB", "URL"),
    "attendance": (
        "event_name", "event_date", "venue", "location", "attendance", "gate_revenue",
        "venue_capacity", "sell_through", "ppv_buys", "source",
    ),
}
# Typed external tables.
EXTERNAL = {
    "event_sentiment": (
        "event_name string, avg_sentiment double, sentiment_std double, min_sentiment double, "
        "max_sentiment double, avg_subjectivity double, total_engagement int, "
        "avg_comment_score double, top_comment_score int, comment_count int, "
        "sentiment_range double, hype_score double, sentiment_category string"
    ),
    "google_trends": "date date, fighter_name string, search_interest int",
    "fighter_buzz": (
        "fighter1_name string, fighter2_name string, event_date date, "
        "f1_avg_search_7d double, f1_avg_search_30d double, f1_peak_search_7d double, "
        "f1_trend_direction int, f2_avg_search_7d double, f2_avg_search_30d double, "
        "f2_peak_search_7d double, f2_trend_direction int, combined_buzz_7d double, "
        "combined_buzz_30d double, max_peak_search double, buzz_differential double"
    ),
    "betting_odds": (
        "fighter1_name string, fighter2_name string, fighter1_odds int, fighter2_odds int, "
        "fighter1_implied_prob double, fighter2_implied_prob double, opening_odds_f1 int, "
        "opening_odds_f2 int, line_movement_f1 int, line_movement_f2 int, odds_spread double, "
        "event_name string, source string, f1_is_favorite int, is_competitive_matchup int, "
        "has_heavy_favorite int, big_line_movement int"
    ),
    "reddit_comments": (
        "event_name string, thread_title string, comment_text string, score int, "
        "created_utc timestamp, polarity double, subjectivity double, source string"
    ),
}


def raw_schema(name: str) -> StructType:
    return StructType([StructField(c, StringType()) for c in RAW[name]])


def schema_of(name: str) -> StructType | str:
    return raw_schema(name) if name in RAW else EXTERNAL[name]
