"""External source tables: odds, search buzz, comments, page facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlytics.functions import odds, text
from eventlytics.functions.sentiment import score_texts
from eventlytics.operators import incremental, pages, rollup, trailing
from eventlytics.operators.scale import keep_first_n


def betting_odds(lines: DataFrame) -> DataFrame:
    """Lines with movement (where opening lines exist) and derived features."""
    if "opening_odds_f1" in lines.columns and "line_movement_f1" not in lines.columns:
        lines = odds.line_movement(lines)
    return odds.odds_features(lines)


def fighter_buzz(trends: DataFrame, fights: DataFrame) -> DataFrame:
    """Trailing search interest of both sides before each contest.

    Contests may give their sides as ``bout``; a missing date gets defaults.
    """
    if "fighter1_name" not in fights.columns:
        fights = fights.withColumns(
            {
                "fighter1_name": text.side_one(F.col("bout")),
                "fighter2_name": text.side_two(F.col("bout")),
            }
        )
    series = trailing.daily_series(trends, "fighter_name", "date", "search_interest")
    return trailing.contest_buzz(fights.select("fighter1_name", "fighter2_name", "event_date"), series)


def event_comments(
    comments: DataFrame, thread_order: str = "thread_title", per_event: int | None = None
) -> DataFrame:
    """Comments of each event's first matching thread, cut and scored.

    A thread matches if its title holds the event name. ``per_event`` keeps the
    first so many comments of an event; without it all are kept.
    """
    matching = comments.filter(F.contains(F.lower("thread_title"), F.lower("event_name")))
    first = matching.groupBy("event_name").agg(F.min(thread_order).alias("thread_title"))
    one_thread = matching.join(first, ["event_name", "thread_title"], "left_semi")
    kept = one_thread
    if per_event is not None:
        kept = keep_first_n(one_thread, ["event_name"], ["created_utc", "comment_text"], per_event)
    scored = score_texts(kept, "comment_text")
    return scored.withColumn("comment_text", text.truncate(F.col("comment_text")))


def event_sentiment(comments: DataFrame) -> DataFrame:
    return rollup.sentiment_rollup(comments)


def page_attendance(raw_pages: DataFrame, as_of: str | None = None) -> DataFrame:
    """Facts of pages, newest first; events after ``as_of`` are left out."""
    out = pages.facts(raw_pages)
    if as_of is not None:
        out = out.filter(F.col("event_date") <= F.lit(as_of).cast("date"))
    return incremental.newest_first(out, ties=["page_id"])
