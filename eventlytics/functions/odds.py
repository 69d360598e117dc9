"""Betting lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds of the line features.
COMPETITIVE_SPREAD = 0.10
HEAVY_PROBABILITY = 0.70
BIG_MOVE = 50
UNKNOWN_PROBABILITY = 0.5


def american_to_decimal(odds: Column) -> Column:
    gain = F.when(odds > 0, odds / 100).otherwise(F.try_divide(F.lit(100.0), F.abs(odds)))
    return gain + 1


def implied_probability(odds: Column) -> Column:
    """Probability behind an American line; a line of 0 counts as even."""
    size = F.abs(odds)
    return (
        F.when(odds == 0, UNKNOWN_PROBABILITY)
        .when(odds > 0, 100 / (size + 100))
        .when(odds < 0, size / (size + 100))
    )


def decimal_to_probability(odds: Column) -> Column:
    return F.when(odds <= 0, 0.0).otherwise(1 / odds)


def _line(c: Column) -> Column:
    return F.replace(F.trim(c), F.lit("+"), F.lit("")).try_cast("int")


def is_line(c: Column) -> Column:
    """Whether a text reads as an American line."""
    return _line(c).isNotNull()


def parse_line(c: Column) -> Column:
    """``+150`` / ``-200`` as integer; unreadable lines become 0."""
    return F.coalesce(_line(c), F.lit(0))


def line_movement(df: DataFrame) -> DataFrame:
    """Closing minus opening line per side."""
    return df.withColumns(
        {
            f"line_movement_f{i}": F.col(f"fighter{i}_odds") - F.col(f"opening_odds_f{i}")
            for i in (1, 2)
        }
    )


def odds_features(df: DataFrame) -> DataFrame:
    """Probabilities (where missing), favourite, spread and flags."""
    probs = ("fighter1_implied_prob", "fighter2_implied_prob")
    missing = {
        p: implied_probability(F.col(p.replace("implied_prob", "odds")))
        for p in probs
        if p not in df.columns
    }
    df = df.withColumns(missing) if missing else df
    p1, p2 = (F.col(p) for p in probs)
    spread = F.abs(p1 - p2)
    flags = {
        "f1_is_favorite": p1 > p2,
        "is_competitive_matchup": spread < COMPETITIVE_SPREAD,
        "has_heavy_favorite": (p1 > HEAVY_PROBABILITY) | (p2 > HEAVY_PROBABILITY),
    }
    if "line_movement_f1" in df.columns:
        flags["big_line_movement"] = F.abs("line_movement_f1") > BIG_MOVE
    return df.withColumns(
        {"odds_spread": spread, **{n: f.cast("int") for n, f in flags.items()}}
    )
