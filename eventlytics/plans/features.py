"""From clean tables to one feature row per event."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlytics.functions import categories, dates, frames
from eventlytics.functions.text import normalize_name
from eventlytics.operators import history, linkage, matchups, rollup
from eventlytics.operators.scale import keep_first
from eventlytics.sources import files
from eventlytics.sources.schemas import EXTERNAL

# What a contest or event gets where a source is silent.
BETTING_DEFAULTS = {
    "betting_spread": 0.1, "is_competitive": 1, "has_heavy_favorite": 0,
    "f1_implied_prob": 0.5, "f2_implied_prob": 0.5,
}
BUZZ_DEFAULTS = {
    "pre_event_buzz_7d": 50.0, "pre_event_buzz_30d": 50.0,
    "peak_search_interest": 30.0, "buzz_differential": 0.0,
}
SENTIMENT_DEFAULTS = {
    "reddit_sentiment": 0.0, "reddit_hype": 0.5, "reddit_engagement": 100, "reddit_comments": 50,
}
# Source columns and the feature names they take.
BETTING_COLUMNS = {
    "odds_spread": "betting_spread", "is_competitive_matchup": "is_competitive",
    "has_heavy_favorite": "has_heavy_favorite",
    "fighter1_implied_prob": "f1_implied_prob", "fighter2_implied_prob": "f2_implied_prob",
}
BUZZ_COLUMNS = {
    "combined_buzz_7d": "pre_event_buzz_7d", "combined_buzz_30d": "pre_event_buzz_30d",
    "max_peak_search": "peak_search_interest", "buzz_differential": "buzz_differential",
}
SENTIMENT_COLUMNS = {
    "avg_sentiment": "reddit_sentiment", "hype_score": "reddit_hype",
    "total_engagement": "reddit_engagement", "comment_count": "reddit_comments",
}
EVENT_COLUMNS = (
    "event_id", "event_name", "event_date", "event_type", "city", "country", "year",
    "num_fights", "num_title_fights", "has_title", "num_rematches", "has_rivalry",
    "avg_exp", "avg_win_rate", "max_exp", "avg_reach_diff", "avg_height_diff", "avg_age_diff",
    "day_of_week", "month", "is_saturday", "days_since_last", "is_vegas", "is_usa", "is_ppv",
)


def source_columns(
    df: DataFrame,
    columns: Mapping[str, str],
    flags: Mapping[str, str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """A source under its feature names: keys normalised, 0/1 flags as booleans."""
    return df.select(
        *keep,
        normalize_name(F.col("fighter1_name")).alias("f1_name_norm"),
        normalize_name(F.col("fighter2_name")).alias("f2_name_norm"),
        *[F.col(a).alias(b) for a, b in columns.items()],
        *[F.coalesce(F.col(a) == 1, F.lit(False)).alias(b) for a, b in (flags or {}).items()],
    )


def event_features(
    events: DataFrame, fights: DataFrame, pairs: DataFrame, fighter_feats: DataFrame, n: int = 5
) -> DataFrame:
    """Contest, pairing and experience roll-ups plus calendar and place of each event."""
    base = rollup.attach(
        events,
        [
            rollup.card_counts(fights).drop("title_weight_class"),
            rollup.matchup_rollup(pairs),
            rollup.experience_rollup(fighter_feats, n),
            # ordered over three columns, not over the joined rows
            history.days_since_previous(events.select("event_id", "event_type", "event_date")).select(
                "event_id", "days_since_last"
            ),
        ],
    )
    day = F.col("event_date")
    return base.withColumns(
        {
            "day_of_week": dates.day_of_week(day),
            "month": F.month(day),
            "is_saturday": dates.is_saturday(day),
            "is_vegas": categories.is_vegas(F.col("city")),
            "is_usa": categories.is_usa(F.col("country")),
            "is_ppv": categories.is_ppv(F.col("event_type")),
        }
    ).select(*EVENT_COLUMNS)


def with_graph(fights: DataFrame, graph: DataFrame) -> DataFrame:
    """Network measures of both sides, their sums, gaps and shared community."""
    measures = ["pagerank_score", "num_opponents", "community_id"]
    nodes = keep_first(
        graph.withColumn("name_norm", normalize_name(F.col("name"))), ["name_norm"], ["name"]
    )
    keyed = fights.withColumns(
        {f"f{i}_name_norm": normalize_name(F.col(f"fighter{i}_name")) for i in (1, 2)}
    )
    out = matchups.role_join(
        keyed, nodes, "name_norm", {"f1_name_norm": "_1", "f2_name_norm": "_2"}, measures
    )
    out = frames.two_sided(
        out, "pagerank_score_1", "pagerank_score_2", "combined_pagerank", "pagerank_differential"
    )
    out = frames.two_sided(
        out, "num_opponents_1", "num_opponents_2", "combined_network_size", missing=0
    )
    return out.withColumn("same_community", frames.same_side("community_id_1", "community_id_2")).drop(
        *[f"{m}_{i}" for m in measures for i in (1, 2)]
    )


def with_betting(fights: DataFrame, odds: DataFrame) -> DataFrame:
    order = [F.col(c).asc_nulls_last() for c in BETTING_COLUMNS]
    return frames.fill(linkage.lookup_by_names(fights, odds, BETTING_COLUMNS, order), BETTING_DEFAULTS)


def with_buzz(fights: DataFrame, buzz: DataFrame) -> DataFrame:
    order = [F.col(c).asc_nulls_last() for c in ("event_date", *BUZZ_COLUMNS) if c in buzz.columns]
    return frames.fill(linkage.lookup_by_names(fights, buzz, BUZZ_COLUMNS, order), BUZZ_DEFAULTS)


def with_sentiment(events: DataFrame, sentiment: DataFrame) -> DataFrame:
    order = [F.col(c).asc_nulls_last() for c in ("event_name", *SENTIMENT_COLUMNS)]
    out = linkage.lookup_by_name(events, sentiment, "event_name", SENTIMENT_COLUMNS, order)
    return frames.fill(out, SENTIMENT_DEFAULTS).drop("event_name_norm")


def extended_event_features(
    events: DataFrame,
    fights: DataFrame,
    pairs: DataFrame,
    fighter_feats: DataFrame,
    external: Mapping[str, DataFrame],
    n: int = 5,
) -> DataFrame:
    """Event features plus whatever external sources are given; numbers never NULL."""
    enriched = fights
    for name, add in (("graph", with_graph), ("betting", with_betting), ("buzz", with_buzz)):
        if name in external:
            enriched = add(enriched, external[name])
    out = rollup.attach(
        event_features(events, fights, pairs, fighter_feats, n),
        [rollup.adaptive_rollup(enriched, ["event_id"])],
    )
    if "sentiment" in external:
        out = with_sentiment(out, external["sentiment"])
    return out.fillna(0)


def load_external(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """External sources that exist under a data folder."""
    wanted = {"betting": "betting_odds", "buzz": "fighter_buzz", "sentiment": "event_sentiment"}
    found = {
        name: files.optional_source(
            files.read_csv, spark, f"{folder}/external/{file}.csv", EXTERNAL[file]
        )
        for name, file in wanted.items()
    }
    found["graph"] = files.optional_source(
        files.read_parquet, spark, f"{folder}/features/graph_features"
    )
    return {k: df for k, df in found.items() if df is not None}


def run(spark: SparkSession, data: str, out: str, external: bool = True, n: int = 5) -> None:
    """Read the processed tables, write the three feature tables.

    Entity and pairing features are read back for the event table instead of
    being computed a second time.
    """
    tables = {t: files.read_parquet(spark, f"{data}/processed/{t}")
              for t in ("events", "fighters", "fights", "fight_stats")}
    events = tables["events"]
    fights = tables["fights"].drop("event_date").join(
        events.select("event_id", "event_date"), "event_id", "left"
    )
    files.write_parquet(
        history.fighter_features(fights, tables["fight_stats"], n), f"{out}/features/fighter_features"
    )
    files.write_parquet(
        matchups.matchup_features(fights, tables["fighters"]), f"{out}/features/matchup_features"
    )
    done = extended_event_features(
        events, fights,
        files.read_parquet(spark, f"{out}/features/matchup_features"),
        files.read_parquet(spark, f"{out}/features/fighter_features"),
        load_external(spark, data) if external else {}, n,
    )
    files.write_parquet(done, f"{out}/features/event_features")
