"""From raw text tables to clean, keyed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlytics.functions import categories, dates, numbers, text
from eventlytics.functions.frames import fill, find_column, optional, safe_names
from eventlytics.operators import incremental, linkage, rollup
from eventlytics.operators.scale import keep_first
from eventlytics.plans import features
from eventlytics.sources import files
from eventlytics.sources.schemas import RAW

TABLES = ("events", "fight_results", "fight_details", "fight_stats", "fighter_tott", "fighter_details")
# Defaults of a fully enriched contest.
ENRICHED_DEFAULTS = {
    "betting_spread": 0.1, "is_competitive": True, "has_heavy_favorite": False,
    "pre_event_buzz_7d": 50.0, "combined_pagerank": 0.5, "combined_network_size": 10,
}
ENRICHED_EVENT_DEFAULTS = {"reddit_sentiment": 0.0, "reddit_engagement": 100, "reddit_hype": 0.5}


def clean_events(raw: DataFrame) -> DataFrame:
    """Typed events, one per id (the first by name and date)."""
    name, place = F.col("event"), F.col("location")
    out = raw.select(
        text.id_from_url(F.col("url"), "event").alias("event_id"),
        name.alias("event_name"),
        dates.parse_date(F.col("date")).alias("event_date"),
        categories.event_type(name).alias("event_type"),
        categories.city(place).alias("city"),
        categories.country(place).alias("country"),
        "location",
    ).withColumn("year", F.year("event_date"))
    return keep_first(out, ["event_id"], ["event_name", "event_date"])


def clean_fighters(raw: DataFrame) -> DataFrame:
    """Typed entities, one per id; columns the source lacks become NULL."""
    def col(name: str):
        return optional(raw, name)

    if "fighter" in raw.columns:
        name = F.col("fighter")
    elif {"first", "last"} <= set(raw.columns):
        name = text.full_name(F.col("first"), F.col("last"))
    else:
        name = F.lit("Unknown")
    record = col("record")
    draws = numbers.record_draws(record) if "record" in raw.columns else F.lit(None).cast("int")
    out = raw.select(
        text.id_from_url(F.col("url"), "fighter").alias("fighter_id"),
        name.alias("fighter_name"),
        col("nickname").alias("nickname"),
        numbers.height_inches(col("height")).alias("height_inches"),
        numbers.leading_int(col("weight")).alias("weight_lbs"),
        numbers.leading_int(col("reach")).alias("reach_inches"),
        col("stance").alias("stance"),
        dates.parse_birth_date(col("dob")).alias("dob"),
        numbers.record_wins(record).alias("wins"),
        numbers.record_losses(record).alias("losses"),
        draws.alias("draws"),
    )
    return keep_first(out, ["fighter_id"], ["fighter_name"])


def clean_fights(raw: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Typed contests, one per id; the event id is found by URL or by event name."""
    has = set(raw.columns)
    if "bout" in has:
        one, two = text.side_one(F.col("bout")), text.side_two(F.col("bout"))
    else:
        one, two = (optional(raw, f"fighter{i}", default="Unknown") for i in (1, 2))
    if "winner" in has:
        won = F.col("winner")
    elif "outcome" in has:
        won = categories.winner(F.col("outcome"), one, two)
    else:
        won = F.lit(None).cast("string")
    cls = next((c for c in ("weightclass", "weight_class") if c in has), None)
    keyed = {"event", "bout"} <= has
    out = raw.select(
        text.id_from_url(F.col("url"), "fight").alias("fight_id"),
        (text.composite_key(F.col("event"), F.col("bout")) if keyed else F.lit(None).cast("string"))
        .alias("fight_key"),
        (text.id_from_url(F.col("event_url"), "event") if "event_url" in has else F.lit(None).cast("string"))
        .alias("event_id"),
        optional(raw, "event").alias("event_"),
        one.alias("fighter1_name"),
        two.alias("fighter2_name"),
        won.alias("winner_name"),
        (categories.bare_class(F.col(cls)) if cls else F.lit("Unknown")).alias("weight_class"),
        (categories.is_title(F.col(cls)) if cls else F.lit(False)).alias("is_title_fight"),
        (categories.method_category(F.col("method")) if "method" in has else F.lit("Unknown"))
        .alias("method_category"),
        optional(raw, "method").alias("method"),
        numbers.leading_int(optional(raw, "round")).alias("round"),
        optional(raw, "time").alias("finish_time"),
    )
    if events is not None:
        ids = keep_first(
            events.select(
                text.normalize_name(F.col("event_name")).alias("name_"), F.col("event_id").alias("found_")
            ),
            ["name_"], ["found_"],
        )
        out = out.withColumn("name_", text.normalize_name(F.col("event_"))).join(ids, "name_", "left")
        out = out.withColumn("event_id", F.coalesce("event_id", "found_")).drop("name_", "found_")
    return keep_first(out.drop("event_"), ["fight_id"], ["fight_key"])


def clean_fight_stats(raw: DataFrame) -> DataFrame:
    """Round statistics with counts as integers; raw columns are kept."""
    strikes = find_column(raw, "sig", "str")
    has = set(raw.columns)
    none = F.lit(None).cast("string")
    sig = F.col(f"`{strikes}`") if strikes else none
    td = optional(raw, "td")
    keyed = {"event", "bout"} <= has
    return raw.withColumns(
        {
            "fighter_name": optional(raw, "fighter", default="Unknown"),
            "fight_key": text.composite_key(F.col("event"), F.col("bout")) if keyed else none,
            "sig_strikes_landed": numbers.landed(sig),
            "sig_strikes_attempted": numbers.attempted(sig),
            "takedowns_landed": numbers.landed(td),
            "takedowns_attempted": numbers.attempted(td),
            "knockdowns": numbers.number(optional(raw, "kd")),
        }
    )


def attach_fight_ids(stats: DataFrame, fights: DataFrame) -> DataFrame:
    """Contest id of each statistics row, through the composite key."""
    ids = keep_first(
        fights.filter(F.col("fight_key").isNotNull()).select("fight_key", "fight_id"),
        ["fight_key"], ["fight_id"],
    )
    return stats.join(ids, "fight_key", "left")


def calendar_features(events: DataFrame, fights: DataFrame) -> DataFrame:
    """Events with their contest counts, calendar and place flags."""
    day = F.col("event_date")
    return rollup.attach(events, [rollup.card_counts(fights).drop("has_title")]).withColumns(
        {
            "day_of_week": dates.day_of_week(day),
            "month": F.month(day),
            "is_saturday": dates.is_saturday(day),
            "is_las_vegas": categories.is_vegas(F.col("city")),
            "is_usa": categories.is_usa(F.col("country")),
        }
    )


def betting_source(odds: DataFrame) -> DataFrame:
    return features.source_columns(
        odds,
        {
            "fighter1_odds": "f1_closing_odds", "fighter2_odds": "f2_closing_odds",
            "fighter1_implied_prob": "f1_implied_prob", "fighter2_implied_prob": "f2_implied_prob",
            "odds_spread": "betting_spread",
        },
        flags={"is_competitive_matchup": "is_competitive", "has_heavy_favorite": "has_heavy_favorite"},
    )


def buzz_source(buzz: DataFrame) -> DataFrame:
    return features.source_columns(buzz, features.BUZZ_COLUMNS)


def enrich_fights(fights: DataFrame, sources: Mapping[str, DataFrame]) -> DataFrame:
    """Contests with betting, buzz and network columns, defaults where unknown."""
    keys = ["f1_name_norm", "f2_name_norm"]
    out = fights.withColumns(
        {f"f{i}_name_norm": text.normalize_name(F.col(f"fighter{i}_name")) for i in (1, 2)}
    )
    for name, shape in (("betting", betting_source), ("buzz", buzz_source)):
        if name in sources:
            side = shape(sources[name])
            order = [F.col(c).asc_nulls_last() for c in side.columns if c not in keys]
            out = out.join(keep_first(side, keys, order), keys, "left")
    if "graph" in sources:
        out = features.with_graph(out, sources["graph"])
    return fill(out, ENRICHED_DEFAULTS)


def enrich_events(events: DataFrame, sentiment: DataFrame) -> DataFrame:
    columns = {**features.SENTIMENT_COLUMNS, "sentiment_std": "sentiment_variance"}
    order = [F.col(c).asc_nulls_last() for c in ("event_name", *columns)]
    out = linkage.lookup_by_name(events, sentiment, "event_name", columns, order)
    return fill(out, ENRICHED_EVENT_DEFAULTS).drop("event_name_norm")


def run(spark: SparkSession, data: str, out: str) -> None:
    """Read ``data/raw``, write the clean tables under ``out/processed``.

    Results are the base of contests, details only the fallback. Each table is
    written once and read back where another needs it. Raw tables may be missing:
    what can't be made without them is left out.
    """
    raw = files.load_tables(spark, f"{data}/raw", TABLES)
    write = files.write_parquet

    def processed(name: str) -> DataFrame:
        return files.read_parquet(spark, f"{out}/processed/{name}")

    if "events" in raw:
        write(clean_events(raw["events"]), f"{out}/processed/events", ["year"])
    body = raw.get("fighter_tott", raw.get("fighter_details"))
    if body is not None:
        write(clean_fighters(body), f"{out}/processed/fighters")
    bouts = raw.get("fight_results", raw.get("fight_details"))
    if bouts is None or "events" not in raw:
        return  # all that follows hangs on contests and their events
    write(clean_fights(bouts, processed("events")), f"{out}/processed/fights")
    if "fight_stats" in raw:
        stats = attach_fight_ids(clean_fight_stats(raw["fight_stats"]), processed("fights"))
        write(safe_names(stats), f"{out}/processed/fight_stats")
    write(calendar_features(processed("events"), processed("fights")), f"{out}/processed/event_features")


def enrich(spark: SparkSession, data: str, out: str) -> None:
    """Second pass, after the graph: contests and events with external columns."""
    sources = features.load_external(spark, data)
    fights = files.read_parquet(spark, f"{out}/processed/fights")
    files.write_parquet(enrich_fights(fights, sources), f"{out}/processed/fights_enriched")
    if "sentiment" in sources:
        events = files.read_parquet(spark, f"{out}/processed/events")
        files.write_parquet(enrich_events(events, sources["sentiment"]), f"{out}/processed/events_enriched")


def typed_attendance(raw: DataFrame) -> DataFrame:
    """The all-text label file with its date and numbers typed."""
    return raw.select(
        "event_name",
        dates.parse_date(F.col("event_date")).alias("event_date"),
        numbers.number(F.col("sell_through"), "double").alias("sell_through"),
        numbers.number(F.col("attendance")).alias("attendance"),
        numbers.number(F.col("venue_capacity")).alias("venue_capacity"),
    )


def merge_sources(
    spark: SparkSession, sample: str, out: str, others: Sequence[DataFrame] = ()
) -> DataFrame:
    """Label sources as one table, newest first, written as CSV."""
    base = files.read_csv(spark, sample).withColumn("event_date", dates.parse_date(F.col("event_date")))
    shared = {c: F.col(c).cast("string") for c in RAW["attendance"] if c != "event_date"}
    rest = [
        o.withColumns({c: e for c, e in shared.items() if c in o.columns}).withColumn("event_date", F.col("event_date").cast("date"))
        for o in others
    ]
    merged = incremental.merge_sources([base, *rest], order=["source"])
    files.write_csv(incremental.newest_first(merged, ties=["event_name"]), out)
    return merged


def label_ratio(df: DataFrame) -> DataFrame:
    """Recompute the label from attendance and capacity."""
    return df.withColumn(
        "sell_through", numbers.guarded_ratio(F.col("attendance"), F.col("venue_capacity"))
    )

