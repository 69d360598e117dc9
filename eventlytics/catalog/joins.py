"""Joins and record linkage."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlytics.catalog import views as v
from eventlytics.catalog.registry import query
from eventlytics.functions import text
from eventlytics.operators import linkage, matchups, rollup


@query(
    "j1_rollup_to_parent",
    v.with_(v.BOUTS, v.CARDS) + """SELECT c.event_id, b.num_fights FROM cards c LEFT JOIN
      (SELECT event_id, count(*) AS num_fights FROM bouts GROUP BY event_id) b USING (event_id)""",
)
def rollup_to_parent(spark, sf):
    counts = v.bouts(spark, sf).groupBy("event_id").agg(F.count("*").alias("num_fights"))
    return rollup.attach(v.cards(spark, sf), [counts]).select("event_id", "num_fights")


NORM = "regexp_replace(lower({}), '[^a-z0-9]', '', 'g')"


@query(
    "j2_two_name_keys",
    v.with_(v.BOUTS, v.ODDS, f"""best AS (
      SELECT * FROM (SELECT *, {NORM.format('upper(fighter1_name)')} AS k1, {NORM.format('fighter2_name')} AS k2,
        row_number() OVER (PARTITION BY fighter1_name, fighter2_name ORDER BY fight_id) AS rn FROM odds) WHERE rn = 1)""")
    + f"""SELECT b.fight_id, coalesce(o.fighter1_odds, 7) AS f1_closing_odds, coalesce(o.fighter2_odds, 7)
      AS f2_closing_odds FROM bouts b LEFT JOIN best o ON {NORM.format('b.fighter1_name')} = k1
      AND {NORM.format('b.fighter2_name')} = k2""",
)
def two_name_keys(spark, sf):
    lines = v.odds(spark, sf).withColumn("fighter1_name", F.upper("fighter1_name"))
    out = linkage.lookup_by_names(
        v.bouts(spark, sf), lines,
        {"fighter1_odds": "f1_closing_odds", "fighter2_odds": "f2_closing_odds"}, ["fight_id"],
    )
    return out.fillna(7, ["f1_closing_odds", "f2_closing_odds"]).select(
        "fight_id", "f1_closing_odds", "f2_closing_odds"
    )


@query(
    "j3_role_playing_dimension",
    v.with_(v.BOUTS, v.FIGHTERS) + """SELECT fight_id, a.height_inches AS h1, b.height_inches AS h2
    FROM bouts LEFT JOIN fighters a ON a.fighter_name = fighter1_name
    LEFT JOIN fighters b ON b.fighter_name = fighter2_name""",
)
def role_playing_dimension(spark, sf):
    df = matchups.role_join(
        v.bouts(spark, sf), v.fighters(spark, sf), "fighter_name",
        {"fighter1_name": "_1", "fighter2_name": "_2"}, ["height_inches"],
    )
    return df.select("fight_id", F.col("height_inches_1").alias("h1"), F.col("height_inches_2").alias("h2"))


KEYS = f"""keyed AS (SELECT *, {NORM.format('event_name')} AS name_key,
    nullif(regexp_extract(event_name, 'UFC\\s*(\\d+)', 1), '') AS number_key,
    CASE WHEN lower(event_name) LIKE 'ufc fight night%' THEN 'ufc fight night'
      WHEN lower(event_name) LIKE 'the ultimate fighter%' THEN 'the ultimate fighter'
      WHEN lower(event_name) LIKE 'ufc on fox%' THEN 'ufc on fox' END AS series_key FROM cards),
fed AS (SELECT *, {NORM.format('event_name')} AS name_key,
    nullif(regexp_extract(event_name, 'UFC\\s*(\\d+)', 1), '') AS number_key,
    CASE WHEN lower(event_name) LIKE 'ufc fight night%' THEN 'ufc fight night'
      WHEN lower(event_name) LIKE 'the ultimate fighter%' THEN 'the ultimate fighter'
      WHEN lower(event_name) LIKE 'ufc on fox%' THEN 'ufc on fox' END AS series_key
  FROM feed WHERE sell_through IS NOT NULL)"""
LINKS = v.with_(v.CARDS, v.LABELS, KEYS)
GAP = "abs(date_diff('day', l.event_date, k.event_date))"
ON = {
    "name_date": f"k.name_key = l.name_key AND {GAP} <= 1",
    "number": "k.number_key = l.number_key",
    "date": f"{GAP} <= 1",
    "type_date": f"k.series_key = l.series_key AND {GAP} <= 1",
}


def linked(*strategies: str) -> str:
    """All candidates ranked by (strategy, day gap or date, name, label); best per event."""
    parts = [
        f"""SELECT k.event_id, {i} AS rank, '{s}' AS strategy,
          {"epoch(l.event_date::TIMESTAMP)" if s == "number" else GAP} AS near, l.event_name AS label_name, l.sell_through
        FROM keyed k JOIN fed l ON {ON[s]}"""
        for i, s in enumerate(strategies)
    ]
    return LINKS + ", candidates AS (" + " UNION ALL ".join(parts) + """)
      SELECT event_id, strategy, sell_through FROM (SELECT *, row_number() OVER (PARTITION BY event_id
        ORDER BY rank, near, label_name NULLS FIRST, sell_through) AS rn FROM candidates) WHERE rn = 1"""


def _link(spark, sf, *strategies):
    return linkage.link_labels(v.cards(spark, sf), v.labels(spark, sf), strategies=strategies).select(
        "event_id", "strategy", "sell_through"
    )


@query("j5_name_and_near_date", linked("name_date"))
def name_and_near_date(spark, sf):
    return _link(spark, sf, "name_date")


@query(
    "j5_interval_join",
    LINKS + f"""SELECT k.event_id, count(l.sell_through) AS matches, min(l.sell_through) AS lowest,
      max(l.sell_through) AS highest FROM keyed k LEFT JOIN fed l ON {ON['name_date']} GROUP BY k.event_id""",
)
def interval_join(spark, sf):
    left = linkage.with_match_keys(v.cards(spark, sf)).select("event_id", "event_date", "name_key")
    feed = linkage.with_match_keys(v.labels(spark, sf).filter("sell_through IS NOT NULL"))
    found = linkage.interval_matches(
        left, feed.select("name_key", "event_date", "sell_through"), "name_key", "sell_through"
    )
    return found.select("event_id", "matches", "lowest", "highest")


@query("j6_near_date", linked("date"))
def near_date(spark, sf):
    return _link(spark, sf, "date")


@query("j7_series_and_near_date", linked("type_date"))
def series_and_near_date(spark, sf):
    return _link(spark, sf, "type_date")


@query(
    "j8_unmatched",
    LINKS + f"""SELECT event_id, event_name FROM keyed WHERE event_id NOT IN
      (SELECT k.event_id FROM keyed k JOIN fed l ON {ON['name_date']})""",
)
def unmatched(spark, sf):
    events = v.cards(spark, sf)
    found = linkage.link_labels(events, v.labels(spark, sf), strategies=["name_date"])
    return linkage.unmatched(events, found).select("event_id", "event_name")


@query("j8_series_for_unmatched", linked("name_date", "type_date"))
def series_for_unmatched(spark, sf):
    return _link(spark, sf, "name_date", "type_date")


@query("j9_number", linked("number"))
def number(spark, sf):
    return _link(spark, sf, "number")


@query("j10_linkage_cascade", linked("name_date", "number", "date", "type_date"))
def linkage_cascade(spark, sf):
    return _link(spark, sf, *linkage.STRATEGIES)


@query(
    "j11_full_outer_counts",
    """SELECT coalesce(a.k, b.k) AS nation, coalesce(a.n, 0) AS customers, coalesce(b.n, 0) AS suppliers
    FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1) a
    FULL JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) b ON a.k = b.k""",
)
def full_outer_counts(spark, sf):
    a = v.table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(
        F.count("*").alias("customers")
    )
    b = v.table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(
        F.count("*").alias("suppliers")
    )
    return a.join(b, "nation", "outer").fillna(0, ["customers", "suppliers"])


@query(
    "j14_child_to_parent_id",
    v.with_(v.BOUTS) + """SELECT l_orderkey, l_linenumber, l_suppkey, fight_id FROM lineitem
      LEFT JOIN bouts ON 'order_' || l_orderkey = 'order_' || fight_id""",
)
def child_to_parent_id(spark, sf):
    parents = v.bouts(spark, sf).select(
        text.composite_key(F.lit("order"), F.col("fight_id").cast("string")).alias("fight_key"), "fight_id"
    )
    children = v.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        text.composite_key(F.lit("order"), F.col("l_orderkey").cast("string")).alias("fight_key"),
    )
    return children.join(parents, "fight_key", "left").drop("fight_key")


@query(
    "j16_natural_merge",
    """SELECT a.k, a.s, a.x, b.y FROM (SELECT o_orderkey AS k, nullif(o_orderstatus, 'P') AS s, o_totalprice AS x FROM orders) a
    JOIN (SELECT o_orderkey AS k, nullif(o_orderstatus, 'P') AS s, o_custkey AS y FROM orders) b
    ON a.k = b.k AND a.s IS NOT DISTINCT FROM b.s""",
)
def natural_merge(spark, sf):
    base = v.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), F.nullif("o_orderstatus", F.lit("P")).alias("s"), "o_totalprice", "o_custkey"
    )
    a = base.select("k", "s", F.col("o_totalprice").alias("x"))
    b = base.select("k", "s", F.col("o_custkey").alias("y"))
    return matchups.natural_join(a, b)


@query(
    "j17_merge_on_name",
    v.with_(v.CARDS, v.LABELS) + f"""SELECT event_id, sell_through FROM cards c LEFT JOIN (
      SELECT * FROM (SELECT *, {NORM.format('event_name')} AS k, row_number() OVER (PARTITION BY
        {NORM.format('event_name')} ORDER BY event_date, sell_through) AS rn FROM feed) WHERE rn = 1) l
      ON {NORM.format('c.event_name')} = l.k""",
)
def merge_on_name(spark, sf):
    out = linkage.lookup_by_name(
        v.cards(spark, sf), v.labels(spark, sf), "event_name", {"sell_through": "sell_through"},
        [F.col("event_date"), F.col("sell_through").asc_nulls_last()],
    )
    return out.select("event_id", "sell_through")


@query(
    "p35_source_projection",
    v.with_(v.SIDES, v.ODDS) + f"""SELECT fight_id, {NORM.format('fighter1_name')} AS f1_name_norm,
      {NORM.format('fighter2_name')} AS f2_name_norm, fighter1_odds AS f1_closing_odds,
      fighter2_odds AS f2_closing_odds, fighter1_odds % 2 = 1 AS is_competitive FROM odds""",
)
def source_projection(spark, sf):
    from eventlytics.plans.features import source_columns

    df = v.odds(spark, sf).withColumn("is_competitive_matchup", F.col("fighter1_odds") % 2)
    out = source_columns(df, {"fighter1_odds": "f1_closing_odds", "fighter2_odds": "f2_closing_odds"},
                         flags={"is_competitive_matchup": "is_competitive"}, keep=["fight_id"])
    return out
