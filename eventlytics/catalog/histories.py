"""Histories, pair history, layoffs and trailing series."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlytics.catalog import views as v
from eventlytics.catalog.registry import query
from eventlytics.operators import history, matchups, trailing
from eventlytics.operators.scale import shared_checkpoint

APPEARANCES = """appearances AS (
  SELECT fight_id, event_id, event_date, fighter1_name AS fighter_name, winner_name, method_category,
    is_title_fight, weight_class FROM bouts
  UNION ALL
  SELECT fight_id, event_id, event_date, fighter2_name, winner_name, method_category,
    is_title_fight, weight_class FROM bouts),
scored AS (
  SELECT *, CAST(fighter_name = winner_name AS INTEGER) AS won,
    CASE WHEN fighter_name = winner_name AND method_category IN ('KO/TKO', 'Submission') THEN 1 ELSE 0 END
      AS finished FROM appearances),
totals AS (
  SELECT fight_id, fighter_name, CAST(sum(sig_strikes_landed) AS BIGINT) AS sl,
    CAST(sum(sig_strikes_attempted) AS BIGINT) AS sa, CAST(sum(takedowns_landed) AS BIGINT) AS tl,
    CAST(sum(takedowns_attempted) AS BIGINT) AS ta FROM stats GROUP BY ALL)"""

HISTORY = """history AS (
  SELECT s.*, t.sl, t.sa, t.tl, t.ta,
    avg(won) OVER last5 AS win_rate_last5, avg(finished) OVER last5 AS finish_rate_last5,
    count(*) OVER past AS total_fights,
    CAST(date_diff('day', lag(event_date) OVER seq, event_date) AS INTEGER) AS days_off,
    avg(CASE WHEN sa > 0 THEN sl / sa END) OVER past AS strike_acc,
    avg(CASE WHEN ta > 0 THEN tl / ta END) OVER past AS td_acc,
    CAST(sum(CAST(is_title_fight AS INTEGER)) OVER past AS BIGINT) AS title_fights
  FROM scored s LEFT JOIN totals t USING (fight_id, fighter_name)
  WINDOW seq AS (PARTITION BY fighter_name ORDER BY event_date, fight_id),
    last5 AS (PARTITION BY fighter_name ORDER BY event_date, fight_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING),
    past AS (PARTITION BY fighter_name ORDER BY event_date, fight_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""

FULL = v.with_(v.BOUTS, v.STATS, APPEARANCES, HISTORY)


def r6(*names):
    return [F.round(n, 6).alias(n) for n in names]


@query(
    "w_entity_history",
    FULL + """SELECT fight_id, event_id, event_date, fighter_name, round(win_rate_last5, 6) AS win_rate_last5,
    round(finish_rate_last5, 6) AS finish_rate_last5, total_fights, days_off,
    round(strike_acc, 6) AS strike_acc, round(td_acc, 6) AS td_acc, title_fights, weight_class
  FROM history""",
)
def entity_history(spark, sf):
    out = history.fighter_features(shared_checkpoint(v.bouts(spark, sf)), v.stats(spark, sf))
    rates = ("win_rate_last5", "finish_rate_last5", "strike_acc", "td_acc")
    return out.withColumns({n: F.round(n, 6) for n in rates})


def _windows(spark, sf, *specs):
    rows = history.appearances(v.bouts(spark, sf))
    rows = rows.withColumn("title_", F.col("is_title_fight").cast("int"))
    return history.prior_features(rows, ["fighter_name"], ["event_date", "fight_id"], specs)


@query(
    "w1_rolling_rates",
    FULL + """SELECT fight_id, fighter_name, round(win_rate_last5, 6) AS win_rate_last5,
    round(finish_rate_last5, 6) AS finish_rate_last5 FROM history""",
)
def rolling_rates(spark, sf):
    return _windows(
        spark, sf,
        history.Prior("win_rate_last5", "avg", "won", 5),
        history.Prior("finish_rate_last5", "avg", "finished", 5),
    ).select("fight_id", "fighter_name", *r6("win_rate_last5", "finish_rate_last5"))


@query(
    "w2_career_to_date",
    FULL + "SELECT fight_id, fighter_name, total_fights, title_fights FROM history",
)
def career_to_date(spark, sf):
    return _windows(
        spark, sf, history.Prior("total_fights", "count"), history.Prior("title_fights", "sum", "title_")
    ).select("fight_id", "fighter_name", "total_fights", "title_fights")


@query("w3_layoff_days", FULL + "SELECT fight_id, fighter_name, days_off FROM history")
def layoff_days(spark, sf):
    return _windows(spark, sf, history.Prior("last_", "last", "event_date")).select(
        "fight_id", "fighter_name", F.datediff("event_date", "last_").alias("days_off")
    )


@query(
    "w4_days_since_same_type",
    v.with_(v.CARDS) + """SELECT event_id, event_type, CAST(date_diff('day',
    lag(event_date) OVER (PARTITION BY event_type ORDER BY event_date, event_id), event_date) AS INTEGER)
    AS days_since_last FROM cards""",
)
def days_since_same_type(spark, sf):
    return history.days_since_previous(v.cards(spark, sf)).select(
        "event_id", "event_type", "days_since_last"
    )


@query(
    "w6_two_sided_unpivot",
    v.with_(v.BOUTS, v.STATS, APPEARANCES)
    + "SELECT fight_id, event_id, fighter_name, won, finished FROM scored",
)
def two_sided_unpivot(spark, sf):
    return history.appearances(v.bouts(spark, sf)).select(
        "fight_id", "event_id", "fighter_name", "won", "finished"
    )


PAIRS = """paired AS (
  SELECT *, least(fighter1_name, fighter2_name) AS pair1, greatest(fighter1_name, fighter2_name) AS pair2
  FROM bouts),
met AS (
  SELECT a.fight_id, count(b.event_date) AS times_fought FROM paired a LEFT JOIN paired b
    ON a.pair1 = b.pair1 AND a.pair2 = b.pair2 AND b.event_date < a.event_date GROUP BY a.fight_id)"""


@query(
    "p20_pair_key",
    v.with_(v.BOUTS, PAIRS) + "SELECT fight_id, pair1, pair2 FROM paired",
)
def pair_key(spark, sf):
    from eventlytics.functions.text import pair_high, pair_low

    one, two = F.col("fighter1_name"), F.col("fighter2_name")
    return v.bouts(spark, sf).select(
        "fight_id", pair_low(one, two).alias("pair1"), pair_high(one, two).alias("pair2")
    )


@query(
    "j4_pair_history",
    v.with_(v.BOUTS, PAIRS) + """SELECT fight_id, times_fought, CAST(times_fought > 0 AS INTEGER) AS is_rematch,
    CAST(times_fought >= 2 AS INTEGER) AS is_rivalry FROM met""",
)
def pair_history(spark, sf):
    return matchups.pair_history(v.bouts(spark, sf)).select(
        "fight_id", "times_fought", "is_rematch", "is_rivalry"
    )


@query(
    "a10_rematch_counts",
    v.with_(v.BOUTS, PAIRS) + """SELECT times_fought, count(*) AS fights FROM met GROUP BY times_fought""",
)
def rematch_counts(spark, sf):
    return matchups.pair_history(v.bouts(spark, sf)).groupBy("times_fought").agg(
        F.count("*").alias("fights")
    )


MATCHUPS = """matchups AS (
  SELECT b.fight_id, b.event_id, b.fighter1_name, b.fighter2_name,
    CAST(m.times_fought > 0 AS INTEGER) AS is_rematch, CAST(m.times_fought >= 2 AS INTEGER) AS is_rivalry,
    b.is_title_fight, abs(f1.reach_inches - f2.reach_inches) AS reach_diff,
    abs(f1.height_inches - f2.height_inches) AS height_diff,
    abs(date_diff('day', f1.dob, b.event_date) - date_diff('day', f2.dob, b.event_date)) / 365.25 AS age_diff
  FROM bouts b JOIN met m USING (fight_id)
  LEFT JOIN fighters f1 ON f1.fighter_name = b.fighter1_name
  LEFT JOIN fighters f2 ON f2.fighter_name = b.fighter2_name)"""


@query(
    "j3_matchup_features",
    v.with_(v.BOUTS, PAIRS, v.FIGHTERS, MATCHUPS) + """SELECT fight_id, event_id, fighter1_name, fighter2_name,
    is_rematch, is_rivalry, is_title_fight, reach_diff, height_diff, round(age_diff, 6) AS age_diff FROM matchups""",
)
def matchup_features(spark, sf):
    out = matchups.matchup_features(v.bouts(spark, sf), v.fighters(spark, sf))
    return out.withColumn("age_diff", F.round("age_diff", 6))


@query(
    "p32_differentials",
    v.with_(v.BOUTS, PAIRS, v.FIGHTERS, MATCHUPS)
    + "SELECT fight_id, reach_diff, height_diff, round(age_diff, 6) AS age_diff FROM matchups",
)
def differentials(spark, sf):
    df = matchups.role_join(
        v.bouts(spark, sf).select("fight_id", "event_date", "fighter1_name", "fighter2_name"),
        matchups.unique_entities(v.fighters(spark, sf)), "fighter_name",
        {"fighter1_name": "_1", "fighter2_name": "_2"}, ["height_inches", "reach_inches", "dob"],
    )
    from eventlytics.functions.dates import years_between

    return df.select(
        "fight_id",
        F.abs(F.col("reach_inches_1") - F.col("reach_inches_2")).alias("reach_diff"),
        F.abs(F.col("height_inches_1") - F.col("height_inches_2")).alias("height_diff"),
        F.round(years_between(F.col("dob_1"), F.col("dob_2")), 6).alias("age_diff"),
    )


# -- trailing series --------------------------------------------------------

# contests between users: consecutive users of one event type on one day
FOCAL = """focal AS (
  SELECT event_id AS fight_id, user_id AS fighter1_name, user_id + 1 + event_id % 3 AS fighter2_name,
    CAST(ts AS DATE) + CAST(event_id % 9 AS INTEGER) AS event_date FROM events),
asked AS (SELECT fighter1_name AS entity, event_date AS day FROM focal
  UNION SELECT fighter2_name, event_date FROM focal),
near AS (
  SELECT a.entity, a.day, s.day AS at_, s.total_, s.points_, s.peak_,
    row_number() OVER (PARTITION BY a.entity, a.day ORDER BY s.day) AS pos,
    count(*) OVER (PARTITION BY a.entity, a.day) AS n
  FROM asked a JOIN series s ON s.entity = a.entity AND s.day BETWEEN a.day - 30 AND a.day),
buzz AS (
  SELECT entity, day,
    sum(total_) FILTER (WHERE at_ >= day - 7) / sum(points_) FILTER (WHERE at_ >= day - 7) AS avg_7d,
    sum(total_) / sum(points_) AS avg_30d, max(peak_) FILTER (WHERE at_ >= day - 7) AS peak_7d,
    CASE WHEN max(n) < 4 THEN 0
      WHEN avg(total_ / points_) FILTER (WHERE pos > n // 2) > avg(total_ / points_) FILTER (WHERE pos <= n // 2) THEN 1
      ELSE -1 END AS direction
  FROM near GROUP BY entity, day),
filled AS (
  SELECT a.entity, a.day, coalesce(avg_7d, 25) AS avg_7d, coalesce(avg_30d, 25) AS avg_30d,
    coalesce(peak_7d, 30) AS peak_7d, coalesce(direction, 0) AS direction
  FROM asked a LEFT JOIN buzz USING (entity, day))"""


def focal(spark, sf):
    key = F.col("event_id")
    return v.table(spark, sf, "events").select(
        key.alias("fight_id"),
        F.col("user_id").alias("fighter1_name"),
        (F.col("user_id") + 1 + key % 3).alias("fighter2_name"),
        F.date_add(F.to_date("ts"), (key % 9).cast("int")).alias("event_date"),
    )


def series(spark, sf):
    points = v.table(spark, sf, "events").withColumn("day_", F.to_date("ts"))
    return trailing.daily_series(points, "user_id", "day_", "value")


@query(
    "j15_trailing_buzz",
    v.with_(v.SERIES, FOCAL) + """SELECT f.fight_id, f.fighter1_name, f.fighter2_name, f.event_date,
    round(a.avg_7d, 8) AS f1_avg_search_7d, round(a.avg_30d, 8) AS f1_avg_search_30d,
    a.peak_7d AS f1_peak_search_7d, a.direction AS f1_trend_direction,
    round(b.avg_7d, 8) AS f2_avg_search_7d, round(b.avg_30d, 8) AS f2_avg_search_30d,
    b.peak_7d AS f2_peak_search_7d, b.direction AS f2_trend_direction,
    round(a.avg_7d + b.avg_7d, 8) AS combined_buzz_7d, round(a.avg_30d + b.avg_30d, 8) AS combined_buzz_30d,
    greatest(a.peak_7d, b.peak_7d) AS max_peak_search, round(abs(a.avg_7d - b.avg_7d), 8) AS buzz_differential
  FROM focal f JOIN filled a ON a.entity = f.fighter1_name AND a.day = f.event_date
  JOIN filled b ON b.entity = f.fighter2_name AND b.day = f.event_date""",
)
def trailing_buzz(spark, sf):
    out = trailing.contest_buzz(focal(spark, sf), series(spark, sf))
    rounded = [c for c in out.columns if "avg_search" in c or "buzz" in c]
    return out.withColumns({c: F.round(c, 8) for c in rounded})


@query(
    "w5_trend_direction",
    v.with_(v.SERIES, FOCAL) + "SELECT entity, day, direction FROM filled",
)
def trend_direction(spark, sf):
    sides = focal(spark, sf).select(
        F.explode(F.array("fighter1_name", "fighter2_name")).alias("entity"), F.col("event_date").alias("day")
    )
    return trailing.trailing_features(series(spark, sf), sides).select("entity", "day", "direction")
