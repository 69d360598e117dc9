"""Contest scores, card selection, estimates and validity."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlytics.catalog import views as v
from eventlytics.catalog.registry import query
from eventlytics.operators import cards, scale

CANDIDATES = v.BOUTS + """, candidates AS (
  SELECT strftime(event_date, '%Y-%m') AS card, fight_id, fighter1_name AS name1, fighter2_name AS name2,
    CASE WHEN fight_id % 10 <> 0 THEN (fight_id % 101) / 101 END AS win_rate1, (fight_id % 89) / 89 AS win_rate2,
    CASE WHEN fight_id % 9 <> 0 THEN CAST(fight_id % 31 AS INTEGER) END AS total_fights1,
    CAST(fight_id % 23 AS INTEGER) AS total_fights2,
    CASE WHEN fight_id % 8 <> 0 THEN (fight_id % 67) / 67 END AS finish_rate1, (fight_id % 71) / 71 AS finish_rate2,
    weight_class, is_title_fight AS is_title FROM bouts),
sided AS (SELECT *, coalesce(win_rate1, 0.5::DOUBLE) AS w1, coalesce(finish_rate1, 0.3::DOUBLE) AS f1,
  coalesce(total_fights1, 0) AS n1 FROM candidates),
scored AS (SELECT *, (w1 + win_rate2) * 0.2::DOUBLE
    + (least(n1 / 20, 1.0::DOUBLE) + least(total_fights2 / 20, 1.0::DOUBLE)) * 0.15::DOUBLE
    + (f1 + finish_rate2) * 0.15::DOUBLE + CASE WHEN is_title THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END
    + (1 - abs(w1 - win_rate2)) * 0.1::DOUBLE + 0.1::DOUBLE AS score FROM sided)"""


def candidates(spark, sf):
    """Contests of a month compete for places on that month's card."""
    key = F.col("fight_id")
    return v.bouts(spark, sf).select(
        F.date_format("event_date", "yyyy-MM").alias("card"), "fight_id",
        F.col("fighter1_name").alias("name1"), F.col("fighter2_name").alias("name2"),
        F.when(key % 10 != 0, key % 101 / 101).alias("win_rate1"), (key % 89 / 89).alias("win_rate2"),
        F.when(key % 9 != 0, (key % 31).cast("int")).alias("total_fights1"),
        (key % 23).cast("int").alias("total_fights2"),
        F.when(key % 8 != 0, key % 67 / 67).alias("finish_rate1"), (key % 71 / 71).alias("finish_rate2"),
        "weight_class", F.col("is_title_fight").alias("is_title"),
    )


@query("o1_contest_score", v.with_(CANDIDATES) + "SELECT card, fight_id, round(score, 6) AS score FROM scored")
def contest_score(spark, sf):
    return cards.score_candidates(candidates(spark, sf)).select(
        "card", "fight_id", F.round("score", 6).alias("score")
    )


GREEDY = "WITH RECURSIVE " + CANDIDATES + """,
ranked AS MATERIALIZED (SELECT card, fight_id, name1, name2, row_number() OVER (PARTITION BY card
  ORDER BY score DESC, fight_id) AS rn FROM scored),
walk AS (
  SELECT DISTINCT card, 0::BIGINT AS rn, []::VARCHAR[] AS used, []::BIGINT[] AS picked FROM ranked
  UNION ALL
  SELECT w.card, r.rn,
    CASE WHEN list_contains(used, name1) OR list_contains(used, name2) THEN used
      ELSE list_concat(used, [name1, name2]) END,
    CASE WHEN list_contains(used, name1) OR list_contains(used, name2) THEN picked
      ELSE list_append(picked, fight_id) END
  FROM walk w JOIN ranked r ON r.card = w.card AND r.rn = w.rn + 1 WHERE len(picked) < 14),
chosen AS (SELECT card, unnest(arg_max(picked, rn)) AS fight_id FROM walk GROUP BY card)
"""


@query("o2_greedy_cards", GREEDY + "SELECT card, fight_id FROM chosen")
def greedy_cards(spark, sf):
    scored = scale.shared_checkpoint(cards.score_candidates(candidates(spark, sf)))
    return cards.greedy_cards(scored).select("card", "fight_id")


LOW = GREEDY.replace("(fight_id % 101) / 101", "(fight_id % 101) / 1010").replace("(fight_id % 89) / 89", "(fight_id % 89) / 890")


def _low(spark, sf):
    """Contests with low win rates."""
    rates = ("win_rate1", "win_rate2")
    return candidates(spark, sf).withColumns({c: F.col(c) / 10 for c in rates})


def _improved(spark, sf):
    """(greedy, improved) cards of contests with low win rates."""
    scored = scale.shared_checkpoint(cards.score_candidates(_low(spark, sf)))
    greedy = scale.shared_checkpoint(cards.greedy_cards(scored))
    return greedy, scale.shared_checkpoint(cards.improve_cards(scored, greedy))


@query("o3_improved_cards", LOW + """SELECT card, count(*) AS num_fights, false AS has_repeat, true AS not_below,
  true AS settled FROM chosen GROUP BY card""")
def improved_cards(spark, sf):
    """Cards of contests with low win rates, so that many estimates can rise.

    Improvement swaps one for one: sizes stay as the greedy walk left them, no
    entity comes twice and no estimate falls.
    """
    greedy, better = _improved(spark, sf)
    before = cards.card_estimates(greedy, greedy).select("card", F.col("sell_through").alias("before"))
    after = cards.card_estimates(better, better).select("card", "num_fights", "sell_through")
    repeats = cards.card_validity(better).select("card", "has_repeat")
    settled = better.groupBy("card").agg(F.min("settled").alias("settled"))
    return after.join(before, "card").join(repeats, "card").join(settled, "card").select(
        "card", "num_fights", "has_repeat", (F.col("sell_through") >= F.col("before") - 1e-9).alias("not_below"), "settled"
    )


#: The search starts from the worst cards and is ended after so many rounds.
SWAP_ROUNDS = 6
POOR = LOW.replace("ORDER BY score DESC, fight_id) AS rn", "ORDER BY score, fight_id) AS rn").replace(
    "(fight_id % 67) / 67", "(fight_id % 67) / 670").replace("(fight_id % 71) / 71", "(fight_id % 71) / 710")
BETTER = POOR.rstrip() + """, whole AS MATERIALIZED (SELECT card, fight_id, name1, name2, weight_class, is_title, score - 0.1 AS base FROM scored),
start AS (SELECT card, list({'score': base + 0.1, 'fight_id': fight_id, 'name1': name1, 'name2': name2,
    'class': weight_class, 'title': CAST(is_title AS INTEGER)} ORDER BY base DESC, fight_id) AS ms
  FROM whole JOIN chosen USING (card, fight_id) GROUP BY card),
steps AS (
  SELECT card, 0 AS round, ms FROM start
  UNION ALL
  SELECT card, round + 1, list_concat(any_value(ms)[:min(spot) - 1], [arg_min(newcomer, spot * 1000000000 + fight_id)], any_value(ms)[min(spot) + 1:])
  FROM (
    SELECT *, base + CASE WHEN list_contains(list_transform(rest, lambda m: m.class), weight_class) THEN 0 ELSE 0.1 END AS score,
      {'score': score, 'fight_id': fight_id, 'name1': name1, 'name2': name2, 'class': weight_class,
       'title': CAST(is_title AS INTEGER)} AS newcomer
    FROM (SELECT s.*, c.* EXCLUDE (card), t.spot, list_concat(ms[:spot - 1], ms[spot + 1:]) AS rest
      FROM steps s JOIN whole c USING (card), range(1, 15) AS t(spot) WHERE spot <= len(ms))
    WHERE NOT list_contains(list_transform(ms, lambda m: m.fight_id), fight_id)
      AND NOT list_has_any(list_concat(list_transform(rest, lambda m: m.name1), list_transform(rest, lambda m: m.name2)), [name1, name2]))
  WHERE round < 6 AND len(ms) BETWEEN 10 AND 14 AND len(list_distinct(list_append(list_transform(rest, lambda m: m.class), weight_class))) >= 3
    AND least(1.0, 0.75 + least((list_sum(list_transform(rest, lambda m: m.score)) + score) / 15, 0.25)
        + (list_sum(list_transform(rest, lambda m: m.title)) + CAST(is_title AS INTEGER)) * 0.02)
      > least(1.0, 0.75 + least(list_sum(list_transform(ms, lambda m: m.score)) / 15, 0.25)
        + list_sum(list_transform(ms, lambda m: m.title)) * 0.02) + 0.001
  GROUP BY card, round),
last AS (SELECT card, round, unnest(ms) AS m FROM steps QUALIFY round = max(round) OVER (PARTITION BY card))
SELECT card, m.fight_id AS fight_id, round(m.score, 6) AS score, CAST(round AS BIGINT) AS swaps FROM last"""


@query("o3_chosen_contests", BETTER)
def chosen_contests(spark, sf):
    """The contests of every card after some rounds of improvement, their scores on it, and how often it was changed."""
    low = _low(spark, sf).withColumns({c: F.col(c) / 10 for c in ("finish_rate1", "finish_rate2")})
    needed = ["card", "fight_id", "name1", "name2", "weight_class", "is_title", "base", "score"]
    scored = scale.shared_checkpoint(cards.score_candidates(low).select(needed))
    poor = cards.greedy_cards(scored.withColumn("score", -F.col("score"))).withColumn("score", -F.col("score"))
    better = cards.improve_cards(scored, scale.shared_checkpoint(poor), max_rounds=SWAP_ROUNDS)
    return better.select("card", "fight_id", F.round("score", 6).alias("score"), "swaps")


PICKED = ", picked AS (SELECT s.* FROM scored s JOIN chosen USING (card, fight_id))"


def picked(spark, sf):
    """The contests chosen for each month's card."""
    return cards.greedy_cards(scale.shared_checkpoint(cards.score_candidates(candidates(spark, sf))))


@query(
    "o4_card_estimate",
    GREEDY.rstrip() + PICKED + """SELECT card, num_fights, round(s, 6) AS sell_through,
      CAST(floor(s * 20000) AS BIGINT) AS attendance
    FROM (SELECT card, count(*) AS num_fights, greatest(0.5, least(1.0, 0.75 + least(sum(score) / 15, 0.25)
      + sum(CAST(is_title AS INTEGER)) * 0.02)) AS s FROM picked GROUP BY card)""",
)
def card_estimate(spark, sf):
    chosen = scale.shared_checkpoint(picked(spark, sf))
    return cards.card_estimates(chosen, chosen).withColumn("sell_through", F.round("sell_through", 6))


@query(
    "o5_card_validity",
    GREEDY.rstrip() + PICKED + """SELECT card, num_fights, num_classes, has_repeat,
      num_fights BETWEEN 10 AND 14 AND num_classes >= 3 AND NOT has_repeat AS is_valid
    FROM (SELECT card, count(*) AS num_fights, count(DISTINCT weight_class) AS num_classes FROM picked GROUP BY card)
    JOIN (SELECT card, max(n) > 1 AS has_repeat FROM (SELECT card, name, count(*) AS n FROM (
        SELECT card, name1 AS name FROM picked UNION ALL SELECT card, name2 FROM picked) GROUP BY ALL) GROUP BY card)
      USING (card)""",
)
def card_validity(spark, sf):
    return cards.card_validity(scale.shared_checkpoint(picked(spark, sf)))
