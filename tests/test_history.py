"""Histories, pair history, trailing windows: golden rows, skew path, cross-checks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventlytics.operators import history, matchups, trailing
from tests.conftest import values

DAY = dt.date(2024, 1, 1)


def day(n):
    return None if n is None else DAY + dt.timedelta(days=n)


FIGHT = ("fight_id int, event_id string, event_date date, fighter1_name string, fighter2_name string, "
         "winner_name string, method_category string, is_title_fight boolean, weight_class string")
STAT = ("fight_id int, fighter_name string, sig_strikes_landed int, sig_strikes_attempted int, "
        "takedowns_landed int, takedowns_attempted int")


def test_prior_rates_of_one_entity(spark):
    fights = spark.createDataFrame(
        [(1, "e1", day(0), "A", "B", "A", "KO/TKO", True, "x"), (2, "e2", day(5), "C", "A", "C", "Decision", False, "x"),
         (3, "e3", day(9), "A", "D", None, "Other", False, "x"), (4, "e4", day(30), "A", "E", "A", "Submission", False, "x")],
        FIGHT,
    )
    stats = spark.createDataFrame([(1, "A", 5, 10, 0, 0), (1, "A", 5, 10, 1, 2), (2, "A", None, None, 0, 0)], STAT)
    out = history.fighter_features(fights, stats).filter("fighter_name = 'A'").orderBy("fight_id").collect()
    assert [r.win_rate_last5 for r in out] == [None, 1.0, 0.5, 0.5]
    assert [r.finish_rate_last5 for r in out] == pytest.approx([None, 1.0, 0.5, 1 / 3])
    assert [r.total_fights for r in out] == [0, 1, 2, 3]
    assert [r.days_off for r in out] == [None, 5, 4, 21]
    assert [r.strike_acc for r in out] == [None, 0.5, 0.5, 0.5]
    assert [r.title_fights for r in out] == [None, 1, 1, 1]
    assert [r.td_acc for r in out] == [None, 0.5, 0.5, 0.5]


def random_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        who = "hot" if rng.random() < 0.5 else rng.choice(["a", "b", "c", None])
        rows.append((i, who, day(rng.randrange(40)), rng.choice([0, 1, None]), rng.choice([None, 0.5, 1.5, 2.0])))
    return rows


SPECS = (
    history.Prior("n", "count"), history.Prior("total", "sum", "w"), history.Prior("mean", "avg", "x"),
    history.Prior("form", "avg", "w", 5), history.Prior("short", "avg", "x", 2), history.Prior("previous", "last", "d"),
    history.Prior("previous_w", "last", "w"),
)


@pytest.mark.parametrize("limit", [1, 3, 40, 10_000])
def test_hot_entities_equal_plain_windows(spark, limit):
    df = spark.createDataFrame(random_rows(300, limit), "i int, who string, d date, w int, x double")
    plain = history.prior_features(df, ["who"], ["d", "i"], SPECS, hot_rows=None)
    split = history.prior_features(df, ["who"], ["d", "i"], SPECS, hot_rows=limit)
    assert plain.columns == split.columns
    rounded = lambda f: f.withColumns({c: F.round(c, 9) for c in ("mean", "form", "short", "x")})
    assert values(rounded(plain)) == values(rounded(split))


def pair_history_self_join(fights):
    """Cross-check: equi join on the pair, earlier dates counted."""
    one, two = F.col("fighter1_name"), F.col("fighter2_name")
    pairs = fights.select("fight_id", F.least(one, two).alias("a"), F.greatest(one, two).alias("b"), "event_date")
    now, then = pairs.alias("now"), pairs.drop("fight_id").alias("then")
    earlier = now.join(then, ["a", "b"]).filter(F.col("then.event_date") < F.col("now.event_date"))
    return earlier.groupBy("fight_id").agg(F.count("*").alias("times_fought"))


def test_pair_history_counts_strictly_earlier_dates(spark):
    rows = [(1, "A", "B", day(0)), (2, "B", "A", day(5)), (3, "A", "B", day(9)), (4, "A", "B", day(9)), (5, "A", "B", None), (6, "A", "C", day(9))]
    fights = spark.createDataFrame(rows, "fight_id int, fighter1_name string, fighter2_name string, event_date date")
    out = matchups.pair_history(fights).orderBy("fight_id").collect()
    assert [r.times_fought for r in out] == [0, 1, 2, 2, 0, 0]
    assert [r.is_rivalry for r in out] == [0, 0, 1, 1, 0, 0]
    crossed = {r.fight_id: r.times_fought for r in pair_history_self_join(fights).collect()}
    assert [crossed.get(i, 0) for i in range(1, 7)] == [r.times_fought for r in out]


def test_matchups_do_not_multiply_on_namesakes(spark):
    fights = spark.createDataFrame([(1, "e", day(0), "A", "B", "A", "KO/TKO", True, "x")], FIGHT)
    fighters = spark.createDataFrame(
        [("f1", "A", 70, 72, day(-9000)), ("f2", "A", 60, 60, day(-1)), ("f3", "B", 75, None, day(-9365))],
        "fighter_id string, fighter_name string, height_inches int, reach_inches int, dob date",
    )
    rows = matchups.matchup_features(fights, fighters).collect()
    assert len(rows) == 1
    assert (rows[0].height_diff, rows[0].reach_diff) == (5, None)
    assert rows[0].age_diff == pytest.approx(365 / 365.25)


def test_trailing_windows_are_inclusive(spark):
    points = [("A", day(n), float(v)) for n, v in [(-31, 1), (-30, 2), (-8, 3), (-7, 4), (0, 6), (1, 100)]]
    series = trailing.daily_series(spark.createDataFrame(points, "who string, d date, v double"), "who", "d", "v")
    fights = spark.createDataFrame(
        [("A", "Z", day(0)), ("A", "Z", None)], "fighter1_name string, fighter2_name string, event_date date"
    )
    first, second = trailing.contest_buzz(fights, series).orderBy(F.col("event_date").asc_nulls_last()).collect()
    assert (first.f1_avg_search_7d, first.f1_avg_search_30d, first.f1_peak_search_7d, first.f1_trend_direction) == (5.0, 3.75, 6.0, 1)
    assert (first.f2_avg_search_7d, first.f2_avg_search_30d, first.f2_peak_search_7d, first.f2_trend_direction) == (25.0, 25.0, 30.0, 0)
    assert (first.combined_buzz_7d, first.max_peak_search, first.buzz_differential) == (30.0, 30.0, 20.0)
    assert (second.f1_avg_search_7d, second.f1_trend_direction) == (25.0, 0)


def test_direction_of_halves(spark):
    rows = [(0, [1.0, 2.0, 3.0, 4.0]), (1, [4.0, 3.0, 2.0, 1.0]), (2, [1.0, 2.0, 3.0]), (3, [1.0, 1.0, 1.0, 1.0]), (4, [1.0, 5.0, 1.0, 1.0, 8.0])]
    df = spark.createDataFrame(rows, "i int, a array<double>")
    out = df.select("i", trailing.trend_direction(F.col("a")).alias("d")).orderBy("i").collect()
    assert [r.d for r in out] == [1, -1, 0, -1, 1]


def test_days_since_previous_of_type(spark):
    rows = [("a", "PPV", day(0)), ("b", "PPV", day(7)), ("c", "TUF", day(8)), ("d", "PPV", day(7))]
    df = spark.createDataFrame(rows, "event_id string, event_type string, event_date date")
    for limit in (None, 1):
        out = history.days_since_previous(df, hot_rows=limit).orderBy("event_id").collect()
        assert [r.days_since_last for r in out] == [None, 7, None, 0]
