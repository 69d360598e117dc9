"""All stages on a small folder of raw files."""

import csv
import datetime as dt
import random

import pytest

from eventlytics.plans import etl, features, network, sources, training
from eventlytics.sources import files, schemas


def write(folder, name, header, rows):
    folder.mkdir(parents=True, exist_ok=True)
    with open(folder / f"{name}.csv", "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(rows)


@pytest.fixture(scope="module")
def data(tmp_path_factory):
    rng = random.Random(5)
    root = tmp_path_factory.mktemp("data")
    people = [f"Person {c}" for c in "ABCDEFGHIJKLMNOPQRST"]
    events, results, stats, att, odds, sent = [], [], [], [], [], []
    for i in range(80):
        day = dt.date(2019, 1, 5) + dt.timedelta(days=28 * i)
        name = f"UFC {200 + i}: Test {i}" if i % 2 else f"UFC Fight Night: Test {i}"
        place = ["Las Vegas, Nevada, USA", "London, England", "Berlin"][i % 3]
        events.append((name, f"http://h/event-details/e{i}", f"{day:%B} {day.day}, {day.year}", place))
        card = rng.sample(people, 12)
        for k in range(6):
            a, b = card[2 * k], card[2 * k + 1]
            bout = f"{a} vs. {b}"
            results.append((name, bout, rng.choice(["W/L", "L/W", "D/D"]), "UFC Lightweight Title Bout" if k == 0 else "Welterweight Bout",
                            rng.choice(["KO/TKO", "Submission", "Decision - Split"]), "3", "4:51", "3 Rnd", "R", "x", f"http://h/fight-details/f{i}_{k}"))
            odds.append((a, b, -150, 130, 0.6, 0.4348, 0, 0, 0, 0, 0.1652, name, "t", 1, 0, 0, 0))
            for who in (a, b):
                for r in (1, 2):
                    stats.append((name, bout, f"Round {r}", who, "0.0", "19 of 32", "59%", "20 of 40", "1 of 2", "50%", "0", "0", "1:00") + ("1 of 1",) * 6)
        att.append((name, day + dt.timedelta(days=i % 2), "V", place, 9000, 1.0, 10000, round(0.7 + rng.random() / 4, 3), "", "t"))
        sent.append((name, 0.1, 0.2, -1.0, 1.0, 0.6, 500, 5.0, 9, 100, 2.0, 0.5, "Neutral"))
    write(root / "raw", "events", schemas.RAW["events"], events)
    write(root / "raw", "fight_results", schemas.RAW["fight_results"], results)
    write(root / "raw", "fight_stats", schemas.RAW["fight_stats"], stats)
    write(root / "raw", "fighter_tott", schemas.RAW["fighter_tott"],
          [(p, "5' 11\"", "155 lbs.", "72\"", "Orthodox", "Jul 3, 1983", f"http://h/fighter-details/{i}") for i, p in enumerate(people)])
    write(root / "external", "attendance", schemas.RAW["attendance"], att)
    names = lambda t: [c.strip().split()[0] for c in schemas.EXTERNAL[t].split(",")]
    write(root / "external", "betting_odds", names("betting_odds"), odds)
    write(root / "external", "event_sentiment", names("event_sentiment"), sent)
    return root


def test_stages(spark, data):
    root = str(data)
    etl.run(spark, root, root)
    fights = files.read_parquet(spark, f"{root}/processed/fights")
    assert fights.count() == 480 and fights.filter("event_id IS NULL").count() == 0
    assert {r.weight_class for r in fights.select("weight_class").distinct().collect()} == {"Lightweight", "Welterweight"}
    stats = files.read_parquet(spark, f"{root}/processed/fight_stats")
    assert {"sig_str", "sig_str_pct", "td_pct", "round"} <= set(stats.columns)
    assert stats.count() == 1920 and stats.filter("fight_id IS NULL OR sig_strikes_landed <> 19").count() == 0

    network.run(spark, root, root)
    nodes = files.read_parquet(spark, f"{root}/features/graph_features")
    assert nodes.count() == 20
    etl.enrich(spark, root, root)
    rich = files.read_parquet(spark, f"{root}/processed/fights_enriched")
    assert rich.count() == 480 and rich.filter("combined_pagerank <= 0 OR f1_closing_odds IS NULL").count() == 0

    features.run(spark, root, root)
    table = files.read_parquet(spark, f"{root}/features/event_features")
    assert table.count() == 80
    last = table.orderBy(table.event_date.desc()).first()
    assert (last.num_fights, last.num_title_fights, last.has_title) == (6, 1, 1)
    assert last.avg_exp > 30 and last.avg_betting_spread == pytest.approx(0.1652) and last.reddit_comments == 100

    metrics = training.run(spark, root, root, test_year=2023, validate=False, maxIter=3, maxDepth=3).first()
    assert metrics.test_size > 10 and metrics.rmse > 0
    folds, summary = training.rolling(spark, root, (2022, 2023), maxIter=2, maxDepth=2)
    assert folds.count() == 2 and summary.first().stability in ("stable", "moderate", "unstable")
    training.summaries(spark, root, root)
    boxes = files.read_csv(spark, f"{root}/summaries/by_title").collect()
    assert [r.title for r in boxes] == ["Has Title Fight"] and boxes[0].n == "80"


def test_label_merge(spark, data, tmp_path):
    other = spark.createDataFrame([("UFC 201: Test 1", dt.date(2019, 2, 3), 1, "page"), ("New", dt.date(2030, 1, 1), 2, "page")],
                                  "event_name string, event_date date, attendance int, source string")
    out = etl.merge_sources(spark, str(data / "external" / "attendance.csv"), str(tmp_path / "m"), [other])
    assert out.count() == 81
    assert files.read_csv(spark, str(tmp_path / "m")).first().event_name == "New"


def test_comment_source(spark):
    now = dt.datetime(2024, 1, 1)
    rows = [("UFC 1", "ufc 1 discussion", f"hype {'x' * 600} {i}", i, now + dt.timedelta(minutes=i)) for i in range(120)]
    rows += [("UFC 1", "zz UFC 1 later", "boring", 1, now), ("UFC 1", "unrelated", "boring", 1, now)]
    df = spark.createDataFrame(rows, "event_name string, thread_title string, comment_text string, score int, created_utc timestamp")
    assert sources.event_comments(df).count() == 120
    kept = sources.event_comments(df, per_event=100)
    assert kept.count() == 100 and kept.filter("length(comment_text) > 500").count() == 0
    row = sources.event_sentiment(kept).first()
    assert row.comment_count == 100 and row.avg_sentiment == 1.0 and row.total_engagement == sum(range(100))


def test_buzz_and_odds_sources(spark):
    trends = spark.createDataFrame([(dt.date(2024, 1, 1), "A", 40)], "date date, fighter_name string, search_interest int")
    fights = spark.createDataFrame([("A vs. B", dt.date(2024, 1, 3))], "bout string, event_date date")
    row = sources.fighter_buzz(trends, fights).first()
    assert (row.f1_avg_search_7d, row.f2_avg_search_7d, row.max_peak_search) == (40.0, 25.0, 40.0)
    lines = spark.createDataFrame([(-150, 130, -100, 120)], "fighter1_odds int, fighter2_odds int, opening_odds_f1 int, opening_odds_f2 int")
    out = sources.betting_odds(lines).first()
    assert (out.line_movement_f1, out.big_line_movement, out.f1_is_favorite) == (-50, 0, 1)


def test_absent_sources(spark, tmp_path):
    assert files.load_tables(spark, str(tmp_path), ["events"]) == {}
    assert files.first_available(files.read_parquet, spark, [str(tmp_path / "none")]) is None
