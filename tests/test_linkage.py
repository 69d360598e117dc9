"""Linkage cascade against a plain loop over all candidates."""

import datetime as dt
import random
import re

from eventlytics.operators import linkage

DAY = dt.date(2024, 1, 10)


def day(n):
    return DAY + dt.timedelta(days=n)


def link(spark, events, labels, strategies=linkage.STRATEGIES):
    e = spark.createDataFrame(events, "event_id string, event_name string, event_date date")
    f = spark.createDataFrame(labels, "event_name string, event_date date, sell_through double")
    out = linkage.link_labels(e, f, strategies=strategies).collect()
    return {r.event_id: (r.sell_through, r.strategy) for r in out}


def test_day_tolerance(spark):
    events = [(str(g), "Show A", day(10 * g)) for g in range(-3, 4)]
    labels = [("show a!", day(10 * g + g), float(g)) for g in range(-3, 4)]
    out = link(spark, events, labels, ["name_date"])
    assert out == {"-1": (-1.0, "name_date"), "0": (0.0, "name_date"), "1": (1.0, "name_date")}


def test_nearest_then_smallest_name(spark):
    events = [("x", "Show A", day(0))]
    assert link(spark, events, [("b", day(1), 0.1), ("c", day(0), 0.2), ("d", day(0), 0.3)]) == {"x": (0.2, "date")}
    assert link(spark, events, [("Show A", day(1), 0.9), ("b", day(0), 0.1)]) == {"x": (0.9, "name_date")}


def test_unlabelled_rows_do_not_match(spark):
    assert link(spark, [("x", "A", day(0))], [("A", day(0), None)]) == {}


def key(name):
    return re.sub("[^a-z0-9]", "", name.lower())


def plain(events, labels):
    out = {}
    for i, name, date in events:
        found = []
        for lname, ldate, label in labels:
            gap = abs((ldate - date).days)
            number = re.search(r"UFC\s*(\d+)", name)
            lnumber = re.search(r"UFC\s*(\d+)", lname)
            if key(name) == key(lname) and gap <= 1:
                found.append((0, gap, lname, label))
            if number and lnumber and number[1] == lnumber[1]:
                found.append((1, ldate.toordinal(), lname, label))
            if gap <= 1:
                found.append((2, gap, lname, label))
        if found:
            out[i] = min(found)[3]
    return out


def test_cascade_equals_plain_loop(spark):
    rng = random.Random(3)
    names = ["UFC 1: A", "UFC 1 - B", "UFC Fight Night: C", "UFC on FOX 2", "Noche", "noche!"]
    events = [(str(i), rng.choice(names), day(rng.randrange(60))) for i in range(120)]
    labels = [(rng.choice(names), day(rng.randrange(60)), round(rng.random(), 3)) for _ in range(25)]
    out = link(spark, events, labels, ["name_date", "number", "date"])
    assert {k: v[0] for k, v in out.items()} == plain(events, labels)


def test_interval_matches_are_counted(spark):
    left = spark.createDataFrame([("a", day(0)), ("a", day(5)), ("a", day(0))], "k string, event_date date")
    right = spark.createDataFrame([("a", day(1), 1), ("a", day(-1), 2), ("a", day(2), 3), ("b", day(0), 4)],
                                  "k string, event_date date, v int")
    out = linkage.interval_matches(left, right, "k", "v").collect()
    assert sorted((r.event_date, r.matches, r.lowest, r.highest) for r in out if r.matches) == [(day(0), 2, 1, 2)] * 2
    assert [r.matches for r in out if r.event_date == day(5)] == [0]
