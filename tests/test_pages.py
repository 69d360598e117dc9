"""Extraction from hand-made pages."""

import datetime as dt

from pyspark.sql import functions as F

from eventlytics.operators import pages
from tests.conftest import values


def made(spark, *htmls):
    rows = [(i, f"http://h/events/card-{i}", h) for i, h in enumerate(htmls)]
    return spark.createDataFrame(rows, "page_id int, url string, html string")


def test_facts(spark):
    page = """<table class="infobox"><tr><th>Date</th><td>April 13, 2024<sup>[1]</sup></td></tr>
    <TR><TH>Venue</TH><TD><a href="/wiki/T">T &amp; Co</a></TD></TR><tr><td>no head</td></tr>
    <tr><th>City</th><td>Las Vegas</td></tr><tr><th>Total gate</th><td>US$1.5 million</td></tr>
    <tr><th>Attendance</th><td>~15,128[3]</td></tr><tr><th>Buy rate</th><td>400,000</td></tr></table>"""
    bare = "<table><tr><th>Venue</th><td>x</td></tr></table>"
    rows = pages.facts(made(spark, page, bare, "")).collect()
    assert len(rows) == 1
    assert tuple(rows[0])[2:] == (15128, 1.5e6, "T & Co", "Las Vegas", dt.date(2024, 4, 13), 400000)


def test_links_keep_the_first_place(spark):
    page = ('<a href="/wiki/UFC_1">UFC 1</a><a class="x" href="/other">no</a><a href="/wiki/UFC_1">again</a>'
            '<a href="/wiki/UFC_2"><b>UFC</b> 2</a><a href="/wiki/UFC_List">List of</a><a href="/wiki/UFC_Disambiguation">UFC</a>')
    out = pages.links(made(spark, page), "/wiki/UFC", 2, "List", "disambiguation")
    assert values(out) == [(0, 0, "/wiki/UFC_1", "UFC 1"), (0, 1, "/wiki/UFC_2", "UFC 2")]


def test_segments_and_rounds(spark):
    flat = "X 1 2 X 3 4 X 5 6 X 7 8".split()
    df = spark.createDataFrame([(flat,), ([],), (["X", "X", "1"],)], "f array<string>")
    out = [r.segments for r in pages.segments(df, "f").collect()]
    assert out == [[["X", "1", "2"], ["X", "3", "4"], ["X", "5", "6"], ["X", "7", "8"]], [], [["X", "X", "1"]]]


def sheet(name, rounds, strikes="7 of 9"):
    totals = [[name, f"{r}", strikes, "50%", "a", "b", "c", "d", "e", "f"] for r in range(rounds + 1)]
    strike_rows = [[name, strikes, "50%", f"h{r}", "i", "j", "k", "l", "m"] for r in range(rounds + 1)]
    return [x for row in totals + strike_rows for x in row]


def test_round_stats(spark):
    df = spark.createDataFrame([(1, sheet("X", 1)), (2, sheet("Y", 3)), (3, [])], "id int, f array<string>")
    out = pages.round_stats(df, "f", ["id"]).orderBy("id", "round").collect()
    assert [(r.id, r.round, r.fighter, r.kd, r.head) for r in out] == [
        (1, "Round 1", "X", "1", "h1"), (2, "Round 1", "Y", "1", "h1"), (2, "Round 2", "Y", "2", "h2"), (2, "Round 3", "Y", "3", "h3"),
    ]


def cells(row):
    return "<tr>" + "".join(
        '<td class="wide c">' + "".join(f"<p> <b>{x}</b></p>" for x in pair if x is not None) + "</td>" for pair in row
    ) + "</tr>"


def test_sides_of_a_sheet(spark):
    """Absent cells keep their place, nested tables don't count."""
    def rows(n, names):
        return [[names] + [(f"{r}{i}", None if i == 3 else f"x{i}") for i in range(n)] for r in range(3)]

    totals, strikes = rows(9, ("A", "B")), rows(8, ("A", "B"))
    for t, s in zip(totals, strikes):
        s[1], s[2] = t[2], t[3]
        s[8] = (None, None)
    page = "<table><tr><td class='c2'><table>" + "".join(map(cells, totals)) + "</table><p>no</p><table>" + "".join(map(cells, strikes)) + "</table></td></tr></table>"
    sides = pages.sheet_sides(made(spark, page, "", None), "c")
    out = pages.side_stats(sides, ["page_id"]).orderBy("fighter", "round").collect()
    assert [(r.fighter, r.round) for r in out] == [("A", "Round 1"), ("A", "Round 2"), ("B", "Round 1"), ("B", "Round 2")]
    assert (out[0].kd, out[0].total_str, out[0].ctrl, out[0].ground) == ("10", "13", "18", None)
    assert (out[2].kd, out[2].total_str, out[2].ctrl, out[2].ground) == ("x0", None, "x8", None)


def test_records_of_contest_and_entity_pages(spark):
    page = """<h2 class="b-content__title"> <a>Event</a>
</h2>
    <div class="b-fight-details__person"><i class="x"> W </i><a class="b-link b-fight-details__person-link">A</a></div>
    <div class="b-fight-details__person"><i class="x"> L </i><a class="b-link b-fight-details__person-link">B</a></div>
    <div class="b-fight-details__fight-head">
    Welterweight Bout
</div>
    <p class="b-fight-details__text"><i class="b-fight-details__text-item_first"><i>Method:</i> KO/TKO</i>
    <i class="b-fight-details__text-item"><i>Round:</i> 2</i><i class="b-fight-details__text-item"><i>Time format:</i> 3 Rnd</i></p>
    <p class="b-fight-details__text"><i>Details:</i> x: y</p>"""
    first, empty = pages.result_record(made(spark, page, "<p>none</p>"), ["page_id"]).orderBy("page_id").collect()
    assert tuple(first)[1:] == ("Event", "A vs. B", "W/L", "Welterweight Bout", "KO/TKO", "2", None, "3 Rnd", None, "x: y", "http://h/events/card-0")
    assert tuple(empty)[1:] == (None, "", "", *[None] * 7, "http://h/events/card-1")
    tape = """<span class="b-content__title-highlight">J A</span><ul class="b-list__box-list"><li><i>Height:</i>
 5' 7&quot; </li>
    <li><i>DOB:</i> -- </li></ul><ul class="b-list__box-list"><li><i>Weight:</i> 1</li></ul>"""
    row = pages.tape_record(made(spark, tape), ["page_id"]).first()
    assert tuple(row)[1:] == ("J A", "5' 7\"", None, None, None, "--")


def test_what_a_row_lacks_shifts_nothing(spark):
    row = '<tr class="r on"{}><td><a class="n">{}</a></td><td><a class="n">{}</a></td></tr>'
    page = ('<h2 class="t">E</h2><table><tr><th>x</th></tr>' + row.format(' data-link="/1"', "A", "B") + row.format("", "C", "D")
            + row.format(" data-link='/3'", "E", "F") + "</table>")
    out = pages.contest_list(made(spark, page), "t", "r", "n")
    assert values(out) == [(0, 0, "E", "A vs. B", "/1"), (0, 1, "E", "C vs. D", None), (0, 2, "E", "E vs. F", "/3")]
    event = '<tr><td>{}</td><td>{}</td><td class="p">P{}</td></tr>'
    link, date = '<a class="b" href="/e/{0}">E{0}</a>', '<span class="d">D{0}</span>'
    page = "<table>" + "".join([
        event.format("", date.format(0), 0), event.format(link.format(1), date.format(1), 1), event.format(link.format(2), "", 2),
        event.format(link.format(3), date.format(3), 3)]) + "</table>"
    out = pages.schedule_records(made(spark, page), "b", "d", "p")
    assert values(out) == [(0, 0, "E1", "/e/1", "D1", "P1"), (0, 1, "E2", "/e/2", None, "P2"), (0, 2, "E3", "/e/3", "D3", "P3")]


def test_chunks(spark):
    link = '<a class="b" href="/f/{0}">{0}</a>'
    page = "".join(link.format(x) for x in "abcdefg")
    flat = pages.tag_texts(F.col("html"), "a", "b")
    out = pages.chunk_records(made(spark, page, ""), flat, ["x", "y", "z"])
    assert values(out) == [(0, 0, "a", "b", "c"), (0, 1, "d", "e", "f")]


def test_odds_tables(spark):
    row = '<tr><th class="oppcell"><a>{}</a></th><td class="odds">{}</td><td class="odds">-1</td></tr>'
    table = '<table class="odds-table">{}</table>'
    page = (table.format(row.format("A", "+150") + row.format("B", "-200"))
            + table.format(row.format("C", "n/a") + row.format("D", "-200")) + table.format(row.format("E", "+1")))
    out = pages.odds_records(made(spark, page)).orderBy("pos").collect()
    assert [(r.fighter1_name, r.fighter1_odds, r.fighter2_odds, r.fighter2_implied_prob) for r in out] == [
        ("A", 150, -200, 200 / 300), ("C", 0, 0, 0.5)]
    assert out[0].event_name == "Card 0"
