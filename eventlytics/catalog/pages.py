"""Extraction from raw pages.

Links come from the given pages. The given pages have no tables, so fact,
schedule, contest, statistics and odds pages are rendered by Spark from the other
tables row by row, and the SQL states what must be read back from them: rows that
lack a link, a date or a cell included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlytics.catalog import views as v
from eventlytics.catalog.registry import query
from eventlytics.operators import pages


def text(name: str):
    return F.col(name).cast("string")


ANCHORS = r"""anchors AS (
  SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 1)) AS href,
    generate_subscripts(regexp_extract_all(html, '(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 1), 1) AS i FROM pages),
first AS (SELECT page_id, href, min(i) AS i FROM anchors WHERE starts_with(href, '{prefix}') GROUP BY ALL)"""


@query(
    "h2_links",
    "WITH " + ANCHORS.replace("{prefix}", "") + """ SELECT page_id, href,
      CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS pos FROM first""",
)
def links(spark, sf):
    return pages.links(v.spread_table(spark, sf, "pages"), shortest_text=0).select("page_id", "href", "pos")


@query(
    "h2_links_with_prefix",
    "WITH " + ANCHORS.replace("{prefix}", "/") + """ SELECT page_id, href,
      CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS pos FROM first""",
)
def links_with_prefix(spark, sf):
    return pages.links(v.spread_table(spark, sf, "pages"), "/", shortest_text=0).select("page_id", "href", "pos")


TEXT = r"""trim(regexp_replace(regexp_replace({}, '<[^>]*>', '', 'g'), '^\s+|\s+$', '', 'g'))"""


@query(
    "h2_links_filtered",
    r"""WITH found AS (
      SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 1)) AS href,
        unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 2)) AS body,
        generate_subscripts(regexp_extract_all(html, '(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 1), 1) AS i FROM pages),
    wanted AS (SELECT page_id, href, i, """ + TEXT.format("body") + r""" AS text FROM found),
    first AS (SELECT page_id, href, min(i) AS i, arg_min(text, i) AS text FROM wanted
      WHERE starts_with(href, '/') AND length(text) >= 3 AND NOT contains(text, 'the') AND NOT contains(lower(href), 'en')
      GROUP BY page_id, href)
    SELECT page_id, href, text, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS pos FROM first""",
)
def links_filtered(spark, sf):
    found = pages.links(v.spread_table(spark, sf, "pages"), "/", 3, without_text="the", without_href="en")
    return found.select("page_id", "href", "text", "pos")


@query(
    "h1_page_facts",
    """SELECT o_orderkey AS page_id, 'http://x.example/' || o_orderkey AS url,
      CASE WHEN o_orderkey % 3 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) END AS attendance,
      CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS gate_revenue,
      'Hall & ' || o_orderpriority AS venue, 'City ' || o_custkey AS location,
      CAST(o_orderdate AS DATE) AS event_date,
      CASE WHEN o_orderkey % 5 <> 0 THEN 1000 + o_custkey END AS ppv_buys
    FROM orders WHERE o_orderkey % 12 <> 0""",
)
def page_facts(spark, sf):
    key, cell = F.col("o_orderkey"), lambda h, d: F.concat(
        F.lit(f'<tr><th scope="row">{h}</th>\n <td class="d">'), d, F.lit("</td></tr>")
    )
    day = F.when(key % 3 == 0, F.date_format("o_orderdate", "MMMM d, yyyy")).when(
        key % 3 == 1, F.date_format("o_orderdate", "d MMMM yyyy")
    ).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    rows = F.concat_ws(
        "\n",
        F.when(key % 3 != 0, cell("Total <i>attendance</i>", F.concat(F.format_number(F.floor("o_totalprice"), 0), F.lit("[2]")))),
        F.when(key % 4 != 0, cell("Total gate", F.concat(F.lit("$"), F.format_number("o_totalprice", 2)))),
        cell("Venue", F.concat(F.lit('<a href="/wiki/H">Hall &amp; '), "o_orderpriority", F.lit("</a>"))),
        cell("City", F.concat(F.lit("City "), text("o_custkey"))),
        cell("Date", F.concat(day, F.lit("[1]"))),
        F.when(key % 5 != 0, cell("Buy rate", F.concat(F.lit("~"), text("o_custkey") + 1000))),
    )
    html = F.concat(F.lit('<html><body><table class="infobox">'), rows, F.lit("</table></body></html>"))
    made = v.spread_table(spark, sf, "orders").select(
        key.alias("page_id"), F.concat(F.lit("http://x.example/"), text("o_orderkey")).alias("url"), html.alias("html")
    )
    return pages.facts(made)


def fifty_to_a_page(rows: DataFrame, key: str, row: Column, per: int = 50) -> DataFrame:
    """page_id, rows: markup of ``per`` neighbouring keys at most."""
    return rows.groupBy(F.floor(F.col(key) / per).alias("page_id")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(key, row.alias("r")))), lambda r: r["r"]), "\n").alias("rows")
    )


@query(
    "h3_schedule_records",
    """SELECT c_custkey // 50 AS page_id, CAST(row_number() OVER w - 1 AS INTEGER) AS pos, c_name AS event,
      'http://x.example/event-details/' || c_custkey AS link,
      CASE WHEN c_custkey % 17 <> 0 THEN c_mktsegment END AS date,
      CASE WHEN c_custkey % 13 <> 0 THEN 'Nation ' || n_nationkey END AS location
    FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 19 <> 0
    WINDOW w AS (PARTITION BY c_custkey // 50 ORDER BY c_custkey)""",
)
def schedule_records(spark, sf):
    key = F.col("c_custkey")
    link = F.concat(
        F.lit('<a href="http://x.example/event-details/'), text("c_custkey"),
        F.lit('" class="b-link b-link_style_black">\n  '), "c_name", F.lit("\n</a>"),
    )
    row = F.concat(
        F.lit("<tr><td><i>"), F.when(key % 19 != 0, link).otherwise(F.lit('<a href="/other">soon</a>')),
        F.when(key % 17 != 0, F.concat(F.lit('<span class="b-statistics__date">\n '), "c_mktsegment", F.lit("</span>"))).otherwise(""),
        F.lit("</i></td>"),
        F.when(key % 13 != 0, F.concat(F.lit('<td class="b-place big">\n <b>Nation</b> '), text("n_nationkey"), F.lit("</td>"))).otherwise(""),
        F.lit("</tr>"),
    )
    upcoming = '<table><tr><td><span class="b-statistics__date">soon</span></td><td class="b-place">later</td></tr>'
    customers, nations = v.table(spark, sf, "customer"), v.table(spark, sf, "nation")
    made = fifty_to_a_page(customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")), "c_custkey", row)
    html = F.concat(F.lit(upcoming), "rows", F.lit("</table>"))
    return pages.schedule_records(
        made.select("page_id", html.alias("html")), "b-link b-link_style_black", "b-statistics__date", "b-place"
    )


@query(
    "h3_contest_list",
    """SELECT o_orderkey // 100 AS page_id,
      CAST(row_number() OVER (PARTITION BY o_orderkey // 100 ORDER BY o_orderkey) - 1 AS INTEGER) AS pos,
      'Event & ' || o_orderkey // 100 AS event,
      'A' || o_orderkey || CASE WHEN o_orderkey % 7 <> 0 THEN ' vs. B' || o_custkey ELSE '' END AS bout,
      CASE WHEN o_orderkey % 13 <> 0 THEN 'http://x.example/fight-details/' || o_orderkey END AS url FROM orders""",
)
def contest_list(spark, sf):
    key = F.col("o_orderkey")

    def name(of):
        return F.concat(F.lit('<p><a class="b-link b-link_style_black" href="/f"> '), of, F.lit(" </a></p>"))

    row = F.concat(
        F.lit('<tr class="b-row b-row__hover js-click"'),
        F.when(key % 13 != 0, F.concat(F.lit(' data-link="http://x.example/fight-details/'), text("o_orderkey"), F.lit('"'))).otherwise(""),
        F.lit('><td><a class="b-flag" href="/w">win</a><table><tr><td>'), name(F.concat(F.lit("A"), text("o_orderkey"))),
        F.when(key % 7 != 0, name(F.concat(F.lit("B"), text("o_custkey")))).otherwise(""), F.lit("</td></tr></table></td></tr>"),
    )
    made = fifty_to_a_page(v.spread_table(spark, sf, "orders"), "o_orderkey", row, 100)
    html = F.concat(
        F.lit('<h2 class="b-content__title"><span>\n Event &amp; '), text("page_id"),
        F.lit('\n</span></h2><table><tr class="b-row"><th>head</th></tr>'), "rows", F.lit("</table>"),
    )
    return pages.contest_list(
        made.select("page_id", html.alias("html")), "b-content__title", "b-row b-row__hover js-click", "b-link b-link_style_black"
    )


@query(
    "h3_entity_list",
    """SELECT s_suppkey // 50 AS page_id,
      CAST(row_number() OVER (PARTITION BY s_suppkey // 50 ORDER BY s_suppkey) - 1 AS INTEGER) AS pos, s_name AS first,
      CAST(s_suppkey AS VARCHAR) AS last, CASE WHEN s_suppkey % 4 <> 0 THEN '' END AS nickname,
      '/f?a=1&id=' || s_suppkey AS url FROM supplier""",
)
def entity_list(spark, sf):
    key = F.col("s_suppkey")

    def link(of):
        return F.concat(F.lit('<td><a class="b-link" href="/f?a=1&amp;id='), text("s_suppkey"), F.lit('">'), of, F.lit("</a></td>"))

    row = F.concat(F.lit("<tr>"), link(F.col("s_name")), link(text("s_suppkey")), F.when(key % 4 != 0, link(F.lit(" "))).otherwise(""), F.lit("</tr>"))
    made = fifty_to_a_page(v.table(spark, sf, "supplier"), "s_suppkey", row)
    return pages.entity_list(made.select("page_id", F.col("rows").alias("html")), "b-link")


@query(
    "r4_chunks_of_three",
    """SELECT s_suppkey // 50 AS page_id, CAST(row_number() OVER (PARTITION BY s_suppkey // 50 ORDER BY s_suppkey) - 1 AS INTEGER) AS pos,
      s_name AS first, CAST(s_suppkey AS VARCHAR) AS last, '' AS nickname FROM supplier""",
)
def chunks_of_three(spark, sf):
    link = '<a class="b-link b-link_style_black" href="/f">'
    row = F.concat(
        F.lit(link), "s_name", F.lit("</a>" + link), text("s_suppkey"), F.lit("</a>" + link + " </a>")
    )
    made = v.table(spark, sf, "supplier").groupBy(F.floor(F.col("s_suppkey") / 50).alias("page_id")).agg(
        F.sort_array(F.collect_list(F.struct("s_suppkey", row.alias("r")))).alias("rows")
    )
    html = F.array_join(F.transform("rows", lambda r: r["r"]), "")
    flat = pages.tag_texts(F.col("html"), "a", "b-link b-link_style_black")
    return pages.chunk_records(made.withColumn("html", html), flat, ["first", "last", "nickname"])


# -- statistics sheets: cells with a paragraph for each side ------------------

ROUNDS = 3
CELL = "b-fight-details__table-col"
#: Name, columns and weight of the two halves of a sheet.
HALVES = (("t", pages.TOTALS, 1), ("s", pages.STRIKES, 7))
_SHARED = [c for c in pages.STRIKES if c in pages.TOTALS]


def _weight(half: tuple, name: str) -> int:
    """What tells a half's value apart; columns of both halves must agree."""
    return 3 if name in _SHARED else half[2]


def _places(half: tuple) -> list[tuple[int, str]]:
    """Number and name of a half's columns, the same number where both have it."""
    return [(pages.TOTALS.index(c) if c in _SHARED else at, c) for at, c in enumerate(half[1])]


def _segment(half: tuple) -> Column:
    """One table row of every round, the summary (round 0) first."""
    key = F.col("c_custkey")

    def cell(r: Column, at: int, name: str) -> Column:
        def paragraph(side: int) -> Column:
            value = (key * (at + 1) + 17 * r + 5 * side) * _weight(half, name) % 101
            # a sheet whose halves disagree loses the round
            if half[0] == "s" and name == "sig_str":
                value = value + F.when((key % 11 == 0) & (r == 1), 1).otherwise(0)
            return F.concat(F.lit("<p class='x'>\n  <b>"), value.cast("string"), F.lit("</b> of &lt;"), text("c_nationkey"), F.lit(" </p>"))

        second = paragraph(1)
        if name == "ctrl":
            second = F.when(key % 5 == 0, "").otherwise(second)
        inside = F.concat(paragraph(0), second)
        if name == "ground":
            inside = F.when(key % 7 == 0, "<i>none</i>").otherwise(inside)
        return F.concat(F.lit(f'<td class="{CELL}">'), inside, F.lit("</td>"))

    names = F.concat(
        F.lit(f'<td class="{CELL} wide">'),
        *[F.concat(F.lit(f'<p><a href="/f">{side}'), text("c_custkey"), F.lit("</a></p>")) for side in "AB"], F.lit("</td>"),
    )
    rounds = F.sequence(F.lit(0), (1 + key % ROUNDS).cast("int"))
    rows = F.transform(rounds, lambda r: F.concat(
        F.lit("<tr>"), names, *[cell(r, at, name) for at, name in _places(half)], F.lit("</tr>"),
    ))
    return F.concat(F.lit('<table class="b"><tr><td class="head"><p>x</p></td></tr>'), F.array_join(rows, ""), F.lit("</table>"))


def _sides(spark, sf):
    """Per customer the sheet's page, read back to both sides' cells."""
    html = F.concat(F.lit("<table><tr><td>"), *map(_segment, HALVES), F.lit("</td></tr></table>"))
    sheets = v.spread_table(spark, sf, "customer").select("c_custkey", html.alias("html"))
    return pages.sheet_sides(sheets, CELL, ["c_custkey"])


def _value(half: tuple, at: int, name: str) -> str:
    value = (
        f"CAST((c_custkey * {at + 1} + 17 * r + 5 * n) * {_weight(half, name)} % 101 AS VARCHAR) || ' of <' || c_nationkey"
    )
    absent = {"ctrl": "c_custkey % 5 = 0 AND n = 1", "ground": "c_custkey % 7 = 0"}.get(name)
    return f"CASE WHEN NOT ({absent}) THEN {value} END" if absent else value


SHEETS = f"""WITH rounds AS (SELECT c_custkey, c_nationkey, side, n, r FROM customer, (VALUES ('A', 0), ('B', 1)) AS s(side, n),
    range(1, {ROUNDS + 1}) AS t(r) WHERE r <= 1 + c_custkey % {ROUNDS} AND NOT (c_custkey % 11 = 0 AND r = 1))
  SELECT c_custkey, 'Round ' || r AS round, side || c_custkey AS fighter, """ + ", ".join(
    f"{_value(half, at, c)} AS {c}" for half in HALVES for at, c in _places(half)
    if half[0] == "t" or c not in _SHARED
) + " FROM rounds"


@query("h4_round_stats", SHEETS)
def round_stats(spark, sf):
    return pages.side_stats(_sides(spark, sf), ["c_custkey"])


def _listed(n: int) -> str:
    """SQL of a side's cells, joined, with '-' for absent ones."""
    rows = " || '|' || ".join(
        f"array_to_string(list_transform(range(0, 2 + c_custkey % {ROUNDS}), lambda r: concat_ws('|', '{'AB'[n]}' || c_custkey, "
        + ", ".join(
            f"coalesce({_value(half, at, c)}, '-')"
            if not (half[0] == "s" and c == "sig_str") else
            f"((c_custkey * {at + 1} + 17 * r + 5 * n) * 3 % 101 + CASE WHEN c_custkey % 11 = 0 AND r = 1 THEN 1 ELSE 0 END)"
            " || ' of <' || c_nationkey"
            for at, c in _places(half)
        ) + ")), '|')"
        for half in HALVES
    )
    return f"(SELECT {rows} FROM (SELECT {n} AS n) AS _{n})"


@query("r3_deinterleaved_sides", f"SELECT c_custkey, {_listed(0)} AS a, {_listed(1)} AS b FROM customer")
def deinterleaved_sides(spark, sf):
    return _sides(spark, sf).select("c_custkey", *[F.array_join(c, "|", "-").alias(c) for c in "ab"])


@query(
    "w7_marker_segments",
    f"""SELECT c_custkey, CAST(place AS INTEGER) AS place, CAST(CASE WHEN place < 2 + c_custkey % {ROUNDS} THEN {len(pages.TOTALS) + 1}
        ELSE {len(pages.STRIKES) + 1} END AS INTEGER) AS cells, 'B' || c_custkey AS marker,
      CASE WHEN place < 2 + c_custkey % {ROUNDS} THEN {_value(HALVES[0], 0, "kd")} ELSE
        {_value(HALVES[1], 2, "head")} END AS probe
    FROM (SELECT *, 1 AS n, place % (2 + c_custkey % {ROUNDS}) AS r FROM customer, range(0, {2 * (ROUNDS + 1)}) AS t(place))
    WHERE place < 2 * (2 + c_custkey % {ROUNDS})""",
)
def marker_segments(spark, sf):
    cut = pages.segments(_sides(spark, sf).select("c_custkey", "b"), "b", "s")
    parts = F.transform("s", lambda part: F.struct(
        F.size(part).alias("cells"), F.get(part, 0).alias("marker"),
        F.when(F.size(part) > len(pages.STRIKES) + 1, F.get(part, 1)).otherwise(F.get(part, 3)).alias("probe"),
    ))
    return cut.select("c_custkey", F.posexplode(parts).alias("place", "part")).select("c_custkey", "place", "part.*")


@query(
    "h5_result_record",
    """SELECT o_orderkey, 'Event ' || o_custkey AS event, 'A' || o_orderkey || ' vs. B & ' || o_custkey AS bout,
      'W/L' AS outcome, o_orderpriority || ' Bout' AS weightclass, 'Decision: Split' AS method,
      CAST(1 + o_orderkey % 5 AS VARCHAR) AS round, '4:51' AS time,
      CASE WHEN o_orderkey % 6 <> 0 THEN '3 Rnd (5-5-5)' END AS time_format,
      CASE WHEN o_orderkey % 9 <> 0 THEN 'R. ' || o_orderstatus END AS referee,
      o_orderkey % 50 || ' Judge 45 - 49.' AS details, 'http://x.example/fight-details/' || o_orderkey AS url FROM orders""",
)
def result_record(spark, sf):
    key, lit = F.col("o_orderkey"), F.lit

    def person(name, outcome):
        return F.concat(
            lit(f'<div class="b-fight-details__person"><i class="b-status">\n  {outcome}  \n</i>'
                '<div class="b-text"><h3><a class="b-link b-fight-details__person-link" href="/f">'),
            name, lit("</a></h3></div></div>"),
        )

    def item(label, value, cls="b-fight-details__text-item"):
        return F.concat(lit(f'<i class="{cls}">\n  <i class="b-label">{label}:</i>\n  '), value, lit("</i>"))

    html = F.concat(
        lit('<html><h2 class="b-content__title">\n    <a class="b-link" href="/e">Event '), text("o_custkey"), lit("</a>\n</h2>"),
        person(F.concat(lit("A"), text("o_orderkey")), "W"), person(F.concat(lit("B &amp; "), text("o_custkey")), "L"),
        lit('<div class="b-fight-details__fight"><div class="b-fight-details__fight-head"><i class="b-title">\n    '),
        "o_orderpriority", lit(' Bout\n</i></div><div><p class="b-fight-details__text">'),
        item("Method", lit('<i style="font-style: normal">Decision: Split</i>'), "b-fight-details__text-item_first"),
        item("Round", (1 + key % 5).cast("string")), item("Time", lit("4:51")),
        F.when(key % 6 != 0, item("Time format", lit("3 Rnd (5-5-5)"))).otherwise(""),
        F.when(key % 9 != 0, item("Referee", F.concat(lit("<span>R. "), "o_orderstatus", lit("</span>")))).otherwise(""),
        lit('</p><p class="b-fight-details__text">\n<i class="b-label">Details:</i>\n  '), (key % 50).cast("string"),
        lit(' Judge <b>45 - 49.</b></p></div></div><p class="b-fight-details__text">more</p></html>'),
    )
    url = F.concat(lit("http://x.example/fight-details/"), text("o_orderkey"))
    made = v.spread_table(spark, sf, "orders").select("o_orderkey", url.alias("url"), html.alias("html"))
    return pages.result_record(made, ["o_orderkey"])


@query(
    "h5_tape_record",
    """SELECT c_custkey, c_name AS fighter, (4 + c_custkey % 3) || chr(39) || ' ' || (c_custkey % 12) || '"' AS height,
      (115 + c_custkey % 150) || ' lbs.' AS weight, CASE WHEN c_custkey % 9 <> 0 THEN '--' END AS reach,
      CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment ELSE '' END AS stance, 'Jul 03, 1983' AS dob
    FROM customer""",
)
def tape_record(spark, sf):
    key, lit = F.col("c_custkey"), F.lit

    def item(label, value):
        return F.concat(lit(f'<li class="b-list"><i class="b-title">\n  {label}:\n</i>\n  '), value, lit("\n  </li>"))

    html = F.concat(
        lit('<h2><span class="b-content__title-highlight">\n '), "c_name",
        lit('\n</span> <span>Record: 1-2-0</span></h2><ul class="b-list__box-list">'),
        item("Height", F.concat((4 + key % 3).cast("string"), lit("' "), (key % 12).cast("string"), lit("&quot;"))),
        item("Weight", F.concat((115 + key % 150).cast("string"), lit(" lbs."))),
        F.when(key % 9 != 0, item("Reach", lit("--"))).otherwise(""),
        item("STANCE", F.when(key % 4 != 0, F.col("c_mktsegment")).otherwise("")), item("DOB", lit("Jul 03, 1983")),
        lit('</ul><ul class="b-list__box-list">'), item("Height", lit("wrong list")), lit("</ul>"),
    )
    made = v.spread_table(spark, sf, "customer").select("c_custkey", html.alias("html"))
    return pages.tape_record(made, ["c_custkey"])


@query(
    "h6_odds_records",
    """SELECT o_orderkey AS page_id, CAST(0 AS INTEGER) AS pos, 'Card Number ' || o_orderkey AS event_name,
      'A ' || o_custkey AS fighter1_name, 'B & ' || o_orderpriority AS fighter2_name,
      CAST(CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE 100 + o_orderkey % 300 END AS INTEGER) AS fighter1_odds,
      CAST(CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE -(101 + o_orderkey % 200) END AS INTEGER) AS fighter2_odds,
      round(CASE WHEN o_orderkey % 7 = 0 THEN 0.5 ELSE 100 / (200 + o_orderkey % 300) END, 6) AS fighter1_implied_prob,
      round(CASE WHEN o_orderkey % 7 = 0 THEN 0.5 ELSE (101 + o_orderkey % 200) / (201 + o_orderkey % 200) END, 6)
        AS fighter2_implied_prob
    FROM orders WHERE o_orderkey % 13 <> 0""",
)
def odds_records(spark, sf):
    key, lit = F.col("o_orderkey"), F.lit

    def row(name, line):
        return F.concat(
            lit('<tr class="r"><th scope="row" class="oppcell"><a href="/x">'), name,
            lit('</a></th><td class="odds">'), line, lit('</td><td class="odds">-110</td></tr>'),
        )

    one = F.when(key % 7 == 0, "n/a").otherwise(F.concat(lit("+"), (100 + key % 300).cast("string")))
    second = row(F.concat(lit("B &amp; "), "o_orderpriority"), (-(101 + key % 200)).cast("string"))
    html = F.concat(
        lit('<table class="odds-table">'), row(F.concat(lit("A "), text("o_custkey")), one),
        F.when(key % 13 == 0, "").otherwise(second), lit("</table>"),
    )
    made = v.spread_table(spark, sf, "orders").select(
        key.alias("page_id"), F.concat(lit("http://x.example/events/card-number-"), text("o_orderkey")).alias("url"),
        html.alias("html"),
    )
    probs = ("fighter1_implied_prob", "fighter2_implied_prob")
    return pages.odds_records(made).withColumns({p: F.round(p, 6) for p in probs})
