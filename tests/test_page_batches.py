"""Texts of batches of pages against the scanner that works row by row."""

import random

from pyspark.sql import functions as F

from eventlytics.operators import markup, page_batches
from tests.test_markup import NAMES, nested


def both_ways(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string").repartition(2)
    e, k = F.col("elements"), "k"

    def raw(x):
        return F.array_join(F.filter(F.slice("tokens", x["start"] + 2, x["stop"] - x["start"] - 1), markup.is_text), "")

    want = markup.scan(df, NAMES).select(
        "page_id", raw(F.get(markup.select(e, "td", k), 1)).alias("first"),
        F.transform(markup.select(e, "p"), raw).alias("all"),
        F.transform(markup.select(e, "div", k), lambda d: F.transform(markup.select(markup.below(d), "p"), raw)).alias("grouped"),
        F.flatten(F.transform(markup.select(e, "div"), lambda d: F.transform(
            F.slice(markup.select(markup.below(d), "td"), 1, 1), raw))).alias("nth"),
    )
    got = page_batches.texts(df, {
        "first": ("first", [("td", k, 1)]), "all": ("all", [("p", None, None)]),
        "grouped": ("grouped", [("div", k, None), ("p", None, None)]), "nth": ("all", [("div", None, None), ("td", None, 0)]),
        "tr": ("all", [("tr", None, None)]),
    }).drop("tr")
    return [sorted(map(tuple, x.collect())) for x in (want, got)]


def test_texts_equal_the_scanner(spark):
    rng = random.Random(3)
    good = ["".join(nested(rng) for _ in range(4)) for _ in range(150)]
    plain = [p for p in good if "<!" not in p and "script" not in p and "x < y" not in p]
    kinds = ["<td>", "<TD class=k>", "<p>", "<p class='a k\tb'>", "<tr>", "<table>", '<div class="k">', "<div id=x Class = 'k'>", "<br/>"]
    bits = [*kinds, "</td>", "</p>", "</tr>", "</table>", "</DIV>", "x", "\u00e9\u4e2d", "<", ">", "<b>", "</ul>", "<pre>", "<p-x>", "<p:y>"]
    bad = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    turn = []
    for _ in range(200):
        page, open_ = "", []
        for _ in range(rng.randint(0, 40)):
            if open_ and rng.random() < 0.5:
                page += f"</{open_.pop()}>"
            else:
                kind = rng.choice([k for k in kinds if "br" not in k])
                open_.append(kind[1:-1].split()[0])
                page += kind + rng.choice(["", "t\u00e9", " &amp; ", "<i>n</i>", "<b class='k'>", ">"])
        turn.append(page + "".join(f"</{x}>" for x in reversed(open_)))
    pages = [*good, *plain, *bad, *turn, "", None, "no tags", "<td", "<td class='x>never ends", "<tdx></tdx>", "<p>" * 30,
             """<div data-x='q"' class="k"><p>1</p></div>""", "<td class='k'>a</td><td class='a&amp;k k'>b<p></td>", "<style>p{}</style><p>a</p>"]
    want, got = both_ways(spark, pages)
    assert got == want
    assert both_ways(spark, ["", None])[1] == [(0, None, [], [], []), (1, None, [], [], [])]


def test_pages_in_turn_need_no_stack():
    """Pages whose tags are closed in turn are done together."""
    import pyarrow as pa

    html = pa.array(["<td class='k'>a<p>b</p></td>"] * 50 + ["<p>open"], pa.large_string())
    found = page_batches._Scanner(sorted({"td", "p", *markup.HOLDERS})).batch(html)
    assert list(found.odd) == [50] and len(found.page) == 100
    assert found.follow([("td", "k", None)])[2] == [b"ab"] * 50
