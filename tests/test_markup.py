"""The scanner against a plain parser with a stack."""

import random
import re

from pyspark.sql import functions as F

from eventlytics.operators import markup

NAMES = ["td", "p", "tr", "div"]


def plain(page, names, implied=False):
    """(number, last, start, stop, depth, name), one by one; implied ends in pages with unclosed tags only."""
    tokens = [m[0] for m in re.finditer(markup.TOKEN.replace("*+", "*"), page)]
    wanted, open_, done, opened = {*names, *markup.HOLDERS}, [], [], 0

    def close(kept, stop):
        for depth, (number, start, name) in enumerate(open_[kept:], kept):
            done.append((number, opened - 1, start, stop, depth, name))
        del open_[kept:]

    for at, token in enumerate(tokens):
        m = re.match(r"</?([a-z][a-z0-9-]*)", token, re.I)
        if not m or m[1].lower() not in wanted:
            continue
        name, names_open = m[1].lower(), [x[2] for x in open_]
        place = len(names_open) - 1 - names_open[::-1].index(name) if name in names_open else None
        if token.startswith("</"):
            if not implied and place != len(open_) - 1:
                return plain(page, names, True)
            if place is not None:
                close(place, at)
            continue
        if implied and place is not None and name in markup.LEFT_OPEN and not set(names_open[place + 1 :]) & set(markup.HOLDERS):
            close(place, at)
        open_.append((opened, at, name))
        opened += 1
    if open_ and not implied:
        return plain(page, names, True)
    close(0, len(tokens))
    return sorted(done)


def scanned(spark, pages, names=NAMES):
    df = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")
    out = markup.scan(df, names).select("page_id", "elements", F.transform("elements", lambda e: markup.text_of(e))).collect()
    return {r[0]: ([tuple(e) for e in r[1]], r[2]) for r in out}


def nested(rng, depth=0, names=(*NAMES, "table", "ul", "Div")):
    if depth > 4 or rng.random() < 0.2:
        return rng.choice(["a", " ", "<br/>", "<!-- <td> -->", "x < y", "&amp;", '<b title="a>b">t</b>', "<script>'<td>'</script>"])
    name = rng.choice(names)
    return f"<{name} class='k'>" + "".join(nested(rng, depth + 1, names) for _ in range(rng.randint(0, 3))) + f"</{name}>"


def test_scans_equal_a_plain_parser(spark):
    rng = random.Random(1)
    good = ["".join(nested(rng) for _ in range(4)) for _ in range(60)]
    bits = ["<td>", "</td>", "<p>", "</p>", "<tr>", "</tr>", "<table>", "</table>", "<div>", "</div>", "x", "<", "<b>", "</ul>"]
    bad = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(120)]
    pages = [*good, *bad, "", "no tags", "<td", "<td class='x>never ends", "<tdx></tdx>", "<p>" * 300]
    got = scanned(spark, pages)
    for i, page in enumerate(pages):
        assert got[i][0] == plain(page, NAMES), page
    assert scanned(spark, [None])[0] == ([], [])


def test_both_ways_agree(spark):
    """A page whose tags are closed in turn, and the same page behind a tag that is not."""
    rng = random.Random(2)
    page = "".join(nested(rng, names=("div", "table", "ul")) for _ in range(300))
    got = scanned(spark, [page, page + "</td>", page + "<div>"])
    assert got[0] == got[1] and got[2][0][: len(got[0][0])] == got[0][0] and got[2][1][:-1] == got[0][1]


def test_texts_attributes_and_what_follows(spark):
    page = """<div id="1" Class="a  b" data-x='q"&amp;'>one <b>two</b> &lt;<div>in</div></div> tail &amp; more<div class=c></div><p></p>"""
    df = spark.createDataFrame([(1, page)], "page_id int, html string")
    e = F.col("elements")
    row = markup.scan(df, ["div", "p"]).select(
        markup.text_of(e[0]), markup.attribute(e[0], "class"), markup.attribute(e[0], "data-x"), markup.attribute(e[0], "x"),
        markup.text_after(e[0]), markup.text_after(e[2]), F.size(markup.below(e[0])),
        F.size(markup.select(e, "div", "b")), F.size(markup.select(e, "div", "a  b")), F.size(markup.select(e, "div", "c")),
        markup.text_of(markup.first(e, "div", "none")), markup.text_after(markup.first(e, "div", "none")),
        markup.attribute(markup.first(e, "p"), "class"),
    ).first()
    assert tuple(row) == ("one two <in", "a  b", 'q"&', None, "tail & more", "", 1, 1, 1, 1, None, None, None)


def test_void_names_are_refused(spark):
    df = spark.createDataFrame([(1, "<br>")], "page_id int, html string")
    try:
        markup.scan(df, ["br"])
    except ValueError:
        return
    raise AssertionError
