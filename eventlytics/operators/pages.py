"""Records out of a table of raw pages ``(page_id, url, html)``.

Each page is handled inside its own row with regular expressions and array
functions; nothing is shuffled, and the arrays are as long as the page. Where
elements nest, ``markup`` finds them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlytics.functions.dates import parse_page_date
from eventlytics.functions.numbers import parse_count, parse_money
from eventlytics.functions.odds import implied_probability, is_line, parse_line
from eventlytics.functions.text import collapse_space, strip_label, url_to_title
from eventlytics.operators import markup, page_batches
from eventlytics.operators.markup import first, resolved, select, text_of

# Header keywords of the facts table, first match wins.
FACTS = (
    ("attendance", ("attendance",)),
    ("gate", ("gate",)),
    ("venue", ("venue",)),
    ("location", ("city", "location")),
    ("date", ("date",)),
    ("buys", ("buyrate", "buys")),
)
FACT_ROW = r"(?is)<tr[^>]*>\s*(<th\b.*?</th>\s*<td\b.*?</td>)\s*</tr>"
HEAD_CELL = r"(?is)<th\b[^>]*>(.*?)</th>"
DATA_CELL = r"(?is)<td\b[^>]*>(.*?)</td>"
ANCHOR = r"(?is)<a\s[^>]*?href=\"[^\"]*\"[^>]*>.*?</a>"
HREF = r"(?is)href=\"([^\"]*)\""
ODDS_TABLE = r"(?is)<table[^>]*class=\"odds-table\"[^>]*>(.*?)</table>"
TABLE_ROW = r"(?is)<tr[^>]*>(.*?)</tr>"
NAME_CELL = r"(?is)<th[^>]*class=\"oppcell\"[^>]*>(.*?)</th>"
LINE_CELL = r"(?is)<td[^>]*class=\"odds\"[^>]*>.*?</td>"
TAG = r"(?s)<[^>]*>"
TOTALS = ("kd", "sig_str", "sig_str_pct", "total_str", "td", "td_pct", "sub_att", "rev", "ctrl")
STRIKES = ("sig_str", "sig_str_pct", "head", "body", "leg", "distance", "clinch", "ground")
# Labels of the texts on contests' and entities' pages.
RESULT_LABELS = {"round": "Round", "time": "Time", "time_format": "Time format", "referee": "Referee"}
TAPE_LABELS = {"height": "Height", "weight": "Weight", "reach": "Reach", "stance": "STANCE", "dob": "DOB"}


def all_groups(c: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def cell_text(c: Column) -> Column:
    """Text of a markup fragment: tags dropped, entities resolved, trimmed."""
    return markup.trimmed(resolved(F.regexp_replace(c, TAG, "")))


def tag_texts(html: Column, tag: str, cls: str | None = None) -> Column:
    """Texts of all elements of a tag, optionally with a class, in page order."""
    attributes = rf"[^>]*class=\"{cls}\"[^>]*" if cls else r"(?:\s[^>]*)?"
    found = all_groups(html, rf"(?is)<{tag}{attributes}>(.*?)</{tag}>")
    return F.transform(found, cell_text)


def links(
    pages: DataFrame,
    prefix: str = "",
    shortest_text: int = 1,
    without_text: str | None = None,
    without_href: str | None = None,
    keep: Sequence[str] = ("page_id",),
) -> DataFrame:
    """(page, pos, href, text): links with a prefix, each once, at its first place.

    Links whose text is too short or holds ``without_text``, or whose target
    holds ``without_href`` in any case, are left out.
    """
    anchors = F.transform(
        all_groups(F.col("html"), ANCHOR, 0),
        lambda a: F.struct(F.regexp_extract(a, HREF, 1).alias("href"), cell_text(a).alias("text")),
    )

    def wanted(a: Column) -> Column:
        hit = a["href"].startswith(prefix) & (F.length(a["text"]) >= shortest_text)
        if without_text:
            hit = hit & ~a["text"].contains(without_text)
        if without_href:
            hit = hit & ~F.lower(a["href"]).contains(without_href)
        return hit

    found = pages.select(*keep, F.filter(anchors, wanted).alias("a_"))
    # links by target and place: the first of a target follows one of another target
    by_href = F.array_sort(F.transform("a_", lambda a, i: F.struct(a["href"], i.alias("i"), a["text"])))
    targets = found.withColumn("s_", by_href)
    first = F.filter("s_", lambda a, i: (i == 0) | (F.get("s_", i - 1)["href"] != a["href"]))
    placed = F.array_sort(F.transform(first, lambda a: F.struct(a["i"], a["href"], a["text"])))
    return targets.select(*keep, F.posexplode(placed).alias("pos", "a")).select(*keep, "pos", "a.href", "a.text")


def facts(pages: DataFrame) -> DataFrame:
    """One record per page from its two-column facts table.

    Rows are told by keywords in the header cell; pages naming neither an
    attendance nor a gate are dropped.
    """
    def kind(row: Column) -> Column:
        head = F.replace(F.lower(cell_text(F.regexp_extract(row, HEAD_CELL, 1))), F.lit(" "), F.lit(""))
        out = None
        for name, words in FACTS:
            hit = F.lit(False)
            for w in words:
                hit = hit | head.contains(w)
            out = F.when(hit, name) if out is None else out.when(hit, name)
        return out

    rows = F.transform(
        all_groups(F.col("html"), FACT_ROW),
        lambda r: F.struct(kind(r).alias("kind"), F.regexp_extract(r, DATA_CELL, 1).alias("data")),
    )

    def cell(name: str) -> Column:
        # of several rows with one keyword the last counts
        mine = F.filter("rows", lambda r: r["kind"] == name)
        return cell_text(F.try_element_at(mine, F.lit(-1))["data"])

    raw = pages.select("page_id", "url", rows.alias("rows")).select(
        "page_id", "url", *[cell(name).alias(name) for name, _ in FACTS]
    )
    typed = F.struct(
        parse_count(F.col("attendance")).alias("attendance"),
        parse_money(F.col("gate")).alias("gate_revenue"),
        "venue",
        "location",
        parse_page_date(F.col("date")).alias("event_date"),
        parse_count(F.col("buys")).alias("ppv_buys"),
    )
    # none or one record per page; a filter would be pushed under the parsing
    # and run all of it twice
    wanted = F.filter(F.array(typed), lambda r: F.coalesce(r["attendance"], r["gate_revenue"]).isNotNull())
    return raw.select("page_id", "url", F.explode(wanted).alias("r")).select("page_id", "url", "r.*")


def chunk_records(
    pages: DataFrame, flat: Column, names: Sequence[str], keep: Sequence[str] = ("page_id",)
) -> DataFrame:
    """Records from one flat list, ``len(names)`` entries each."""
    width = len(names)
    lists = pages.select(*keep, flat.alias("flat_"))
    starts = F.sequence(F.lit(0), F.floor(F.size("flat_") / width).cast("int") - 1)
    chunks = F.transform(
        F.when(F.size("flat_") >= width, starts).otherwise(F.array().cast("array<int>")),
        lambda i: F.slice("flat_", i * width + 1, width),
    )
    return lists.select(*keep, F.posexplode(chunks).alias("pos", "c")).select(
        *keep, "pos", *[F.col("c")[i].alias(n) for i, n in enumerate(names)]
    )


def schedule_records(pages: DataFrame, link_class: str, date_class: str, place_class: str) -> DataFrame:
    """(event, link, date, location) rows of a schedule page, one for each table row with a link.

    The row of an event yet to come has a date and a place, but no link.
    """
    fields = {
        "event": lambda _, inside: text_of(first(inside, "a", link_class)),
        "link": lambda _, inside: markup.attribute(first(inside, "a", link_class), "href"),
        "date": lambda _, inside: text_of(first(inside, "span", date_class)),
        "location": lambda _, inside: text_of(first(inside, "td", place_class)),
    }
    return markup.records(markup.scan(pages, ["tr", "td", "a", "span"]), select(F.col("elements"), "tr"), fields, "link")


def contest_list(pages: DataFrame, title_class: str, row_class: str, name_class: str) -> DataFrame:
    """(event, bout, url) of every contest row of an event's page.

    The row's own ``data-link`` is its url, null where it has none; both sides' names are its links.
    """
    scanned = markup.scan(pages, ["h2", "tr", "a"])
    title = text_of(first(F.col("elements"), "h2", title_class))
    fields = {
        "bout": lambda _, inside: F.array_join(F.transform(select(inside, "a", name_class), lambda e: text_of(e)), " vs. "),
        "url": lambda row, _: markup.attribute(row, "data-link"),
    }
    rows = select(F.col("elements"), "tr", row_class)
    found = markup.records(scanned.withColumn("event", title), rows, fields, "bout", ["page_id", "event"])
    return found.select("page_id", "pos", "event", "bout", "url")


def entity_list(pages: DataFrame, link_class: str, names: Sequence[str] = ("first", "last", "nickname")) -> DataFrame:
    """Names and url of every table row that holds links: the n-th link is the n-th name."""
    def nth(i: int):
        return lambda _, inside: text_of(F.get(select(inside, "a", link_class), i))

    fields = {name: nth(i) for i, name in enumerate(names)}
    fields["url"] = lambda _, inside: markup.attribute(first(inside, "a", link_class), "href")
    return markup.records(markup.scan(pages, ["tr", "a"]), select(F.col("elements"), "tr"), fields, "url")


def alternate(cells: Column, side: int) -> Column:
    """Entries at even (side 0) or odd (side 1) positions."""
    return F.filter(cells, lambda x, i: i % 2 == side)


def segments(df: DataFrame, flat: str, out: str = "segments") -> DataFrame:
    """Split a list column into segments that each start with its first value.

    Neighbouring repeats of the first value open one segment only. The start
    positions are a column of their own, so they are found once per row.
    """
    at = F.col(flat)
    start = F.try_element_at(at, F.lit(1))
    opens = F.transform(
        at, lambda x, i: F.when((x == start) & ((i == 0) | ~F.get(at, i - 1).eqNullSafe(start)), i + 1)
    )
    starts = F.col("starts_")
    ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(at) + 1))
    return (
        df.withColumn("starts_", F.filter(opens, lambda p: p.isNotNull()))
        .withColumn(out, F.zip_with(starts, ends, lambda a, b: F.slice(at, a, b - a)))
        .withColumn(out, F.slice(out, 1, F.size("starts_")))
        .drop("starts_")
    )


def round_stats(sheets: DataFrame, stats: str, keep: Sequence[str]) -> DataFrame:
    """Rows per round from one side's flat list of cells.

    The list holds a summary and one segment per round of totals, then the same
    of strikes. Summaries are dropped; totals and strikes of a round are put
    side by side where the columns both have agree.
    """
    parts = segments(sheets.select(*keep, stats), stats, "seg_")
    rounds = F.greatest(F.floor((F.size("seg_") - 2) / 2), F.lit(0)).cast("int")
    half = F.floor(F.size("seg_") / 2).cast("int")
    # the n-th round of totals beside the n-th round of strikes
    pairs = F.arrays_zip(
        F.slice("seg_", 2, rounds).alias("t"), F.slice("seg_", half + 2, rounds).alias("s")
    )
    rows = parts.select(*keep, F.posexplode(pairs).alias("at_", "p")).select(
        *keep, "at_", F.col("p.t").alias("t"), F.col("p.s").alias("s")
    )
    shared = [c for c in STRIKES if c in TOTALS]
    agree = F.get("t", 0).eqNullSafe(F.get("s", 0))
    for c in shared:
        agree = agree & F.get("t", 1 + TOTALS.index(c)).eqNullSafe(F.get("s", 1 + STRIKES.index(c)))
    return rows.filter(agree).select(
        *keep,
        F.concat(F.lit("Round "), (F.col("at_") + 1).cast("string")).alias("round"),
        F.get("t", 0).alias("fighter"),
        *[F.get("t", i + 1).alias(c) for i, c in enumerate(TOTALS)],
        *[F.get("s", i + 1).alias(c) for i, c in enumerate(STRIKES) if c not in shared],
    )


def sheet_sides(pages: DataFrame, cell_class: str, keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """keep, a, b: both sides' texts from cells that hold a paragraph for each side in turn.

    A cell has at least one place for each side; what is absent is null there, so that
    later cells don't shift.
    """
    found = page_batches.texts(pages, {"raw_": ("grouped", [("td", cell_class, None), ("p", None, None)])}, keep=keep)
    cells = F.transform("raw_", lambda cell: F.transform(cell, markup.read))

    def side(odd: int) -> Column:
        def places(cell: Column) -> Column:
            last = F.greatest(F.ceil((F.size(cell) - 2) / 2).cast("int"), F.lit(0))
            return F.transform(F.sequence(F.lit(0), last), lambda i: F.get(cell, 2 * i + odd))

        return F.flatten(F.transform("cells", places))

    return found.select(*keep, cells.alias("cells")).select(*keep, side(0).alias("a"), side(1).alias("b"))


def side_stats(sides: DataFrame, keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """Round rows of both sides of a sheet."""
    return round_stats(sides.select(*keep, F.explode(F.array("a", "b")).alias("one_")), "one_", keep)


def labelled(texts: Column, label: str) -> Column:
    """What follows a label in the first of several texts that begins with it."""
    return strip_label(F.get(F.filter(texts, lambda t: t.startswith(f"{label}:")), 0))


def result_record(pages: DataFrame, keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """Contest record of a contest's page; what the page lacks is null and shifts nothing."""
    start = "b-fight-details__"
    lines = ("p", start + "text")
    found = page_batches.texts(pages, {
        "event": ("first", [("h2", "b-content__title", 0)]),
        "names": ("all", [("a", f"b-link {start}person-link", None)]),
        "outcomes": ("all", [("div", start + "person", None), ("i", None, None)]),
        "weightclass": ("first", [("div", start + "fight-head", 0)]),
        "method": ("first", [("i", start + "text-item_first", 0)]),
        "items": ("all", [(*lines, 0), ("i", start + "text-item", None)]),
        "details": ("first", [(*lines, 1)]),
    }, keep=[*keep, "url"])

    def one(name: str) -> Column:
        return collapse_space(markup.read(F.col(name)))

    def texts(name: str) -> Column:
        return F.transform(name, lambda t: collapse_space(markup.read(t))).alias(name)

    return found.select(
        *keep, "url",
        one("event").alias("event"), texts("names"), texts("outcomes"), one("weightclass").alias("weightclass"),
        strip_label(one("method")).alias("method"), texts("items"), strip_label(one("details")).alias("details"),
    ).select(
        *keep, "event",
        F.array_join(F.slice("names", 1, 2), " vs. ").alias("bout"),
        F.array_join(F.slice("outcomes", 1, 2), "/").alias("outcome"),
        "weightclass", "method",
        *[labelled(F.col("items"), label).alias(name) for name, label in RESULT_LABELS.items()], "details", "url",
    )


def tape_record(pages: DataFrame, keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """Entity record of an entity's page: the labels in its first list and the texts after them."""
    scanned = markup.scan(pages, ["span", "ul", "i"], keep=keep)
    elements = F.col("elements")
    name = text_of(first(elements, "span", "b-content__title-highlight"))
    box = select(markup.below(first(elements, "ul", "b-list__box-list")), "i")
    items = F.transform(box, lambda e: collapse_space(F.concat(text_of(e), markup.text_after(e))))
    return scanned.select(*keep, collapse_space(name).alias("fighter"), items.alias("items")).select(
        *keep, "fighter", *[labelled(F.col("items"), label).alias(c) for c, label in TAPE_LABELS.items()]
    )


def odds_records(pages: DataFrame) -> DataFrame:
    """One contest per two-row odds table, titled by the page's URL."""
    tables = all_groups(F.col("html"), ODDS_TABLE)
    two_rows = F.slice(all_groups(F.col("t"), TABLE_ROW), 1, 2)
    # name and first line of each row; '' where a cell is missing
    sides = F.transform(
        two_rows,
        lambda r: F.struct(
            cell_text(F.regexp_extract(r, NAME_CELL, 1)).alias("name"),
            F.regexp_extract(r, LINE_CELL, 0).alias("cell"),
        ),
    )
    found = pages.select("page_id", "url", F.posexplode(tables).alias("pos", "t")).select(
        "page_id", "url", "pos", sides.alias("s")
    )
    complete = (F.size("s") == 2) & ~F.exists("s", lambda x: (x["name"] == "") | (x["cell"] == ""))
    # none or one record per table; a filter would be pushed under the parsing
    kept = found.select("page_id", "url", "pos", F.explode(F.when(complete, F.array("s"))).alias("s"))
    lines = {f"line{i}_": cell_text(F.get("s", i - 1)["cell"]) for i in (1, 2)}
    out = kept.withColumns(lines)
    # one unreadable line voids both, as they are only meaningful together
    readable = is_line(F.col("line1_")) & is_line(F.col("line2_"))
    odds = {
        f"fighter{i}_odds": F.when(readable, parse_line(F.col(f"line{i}_"))).otherwise(0)
        for i in (1, 2)
    }
    probs = {f"fighter{i}_implied_prob": implied_probability(F.col(f"fighter{i}_odds")) for i in (1, 2)}
    return out.withColumns(odds).withColumns(probs).select(
        "page_id", "pos", url_to_title(F.col("url")).alias("event_name"),
        *[F.get("s", i - 1)["name"].alias(f"fighter{i}_name") for i in (1, 2)], *odds, *probs,
    )
