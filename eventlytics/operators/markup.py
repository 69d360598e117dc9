"""Elements of raw pages with their nesting, found inside each row.

One regular expression cuts a page into tags and texts. Where every tag is closed in turn,
elements nest as they are written: the n-th opening tag of a depth belongs to the n-th
closing tag of that depth. Other pages are folded tag by tag with a stack of open elements
and HTML's rules for tags left open. Either way tags that nest in their like are
paired rightly, which no regular expression can do. An element
knows where it starts and stops and which elements lie below it (they follow it in
the list), so records are put together by what encloses them, not by
counting. Work is proportional to the page; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Comments, scripts and styles are one token; a stray "<" is a text of its own.
TOKEN = (
    r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"
    r"|</?[a-z][^>\"']*+(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*+)*+>|<[!?][^>]*>|[^<]+|<"
)
#: Tags that HTML lets stay open; in pages with unclosed tags the next one of the kind
#: closes them, unless what holds them was opened in between.
LEFT_OPEN = ("p", "li", "tr", "td", "th", "dd", "dt", "option")
HOLDERS = ("table", "ul", "ol", "dl", "select")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))

_CHUNK = 64
_OPEN = "array<struct<number:int,start:int,name:string>>"
_CLOSED = "array<struct<number:int,last:int,start:int,stop:int,depth:int,name:string>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), 0)


def _empty(kind: str) -> Column:
    return F.array().cast(kind)


def _closed(open_: Column, kept: Column, stop: Column, opened: Column) -> Column:
    """What is closed when only the first ``kept`` open elements stay."""
    return F.transform(
        F.slice(open_, kept + 1, F.size(open_) - kept),
        lambda e, i: F.struct(
            e["number"].alias("number"), (opened - 1).alias("last"), e["start"].alias("start"),
            stop.alias("stop"), (kept + i).alias("depth"), e["name"].alias("name"),
        ),
    )


def _kept(open_: Column, tag: Column) -> Column:
    """How many open elements a tag leaves open."""
    names = F.transform(open_, lambda e: e["name"])
    size = F.size(names)

    def choose(back: Column) -> Column:
        inside = F.slice(names, size - back + 2, back - 1)  # opened after the last one of the name
        ends = tag["closes"] | (tag["name"].isin(*LEFT_OPEN) & ~F.exists(inside, lambda n: n.isin(*HOLDERS)))
        return F.when((back > 0) & ends, size - back).otherwise(size)

    return _let(F.array_position(F.reverse(names), tag["name"]).cast("int"), choose)


def _step(state: Column, tag: Column) -> Column:
    def after(kept: Column) -> Column:
        rest = F.slice(state["open"], 1, kept)
        mine = F.struct(state["opened"].alias("number"), tag["at"].alias("start"), tag["name"].alias("name"))
        return F.struct(
            F.when(tag["closes"], rest).otherwise(F.concat(rest, F.array(mine))).alias("open"),
            (state["opened"] + F.when(tag["closes"], 0).otherwise(1)).alias("opened"),
            F.concat(state["closed"], _closed(state["open"], kept, tag["at"], state["opened"])).alias("closed"),
        )

    return _let(_kept(state["open"], tag), after)


def _state(open_: Column, opened: Column, name: str, closed: Column) -> Column:
    return F.struct(open_.alias("open"), opened.alias("opened"), closed.alias(name))


def scan(pages: DataFrame, names: Sequence[str], html_col: str = "html", keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """keep, tokens, elements: the page's elements of the given names (and of those that
    hold rows and items) in order of their opening tags.

    An element is (number, last, start, stop, depth, name): the elements below it have the numbers
    up to ``last``, its content are the tokens between ``start`` and ``stop``. A closing tag
    ends the last open element of its name and all opened since; one without an open
    element is ignored; what is never closed goes on to the end of the page. A null
    page has no elements.
    """
    wanted = sorted({*names, *HOLDERS})
    if set(wanted) & set(VOID):
        raise ValueError(f"elements without content can't be scanned: {sorted(set(wanted) & set(VOID))}")
    tokens = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(TOKEN), F.lit(0))
    tag = rf"(?i)^</?({'|'.join(wanted)})(?![a-z0-9-])"
    marked = F.filter(
        F.transform("tokens", lambda t, i: F.struct(
            i.alias("at"), F.when(t.startswith("<"), F.lower(F.regexp_extract(t, tag, 1))).otherwise("").alias("name"),
            t.startswith("</").alias("closes"),
        )),
        lambda t: t["name"] != "",
    )
    nested = pages.select(*keep, tokens.alias("tokens")).withColumn("tags", marked)
    paired = nested.withColumn("opens", _opens()).withColumn("ends", _ends()).withColumn("pairs", F.arrays_zip("opens", "ends"))
    alike = F.forall("pairs", lambda p: (
        (p["opens"]["depth"] == p["ends"]["depth"]) & (p["opens"]["name"] == p["ends"]["name"])
        & (p["opens"]["i"] < p["ends"]["i"])
    ))
    in_turn = (F.size("opens") == F.size("ends")) & alike
    return paired.select(
        *keep, "tokens", F.sort_array(F.when(F.coalesce(in_turn, F.lit(False)), _by_depth()).otherwise(_by_stack())).alias("elements")
    )


def _opens() -> Column:
    """Opening tags by depth, then place."""
    numbered = F.filter(F.transform("tags", lambda t, i: F.struct(i.alias("i"), t.alias("tag"))), lambda t: ~t["tag"]["closes"])
    return F.sort_array(F.transform(numbered, lambda t, n: F.struct(
        (2 * n - t["i"]).alias("depth"), t["i"].alias("i"), n.alias("number"),
        t["tag"]["at"].alias("at"), t["tag"]["name"].alias("name"),
    )))


def _ends() -> Column:
    """Closing tags by the depth they lead back to, then place."""
    numbered = F.filter(F.transform("tags", lambda t, i: F.struct(i.alias("i"), t.alias("tag"))), lambda t: t["tag"]["closes"])
    return F.sort_array(F.transform(numbered, lambda t, k: F.struct(
        (t["i"] - 2 * k - 1).alias("depth"), t["i"].alias("i"), t["tag"]["at"].alias("at"), t["tag"]["name"].alias("name"),
    )))


def _by_depth() -> Column:
    # between an opening tag and its end stand as many opening as closing tags
    return F.transform("pairs", lambda p: F.struct(
        p["opens"]["number"].alias("number"),
        (p["opens"]["number"] + F.shiftright(p["ends"]["i"] - p["opens"]["i"] - 1, 1)).alias("last"),
        p["opens"]["at"].alias("start"), p["ends"]["at"].alias("stop"),
        p["opens"]["depth"].alias("depth"), p["opens"]["name"].alias("name"),
    ))


def _by_stack() -> Column:
    # the list of closed elements is copied with each step: short lists are made, then joined
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor(F.size("tags") / _CHUNK).cast("int")), lambda k: F.slice("tags", k * _CHUNK + 1, _CHUNK)
    )

    def chunk(state: Column, part: Column) -> Column:
        start = _state(state["open"], state["opened"], "closed", _empty(_CLOSED))
        return _let(
            F.aggregate(part, start, _step),
            lambda s: _state(s["open"], s["opened"], "parts", F.concat(state["parts"], F.array(s["closed"]))),
        )

    def finish(state: Column) -> Column:
        left = _closed(state["open"], F.lit(0), F.size("tokens"), state["opened"])
        return F.concat(F.flatten(state["parts"]), left)

    return F.aggregate(chunks, _state(_empty(_OPEN), F.lit(0), "parts", _empty(f"array<{_CLOSED}>")), chunk, finish)


def below(element: Column, elements: Column | str = "elements") -> Column:
    """All elements inside an element, in order."""
    return F.slice(elements, element["number"] + 2, element["last"] - element["number"])


def opening(element: Column, tokens: Column | str = "tokens") -> Column:
    return F.get(tokens, element["start"])


def attribute(element: Column, name: str, tokens: Column | str = "tokens") -> Column:
    """Value of an attribute, entities resolved; null where there is none."""
    value = rf"(?is)^<[^\s>]+(?:\s[^>]*?)?\s{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"

    def bare(found: Column) -> Column:
        quoted = found.startswith('"') | found.startswith("'")
        inside = F.when(quoted, F.substr(found, F.lit(2), F.length(found) - 2)).otherwise(found)
        return F.when(found != "", resolved(inside))

    return _let(F.regexp_extract(opening(element, tokens), value, 1), bare)


def select(elements: Column, name: str, cls: str | None = None, tokens: Column | str = "tokens") -> Column:
    """Elements of a name, and of a class: one of the attribute's words, or all of it."""

    def named(value: Column) -> Column:
        return F.coalesce((value == cls) | F.array_contains(F.split(value, r"\s+"), cls), F.lit(False))

    def hit(e: Column) -> Column:
        return (e["name"] == name) if cls is None else (e["name"] == name) & _let(attribute(e, "class", tokens), named)

    return F.filter(elements, hit)


def first(elements: Column, name: str, cls: str | None = None, tokens: Column | str = "tokens") -> Column:
    return F.get(select(elements, name, cls, tokens), 0)


def resolved(text: Column) -> Column:
    out = text
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.when(text.contains("&"), out).otherwise(text)


def trimmed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"^\s+|\s+$", ""))


def read(text: Column) -> Column:
    """Raw text as it is read: entities resolved, trimmed."""
    return trimmed(resolved(text))


def text_of(element: Column, tokens: Column | str = "tokens") -> Column:
    """All text inside an element, tags left out, entities resolved, trimmed; null without element."""
    inside = F.slice(tokens, element["start"] + 2, element["stop"] - element["start"] - 1)
    return read(F.array_join(F.filter(inside, is_text), ""))


def text_after(element: Column, tokens: Column | str = "tokens") -> Column:
    """The text that follows an element at once, trimmed; empty if a tag follows."""
    token = F.get(tokens, element["stop"] + 1)
    return F.when(element.isNotNull(), F.coalesce(F.when(is_text(token), trimmed(resolved(token))), F.lit("")))


def is_text(token: Column) -> Column:
    return ~token.startswith("<") | (F.length(token) == 1)


def records(
    scanned: DataFrame, outer: Column, fields: Mapping[str, Callable[[Column, Column], Column]], needs: str,
    keep: Sequence[str] = ("page_id",),
) -> DataFrame:
    """keep, pos, fields: a record of every outer element, from it and the elements below it.

    What a record lacks is null and shifts nothing; records without ``needs`` are left out.
    """
    def one(e: Column) -> Column:
        return _let(below(e), lambda inside: F.struct(*[make(e, inside).alias(name) for name, make in fields.items()]))

    # exploded as it is made: Spark asks a column for its size first, and makes it twice for that
    found = F.filter(F.transform(outer, one), lambda r: r[needs].isNotNull())
    return scanned.select(*keep, F.posexplode(found).alias("pos", "r_")).select(*keep, "pos", "r_.*")
