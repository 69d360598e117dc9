"""Categories, flags and buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventlytics.functions.text import normalize_name

# Category rules, first match wins.
NUMBERED_EVENT = "^UFC [0-9]+"
EVENT_TYPES = (("Fight Night", "Fight Night"), ("TUF", "TUF"), ("Contender", "DWCS"))
METHODS = (("KO", "KO/TKO"), ("SUB", "Submission"), ("DEC", "Decision"))
FINISHES = ("KO/TKO", "Submission")
COUNTRIES = {
    "USA": ("USA", "United States"),
    "UK": ("UK", "England", "Scotland"),
    "Canada": ("Canada",),
}
BASE_TYPES = (
    (r"ufc\s+(ultimate\s+)?fight\s+night", "ufc fight night"),
    (r"the\s+ultimate\s+fighter", "the ultimate fighter"),
)
NETWORK_TYPE = r"(ufc\s+on\s+\w+)"
NUMBERED_TYPE = r"ufc\s+\d+"
CLASS_AFFIXES = r"^UFC | Title| Bout"
SENTIMENT_EDGES = (-1.0, -0.2, 0.2, 1.0)
SENTIMENT_LABELS = ("Negative", "Neutral", "Positive")
STABILITY = ((0.1, "stable"), (0.2, "moderate"))


def event_type(name: Column) -> Column:
    out = F.when(name.rlike(NUMBERED_EVENT), "PPV")
    for text, label in EVENT_TYPES:
        out = out.when(name.contains(text), label)
    return out.otherwise("Other")


def method_category(method: Column) -> Column:
    """How a contest ended; spelling and case of the source do not matter."""
    upper = F.upper(method)
    first, *rest = METHODS
    out = F.when(upper.contains(first[0]), first[1])
    for text, label in rest:
        out = out.when(upper.contains(text), label)
    return out.otherwise("Other")


def base_event_type(name: Column) -> Column:
    """Series an event belongs to, the normalised name if none is known."""
    low = F.lower(name)
    (first, label), *others = BASE_TYPES
    out = F.when(low.rlike(first), label)
    for pattern, label in others:
        out = out.when(low.rlike(pattern), label)
    return (
        out.when(low.rlike(NETWORK_TYPE), F.regexp_extract(low, NETWORK_TYPE, 1))
        .when(low.rlike(NUMBERED_TYPE), "ufc")
        .otherwise(normalize_name(name))
    )


def city(location: Column) -> Column:
    return F.try_element_at(F.split(location, ", "), F.lit(1))


def country(location: Column) -> Column:
    """Last part of a place with two or more parts, common names unified."""
    parts = F.split(location, ", ")
    last = F.when(F.size(parts) >= 2, F.try_element_at(parts, F.lit(-1)))
    unified = [F.when(last.isin(*names), F.lit(label)) for label, names in COUNTRIES.items()]
    return F.coalesce(*unified, last)


def is_title(weight_class: Column) -> Column:
    return weight_class.contains("Title")


def bare_class(weight_class: Column) -> Column:
    """Class without its promotion, title and bout affixes."""
    return F.regexp_replace(weight_class, CLASS_AFFIXES, "")


def winner(outcome: Column, one: Column, two: Column) -> Column:
    """Name of the winning side; NULL for draws and no contests."""
    return F.when(outcome.startswith("W"), one).when(outcome.startswith("L"), two)


def is_vegas(city_: Column) -> Column:
    return F.lower(city_).contains("las vegas").cast("int")


def is_usa(country_: Column) -> Column:
    return (country_ == "USA").cast("int")


def is_ppv(type_: Column) -> Column:
    return (type_ == "PPV").cast("int")


def bucket(value: Column, edges: tuple[float, ...], labels: tuple[str, ...]) -> Column:
    """Right-closed bins ``(e0, e1], (e1, e2] …``; outside them NULL."""
    out = None
    for low, high, label in zip(edges, edges[1:], labels):
        hit = (value > low) & (value <= high)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


def sentiment_category(value: Column) -> Column:
    return bucket(value, SENTIMENT_EDGES, SENTIMENT_LABELS)


def stability_class(std: Column) -> Column:
    out = None
    for limit, label in STABILITY:
        out = F.when(std < limit, label) if out is None else out.when(std < limit, label)
    return out.otherwise("unstable")
