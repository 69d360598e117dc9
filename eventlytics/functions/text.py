"""Names, keys, URLs and labels held in text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that must match the source data.
SIDE_ONE = r"^(.+?)\s+vs\.?\s+"
SIDE_TWO = r"^.+?\s+vs\.?\s+(.+)$"
CONTEST_NUMBER = r"UFC\s*(\d+)"
LABEL_PREFIX = r"^(.+?): ?"
WIKI_ROOT = "https://en.wikipedia.org/wiki/"


def non_empty(c: Column) -> Column:
    """The text, or NULL where it is empty (what a failed regex group gives)."""
    return F.nullif(c, F.lit(""))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """A regex group, NULL instead of '' where it does not match."""
    return non_empty(F.regexp_extract(c, pattern, group))


def normalize_name(c: Column) -> Column:
    """Join key of a name: lower case, then only ``a-z0-9`` kept."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def full_name(*parts: Column) -> Column:
    return F.concat_ws(" ", *parts)


def side_one(bout: Column) -> Column:
    """Left side of ``A vs. B``; the first separator splits."""
    return F.trim(F.regexp_extract(bout, SIDE_ONE, 1))


def side_two(bout: Column) -> Column:
    """Right side of ``A vs. B``; everything behind the first separator."""
    return F.trim(F.regexp_extract(bout, SIDE_TWO, 1))


def composite_key(*parts: Column) -> Column:
    return F.concat_ws("_", *parts)


def pair_low(a: Column, b: Column) -> Column:
    return F.least(a, b)


def pair_high(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def id_from_url(url: Column, kind: str) -> Column:
    """``…/<kind>-details/ID`` or ``…/<kind>/ID``; the URL itself otherwise."""
    found = [
        F.when(url.contains(f"{path}/"), F.regexp_extract(url, f"{path}/([^/]+)", 1))
        for path in (f"{kind}-details", kind)
    ]
    return F.coalesce(*found, url)


def contest_number(name: Column) -> Column:
    """Running number in an event name, '' if there is none."""
    return F.regexp_extract(name, CONTEST_NUMBER, 1)


def strip_label(c: Column) -> Column:
    """Drop a leading ``Label:`` and one blank behind it."""
    return F.regexp_replace(c, LABEL_PREFIX, "")


def collapse_space(c: Column) -> Column:
    """Drop line ends and runs of two blanks, as in scraped cells."""
    return F.regexp_replace(F.regexp_replace(c, "\n", ""), "  ", "")


def join_sides(a: Column, b: Column, separator: str = " vs. ") -> Column:
    return F.concat_ws(separator, a, b)


def name_to_url(name: Column, root: str = WIKI_ROOT) -> Column:
    """Article URL of an event name: blanks to ``_``, colons escaped."""
    slug = F.replace(F.replace(F.trim(name), F.lit(" "), F.lit("_")), F.lit(":"), F.lit("%3A"))
    return F.concat(F.lit(root), slug)


def url_to_title(url: Column) -> Column:
    """Last path part with dashes as blanks, each word capitalised."""
    return F.initcap(F.replace(F.substring_index(url, "/", -1), F.lit("-"), F.lit(" ")))


def truncate(c: Column, length: int = 500) -> Column:
    return F.substring(c, 1, length)
