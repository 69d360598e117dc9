"""Dates held as text, and calendar parts of real dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date spellings found in the sources, as (shape, format).
ISO = (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd")
LONG = (r"^([A-Za-z]{4,}|May) \d{1,2}, \d{4}$", "MMMM d, yyyy")
SHORT = (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy")
DAY_FIRST = (r"^\d{1,2} [A-Za-z]+ \d{4}$", "d MMMM yyyy")
ISO_DATE = r"(\d{4}-\d{2}-\d{2})"

SATURDAY = 7


def first_format(c: Column, *spellings: tuple[str, str]) -> Column:
    """Date in the first spelling whose shape fits; NULL otherwise, never an error.

    The shape is checked first because a failed parse costs an exception a row.
    """
    return F.coalesce(*[F.when(c.rlike(shape), F.try_to_date(c, form)) for shape, form in spellings])


def parse_date(c: Column) -> Column:
    """Date from text: an ISO date anywhere in it, else the long spellings."""
    iso = F.regexp_extract(c, ISO_DATE, 1)
    return first_format(F.when(iso != "", iso).otherwise(c), ISO, LONG, SHORT)


def parse_page_date(c: Column) -> Column:
    """Date cell of a page; a footnote mark behind it is cut off."""
    return first_format(F.trim(F.substring_index(c, "[", 1)), LONG, DAY_FIRST, ISO)


def parse_birth_date(c: Column) -> Column:
    """``Jul 3, 1983`` or a long month name; blanks and ``--`` give NULL."""
    return first_format(c, SHORT, LONG)


def day_of_week(c: Column) -> Column:
    """1 = Sunday … 7 = Saturday."""
    return F.dayofweek(c)


def is_saturday(c: Column) -> Column:
    return (F.dayofweek(c) == SATURDAY).cast("int")


def years_between(a: Column, b: Column) -> Column:
    """Absolute distance in years of 365.25 days."""
    return F.abs(F.datediff(a, b)) / F.lit(365.25)


def epoch_to_timestamp(c: Column) -> Column:
    return F.timestamp_seconds(c)
