"""Numbers held in noisy text; every parser returns NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventlytics.functions.text import extract, non_empty

# Shapes of numbers in the sources.
COUNT_RUN = r"([\d,]+)"
MONEY_RUN = r"([\d,]+\.?\d*)"
MILLIONS_RUN = r"([\d.]+)"
FOOTNOTE = r"\[\d+\]"
COUNT_MARKS = r"[~+*]"
CURRENCY_PREFIX = r"US\$|USD|[$£€]"
SMALLEST_STRICT_COUNT = 100


def int_from(c: Column, pattern: str) -> Column:
    """Integer from a regex group."""
    return extract(c, pattern).try_cast("int")


def height_inches(c: Column) -> Column:
    """``5' 11"`` in inches; feet alone are enough."""
    feet, inches = int_from(c, r"(\d+)'"), int_from(c, r"(\d+)\"")
    return feet * 12 + F.coalesce(inches, F.lit(0))


def leading_int(c: Column) -> Column:
    """First run of digits (reach, weight, round)."""
    return int_from(c, r"(\d+)")


def record_wins(c: Column) -> Column:
    return int_from(c, r"^(\d+)")


def record_losses(c: Column) -> Column:
    return extract(c, r"^(\d+)-(\d+)", 2).try_cast("int")


def record_draws(c: Column) -> Column:
    """Third part of ``W-L-D``; 0 where it is not given."""
    return F.coalesce(extract(c, r"^(\d+)-(\d+)-(\d+)", 3).try_cast("int"), F.lit(0))


def landed(c: Column) -> Column:
    """``x`` of ``x of y``."""
    return int_from(c, r"(\d+) of")


def attempted(c: Column) -> Column:
    """``y`` of ``x of y``."""
    return int_from(c, r"of (\d+)")


def number(c: Column, to: str = "int") -> Column:
    """Guarded numeric cast; an integer may be spelt ``2.0``."""
    return F.trim(c).try_cast("double").try_cast(to)


def parse_count(c: Column, strict: bool = False) -> Column:
    """First count in a text such as ``~15,128[3]``; strict drops small ones."""
    bare = F.regexp_replace(F.regexp_replace(c, FOOTNOTE, ""), COUNT_MARKS, "")
    value = F.replace(extract(bare, COUNT_RUN), F.lit(","), F.lit("")).try_cast("bigint")
    return F.when(value >= SMALLEST_STRICT_COUNT, value) if strict else value


def parse_money(c: Column) -> Column:
    """Amount in a text such as ``$2,200,100`` or ``US$1.5 million``."""
    bare = F.trim(F.regexp_replace(c, CURRENCY_PREFIX, ""))
    plain = F.replace(extract(bare, MONEY_RUN), F.lit(","), F.lit("")).try_cast("double")
    millions = extract(bare, MILLIONS_RUN).try_cast("double") * F.lit(1e6)
    return F.when(F.lower(bare).contains("million"), millions).otherwise(plain)


def largest_number(c: Column) -> Column:
    """Largest count named in a text (capacity by configuration)."""
    runs = F.regexp_extract_all(c, F.lit(COUNT_RUN), F.lit(1))
    return F.array_max(
        F.transform(runs, lambda r: non_empty(F.replace(r, F.lit(","), F.lit(""))).try_cast("bigint"))
    )


def guarded_ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` where both are known and ``whole`` is positive."""
    return F.when(whole > 0, part / whole)


def share(hits: Column, tries: Column) -> Column:
    """Accuracy: NULL unless there was a try."""
    return F.when(tries > 0, hits / tries)
