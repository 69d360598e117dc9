"""Whole-frame projections: optional columns, fills, combinations, order."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def optional(df: DataFrame, name: str, kind: str = "string", default=None) -> Column:
    """The column if it is there, else a typed constant."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(default).cast(kind)


def find_column(df: DataFrame, *words: str) -> str | None:
    """First column whose name holds all the words, in any case."""
    for name in df.columns:
        if all(w in name.lower() for w in words):
            return name
    return None


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def safe_names(df: DataFrame) -> DataFrame:
    """Names of letters, digits and ``_`` only, for columnar files."""
    def safe(name: str) -> str:
        return re.sub("[^a-z0-9]+", "_", name.lower().replace("%", " pct ")).strip("_")

    return df.toDF(*[safe(c) for c in df.columns])


def fill(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Per-column defaults; names the frame does not have are skipped."""
    wanted = {k: v for k, v in defaults.items() if k in df.columns}
    return df.fillna(wanted) if wanted else df


def two_sided(
    df: DataFrame, left: str, right: str, total: str, gap: str | None = None, missing=0.0
) -> DataFrame:
    """Sum (and absolute difference) of both sides, unknown sides as 0."""
    a, b = F.coalesce(left, F.lit(missing)), F.coalesce(right, F.lit(missing))
    cols = {total: a + b}
    if gap:
        cols[gap] = F.abs(a - b)
    return df.withColumns(cols)


def same_side(left: str, right: str) -> Column:
    """1 / 0 equality flag, NULL if a side is unknown."""
    return (F.col(left) == F.col(right)).cast("int")


def interactions(
    df: DataFrame, products: Mapping[str, tuple[str, str]]
) -> tuple[DataFrame, list[str]]:
    """Named products of two columns, each made only if both exist."""
    made = {
        name: F.col(a) * F.col(b)
        for name, (a, b) in products.items()
        if a in df.columns and b in df.columns
    }
    return (df.withColumns(made) if made else df), list(made)


def pick_features(df: DataFrame, wanted: Sequence[str]) -> tuple[list[str], list[str]]:
    """(present, missing) columns of a wish list, in its order."""
    present = [c for c in wanted if c in df.columns]
    return present, [c for c in wanted if c not in df.columns]


def move_columns(df: DataFrame, names: Sequence[str], anchor: str, place: str) -> DataFrame:
    """Put ``names`` directly before or after the ``anchor`` column."""
    if place not in ("before", "after"):
        raise ValueError("place is 'before' or 'after'")
    rest = [c for c in df.columns if c not in names]
    at = rest.index(anchor) + (place == "after")
    return df.select(*[f"`{c}`" for c in (*rest[:at], *names, *rest[at:])])
