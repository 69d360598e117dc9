"""Tables of vectors: the rows that take part, and blocks of them in files."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlytics.llm.hashstore import Array, write_array


def _split(table: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, Column]:
    rows = table.select(
        table[id_col].cast("long").alias("vec_id"), table[vector_col].cast("array<double>").alias("v")
    )
    known = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fine = F.col("vec_id").isNotNull() & F.col("v").isNotNull() & known & F.exists("v", lambda x: x != 0)
    return rows, F.coalesce(fine, F.lit(False))


def usable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v, dim) of the rows whose vector is known, finite and not zero, and whose id is known."""
    rows, fine = _split(table, id_col, vector_col)
    return rows.filter(fine).withColumn("dim", F.size("v"))


def unusable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id) of all other rows."""
    rows, fine = _split(table, id_col, vector_col)
    return rows.filter(~fine).select("vec_id")


def matrix(rows: pa.Table, dim: int, column: str = "v") -> np.ndarray:
    lists = rows[column].combine_chunks()
    return np.asarray(lists.flatten(), np.float64).reshape(-1, dim)


def save(folder: str, *columns: np.ndarray) -> str:
    """One file of 8-byte columns, end to end."""
    data = [np.ascontiguousarray(c).reshape(-1).view(np.uint64) for c in columns]
    return write_array(folder, np.concatenate(data))


def load(place: str, count: int, *kinds: tuple[type, int], start: int = 0) -> list[np.ndarray]:
    """The columns of a saved file, from its ``start``-th number on: (type, width) each."""
    file, at, out = Array(place), start, []
    for kind, width in kinds:
        part = file.part(at, count * width).view(kind)
        out.append(part.reshape(count, width) if width > 1 else part)
        at += count * width
    return out
