"""What the operators of this subpackage share: inputs, batches, byte packing."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """Only the named columns, so that no other column's name can clash."""
    return docs.select(
        docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"), *more
    )


def fresh_name(base: str, docs: DataFrame) -> str:
    """A column name that no column has, in any case."""
    taken = {c.lower() for c in docs.columns}
    while base.lower() in taken:
        base += "_"
    return base


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == part


def smallest(rows: DataFrame, group: str, order: list[str], n: int, salts: int = 16) -> DataFrame:
    """The first ``n`` rows of each group; no task sorts more than ``salts * n`` rows of a group
    at the end, however large it is."""
    by_salt = Window.partitionBy(group, "salt_").orderBy(*order)
    by_group = Window.partitionBy(group).orderBy(*order)
    few = rows.withColumn("salt_", F.pmod(F.xxhash64(*order), F.lit(salts))).withColumn(
        "place_", F.row_number().over(by_salt)
    ).filter(F.col("place_") <= n)
    return few.withColumn("place_", F.row_number().over(by_group)).filter(F.col("place_") <= n).drop(
        "place_", "salt_"
    )


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one hold about ``limit`` bytes (or one text)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts as Python strings; null is the empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


def to_planes(values: np.ndarray) -> bytes:
    """Bytes of unsigned numbers, all first bytes before all second ones.

    Sorted numbers of one range share their high bytes, which then compress.
    """
    return values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T.tobytes()


def from_planes(data: bytes, dtype: type = np.uint64) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(-1)


def mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit hash of two 64-bit hashes, in order (multiply and fold)."""
    with np.errstate(over="ignore"):
        x = left * np.uint64(0x9E3779B97F4A7C15) + right
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
    return x


def once(key: tuple, build: Callable[[], object]) -> object:
    """What ``build`` gives, made once in a worker process and kept for its next tasks.

    Of each kind (``key[0]``) only the last value stays: the old one is freed before
    another is made, so a long-lived worker doesn't pile up the models of ended queries.
    """
    kept = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker")).__dict__
    kind = f"kind {key[0]}"
    if kind not in kept or kept[kind][0] != key:
        kept.pop(kind, None)
        kept[kind] = key, build()
    return kept[kind][1]
