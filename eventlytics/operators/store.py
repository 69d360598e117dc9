"""A stored table that is refreshed in place: only the buckets a refresh touches are written.

Rows lie in ``data/generation_=G/bucket_=B`` by the hash of their key. A state, one small
file in ``states/version_=V``, names the generation that counts for every bucket. A refresh
writes the touched buckets as a new generation and then the next state: that file is the
switch, so a reader sees the old table or the new one, and a refresh that dies leaves the
old one as it was. Older versions stay readable until their files are deleted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlytics.operators.incremental import refresh
from eventlytics.sources.files import optional_source

_STATE = "bucket_ int, state_generation_ int"


@dataclass(frozen=True)
class Store:
    """``buckets`` and ``keys`` belong to the stored table and can't change later. The
    driver holds one number for each bucket, nothing that grows with rows or keys."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    buckets: int = 256

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _states(self) -> DataFrame | None:
        def read(path: str) -> DataFrame:
            # the version is the folder's, the rows are one file's: it is there whole or not at all
            return self.spark.read.schema(f"{_STATE}, version_ int").json(path)

        return optional_source(read, f"{self.path}/states")

    def version(self) -> int:
        """Number of the current state; 0 before anything was stored."""
        states = self._states()
        newest = states.agg(F.max("version_")).first()[0] if states is not None else None
        return newest or 0

    def generations(self, version: int | None = None) -> dict[int, int]:
        """Bucket -> generation, at most ``buckets`` entries."""
        states, wanted = self._states(), self.version() if version is None else version
        if states is None or not wanted:
            return {}
        return {r[0]: r[1] for r in states.filter(F.col("version_") == wanted).select("bucket_", "state_generation_").collect()}

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table, or some buckets of it, in its current or an older version.

        Which files count is a condition on partition columns, so no other file is read.
        """
        counts = self.generations(version)
        if not counts:
            raise ValueError(f"{self.path} holds no such version")
        chosen = [F.lit(x) for b, g in counts.items() if buckets is None or b in set(buckets) for x in (b, g)]
        rows = self.spark.read.parquet(f"{self.path}/data")
        current = F.create_map(*chosen)[F.col("bucket_")] == F.col("generation_") if chosen else F.lit(False)
        return rows.filter(F.coalesce(current, F.lit(False))).drop("bucket_", "generation_")

    def create(self, rows: DataFrame) -> int:
        """Store a table anew, as the next version."""
        version = self.version() + 1
        self._write(rows, version)
        return self._switch(dict.fromkeys(range(self.buckets), version), version)

    def refresh(self, fresh: DataFrame, stale_keys: DataFrame) -> int:
        """Drop the rows of stale keys, add the fresh rows; the new version.

        ``stale_keys`` holds the key columns, ``fresh`` those of the table. What a bucket
        without such keys holds is neither read nor written. If another refresh was
        quicker, the switch fails and the table is as that one left it.
        """
        old, version = self.generations(), self.version() + 1
        keyed = stale_keys.select(*self.keys).unionByName(fresh.select(*self.keys))
        touched = sorted(r[0] for r in keyed.select(self.bucket().alias("b")).distinct().collect())
        if not touched:
            return version - 1
        store = self.read(buckets=touched)
        kept = refresh(store, fresh.select(*store.columns), stale_keys, list(self.keys))
        self._write(kept.select(*store.columns), version)
        return self._switch(old | dict.fromkeys(touched, version), version)

    def unreferenced(self, versions_kept: int = 1) -> DataFrame:
        """path: data files that none of the last versions names, to be deleted by the caller."""
        last = self.version()
        wanted = [self.read(v).select(F.col("_metadata.file_path").alias("path")).distinct()
                  for v in range(max(1, last - versions_kept + 1), last + 1)]
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
            "pathGlobFilter", "*.parquet").load(f"{self.path}/data").select("path")
        bare = F.regexp_replace("path", "^[a-z0-9]+:/*", "/")
        named = wanted[0]
        for more in wanted[1:]:
            named = named.union(more)
        return files.withColumn("bare_", bare).join(named.select(bare.alias("bare_")), "bare_", "left_anti").select("path")

    def _write(self, rows: DataFrame, version: int) -> None:
        # one file for a bucket, or several where it is large: a hot key is split over tasks
        placed = rows.withColumn("bucket_", self.bucket()).hint("rebalance", "bucket_")
        placed.sortWithinPartitions("bucket_", *self.keys).write.mode("overwrite").partitionBy("bucket_").parquet(
            f"{self.path}/data/generation_={version}"
        )

    def _switch(self, generations: dict[int, int], version: int) -> int:
        rows = self.spark.createDataFrame(sorted(generations.items()), _STATE)
        rows.coalesce(1).write.mode("error").json(f"{self.path}/states/version_={version}")
        return version
