"""Helpers that keep a plan whole on large and skewed data.

* ``shared_checkpoint`` cuts lineage in the folder all executors can reach;
* ``shared_table`` does so in rounds that join what earlier rounds left;
* ``split_hot`` separates the few keys too large for one task;
* ``ordered_chunks`` cuts an ordering into ranges that may split a key;
* ``dense_ids`` and ``exact_quantiles`` are built on them.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# A window partition or group up to this many rows is fine for one task.
HOT_ROWS = 2_000_000
# Steps of the sketch that narrows a bracket.
GRID = 100
# A counted side of narrow rows up to this length is broadcast.
BROADCAST_ROWS = 200_000


def checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named in ``spark.checkpoint.dir``; local runs get their own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="checkpoints-")
    context.setCheckpointDir(configured)


def shared_checkpoint(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and go on from there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_table(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder as files and go on from those.

    A checkpoint keeps the size that its plan was estimated at, and that of a join is the
    product of its sides. Where every round joins what the last one left, the digits of
    this number multiply from round to round, and with them the driver's time and memory.
    Files have the size they have; they stay until the folder is cleaned.
    """
    checkpoint_dir(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for heavy per-row work on an input of few file splits.

    An input with at least as many splits as cores is left as it is, so large
    tables are never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def splittable(df: DataFrame) -> DataFrame:
    """A reduced side, dealt out anew before it is joined.

    Spark splits the skewed keys of a join only if both sides come straight from
    an exchange for that join. An aggregate or a windowed side is already dealt by
    the key and would keep that; after a deal without a key it is exchanged again.
    """
    return df.repartition(shuffle_width(df.sparkSession))


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def broadcast_checked(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Materialise a side expected to be small; broadcast it only if it is."""
    small = shared_checkpoint(df)
    return F.broadcast(small) if small.count() <= max_rows else small


def split_hot(
    df: DataFrame, keys: Sequence[str], limit: int = HOT_ROWS
) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of keys with more than ``limit`` rows).

    The count reads the key columns only and is combined before the shuffle.
    There are at most rows / limit hot keys, so their list is short; the second
    result is None where there are none, which costs nothing further.
    """
    counts = df.groupBy(*keys).count().filter(F.col("count") > limit).select(*keys)
    if counts.isEmpty():
        return df, None
    hot = broadcast_checked(counts)
    on = null_safe(df, hot, keys)
    return df.join(hot, on, "left_anti"), df.join(hot, on, "left_semi")


def ordered_chunks(df: DataFrame, order: Sequence[str], chunk_rows: int = HOT_ROWS) -> DataFrame:
    """Rows with ``chunk_``: ascending ranges of ``order``, of about ``chunk_rows``.

    The range exchange splits at any value of the full ordering, so one key can
    span many chunks. The rows are written out first: chunk numbers must not
    change if a task is run again.
    """
    rows = df.count()
    width = max(rows // chunk_rows + 1, 2)
    ranged = df.repartitionByRange(width, *order)
    return shared_checkpoint(ranged.withColumn("chunk_", F.spark_partition_id()))


def dense_ids(df: DataFrame, key: str, id_name: str = "id", chunk_rows: int = HOT_ROWS) -> DataFrame:
    """0, 1, 2, … in key order over distinct keys, without a global window."""
    chunks = ordered_chunks(df, [key], chunk_rows)
    before = Window.orderBy("chunk_").rowsBetween(Window.unboundedPreceding, -1)
    # one row per chunk, so the unpartitioned window is over a short list
    offsets = chunks.groupBy("chunk_").agg(F.count("*").alias("n_")).select(
        "chunk_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("offset_")
    )
    inside = F.row_number().over(Window.partitionBy("chunk_").orderBy(key))
    return (
        chunks.withColumn("pos_", inside)
        .join(offsets, "chunk_")
        .withColumn(id_name, F.col("offset_") + F.col("pos_") - 1)
        .drop("chunk_", "pos_", "offset_")
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in a stated order.

    Spark cuts every map task's rows to one per key before the shuffle
    (WindowGroupLimit), so copies of one key never meet in one task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank_", rank).filter("rank_ = 1").drop("rank_")


def keep_first_n(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int
) -> DataFrame:
    """The first ``n`` rows per key, cut before the shuffle as above."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank_", rank).filter(F.col("rank_") <= n).drop("rank_")


def exact_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    probs: Sequence[float],
    accuracy: int = 20_000,
    ordered_rows: int = 1_000_000,
) -> DataFrame:
    """Exact interpolated quantiles per group, as columns ``q0, q1, …``.

    A mergeable sketch brackets each wanted rank. While a bracket holds more than
    ``ordered_rows`` rows, a sketch of its inside narrows it to a few hundredths; a
    last pass counts what lies below and orders only the distinct values left. All
    passes combine before the shuffle, so a group may be of any size.
    """
    data = df.filter(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("v_"))
    margin = 4.0 / accuracy
    steps = [x for p in probs for x in (max(p - margin, 0.0), min(p + margin, 1.0))]
    sketch = data.groupBy(*groups).agg(
        F.count("*").alias("n_"),
        F.percentile_approx("v_", steps, accuracy).alias("s_"),
        F.min("v_").alias("min_"),
        F.max("v_").alias("max_"),
    )
    # the sketch is off by n / accuracy rows at most, the bracket spans four
    # times that; a group too small for the margin to cover a row takes all
    small = F.col("n_") <= accuracy
    # the wanted zero-based ranks: both neighbours of p * (n - 1)
    bounds = F.array(
        *[
            F.struct(
                F.lit(i).alias("q"),
                (F.col("n_") - 1).alias("last"),
                ((F.col("n_") - 1) * F.lit(float(p))).alias("at"),
                F.when(small, F.col("min_")).otherwise(F.col("s_")[2 * i]).alias("lo"),
                F.when(small, F.col("max_")).otherwise(F.col("s_")[2 * i + 1]).alias("hi"),
            )
            for i, p in enumerate(probs)
        ]
    )
    brackets = sketch.select(*groups, F.explode(bounds).alias("b")).select(*groups, "b.*")
    def with_brackets(table: DataFrame) -> DataFrame:
        if groups:
            return data.join(broadcast_checked(table), list(groups))
        # one row per probability: read them as constants
        known = [F.struct(*[F.lit(x).alias(n) for n, x in r.asDict().items()]) for r in table.collect()]
        return data.select("v_", F.explode(F.array(*known)).alias("b")).select("v_", "b.*")

    brackets = shared_checkpoint(brackets)
    while narrower := _too_wide(with_brackets(brackets), groups, ordered_rows, max(accuracy, GRID * GRID)):
        brackets = narrower
    near = with_brackets(brackets)
    keys = [*groups, "q", "at"]
    counted = (
        near.filter(F.col("v_") <= F.col("hi"))
        .withColumn("v_", F.when(F.col("v_") >= F.col("lo"), F.col("v_")))
        .groupBy(*keys, "v_")
        .agg(F.count("*").alias("c_"))
    )
    # values under the bracket were folded into one NULL row, which sorts first
    upto = Window.partitionBy(*groups, "q").orderBy(F.col("v_").asc_nulls_first())
    ranked = counted.withColumn("end_", F.sum("c_").over(upto.rowsBetween(Window.unboundedPreceding, 0)))

    def at_rank(rank: Column) -> Column:
        inside = (F.col("end_") > rank) & (F.col("end_") - F.col("c_") <= rank)
        return F.max(F.when(inside, F.col("v_")))

    low, high = F.floor("at"), F.ceil("at")
    picked = ranked.groupBy(*keys).agg(at_rank(low).alias("a_"), at_rank(high).alias("z_"))
    missed = F.col("a_").isNull() | F.col("z_").isNull()
    picked = picked.withColumn(
        "a_", F.when(missed, F.raise_error("a rank lies outside its bracket; raise accuracy")).otherwise(F.col("a_"))
    )
    part = F.col("at") - F.floor("at")
    whole = picked.withColumn("x_", F.col("a_") + (F.col("z_") - F.col("a_")) * part)
    columns = [
        F.max(F.when(F.col("q") == i, F.col("x_"))).alias(f"q{i}") for i in range(len(probs))
    ]
    return whole.groupBy(*groups).agg(*columns)


def _too_wide(near: DataFrame, groups: Sequence[str], limit: int, accuracy: int) -> DataFrame | None:
    """Brackets narrowed around their ranks; None if none was too wide or could shrink."""
    own = [*groups, "q", "last", "at", "lo", "hi"]
    held = F.when(F.col("v_").between(F.col("lo"), F.col("hi")), F.col("v_"))
    steps = [i / GRID for i in range(GRID + 1)]
    state = near.groupBy(*own).agg(
        F.count_if(F.col("v_") < F.col("lo")).alias("below_"), F.count(held).alias("inside_"),
        F.percentile_approx(held, steps, accuracy).alias("grid_"),
    )
    # one step of the grid to either side is far more than the sketch can be off
    place = (F.floor("at") - F.col("below_")) / F.col("inside_") * GRID
    wide = F.col("inside_") > limit
    first = F.get("grid_", F.greatest(F.floor(place).cast("int") - 1, F.lit(0)))
    last = F.get("grid_", F.least(F.ceil(place).cast("int") + 2, F.lit(GRID)))
    state = shared_checkpoint(
        state.withColumns({
            "low_": F.when(wide, first).otherwise(F.col("lo")), "high_": F.when(wide, last).otherwise(F.col("hi"))
        })
    )
    if state.filter((F.col("low_") > F.col("lo")) | (F.col("high_") < F.col("hi"))).isEmpty():
        return None
    return state.select(*own[:-2], F.col("low_").alias("lo"), F.col("high_").alias("hi"))
