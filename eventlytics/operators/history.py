"""Per-entity histories: what was known before each contest.

Every row sees only the rows before it in (date, id) order. Ordinary entities
use plain windows, one shuffle for all features. An entity with more rows than
one task should hold is cut into ordered chunks: windows run inside a chunk and
a short per-chunk summary carries totals and the last rows over.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventlytics.functions.categories import FINISHES
from eventlytics.functions.numbers import share
from eventlytics.operators.scale import HOT_ROWS, ordered_chunks, split_hot


@dataclass(frozen=True)
class Prior:
    """A feature over the rows before the current one.

    ``kind`` is count (of rows), sum, avg or last; ``rows`` limits avg to the
    rows just before the current one.
    """

    name: str
    kind: str
    value: str | None = None
    rows: int | None = None


BEFORE = (Window.unboundedPreceding, -1)


def _plain(df: DataFrame, keys: Sequence[str], order: Sequence[str], specs: Sequence[Prior]) -> DataFrame:
    ordered = Window.partitionBy(*keys).orderBy(*order)
    cols = {}
    for s in specs:
        frame = ordered.rowsBetween(-s.rows, -1) if s.rows else ordered.rowsBetween(*BEFORE)
        if s.kind == "count":
            cols[s.name] = F.count("*").over(frame)
        elif s.kind == "last":
            cols[s.name] = F.lag(s.value).over(ordered)
        else:
            cols[s.name] = (F.sum if s.kind == "sum" else F.avg)(s.value).over(frame)
    return df.withColumns(cols)


def _chunked(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], specs: Sequence[Prior], chunk_rows: int
) -> DataFrame:
    columns = df.columns
    rows = ordered_chunks(df, [*keys, *order], chunk_rows)
    group = ["chunk_", *keys]
    inside = Window.partitionBy(*group).orderBy(*order)
    values = sorted({s.value for s in specs if s.value})
    depth = max([s.rows or 1 for s in specs])

    # summary per (key, chunk): totals and the last rows of the chunk
    totals = rows.groupBy(*group).agg(
        F.count("*").alias("rows_"),
        *[F.sum(v).alias(f"sum_{v}") for v in values if _summed(specs, v)],
        *[F.count(v).alias(f"cnt_{v}") for v in values],
    )
    from_end = F.row_number().over(
        Window.partitionBy(*group).orderBy(*[F.col(o).desc() for o in order])
    )
    tails = (
        rows.withColumn("end_", from_end)
        .filter(F.col("end_") <= depth)
        .groupBy(*group)
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("end_")).alias("at"), *values))).alias("tail_"))
    )
    summary = totals.alias("t").join(tails.alias("u"), group_match("t", "u", group)).select("t.*", "u.tail_")
    # carry over the chunks before; a key has at most as many rows here as chunks
    earlier = Window.partitionBy(*keys).orderBy("chunk_")
    past, recent = earlier.rowsBetween(*BEFORE), earlier.rowsBetween(-depth, -1)
    carry = summary.select(
        *group,
        F.coalesce(F.sum("rows_").over(past), F.lit(0)).alias("past_rows_"),
        *[F.sum(f"sum_{v}").over(past).alias(f"past_sum_{v}") for v in values if _summed(specs, v)],
        *[F.coalesce(F.sum(f"cnt_{v}").over(past), F.lit(0)).alias(f"past_cnt_{v}") for v in values],
        F.flatten(F.collect_list("tail_").over(recent)).alias("carry_"),
    )
    joined = rows.alias("r").join(carry.alias("c"), group_match("r", "c", group)).select(
        "r.*", *[f"c.{c}" for c in carry.columns if c not in group]
    )
    before = inside.rowsBetween(*BEFORE)
    joined = joined.withColumn("pos_", F.row_number().over(inside) - 1)
    out = {}
    for s in specs:
        if s.kind == "count":
            out[s.name] = F.col("past_rows_") + F.col("pos_")
        elif s.kind == "last":
            carried = F.try_element_at("carry_", F.lit(-1))[s.value]
            out[s.name] = F.when(F.col("pos_") > 0, F.lag(s.value).over(inside)).otherwise(carried)
        elif s.rows:
            out[s.name] = _rolling(s, inside)
        else:
            total = _plus(F.sum(s.value).over(before), F.col(f"past_sum_{s.value}"))
            count = F.count(s.value).over(before) + F.col(f"past_cnt_{s.value}")
            out[s.name] = total if s.kind == "sum" else F.when(count > 0, total / count)
    return joined.withColumns(out).select(*columns, *[s.name for s in specs])


def _summed(specs: Sequence[Prior], value: str) -> bool:
    return any(s.value == value and s.kind in ("sum", "avg") for s in specs)


def _plus(a: Column, b: Column) -> Column:
    """Sum in which a missing side counts as nothing, NULL if both are."""
    return F.coalesce(a + b, a, b)


def _rolling(s: Prior, inside) -> Column:
    frame = inside.rowsBetween(-s.rows, -1)
    missing = F.greatest(F.lit(s.rows) - F.col("pos_"), F.lit(0))
    size = F.size("carry_")
    borrowed = F.slice(
        F.col("carry_"),
        F.greatest(size - missing + 1, F.lit(1)),
        F.when(size > 0, missing).otherwise(0),
    )
    known = F.filter(F.transform(borrowed, lambda t: t[s.value].cast("double")), lambda x: x.isNotNull())
    total = F.coalesce(F.sum(s.value).over(frame).cast("double"), F.lit(0.0)) + F.aggregate(
        known, F.lit(0.0), lambda a, x: a + x
    )
    count = F.count(s.value).over(frame) + F.size(known)
    return F.when(count > 0, total / count)


def group_match(left: str, right: str, names: Sequence[str]) -> Column:
    on = F.lit(True)
    for n in names:
        on = on & F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}"))
    return on


def prior_features(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    specs: Sequence[Prior],
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add the ``specs`` columns; ``hot_rows=None`` skips the skew check."""
    if hot_rows is None:
        return _plain(df, keys, order, specs)
    ordinary, hot = split_hot(df, keys, hot_rows)
    out = _plain(ordinary, keys, order, specs)
    if hot is None:
        return out
    return out.unionByName(_chunked(hot, keys, order, specs, hot_rows))


def appearances(fights: DataFrame) -> DataFrame:
    """Two rows per contest, one per side, in one scan of the contests."""
    side = F.explode(F.array("fighter1_name", "fighter2_name")).alias("fighter_name")
    rows = fights.select(
        "fight_id", "event_id", "event_date", side,
        "winner_name", "method_category", "is_title_fight", "weight_class",
    )
    won = (F.col("fighter_name") == F.col("winner_name")).cast("int")
    return rows.withColumn("won", won).withColumn(
        "finished",
        F.when((F.col("won") == 1) & F.col("method_category").isin(*FINISHES), 1).otherwise(0),
    )


STAT_COLUMNS = (
    "sig_strikes_landed", "sig_strikes_attempted", "takedowns_landed", "takedowns_attempted",
)


def fight_totals(stats: DataFrame) -> DataFrame:
    """Round statistics summed to one row per (fight, entity)."""
    return stats.groupBy("fight_id", "fighter_name").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in STAT_COLUMNS]
    )


def fighter_features(
    fights: DataFrame, stats: DataFrame, n: int = 5, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Form, experience, layoff and accuracy of each side before each contest."""
    rows = (
        appearances(fights)
        .join(fight_totals(stats), ["fight_id", "fighter_name"], "left")
        .select(
            "fight_id", "event_id", "event_date", "fighter_name", "weight_class", "won", "finished",
            F.col("is_title_fight").cast("int").alias("title_"),
            share(F.col("sig_strikes_landed"), F.col("sig_strikes_attempted")).alias("strike_"),
            share(F.col("takedowns_landed"), F.col("takedowns_attempted")).alias("td_"),
        )
    )
    specs = (
        Prior(f"win_rate_last{n}", "avg", "won", n),
        Prior(f"finish_rate_last{n}", "avg", "finished", n),
        Prior("total_fights", "count"),
        Prior("last_fight", "last", "event_date"),
        Prior("strike_acc", "avg", "strike_"),
        Prior("td_acc", "avg", "td_"),
        Prior("title_fights", "sum", "title_"),
    )
    out = prior_features(rows, ["fighter_name"], ["event_date", "fight_id"], specs, hot_rows)
    return out.select(
        "fight_id", "event_id", "event_date", "fighter_name",
        f"win_rate_last{n}", f"finish_rate_last{n}", "total_fights",
        F.datediff("event_date", "last_fight").alias("days_off"),
        "strike_acc", "td_acc", "title_fights", "weight_class",
    )


def days_since_previous(
    events: DataFrame, group: str = "event_type", hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Days since the event before it in its group."""
    spec = [Prior("previous_", "last", "event_date")]
    out = prior_features(events, [group], ["event_date", "event_id"], spec, hot_rows)
    return out.withColumn("days_since_last", F.datediff("event_date", "previous_")).drop("previous_")
