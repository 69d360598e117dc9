"""Near-duplicate vectors by dual traversal of cover trees.

Vectors of length one are dealt into blocks around a bounded sample of centres,
large blocks into parts of about 2048. Each part gets a cover tree: levels with
halving radii, where every node's points lie within the level's radius of its
centre. Two trees are walked together from the roots: a pair of nodes whose
centres are farther apart than the threshold and both covering radii is dropped,
one that can't be farther is linked as a whole, and the others go on to their
children. Parts meet only if their own radii allow it. Pairs at the leaves are
compared by cosine in double precision, so the result is exact.

A task sends on counts by vector and a spanning forest of its links, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlytics.llm.hashstore import Array, new_folder
from eventlytics.llm.links import components
from eventlytics.llm.vectors import load, matrix, save, unusable, usable
from eventlytics.operators.scale import shared_checkpoint

SIMILARITY = 0.95
PART = 2048
CENTRES = 512  # at most; a bounded sample of the rows
LEVELS = 6
_SLACK = 1e-7  # bounds are taken this much wider: small distances are known to 1e-8 only


@dataclass
class Tree:
    """Points in tree order. Per level, arrays over its nodes: first point, end, radius,
    first and end of the children in the next level. A node's centre is its first point."""

    order: np.ndarray
    levels: list[np.ndarray]


def build(points: np.ndarray, levels: int = LEVELS) -> Tree:
    """Radii 1, 1/2, 1/4, ... below one root."""
    order = np.arange(len(points))
    nodes = [(0, len(points))]
    out: list[np.ndarray] = []
    radius = 2.0
    for level in range(levels + 1):
        rows, below = [], []
        for start, end in nodes:
            first_child = len(below)
            if end - start == 1:
                spread = 0.0
                below.append((start, end))
            else:
                own = order[start:end]
                gap = distances(points[own], points[own[:1]])[:, 0]
                spread = float(gap.max())
                if level == levels:
                    below.append((start, end))
                else:
                    order[start:end], sizes = _net(points, own, radius / 2)
                    at = start
                    for size in sizes:
                        below.append((at, at + size))
                        at += size
            rows.append((start, end, spread, first_child, len(below)))
        out.append(np.array(rows, np.float64))
        nodes, radius = below, radius / 2
    return Tree(order, out)


def _net(points: np.ndarray, own: np.ndarray, radius: float) -> tuple[np.ndarray, list[int]]:
    """The points by centre: the first uncovered point is the next centre and takes all within the radius."""
    near = distances(points[own], points[own]) <= radius
    free = np.ones(len(own), bool)
    groups: list[np.ndarray] = []
    for i in range(len(own)):
        if free[i]:
            members = np.flatnonzero(near[i] & free)
            free[members] = False
            groups.append(np.concatenate([[i], members[members != i]]))
            free[i] = False
    return own[np.concatenate(groups)], [len(g) for g in groups]


def distances(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (one @ other.T), 0))


def _paired(one: np.ndarray, other: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of one[a] with other[b] for each pair."""
    if len(a) > 0.05 * len(one) * len(other):
        return (one @ other.T)[a, b]
    out = np.empty(len(a))
    for i in range(0, len(a), 65536):
        out[i : i + 65536] = np.einsum("ij,ij->i", one[a[i : i + 65536]], other[b[i : i + 65536]])
    return out


def _product(a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All (x, y) with x in a0:a1 and y in b0:b1 for each row, and the row they come from."""
    wide, high = a1 - a0, b1 - b0
    row = np.repeat(np.arange(len(a0)), wide * high)
    within = np.arange(len(row)) - np.repeat(np.cumsum(wide * high) - wide * high, wide * high)
    return a0[row] + within // high[row], b0[row] + within % high[row], row


def dual(one: np.ndarray, first: Tree, other: np.ndarray, second: Tree, similarity: float,
         same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs (place in one, place in other), points being in tree order.

    For a tree with itself each pair of different points comes once.
    """
    limit = np.sqrt(2 - 2 * similarity)
    a, b = np.zeros(1, np.int64), np.zeros(1, np.int64)
    last = len(first.levels) - 1
    for level, (nodes, others) in enumerate(zip(first.levels, second.levels, strict=True)):
        heads, theirs = nodes[:, 0].astype(np.int64), others[:, 0].astype(np.int64)
        gap = np.sqrt(np.maximum(2 - 2 * _paired(one[heads], other[theirs], a, b), 0))
        reach = nodes[a, 2] + others[b, 2]
        going = gap - reach <= limit + _SLACK
        if same:
            going &= a <= b
        whole = going & (gap + reach <= limit - _SLACK) & ((a != b) if same else True)
        bounds = [x.astype(np.int64) for x in (nodes[a, 0], nodes[a, 1], others[b, 0], others[b, 1])]
        if whole.any():
            yield _product(*(x[whole] for x in bounds))[:2]
        going &= ~whole
        if level == last:
            x, y, _ = _product(*(x[going] for x in bounds))
            if same:
                x, y = x[x < y], y[x < y]
            close = _paired(one, other, x, y) >= similarity
            yield x[close], y[close]
        else:
            a, b = _children(one, first.levels, other, second.levels, level, a[going], b[going], limit)


def _children(one: np.ndarray, levels: list[np.ndarray], other: np.ndarray, levels2: list[np.ndarray],
              level: int, a: np.ndarray, b: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of children of the pairs of nodes. Where a pair has many, those too far apart are left out at once."""
    bounds = [x.astype(np.int64) for x in (levels[level][a, 3], levels[level][a, 4], levels2[level][b, 3], levels2[level][b, 4])]
    many = (bounds[1] - bounds[0]) * (bounds[3] - bounds[2]) > 65536
    parts = [_product(*(x[~many] for x in bounds))[:2]]
    below, below2 = levels[level + 1], levels2[level + 1]
    for a0, a1, b0, b1 in zip(*(x[many].tolist() for x in bounds), strict=True):
        heads, theirs = below[a0:a1, 0].astype(np.int64), below2[b0:b1, 0].astype(np.int64)
        # cosines at which centres are as far apart as the threshold and both radii allow
        least = below[a0:a1, 2][:, None] + (below2[b0:b1, 2] + (limit + _SLACK))[None, :]
        np.multiply(least, least, out=least)
        least *= -0.5
        least += 1
        x, y = np.nonzero(one[heads] @ other[theirs].T >= least)
        parts.append((x + a0, y + b0))
    return np.concatenate([x for x, _ in parts]), np.concatenate([y for _, y in parts])


def forest(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest place that each of ``count`` places reaches by the pairs."""
    label = np.arange(count)
    while True:
        before = label.copy()
        np.minimum.at(label, a, before[b])
        np.minimum.at(label, b, before[a])
        label = label[label]
        if (label == before).all():
            return label


_PART = "dim int, block int, part bigint, place string, n bigint, radius double"


def _maker(folder: str, centres: dict[int, np.ndarray]):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        dim, block, part = (k.as_py() for k in key)
        points = matrix(rows, dim)
        tree = build(points)
        points = points[tree.order]
        ids = rows["vec_id"].to_numpy()[tree.order]
        weight = rows["weight"].to_numpy()[tree.order].astype(np.float64)
        radius = float(distances(points, centres[dim][block : block + 1]).max())
        sizes = np.array([len(level) for level in tree.levels], np.float64)
        place = save(folder, ids, weight, points, sizes, *tree.levels)
        return pa.table({
            "dim": pa.array([dim], pa.int32()), "block": pa.array([block], pa.int32()), "part": pa.array([part], pa.int64()),
            "place": [place], "n": pa.array([len(ids)], pa.int64()), "radius": [radius],
        })

    return run


def _read(place: str, count: int, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Tree]:
    ids, weight, points = load(place, count, (np.int64, 1), (np.float64, 1), (np.float64, dim))
    file, at = Array(place), count * (2 + dim)
    sizes = file.part(at, LEVELS + 1).view(np.float64).astype(np.int64)
    at += LEVELS + 1
    levels = []
    for size in sizes:
        levels.append(file.part(at, int(size) * 5).view(np.float64).reshape(-1, 5))
        at += int(size) * 5
    return ids, weight, points.reshape(count, dim), Tree(np.arange(count), levels)


def _joiner(similarity: float):
    """Pairs of parts -> (vec_id, links, root): links found, and a member it hangs together with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                same = row["place"] == row["place2"]
                ids, weight, points, tree = _read(row["place"], row["n"], row["dim"])
                ids2, weight2, points2, tree2 = (
                    (ids, weight, points, tree) if same else _read(row["place2"], row["n2"], row["dim"])
                )
                shift = 0 if same else len(ids)
                count = shift + len(ids2)
                found, label = np.zeros(count), np.arange(count)
                for x, y in dual(points, tree, points2, tree2, similarity, same):
                    if len(x):
                        found += np.bincount(x, weight2[y], count) + np.bincount(y + shift, weight[x], count)
                        label = forest(count, np.concatenate([x, np.arange(count)]), np.concatenate([y + shift, label]))
                every = ids if same else np.concatenate([ids, ids2])
                hit = np.flatnonzero(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(every[hit]), pa.array(found[hit].astype(np.int64)), pa.array(every[label[hit]])],
                    ["vec_id", "links", "root"],
                )

    return run


def near_duplicates(
    table: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
    similarity: float = SIMILARITY, part: int = PART, max_centres: int = CENTRES,
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    Two vectors link when their cosine is at least ``similarity``. Vectors that
    are null or zero, hold null or non-finite components, or differ in length
    link with nothing; their component is their own id. Equal vectors are compared
    once, with their number as weight. Rows that share an id count as different
    vectors of one id. A null id has a null component and is not kept.
    """
    spark = table.sparkSession
    rows = usable(table, id_col, vector_col).withColumns(
        {"p1": F.xxhash64("v"), "p2": F.xxhash64(F.lit(1), "v")}
    )
    prints = ["p1", "p2"]
    classes = shared_checkpoint(
        rows.groupBy(*prints).agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("weight"), F.first("v").alias("v"))
        .withColumn("dim", F.size("v"))
        # scaled first, so that squares of very small or large components stay in range
        .withColumn("top", F.array_max(F.transform("v", F.abs)))
        .withColumn("v", F.transform("v", lambda x: x / F.col("top")))
        .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))
        .withColumn("v", F.transform("v", lambda x: x / F.col("norm"))).drop("top", "norm")
    )
    folder = new_folder(spark, "cover-trees")
    count = classes.count()
    wanted = min(max_centres, max(1, count // (2 * part)))
    sample = (
        classes.select("dim", "v", F.xxhash64("p1", F.lit(7)).alias("at")).orderBy("at").limit(wanted).collect()
        + classes.groupBy("dim").agg(F.min_by("v", "p1").alias("v")).collect()  # a centre for every length
    )
    centres = {d: np.array([r["v"] for r in sample if r["dim"] == d]) for d in {r["dim"] for r in sample}}
    shared = spark.sparkContext.broadcast(centres)  # at most ``max_centres`` and one a length

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = np.zeros(batch.num_rows, np.int32)
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                points = matrix(pa.Table.from_batches([batch.take(pa.array(at))]), dim)
                blocks[at] = (points @ shared.value[dim].T).argmax(1)
            yield batch.append_column("block", pa.array(blocks))

    kind = "vec_id bigint, weight bigint, v array<double>, dim int"
    dealt = shared_checkpoint(
        classes.select("vec_id", "weight", "v", "dim").mapInArrow(nearest, f"{kind}, block int")
    )
    # one row a block, so at most ``max_centres`` and one a length
    sizes = {(r["dim"], r["block"]): r["count"] for r in dealt.groupBy("dim", "block").count().collect()}
    parts_of = F.create_map(*[
        x for (d, b), n in sizes.items() for x in (F.lit(f"{d}/{b}"), F.lit(max(1, round(n / part))))
    ]) if sizes else F.create_map(F.lit(""), F.lit(1))
    own = F.element_at(parts_of, F.concat_ws("/", "dim", "block"))
    parts = shared_checkpoint(
        dealt.withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(3)), own))
        .groupBy("dim", "block", "part").applyInArrow(_maker(folder, centres), _PART)
    )
    reach = np.sqrt(2 - 2 * similarity) + _SLACK
    radii = {(r["dim"], r["block"]): r["radius"] for r in parts.groupBy("dim", "block").agg(F.max("radius").alias("radius")).collect()}
    meeting = []
    for d, points in centres.items():
        gaps = distances(points, points)
        meeting += [
            (d, i, j) for i in range(len(points)) for j in range(i, len(points))
            if (d, i) in radii and (d, j) in radii and gaps[i, j] - radii[d, i] - radii[d, j] <= reach
        ]
    pairs = spark.createDataFrame(meeting, "dim int, block int, block2 int")
    left = parts.select("dim", "block", "part", "place", "n")
    right = parts.select("dim", *(F.col(c).alias(f"{c}2") for c in ("block", "part", "place", "n")))
    together = pairs.join(left, ["dim", "block"]).join(right, ["dim", "block2"]).filter(
        (F.col("block") < F.col("block2")) | (F.col("part") <= F.col("part2"))
    )
    tasks = together.select("dim", "place", "n", "place2", "n2").repartition(
        max(len(meeting), spark.sparkContext.defaultParallelism), "place", "place2"
    )
    found = shared_checkpoint(tasks.mapInArrow(_joiner(similarity), "vec_id bigint, links bigint, root bigint"))
    linked = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    of_class = components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("id", "class")
    ends = shared_checkpoint(
        classes.select(*prints, F.col("vec_id").alias("class"), "weight")
        .join(linked.withColumnRenamed("vec_id", "class"), "class", "left").join(of_class, "class", "left")
        .select(
            *prints, (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component_id", "class").alias("component_id"),
        )
    )
    out = rows.select("vec_id", *prints).join(ends, prints).select("vec_id", "n_links", "component_id")
    lone = unusable(table, id_col, vector_col).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(lone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )

