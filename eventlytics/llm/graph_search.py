"""Approximate nearest neighbours on robust-pruned directed graphs.

Equal vectors are indexed once: one vector stands for its class, with the ``k + 1``
smallest ids of it, and what a search finds is expanded to ids before it is ranked.
Classes are dealt by the hash of their vector into shards of about 4096. Every
shard gets a graph: points enter in batches, a greedy beam search on the graph so
far proposes neighbours, and relaxed pruning keeps one only if no kept neighbour
is closer to it by the factor ``alpha`` than the point itself, so that edges stay
diverse; reverse edges are added and pruned alike. All classes are indexed. A query
runs a beam search in every shard; the nearest of all shards are its answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventlytics.llm.common import smallest
from eventlytics.llm.hashstore import new_folder
from eventlytics.llm.vectors import load, matrix, save, usable
from eventlytics.operators.scale import shared_checkpoint

SHARD = 4096
DEGREE = 40
BUILD_BEAM = 64
QUERY_BEAM = 192
ALPHA = 1.2
QUERY_BLOCK = 512
BATCH = 256


def beam_search(points: np.ndarray, squares: np.ndarray, graph: np.ndarray, entry: int,
                queries: np.ndarray, beam: int, width: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(ids, squared distances) of the ``beam`` best found for each query, nearest first; -1 pads.

    All queries go in step: each expands its ``width`` nearest unexpanded points at a time.
    """
    count = len(queries)
    own = np.einsum("ij,ij->i", queries, queries)
    ids = np.full((count, beam), -1)
    gaps = np.full((count, beam), np.inf)
    done = np.ones((count, beam), bool)
    seen = np.zeros((count, len(points) + 1), bool)
    ids[:, 0], done[:, 0] = entry, False
    gaps[:, 0] = squares[entry] - 2 * (queries @ points[entry]) + own
    seen[:, entry] = seen[:, -1] = True  # -1 is the last column
    active = np.arange(count)
    while len(active):
        # the first ``width`` unexpanded places of each beam, as the beam is sorted
        waiting = ~done[active]
        place = np.argsort(~waiting, axis=1, kind="stable")[:, :width]
        at = np.arange(len(active))[:, None]
        use = waiting[at, place]
        done[active[:, None], place] = True
        current = np.where(use, ids[active[:, None], place], -1)
        near = graph[current].reshape(len(active), -1)
        near[np.repeat(~use, graph.shape[1], axis=1)] = -1
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        near[seen[active[:, None], near]] = -1
        seen[active[:, None], near] = True
        gap = squares[near] - 2 * np.einsum("arj,aj->ar", points[near], queries[active]) + own[active][:, None]
        gap[near < 0] = np.inf
        all_gaps = np.concatenate([gaps[active], gap], 1)
        all_ids = np.concatenate([ids[active], near], 1)
        all_done = np.concatenate([done[active], near < 0], 1)
        best = np.argsort(all_gaps, axis=1, kind="stable")[:, :beam]
        ids[active], gaps[active], done[active] = all_ids[at, best], all_gaps[at, best], all_done[at, best]
        active = active[(~done[active]).any(1)]
    return ids, gaps


def prune(points: np.ndarray, squares: np.ndarray, centre: np.ndarray, ids: np.ndarray,
          degree: int, alpha: float) -> np.ndarray:
    """At most ``degree`` of the candidates of each centre (-1 pads), by relaxed pruning."""
    known = (ids >= 0) & (ids != centre[:, None])
    own = points[ids]
    flat = points[centre]
    to_centre = squares[ids] - 2 * np.einsum("brj,bj->br", own, flat) + squares[centre][:, None]
    between = squares[ids][:, :, None] + squares[ids][:, None, :] - 2 * (own @ own.transpose(0, 2, 1))
    out = np.full((len(centre), degree), -1)
    gap = np.where(known, np.maximum(to_centre, 0), np.inf)
    rows = np.arange(len(centre))
    for k in range(degree):
        best = gap.argmin(1)
        live = np.isfinite(gap[rows, best])
        if not live.any():
            break
        out[live, k] = ids[rows, best][live]
        # distances are squared, so the factor is too
        covered = alpha**2 * np.maximum(between[rows, best], 0) <= gap
        covered[rows, best] = True
        gap[covered & live[:, None]] = np.inf
    return out


def build(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA,
          seed: int = 11) -> tuple[np.ndarray, int]:
    """(neighbours of each point, -1 pads; the entry point, nearest to the mean)."""
    count = len(points)
    squares = np.einsum("ij,ij->i", points, points)
    entry = int((squares - 2 * (points @ points.mean(0))).argmin())
    graph = np.full((count + 1, degree), -1)  # the last row answers for -1
    order = np.random.default_rng(seed).permutation(count)
    order = np.concatenate([[entry], order[order != entry]])
    done, size = 1, 1
    while done < count:
        batch = order[done : done + size]
        ids, _ = beam_search(points, squares, graph, entry, points[batch], beam)
        graph[batch] = prune(points, squares, batch, ids, degree, alpha)
        sources = np.repeat(batch, degree)
        targets = graph[batch].ravel()
        sources, targets = sources[targets >= 0], targets[targets >= 0]
        by = np.argsort(targets, kind="stable")
        sources, targets = sources[by], targets[by]
        nodes, starts, new = np.unique(targets, return_index=True, return_counts=True)
        for few in np.array_split(np.argsort(new, kind="stable"), max(1, len(nodes) // 128)):
            if not len(few):
                continue
            wide = int(new[few].max())
            more = np.full((len(few), wide), -1)
            slot = np.arange(wide)[None, :] < new[few][:, None]
            more[slot] = sources[(starts[few][:, None] + np.arange(wide)[None, :])[slot]]
            both = np.concatenate([graph[nodes[few]], more], 1)
            full = (both >= 0).sum(1) > degree
            packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)
            graph[nodes[few[~full]]] = packed[~full][:, :degree]
            if full.any():
                graph[nodes[few[full]]] = prune(points, squares, nodes[few[full]], packed[full], degree, alpha)
        done += len(batch)
        size = min(BATCH, 2 * size)
    return graph, entry


_INDEX = "dim int, shard bigint, place string, n bigint, n_ids bigint, entry bigint"


def _indexer(folder: str, degree: int, beam: int, alpha: float):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        dim, shard = (k.as_py() for k in key)
        # the same graph whatever order rows arrive in
        rows = rows.sort_by([("p1", "ascending"), ("p2", "ascending")])
        lists = rows["ids"].combine_chunks()
        ids, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy(), dtype=np.int64)
        points = matrix(rows, dim)
        graph, entry = build(points, degree, beam, alpha)
        place = save(folder, ends, ids, points, graph[:-1])
        return pa.table({
            "dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int64()), "place": [place],
            "n": pa.array([len(ends)], pa.int64()), "n_ids": pa.array([len(ids)], pa.int64()), "entry": pa.array([entry], pa.int64()),
        })

    return run


def _blocks(folder: str):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        place = save(folder, rows["vec_id"].to_numpy(), matrix(rows, dim))
        return pa.table({"dim": pa.array([dim], pa.int32()), "queries": [place], "q": pa.array([len(rows)], pa.int64())})

    return run


def _ranked(own: np.ndarray, found: np.ndarray, gaps: np.ndarray, ends: np.ndarray, ids: np.ndarray,
            k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, distance) of the ``k`` nearest ids of each query, out of the classes found for it."""
    row, column = np.nonzero(found >= 0)
    groups, gap = found[row, column], gaps[row, column]
    sizes = np.diff(ends, prepend=0)[groups]
    row, gap = np.repeat(row, sizes), np.repeat(gap, sizes)
    # the places of each class's ids, end to end
    names = ids[np.repeat(ends[groups] - np.cumsum(sizes), sizes) + np.arange(sizes.sum())]
    other = names != own[row]
    row, gap, names = row[other], gap[other], names[other]
    order = np.lexsort((gap, names, row))
    row, gap, names = row[order], gap[order], names[order]
    first = np.ones(len(row), bool)  # an id counts once, where it is nearest
    first[1:] = (row[1:] != row[:-1]) | (names[1:] != names[:-1])
    row, gap, names = row[first], gap[first], names[first]
    order = np.lexsort((names, gap, row))
    row, gap, names = row[order], gap[order], names[order]
    good = np.arange(len(row)) - np.searchsorted(row, row) < k
    return own[row[good]], names[good], gap[good]


def _searcher(k: int, degree: int, beam: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim, n = row["dim"], row["n"]
                (ends,) = load(row["place"], n, (np.int64, 1))
                (ids,) = load(row["place"], row["n_ids"], (np.int64, 1), start=n)
                points, graph = load(
                    row["place"], n, (np.float64, dim), (np.int64, degree), start=n + row["n_ids"]
                )
                points = points.reshape(n, dim)
                graph = np.concatenate([graph.reshape(n, degree), np.full((1, degree), -1)])
                own, queries = load(row["queries"], row["q"], (np.int64, 1), (np.float64, dim))
                queries = queries.reshape(row["q"], dim)
                squares = np.einsum("ij,ij->i", points, points)
                out: list[list[np.ndarray]] = [[], [], []]
                for a in range(0, len(own), BATCH):
                    part = queries[a : a + BATCH]
                    found, _ = beam_search(points, squares, graph, row["entry"], part, beam)
                    exact = np.sqrt(((points[found] - part[:, None]) ** 2).sum(2))
                    for held, new in zip(out, _ranked(own[a : a + BATCH], found, exact, ends, ids, k), strict=True):
                        held.append(new)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["query_id", "vec_id", "score"])

    return run


def nearest(
    table: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
    shard: int = SHARD, degree: int = DEGREE, build_beam: int = BUILD_BEAM, beam: int = QUERY_BEAM,
    alpha: float = ALPHA,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest rows found for each query.

    The score is the Euclidean distance of the vectors as given, in double
    precision; ties go to the smaller id. A row with the query's own id is no
    answer. Vectors that are null or zero or hold null or non-finite components
    take no part, nor do ids that are null; vectors of another length are never
    compared. Queries are told by their ids: of rows that share one, all ask. Equal
    vectors take one place of the beam, however many they are.
    """
    spark = table.sparkSession
    folder, beam = new_folder(spark, "graphs"), max(beam, k + 1)

    def dealt(frame: DataFrame, key: str, per_group: int, name: str) -> DataFrame:
        groups = max(1, round(frame.count() / per_group))
        return frame.withColumn(name, F.pmod(F.xxhash64(key), F.lit(groups)))

    # 0.0 and -0.0 are one component
    rows = usable(table, id_col, vector_col).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    rows = rows.withColumn("class_", F.struct(F.xxhash64("v").alias("p1"), F.xxhash64(F.lit(1), "v").alias("p2")))
    # of equal vectors, no more than k and the query's own id can be among the answers
    few = smallest(rows.select("class_", "vec_id").distinct(), "class_", ["vec_id"], k + 1)
    classes = shared_checkpoint(
        rows.groupBy("class_").agg(F.first("v").alias("v"), F.first("dim").alias("dim"))
        .join(few.groupBy("class_").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "class_")
        .select("class_.*", "v", "dim", "ids")
    )
    index = shared_checkpoint(
        dealt(classes, "p1", shard, "shard").groupBy("dim", "shard")
        .applyInArrow(_indexer(f"{folder}/index", degree, build_beam, alpha), _INDEX)
    )
    blocks = shared_checkpoint(
        dealt(usable(queries, id_col, vector_col), "vec_id", QUERY_BLOCK, "block").groupBy("dim", "block")
        .applyInArrow(_blocks(f"{folder}/queries"), "dim int, queries string, q bigint")
    )
    # every block of queries goes to every shard; rows hold the names of their files only
    tasks = index.join(blocks, "dim").select("dim", "place", "n", "n_ids", "entry", "queries", "q")
    found = tasks.repartition(
        max(spark.sparkContext.defaultParallelism, index.count()), "place", "queries"
    ).mapInArrow(_searcher(k, degree, beam), "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return (
        found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
