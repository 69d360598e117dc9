"""Jaccard join on word shingles by T-occurrence search.

1. The distinct shingles of all documents are counted by the owners of hash
   ranges; those of two or more documents are kept in sorted arrays. A document
   with fewer than the threshold's share of such shingles can link with nothing.
   The others write their shared shingles to files that workers map.
2. Documents with equal sets are one class, named by its smallest id. Classes
   that share a smallest hash are compared with one among them, and what links
   becomes a cluster; several rounds with other hashes take other leaders, so a
   group of near copies costs a few comparisons for each member, not one a pair.
   Most rounds are led by the class with the smallest part of shingles of its own: in
   a group of edited copies that is the one the others were made from, or next to it.
3. An inverted index leads each shingle to the clusters that hold it. For every
   class the lists of its shingles are searched for other clusters that reach
   the required overlap (DivideSkip: short lists are merged, long ones probed by
   binary search). Where both are alone in their clusters that overlap decides. Two clusters
   are looked for from one side only: from the one that is a single class, else from
   the one with the larger id. Of a cluster that is reached the member with the smallest part of shingles of its
   own is compared first; if that doesn't link, the same search runs over its members,
   512 at a time.

Any two documents that link are in one cluster or found by 3, so the components
are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlytics.llm.common import from_planes, id_and_text, mix, once, text_slices, texts_of, to_planes
from eventlytics.llm.hashstore import (
    Array,
    Reader,
    Store,
    new_folder,
    shard_of,
    shards_for,
    write_array,
    write_shard,
)
from eventlytics.llm.links import components
from eventlytics.llm.ngram_lm import hashed
from eventlytics.operators.scale import shared_checkpoint, splittable

SHINGLE_WORDS = 5
SIMILARITY = 75  # in hundredths
ROUNDS = 6
CENTRAL_ROUNDS = 4  # of these; the others take any leader
FLUSH_SHINGLES = 4_000_000
PART_MEMBERS = 512
PROBED_SHARE = 0.5  # of the lists that may be skipped, the longest are probed


def shingle_sets(texts: list[str], size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(text, shingle) of the distinct shingles, by text and then shingle."""
    parts = [hashed(t) for t in texts]
    lengths = np.array([len(p) for p in parts], np.int64)
    words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    count = max(len(words) - size + 1, 0)
    keys = words[:count].copy()
    for i in range(1, size):
        keys = mix(keys, words[i : count + i])
    own = owner[:count] == owner[size - 1 : count + size - 1]
    texts_at, keys = owner[:count][own], keys[own]
    few = np.flatnonzero((lengths > 0) & (lengths < size))
    whole = []
    for i in few:  # the whole sequence, marked by its length
        key = np.full(1, lengths[i], np.uint64)
        for word in parts[i]:
            key = mix(key, np.full(1, word))
        whole.append(key)
    if whole:
        texts_at, keys = np.concatenate([texts_at, few]), np.concatenate([keys, *whole])
    order = np.lexsort([keys, texts_at])
    texts_at, keys = texts_at[order], keys[order]
    if len(keys):
        new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (texts_at[1:] != texts_at[:-1])])
        texts_at, keys = texts_at[new], keys[new]
    return texts_at, keys


def required(size: int, similarity: int) -> int:
    """Overlap that a set of this size needs with any other at least."""
    return -(-similarity * size // 100)


def linked(common: int, one: int, other: int, similarity: int) -> bool:
    return 100 * common >= similarity * (one + other - common) and common > 0


def divide_skip(lists: list[np.ndarray], needed: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids on at least ``needed`` of the sorted lists, and on how many each is.

    An id that misses all of the ``long`` longest lists is on few enough of them
    to matter only if it is on ``needed - long`` short ones: these are merged, and
    ids found there are looked up in the long lists.
    """
    if needed <= 0 or len(lists) < needed:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lists = sorted(lists, key=len)
    long = int(PROBED_SHARE * (needed - 1))
    short = lists[: len(lists) - long]
    ids, counts = np.unique(np.concatenate(short), return_counts=True)
    some = counts >= needed - long
    ids, counts = ids[some], counts[some]
    for probed in lists[len(lists) - long :]:
        if not len(ids):
            break
        at = np.minimum(np.searchsorted(probed, ids), len(probed) - 1)
        counts = counts + (probed[at] == ids)
    enough = counts >= needed
    return ids[enough], counts[enough]


_PACKED = "shard int, keys binary, more binary, alone binary"
_PACKED_ARROW = pa.schema([("shard", pa.int32()), *((x, pa.binary()) for x in ("keys", "more", "alone"))])


def _by_shard(keys: np.ndarray, more: np.ndarray, shards: int, alone: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Sorted keys and what goes with them, one row a shard."""
    owner = shard_of(keys, shards)
    cuts = [0, *(np.flatnonzero(np.diff(owner)) + 1).tolist(), len(keys)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield pa.RecordBatch.from_pylist([{
                "shard": int(owner[a]), "keys": to_planes(keys[a:b]), "more": to_planes(more[a:b]),
                "alone": None if alone is None else to_planes(alone[a:b]),
            }], _PACKED_ARROW)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of the runs of equal keys."""
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return at, np.diff(np.concatenate([at, [len(keys)]]))


def _counter(size: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            keys = np.sort(np.concatenate(held))
            held.clear()
            at, n = _runs(keys)
            yield from _by_shard(keys[at], np.minimum(n, 2).astype(np.uint8), shards)

        for batch in text_slices(batches):
            held.append(shingle_sets(texts_of(batch), size)[1])
            if sum(map(len, held)) >= FLUSH_SHINGLES:
                yield from flush()
        if held:
            yield from flush()

    return run


def _sharer(folder: str):
    def run(key: tuple[pa.Scalar], rows: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        keys = np.concatenate([from_planes(x) for x in rows["keys"].to_pylist()])
        n = np.concatenate([from_planes(x, np.uint8) for x in rows["more"].to_pylist()])
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order].astype(np.int64)
        at, _ = _runs(keys)
        shared = keys[at[np.add.reduceat(n, at) > 1]]
        place = write_shard(folder, shard, shared, np.ones((len(shared), 1), np.uint32))
        return pa.table({
            "shard": pa.array([shard], pa.int32()), "place": pa.array([place]), "n": pa.array([len(shared)], pa.int64()),
        })

    return run


_DOC = "doc_id bigint, n bigint, f1 bigint, f2 bigint, place string, start bigint, length bigint, mins array<bigint>"
_DOC_ARROW = pa.schema([
    *((x, pa.int64()) for x in ("doc_id", "n", "f1", "f2")), ("place", pa.string()),
    ("start", pa.int64()), ("length", pa.int64()), ("mins", pa.list_(pa.int64())),
])


def _describer(size: int, similarity: int, rounds: int, folder: str, store: dict, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = once(("shared", name), lambda: Reader(Store(**store)))
        for batch in text_slices(batches):
            ids = batch.column("doc_id").to_pylist()
            owner, keys = shingle_sets(texts_of(batch), size)
            n = np.bincount(owner, minlength=len(ids))
            ends = np.cumsum(n)
            shared = reader.find(keys)[:, 0] > 0
            out, kept, length = [], [], 0
            for i, doc_id in enumerate(ids):
                a, b = ends[i] - n[i], ends[i]
                own = keys[a:b]
                with np.errstate(over="ignore"):
                    prints = [int(f.sum(dtype=np.uint64).view(np.int64)) for f in (own, mix(own, ~own))]
                row = {"doc_id": doc_id, "n": int(n[i]), "f1": prints[0], "f2": prints[1]}
                common = own[shared[a:b]]
                if len(common) >= max(required(int(n[i]), similarity), 1):
                    mins = [int(mix(common, np.full(1, r, np.uint64)).min().view(np.int64)) for r in range(rounds)]
                    row |= {"start": length, "length": len(common), "mins": mins}
                    kept.append(common)
                    length += len(common)
                out.append(row)
            if kept:
                place = write_array(folder, np.concatenate(kept))
                for row in out:
                    if "start" in row:
                        row["place"] = place
            yield pa.RecordBatch.from_pylist(out, _DOC_ARROW)

    return run


def _comparer(similarity: int):
    """Pairs (a, b) with the places of both sets -> those that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: dict[str, np.ndarray] = {}

        def members(row: dict, side: str) -> np.ndarray:
            place = row[f"place_{side}"]
            if place not in files:
                if len(files) > 64:
                    files.clear()
                files[place] = Array(place)
            return files[place].part(row[f"start_{side}"], row[f"length_{side}"])

        for batch in batches:
            good = []
            for row in batch.to_pylist():
                one, other = members(row, "a"), members(row, "b")
                common = len(np.intersect1d(one, other, assume_unique=True))
                if linked(common, row["n_a"], row["n_b"], similarity):
                    good.append((row["a"], row["b"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in good], pa.int64()), pa.array([y for _, y in good], pa.int64())], ["a", "b"]
            )

    return run


def _links(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) whose sets link; sizes that can't are left out first."""

    def side(x: str) -> DataFrame:
        return sets.select(F.col("doc_id").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("n", "place", "start", "length")))

    near = pairs.join(side("a"), "a").join(side("b"), "b").filter(
        (F.col("n_a") * 100 >= F.col("n_b") * similarity) & (F.col("n_b") * 100 >= F.col("n_a") * similarity)
    )
    return near.mapInArrow(_comparer(similarity), "a bigint, b bigint")


def _set_slices(batches: Iterator[pa.RecordBatch], limit: int = FLUSH_SHINGLES) -> Iterator[list[dict]]:
    """Rows whose sets hold about ``limit`` shingles together (or one row)."""
    for batch in batches:
        rows, held = [], 0
        for row in batch.to_pylist():
            if rows and held + row["length"] > limit:
                yield rows
                rows, held = [], 0
            rows.append(row)
            held += row["length"]
        if rows:
            yield rows


def _inverter(shards: int):
    """Distinct (shingle, cluster) of a task's classes, packed, with the set size of single classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _set_slices(batches):
            sets = [Array(r["place"]).part(r["start"], r["length"]) for r in rows]
            lengths = [len(x) for x in sets]
            keys = np.concatenate(sets)
            clusters = np.repeat([r["cluster"] for r in rows], lengths).astype(np.int64)
            alone = np.repeat([r["alone"] for r in rows], lengths).astype(np.uint64)
            order = np.lexsort([clusters, keys])
            keys, clusters, alone = keys[order], clusters[order], alone[order]
            new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (clusters[1:] != clusters[:-1])])
            yield from _by_shard(keys[new], clusters[new].view(np.uint64), shards, alone[new])

    return run


def _indexer(folder: str):
    """Lists of clusters for the shingles of two or more of them, in files: the ids, then the
    set sizes of single classes (0 for the others)."""

    def run(key: tuple[pa.Scalar], rows: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        keys = np.concatenate([from_planes(x) for x in rows["keys"].to_pylist()])
        clusters = np.concatenate([from_planes(x) for x in rows["more"].to_pylist()]).view(np.int64)
        alone = np.concatenate([from_planes(x) for x in rows["alone"].to_pylist()])
        order = np.lexsort([clusters, keys])
        keys, clusters, alone = keys[order], clusters[order], alone[order]
        new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (clusters[1:] != clusters[:-1])])
        keys, clusters, alone = keys[new], clusters[new], alone[new]
        at, n = _runs(keys)
        more = n > 1
        keep = np.repeat(more, n)
        begins = np.cumsum(n[more]) - n[more]
        place = write_shard(folder, shard, keys[at[more]], np.stack([begins, n[more]], 1).astype(np.uint32))
        lists = write_array(folder, np.concatenate([clusters[keep].view(np.uint64), alone[keep]]))
        return pa.table({
            "shard": pa.array([shard], pa.int32()), "place": pa.array([place]),
            "n": pa.array([int(more.sum())], pa.int64()), "lists": pa.array([lists]),
        })

    return run


def _sizes(wanted: np.ndarray, lists: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """What the lists say of the wanted ids, each of which is on most of them."""
    sizes, left = np.zeros(len(wanted), np.int64), np.arange(len(wanted))
    for ids, alone in lists:
        if not len(left):
            break
        at = np.minimum(np.searchsorted(ids, wanted[left]), len(ids) - 1)
        hit = ids[at] == wanted[left]
        sizes[left[hit]] = alone[at[hit]]
        left = left[~hit]
    return sizes


def _searcher(similarity: int, index: dict, lists: dict[int, str], name: str):
    """(doc_id, other, sure): clusters that reach the overlap a class needs; sure ones link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = once(("lists", name), lambda: Reader(Store(**index)))
        arrays: dict[int, Array] = {}
        for rows in _set_slices(batches):
            found: list[tuple[int, int, bool]] = []
            for row in rows:
                own = np.asarray(Array(row["place"]).part(row["start"], row["length"]))
                at = reader.find(own)
                hit = at[:, 1] > 0
                needed = required(row["n"], similarity)
                if hit.sum() < needed:
                    continue
                owner = shard_of(own[hit], index["shards"])
                for shard in np.unique(owner).tolist():
                    if shard not in arrays:
                        arrays[shard] = Array(lists[shard])
                places = [
                    (arrays[int(s)], int(b), int(n)) for s, (b, n) in zip(owner, at[hit], strict=True)
                ]
                postings = [a.part(b, n).view(np.int64) for a, b, n in places]
                ids, common = divide_skip(postings, needed)
                single = row["alone"] > 0
                # clusters of several classes are looked for from the larger id, single ones look for others
                mine = (ids != row["cluster"]) if single else (ids < row["cluster"])
                ids, common = ids[mine], common[mine]
                if not len(ids):
                    continue
                alone = ((p, a.part(len(a.values) // 2 + b, n).view(np.int64)) for p, (a, b, n) in zip(postings, places, strict=True))
                sizes = _sizes(ids, alone)
                found += [(row["doc_id"], c, False) for c in ids[sizes == 0].tolist()]
                if single:
                    both = (sizes > 0) & (ids < row["doc_id"])
                    both &= 100 * common >= similarity * (row["n"] + sizes - common)
                    found += [(row["doc_id"], c, True) for c in ids[both].tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                 pa.array([f[2] for f in found], pa.bool_())],
                ["doc_id", "other", "sure"],
            )

    return run


_PARTS = "theirs bigint, members string, m bigint, k bigint"


def _divider(folder: str):
    """Part of a cluster -> a file of its members and their inverted lists."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        members = rows.sort_by("doc_id").to_pylist()
        sets = [Array(r["place"]).part(r["start"], r["length"]) for r in members]
        keys = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        order = np.lexsort([owner, keys])
        ids, sizes = (np.array([r[c] for r in members], np.int64) for c in ("doc_id", "n"))
        place = write_array(
            folder, np.concatenate([ids.view(np.uint64), sizes.view(np.uint64), keys[order], owner[order].view(np.uint64)])
        )
        return pa.table({
            "theirs": pa.array([key[0].as_py()], pa.int64()), "members": pa.array([place]),
            "m": pa.array([len(ids)], pa.int64()), "k": pa.array([len(keys)], pa.int64()),
        })

    return run


def _member_searcher(similarity: int):
    """A class and a part of another cluster -> the first member that it links with, if any does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            for row in batch.to_pylist():
                own = Array(row["place"]).part(row["start"], row["length"])
                m, k = row["m"], row["k"]
                file = Array(row["members"])
                ids, sizes, owner = (file.part(a, n).view(np.int64) for a, n in ((0, m), (m, m), (2 * m + k, k)))
                keys = file.part(2 * m, k)
                low, high = np.searchsorted(keys, own), np.searchsorted(keys, own, "right")
                lists = [owner[a:b] for a, b in zip(low, high, strict=True) if b > a]
                at, common = divide_skip(lists, required(row["n"], similarity))
                good = 100 * common >= similarity * (row["n"] + sizes[at] - common)
                if good.any():
                    found.append((row["doc_id"], int(ids[at[good]].min())))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"]
            )

    return run


def _clusters(sets: DataFrame, links: DataFrame, width: int) -> DataFrame:
    """The classes with the cluster that links put them in, dealt out for the search."""
    of = components(links).select(F.col("id").alias("doc_id"), "component_id")
    return shared_checkpoint(
        sets.join(of, "doc_id", "left").withColumn("cluster", F.coalesce("component_id", "doc_id"))
        .withColumn("alone", F.when(F.col("component_id").isNull(), F.col("n")).otherwise(0)).drop("component_id").repartition(width, "doc_id")
    )


def jaccard_components(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE_WORDS,
    similarity: int = SIMILARITY, rounds: int = ROUNDS,
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links), for every row.

    Two documents link when 100 * intersection >= ``similarity`` * union of their
    sets of ``size``-word shingles; fewer words make one shingle, none make an
    empty set, which links with nothing. Null texts count as empty. Rows that
    share an id are one document with several sets. A null id links with nothing
    and has a null component.
    """
    spark = docs.sparkSession
    source = id_and_text(docs, id_col, text_col).select(F.col("doc_id").cast("long"), "text")
    shards = shards_for(source.rdd.getNumPartitions())
    folder, name = new_folder(spark, "shingles"), uuid4().hex
    files = (
        source.filter(F.col("doc_id").isNotNull()).mapInArrow(_counter(size, shards), _PACKED)
        .groupBy("shard").applyInArrow(_sharer(folder), "shard int, place string, n bigint").collect()
    )
    shared = vars(Store(shards, 1, {r["shard"]: (r["place"], r["n"]) for r in files}))
    described = shared_checkpoint(
        source.mapInArrow(_describer(size, similarity, rounds, f"{folder}/sets", shared, name), _DOC)
    )
    sets = ["n", "f1", "f2"]
    known = described.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = shared_checkpoint(known.groupBy(*sets).agg(F.min("doc_id").alias("class")))
    first = described.filter(F.col("place").isNotNull()).join(
        classes.select(*sets, F.col("class").alias("doc_id")), [*sets, "doc_id"], "left_semi"
    )
    first = shared_checkpoint(first.dropDuplicates([*sets, "doc_id"]))

    own_share = 1 - F.col("length") / F.col("n")
    keyed = first.select("doc_id", own_share.alias("own"), F.posexplode("mins").alias("round", "key"))
    rank = F.struct(F.when(F.col("round") < CENTRAL_ROUNDS, F.col("own")).otherwise(0.0), F.xxhash64("doc_id", "round"))
    leaders = shared_checkpoint(keyed.groupBy("round", "key").agg(F.min_by("doc_id", rank).alias("b"), F.count("*").alias("k")))
    pairs = keyed.join(leaders.filter("k > 1"), ["round", "key"]).select(F.col("doc_id").alias("a"), "b")
    links = shared_checkpoint(_links(pairs.filter("a <> b").distinct(), first, similarity))
    # members of a class hold together as well
    same = known.join(classes, sets).select(F.col("doc_id").alias("a"), F.col("class").alias("b")).filter("a <> b")
    clustered = _clusters(first, links, shards)

    index = (
        clustered.select("cluster", "alone", "place", "start", "length").mapInArrow(_inverter(shards), _PACKED)
        .groupBy("shard").applyInArrow(_indexer(f"{folder}/index"), "shard int, place string, n bigint, lists string")
        .collect()
    )
    store = vars(Store(shards, 2, {r["shard"]: (r["place"], r["n"]) for r in index}))
    lists = {r["shard"]: r["lists"] for r in index}
    reached = shared_checkpoint(
        clustered.mapInArrow(_searcher(similarity, store, lists, uuid4().hex), "doc_id bigint, other bigint, sure boolean")
    )
    found = reached.filter("NOT sure")
    singles = reached.filter("sure").select(F.col("doc_id").alias("a"), F.col("other").alias("b"))
    # most such clusters are joined by one member; only the rest is compared member by member
    centers = clustered.join(found.select(F.col("other").alias("cluster")).distinct(), "cluster", "left_semi").groupBy(
        F.col("cluster").alias("other")
    ).agg(F.min_by("doc_id", F.struct(own_share, "doc_id")).alias("b"))
    heads = found.join(splittable(centers), "other").select(F.col("doc_id").alias("a"), "b")
    links = shared_checkpoint(links.unionByName(singles).unionByName(_links(heads, first, similarity)))
    clustered = _clusters(first, links, shards)
    now = clustered.select("doc_id", "cluster")
    rest = shared_checkpoint(
        found.join(now, "doc_id").join(now.select(F.col("doc_id").alias("other"), F.col("cluster").alias("theirs")), "other")
        .filter("cluster <> theirs").select("doc_id", "theirs").distinct()
    )
    wanted = clustered.withColumnRenamed("cluster", "theirs").join(rest.select("theirs").distinct(), "theirs", "left_semi")
    sizes = splittable(wanted.groupBy("theirs").agg(F.ceil(F.count("*") / PART_MEMBERS).alias("parts")))
    parts = shared_checkpoint(
        wanted.join(sizes, "theirs").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")))
        .select("theirs", "part", "doc_id", "n", "place", "start", "length")
        .groupBy("theirs", "part").applyInArrow(_divider(f"{folder}/parts"), _PARTS)
    )
    asked = rest.join(parts, "theirs").join(first.select("doc_id", "n", "place", "start", "length"), "doc_id")
    late = asked.repartition(shards, "doc_id", "members").mapInArrow(_member_searcher(similarity), "a bigint, b bigint")
    links = links.unionByName(late).unionByName(same)
    of = components(links).select(F.col("id").alias("doc_id"), "component_id")
    return described.select("doc_id", F.col("n").alias("n_shingles")).join(of, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
