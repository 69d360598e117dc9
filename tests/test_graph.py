"""Graph measures on known graphs and against plain Python."""

import random
from collections import Counter, defaultdict

import pytest

from eventlytics.operators import graph

EDGES = [(1, 2), (2, 3), (3, 1), (3, 4), (5, 6), (6, 5), (7, 1)]
RANKS = {1: 0.889894838, 2: 0.991076491, 3: 1.075877026, 4: 0.691111034, 5: 1.559088656, 6: 1.559088656, 7: 0.233863298}


def frames(spark, edges, vertices=None):
    ids = sorted(vertices or {x for e in edges for x in e})
    return (spark.createDataFrame([(i,) for i in ids], "id bigint"),
            spark.createDataFrame(edges, "src bigint, dst bigint"))


def as_dict(df):
    return {r[0]: r[1] for r in df.collect()}


@pytest.mark.parametrize("salt", [1, 2, 1000])
def test_known_graph(spark, salt):
    v, e = frames(spark, EDGES)
    ranks = as_dict(graph.pagerank(v, e, salt_edges=salt))
    assert ranks == pytest.approx(RANKS, abs=1e-8)
    assert sum(ranks.values()) == pytest.approx(7)
    assert as_dict(graph.label_propagation(v, e, salt_edges=salt)) == {1: 1, 2: 1, 3: 1, 4: 1, 7: 1, 5: 6, 6: 5}
    assert as_dict(graph.connected_components(v, e)) == {1: 1, 2: 1, 3: 1, 4: 1, 7: 1, 5: 5, 6: 5}
    assert as_dict(graph.triangle_count(v, e)) == {1: 1, 2: 1, 3: 1, 4: 0, 5: 0, 6: 0, 7: 0}
    degrees = {r.id: (r.degree, r.num_opponents) for r in graph.degrees(e).collect()}
    assert degrees[5] == (2, 1) and degrees[3] == (3, 3)


def star_and_noise(seed):
    rng = random.Random(seed)
    edges = {(0, i) for i in range(1, 40)}  # one vertex with most edges
    edges |= {(rng.randrange(80), rng.randrange(80)) for _ in range(60)}
    return sorted((a, b) for a, b in edges if a != b)


def components(ids, edges):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_and_triangles_of_random_graphs(spark, seed):
    edges = star_and_noise(seed)
    ids = set(range(85))  # some without edges
    v, e = frames(spark, edges, ids)
    assert as_dict(graph.connected_components(v, e)) == components(ids, edges)
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    count = Counter()
    for a in ids:
        for b in near[a]:
            for c in near[a] & near[b]:
                if a < b < c:
                    count.update((a, b, c))
    found = as_dict(graph.triangle_count(v, e))
    assert found == {i: count[i] for i in ids}
    assert sum(found.values()) % 3 == 0


def test_long_chain(spark):
    edges = [(i, i + 1) for i in range(200)]
    v, e = frames(spark, edges)
    assert set(as_dict(graph.connected_components(v, e)).values()) == {0}


def test_no_edges(spark):
    v, e = frames(spark, [], [1, 2])
    assert as_dict(graph.connected_components(v, e)) == {1: 1, 2: 2}
    assert as_dict(graph.triangle_count(v, e)) == {1: 0, 2: 0}


def test_features_of_contests(spark):
    fights = spark.createDataFrame([("A", "B"), ("A", "B"), ("B", "C"), ("C", "A"), ("D", None)],
                                   "fighter1_name string, fighter2_name string")
    rows = {r.name: r for r in graph.graph_features(fights).collect()}
    assert set(rows) == {"A", "B", "C", "D"}
    assert rows["A"].triangle_count == 1 and rows["A"].num_opponents == 2 and rows["D"].degree == 0
    edges = graph.build_graph(fights)[1].collect()
    assert sorted(r.fight_count for r in edges) == [1, 1, 2]
    share = {r.name: r.pagerank_score for r in graph.appearance_share(fights.na.drop()).collect()}
    assert share["A"] == 1.0 and share["C"] == pytest.approx(2 / 3)


def test_components_contract(spark):
    """Edges of a chain shrink in every round, whatever the order of its ids; names and ids of any kind."""
    edges = [(i, i + 1) for i in range(3000)]
    pairs, left = spark.createDataFrame(edges, "u bigint, v bigint"), []
    for i in range(4):
        pairs = graph._contracted(pairs, graph._renamed(pairs, i)).localCheckpoint()
        left.append(pairs.count())
    assert left[0] < 2000 and left[3] < 400
    v = spark.createDataFrame([(x,) for x in ["z", "b", "c", "d", "q"]], "id string")
    e = spark.createDataFrame([("z", "c"), ("c", "b"), ("d", "d"), (None, "q")], "src string, dst string")
    assert as_dict(graph.connected_components(v, e)) == {"z": "b", "c": "b", "b": "b", "d": "d", "q": "q"}
    v = spark.createDataFrame([(1,), (2,), (2,), (-3,), (None,)], "id int")
    e = spark.createDataFrame([(2, 1), (1, 2), (1, -3), (1, 9)], "src int, dst int")
    out = graph.connected_components(v, e)
    assert sorted(map(str, map(tuple, out.collect()))) == ["(-3, -3)", "(1, -3)", "(2, -3)", "(2, -3)", "(None, None)"]
    assert dict(out.dtypes) == {"id": "int", "component_id": "int"}


def test_estimates_of_components_stay_small(spark):
    """The estimated size had three times the digits after every round, and plans were slow by that."""
    v, e = frames(spark, [(i, i + 1) for i in range(300)])
    out = graph.connected_components(v, e)
    assert out._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 1_500
    assert set(as_dict(out).values()) == {0}


def test_combined_measures_are_planned_with_small_sizes(spark):
    """The driver held the sizes of components in every node of the plan that joins all measures."""
    v, e = frames(spark, [(i, i + 1) for i in range(300)] + [(0, 2)])
    parts = [graph.pagerank(v, e, rounds=2), graph.connected_components(v, e), graph.triangle_count(v, e),
             graph.degrees(e).drop("degree"), graph.label_propagation(v, e, rounds=2)]
    out = graph.combine(v, parts)
    assert out._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 3_000
    rows = {r.id: r for r in out.collect()}
    assert len(rows) == 301 and {r.component_id for r in rows.values()} == {0}
    assert [rows[i].triangle_count for i in range(4)] == [1, 1, 1, 0] and rows[2].num_opponents == 3
