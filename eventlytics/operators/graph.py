"""Graph measures of the who-met-whom network as iterative DataFrame jobs.

A graph is two frames: ``vertices(id, …)`` and directed ``edges(src, dst, …)``
with each (src, dst) once. Edges stay where they are: they are laid out once by
source, and only the much smaller vertex state moves in each round. A
vertex with very many edges gets several salts, so its edges fill several
partitions and its state row is repeated once per salt. Messages are combined
before the shuffle. State is checkpointed to the shared folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from eventlytics.operators.scale import dense_ids, shared_checkpoint, shared_table, shuffle_width, splittable

SALT_EDGES = 500_000
CHECKPOINT_EVERY = 5


# -- building ---------------------------------------------------------------

def vertex_names(fights: DataFrame, one: str = "fighter1_name", two: str = "fighter2_name") -> DataFrame:
    """Distinct names of both sides; an empty name is none."""
    return fights.select(F.explode(F.array(one, two)).alias("name")).filter(
        F.length("name") > 0
    ).distinct()


def name_edges(fights: DataFrame, one: str = "fighter1_name", two: str = "fighter2_name") -> DataFrame:
    """Directed edges by name with the number of meetings."""
    return (
        fights.filter((F.length(one) > 0) & (F.length(two) > 0))
        .groupBy(F.col(one).alias("src_name"), F.col(two).alias("dst_name"))
        .agg(F.count("*").alias("fight_count"))
    )


def attach_ids(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Vertex ids for both edge ends (inner lookups)."""
    src = vertices.select(F.col("name").alias("src_name"), F.col("id").alias("src"))
    dst = vertices.select(F.col("name").alias("dst_name"), F.col("id").alias("dst"))
    return edges.join(src, "src_name").join(dst, "dst_name").select("src", "dst", "fight_count")


def build_graph(
    fights: DataFrame, one: str = "fighter1_name", two: str = "fighter2_name"
) -> tuple[DataFrame, DataFrame]:
    """(vertices(id, name), edges(src, dst, fight_count)); ids follow name order.

    Meetings are counted by name first, so the id lookups see each pair once.
    """
    vertices = dense_ids(vertex_names(fights, one, two), "name").select("id", "name")
    return vertices, attach_ids(name_edges(fights, one, two), vertices)


# -- layout for iteration ---------------------------------------------------

class _Layout:
    """Edges laid out for iteration, with the vertex columns that go with them.

    ``start`` holds (id, out_, salts_) of every vertex, laid out by id. Edges are
    laid out by src, or by (src, salt_) if some vertex has too many of them for
    one partition. Without such vertices the state meets its edges where it is,
    so a round shuffles nothing but the combined messages.
    """

    def __init__(self, vertices: DataFrame, edges: DataFrame, salt_edges: int):
        width = shuffle_width(edges.sparkSession)
        pairs = edges.select("src", "dst")
        degrees = shared_checkpoint(
            pairs.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("out_")).withColumn(
                "salts_", F.ceil(F.col("out_") / salt_edges).cast("int")
            )
        )
        self.salted = not degrees.filter("salts_ > 1").isEmpty()
        if self.salted:
            salt = F.pmod(F.xxhash64("dst"), F.col("salts_")).cast("int")
            pairs = pairs.join(degrees.select(F.col("id").alias("src"), "salts_"), "src").select(
                "src", "dst", salt.alias("salt_")
            )
        self.on = ["src", "salt_"] if self.salted else ["src"]
        # sorted as they are kept, so that no round sorts them again
        self.edges = pairs.repartition(width, *self.on).sortWithinPartitions(*self.on).persist()
        self.start = (
            vertices.select("id").join(degrees, "id", "left").fillna(0, ["out_", "salts_"])
            .repartition(width, "id").sortWithinPartitions("id").persist()
        )

    def send(self, state: DataFrame) -> DataFrame:
        """Vertex state along its out edges: one row per edge, keyed by ``dst``."""
        moved = state.withColumnRenamed("id", "src")
        if self.salted:
            moved = moved.filter("salts_ > 0").withColumn(
                "salt_", F.explode(F.sequence(F.lit(0), F.col("salts_") - 1))
            )
        return moved.join(self.edges, self.on)

    def release(self) -> None:
        self.edges.unpersist()
        self.start.unpersist()


def pagerank(
    vertices: DataFrame, edges: DataFrame, reset: float = 0.15, rounds: int = 20,
    salt_edges: int = SALT_EDGES,
) -> DataFrame:
    """(id, pagerank_score): ``reset + (1 - reset) · Σ rank / out-degree``, all
    ranks 1 at the start, scaled at the end so that they sum to the vertex count.
    """
    layout = _Layout(vertices, edges, salt_edges)
    state = layout.start.withColumn("rank_", F.lit(1.0))
    for i in range(1, rounds + 1):
        sent = layout.send(state).groupBy(F.col("dst").alias("id")).agg(
            F.sum(F.col("rank_") / F.col("out_")).alias("in_")
        )
        state = layout.start.join(sent, "id", "left").withColumn(
            "rank_", F.lit(reset) + F.lit(1 - reset) * F.coalesce("in_", F.lit(0.0))
        ).drop("in_")
        if i % CHECKPOINT_EVERY == 0 or i == rounds:
            state = shared_checkpoint(state)
    layout.release()
    scale = state.agg(F.count("*") / F.sum("rank_")).scalar()
    return state.select("id", (F.col("rank_") * scale).alias("pagerank_score"))


def label_propagation(
    vertices: DataFrame, edges: DataFrame, rounds: int = 5, salt_edges: int = SALT_EDGES
) -> DataFrame:
    """(id, community_id): synchronous rounds over edges in both directions.

    A vertex takes the label most of its edges bring, the smallest of several;
    a vertex without edges keeps its own.
    """
    both = edges.select("src", "dst").unionByName(
        edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    )
    layout = _Layout(vertices, both, salt_edges)
    state = layout.start.withColumn("label_", F.col("id"))
    for i in range(1, rounds + 1):
        votes = layout.send(state).groupBy(F.col("dst").alias("id"), "label_").agg(
            F.count("*").alias("n_")
        )
        winner = votes.groupBy("id").agg(
            F.min(F.struct((-F.col("n_")).alias("n"), F.col("label_").alias("label"))).alias("w_")
        )
        state = layout.start.join(winner, "id", "left").withColumn(
            "label_", F.coalesce(F.col("w_.label"), F.col("id"))
        ).drop("w_")
        if i % CHECKPOINT_EVERY == 0 or i == rounds:
            state = shared_checkpoint(state)
    layout.release()
    return state.select("id", F.col("label_").alias("community_id"))


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component_id): the smallest id reachable, edge direction ignored.

    Randomised contraction (Bögeholz, Brand, Todor, 2019): in each round every vertex is
    renamed to the least hash among its own and its neighbours', and edges inside a name
    go. Chains halve, and rounds are few whatever the order of ids. The hash of one
    whole number is one-to-one, so names of a round never clash; ids of other kinds are
    numbered first. Each round's renaming is kept, and read back from the last to the first.
    """
    ends = edges.filter("src <> dst").select("src", "dst")
    if not isinstance(edges.schema["src"].dataType, IntegralType):
        named = shared_checkpoint(dense_ids(ends.select(F.explode(F.array("src", "dst")).alias("key")).distinct(), "key", "at"))
        for end in ("src", "dst"):
            ends = ends.join(named.select(F.col("key").alias(end), F.col("at").alias(f"{end}_at")), end)
        numbers = vertices.select("id").distinct().join(named, F.col("id") == F.col("key")).select("id", "at")
        found = connected_components(numbers.select(F.col("at").alias("id")), ends.select(
            F.col("src_at").alias("src"), F.col("dst_at").alias("dst")
        ))
        found = numbers.join(found.withColumnRenamed("id", "at"), "at")
        least = splittable(found.groupBy("component_id").agg(F.min("id").alias("root_")))
        rooted = found.join(least, "component_id").select("id", "root_")
        return vertices.select("id").join(rooted, "id", "left").select("id", F.coalesce("root_", "id").alias("component_id"))
    pairs = ends.select(*[F.col(end).cast("bigint").alias(c) for c, end in zip("uv", ("src", "dst"))])
    pairs = shared_checkpoint(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    levels = []
    while not pairs.isEmpty():
        levels.append(shared_table(_renamed(pairs, len(levels))))
        pairs = shared_checkpoint(_contracted(pairs, levels[-1]))
    if not levels:
        return vertices.select("id", F.col("id").alias("component_id"))
    last = len(levels) - 1
    roots = levels[last].select("a", F.col("m").alias("root_"), F.lit(last).alias("level_"))
    for i in reversed(range(last)):
        # a name that no edge was left for is a root of its own round
        roots = levels[i].select(F.col("a").alias("a_"), "m").join(roots, F.col("m") == F.col("a"), "left").select(
            F.col("a_").alias("a"), F.coalesce("root_", "m").alias("root_"), F.coalesce("level_", F.lit(i)).alias("level_")
        )
    roots = shared_checkpoint(roots)
    least = splittable(roots.groupBy("root_", "level_").agg(F.min("a").alias("least_")))
    rooted = roots.join(least, ["root_", "level_"]).select(F.col("a").alias("id"), "least_")
    kind = vertices.schema["id"].dataType
    return vertices.select("id").join(rooted, "id", "left").select(
        "id", F.coalesce(F.col("least_").cast(kind), F.col("id")).alias("component_id")
    )


def _renamed(pairs: DataFrame, round_: int) -> DataFrame:
    """(a, m): the least hash among a vertex and its neighbours; every round hashes anew."""
    both = pairs.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(
        pairs.select(F.col("v").alias("a"), F.col("u").alias("b"))
    )
    near = both.groupBy("a").agg(F.min(F.xxhash64(F.lit(round_), "b")).alias("m"))
    return near.select("a", F.least("m", F.xxhash64(F.lit(round_), "a")).alias("m"))


def _contracted(pairs: DataFrame, names: DataFrame) -> DataFrame:
    """Edges between different new names, each once."""
    names = splittable(names)
    moved = pairs
    for end in "uv":
        moved = moved.join(names.select(F.col("a").alias(end), F.col("m").alias(f"{end}_")), end)
    return moved.filter("u_ <> v_").select(F.least("u_", "v_").alias("u"), F.greatest("u_", "v_").alias("v")).distinct()


def triangle_count(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, triangle_count), undirected and simple.

    Each edge points from its end of smaller degree, which bounds the out
    neighbours of any vertex by about the square root of twice the edge count,
    so the wedges to be closed stay few however popular a vertex is.
    """
    pairs = edges.filter("src <> dst").select(
        F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")
    ).distinct()
    pairs = shared_checkpoint(pairs)
    degree = splittable(
        pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("d"))
    )
    with_degrees = pairs.join(degree.select(F.col("id").alias("a"), F.col("d").alias("da")), "a").join(
        degree.select(F.col("id").alias("b"), F.col("d").alias("db")), "b"
    )
    forward = F.struct("da", "a") < F.struct("db", "b")
    oriented = shared_checkpoint(
        with_degrees.select(
            F.when(forward, F.col("a")).otherwise(F.col("b")).alias("x"),
            F.when(forward, F.col("b")).otherwise(F.col("a")).alias("y"),
        )
    )
    second = oriented.select("x", F.col("y").alias("z"))
    wedges = oriented.join(second, "x").filter("y < z")
    closing = pairs.select(F.col("a").alias("y"), F.col("b").alias("z"))
    closed = wedges.join(closing, ["y", "z"])
    per_vertex = closed.select(F.explode(F.array("x", "y", "z")).alias("id")).groupBy("id").agg(
        F.count("*").alias("triangle_count")
    )
    return vertices.select("id").join(per_vertex, "id", "left").fillna(0, ["triangle_count"])


def degrees(edges: DataFrame) -> DataFrame:
    """(id, degree, num_opponents): edge ends, and distinct neighbours."""
    ends = edges.select("src", "dst").unionByName(
        edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    )
    per_pair = ends.groupBy("src", "dst").agg(F.count("*").alias("n"))
    return per_pair.groupBy(F.col("src").alias("id")).agg(
        F.sum("n").alias("degree"), F.count("*").alias("num_opponents")
    )


def group_sizes(df: DataFrame, label: str, top: int | None = None) -> DataFrame:
    """Members per label, largest first."""
    sizes = df.groupBy(label).agg(F.count("*").alias("members"))
    return sizes.orderBy(F.desc("members"), label).limit(top) if top else sizes


def combine(vertices: DataFrame, measures: list[DataFrame]) -> DataFrame:
    """All measures by vertex id, unknown values as 0."""
    joined = reduce(lambda a, b: a.join(b, "id", "left"), measures, vertices)
    return joined.fillna(0)


def graph_features(fights: DataFrame) -> DataFrame:
    """Names with rank, component, triangles, opponents and community."""
    vertices, edges = build_graph(fights)
    vertices, edges = shared_checkpoint(vertices), shared_checkpoint(edges)
    return combine(
        vertices,
        [
            pagerank(vertices, edges),
            connected_components(vertices, edges),
            triangle_count(vertices, edges),
            degrees(edges),
            label_propagation(vertices, edges),
        ],
    )


def appearance_share(
    fights: DataFrame, one: str = "fighter1_name", two: str = "fighter2_name"
) -> DataFrame:
    """Cheap stand-in for the graph: appearances relative to the busiest entity."""
    left = fights.groupBy(F.col(one).alias("name")).agg(F.count("*").alias("fights_as_f1"))
    right = fights.groupBy(F.col(two).alias("name")).agg(F.count("*").alias("fights_as_f2"))
    both = left.join(right, "name", "outer").fillna(0).withColumn(
        "num_opponents", F.col("fights_as_f1") + F.col("fights_as_f2")
    )
    return share_of_max(both, "num_opponents", "pagerank_score").withColumns(
        {c: F.lit(0).cast("bigint") for c in ("component_id", "triangle_count", "community_id")}
    )


def share_of_max(df: DataFrame, column: str, out: str) -> DataFrame:
    """Value over the global maximum, which stays a scalar subquery."""
    return df.withColumn(out, F.col(column) / df.agg(F.max(column)).scalar())


def top_by(df: DataFrame, measure: str, key: str, n: int = 10) -> DataFrame:
    return df.orderBy(F.desc(measure), key).limit(n)

