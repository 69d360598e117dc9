"""Network measures of the who-met-whom graph."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventlytics.catalog import views as v
from eventlytics.catalog.registry import query
from eventlytics.operators import graph, scale

GRAPH = v.with_(v.EDGES)


def _graph(spark, sf):
    vertices, edges = v.part_graph(spark, sf)
    edges = scale.shared_checkpoint(edges)
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct(), edges


@query(
    "g1_vertices",
    v.with_(v.BOUTS) + """SELECT row_number() OVER (ORDER BY name) - 1 AS id, name FROM
      (SELECT fighter1_name AS name FROM bouts UNION SELECT fighter2_name FROM bouts)""",
)
def vertices(spark, sf):
    return graph.build_graph(v.bouts(spark, sf))[0]


@query(
    "g1_edges",
    v.with_(v.BOUTS, """ids AS (SELECT row_number() OVER (ORDER BY name) - 1 AS id, name FROM
      (SELECT fighter1_name AS name FROM bouts UNION SELECT fighter2_name FROM bouts))""")
    + """SELECT a.id AS src, b.id AS dst, count(*) AS fight_count FROM bouts JOIN ids a ON a.name = fighter1_name
      JOIN ids b ON b.name = fighter2_name GROUP BY ALL""",
)
def edges(spark, sf):
    return graph.build_graph(v.bouts(spark, sf))[1]


@query(
    "j12_name_to_id",
    """SELECT s_suppkey AS src, n_nationkey AS dst, count(*) AS fight_count FROM supplier
    JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL""",
)
def name_to_id(spark, sf):
    suppliers, nations = v.table(spark, sf, "supplier"), v.table(spark, sf, "nation")
    named = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    ids = suppliers.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")).unionByName(
        nations.select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("id"))
    )
    pairs = graph.name_edges(named, "s_name", "n_name")
    return graph.attach_ids(pairs, ids).withColumn("dst", F.col("dst").cast("int"))


def _rank_rounds(rounds: int) -> str:
    steps = ["""weighted AS MATERIALIZED (SELECT src, dst, count(*) OVER (PARTITION BY src) AS d FROM edges),
      r0 AS (SELECT id, 1.0::DOUBLE AS r FROM vertices)"""]
    for i in range(1, rounds + 1):
        steps.append(f"""r{i} AS MATERIALIZED (SELECT v.id, 0.15 + 0.85 * coalesce(sum(p.r / w.d), 0) AS r
        FROM vertices v LEFT JOIN weighted w ON w.dst = v.id LEFT JOIN r{i - 1} p ON p.id = w.src GROUP BY v.id)""")
    return ", " + ", ".join(steps) + f", ranks AS (SELECT id, r * count(*) OVER () / sum(r) OVER () AS rank FROM r{rounds})"


RANKS = _rank_rounds(20)


@query("g2_pagerank", GRAPH + RANKS + " SELECT id, round(rank, 6) AS pagerank_score FROM ranks")
def pagerank(spark, sf):
    return graph.pagerank(*_graph(spark, sf)).withColumn("pagerank_score", F.round("pagerank_score", 6))


def _least_rounds(rounds: int) -> str:
    steps = ["""around AS MATERIALIZED (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges),
      c0 AS (SELECT id, id AS c FROM vertices)"""]
    for i in range(1, rounds + 1):
        steps.append(f"""c{i} AS MATERIALIZED (SELECT p.id, least(p.c, min(q.c)) AS c FROM c{i - 1} p
        LEFT JOIN around ON src = p.id LEFT JOIN c{i - 1} q ON q.id = dst GROUP BY p.id, p.c)""")
    return ", " + ", ".join(steps) + f", components AS (SELECT id, c AS component_id FROM c{rounds})"


COMPONENTS = _least_rounds(12)


@query("g3_connected_components", GRAPH + COMPONENTS + " SELECT id, component_id FROM components")
def connected_components(spark, sf):
    return graph.connected_components(*_graph(spark, sf))


@query(
    "g3_components_of_chains",
    "SELECT o_orderkey AS id, min(o_orderkey) OVER (PARTITION BY o_custkey) AS component_id FROM orders",
)
def components_of_chains(spark, sf):
    """Each customer's orders linked one after another: many long thin components."""
    orders = v.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey", "o_orderdate")
    after = Window.partitionBy("o_custkey").orderBy("o_orderdate", "id")
    links = orders.withColumn("src", F.lag("id").over(after)).filter("src IS NOT NULL")
    return graph.connected_components(
        orders.select("id"), scale.shared_checkpoint(links.select("src", F.col("id").alias("dst")))
    )


@query(
    "g3_component_sizes",
    GRAPH + COMPONENTS + """SELECT component_id, count(*) AS members FROM components GROUP BY component_id
      ORDER BY members DESC, component_id LIMIT 5""",
)
def component_sizes(spark, sf):
    return graph.group_sizes(graph.connected_components(*_graph(spark, sf)), "component_id", 5)


TRIANGLES = """, pairs AS MATERIALIZED (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM edges),
tri AS MATERIALIZED (SELECT p.a AS x, p.b AS y, q.b AS z FROM pairs p JOIN pairs q ON p.b = q.a
  JOIN pairs r ON r.a = p.a AND r.b = q.b),
triangles AS (SELECT id, count(t) AS triangle_count FROM vertices LEFT JOIN
  (SELECT x AS t FROM tri UNION ALL SELECT y FROM tri UNION ALL SELECT z FROM tri) ON t = id GROUP BY id)"""


@query("g4_triangle_count", GRAPH + TRIANGLES + " SELECT id, triangle_count FROM triangles")
def triangle_count(spark, sf):
    return graph.triangle_count(*_graph(spark, sf))


DEGREES = """, degrees AS (SELECT id, count(*) AS degree, count(DISTINCT other) AS num_opponents FROM (
  SELECT src AS id, dst AS other FROM edges UNION ALL SELECT dst, src FROM edges) GROUP BY id)"""


@query("g5_degrees", GRAPH + DEGREES + " SELECT id, degree, num_opponents FROM degrees")
def degrees(spark, sf):
    return graph.degrees(_graph(spark, sf)[1])


def _label_rounds(rounds: int) -> str:
    steps = ["""ways AS MATERIALIZED (SELECT src, dst FROM edges UNION ALL SELECT dst, src FROM edges),
      l0 AS (SELECT id, id AS label FROM vertices)"""]
    for i in range(1, rounds + 1):
        steps.append(f"""l{i} AS MATERIALIZED (SELECT v.id, coalesce(w.label, p.label) AS label FROM vertices v
        JOIN l{i - 1} p ON p.id = v.id LEFT JOIN (SELECT dst, label, row_number() OVER (PARTITION BY dst
          ORDER BY count(*) DESC, label) AS rn FROM ways JOIN l{i - 1} q ON q.id = src GROUP BY dst, label) w
          ON w.dst = v.id AND w.rn = 1)""")
    return ", " + ", ".join(steps) + f", communities AS (SELECT id, label AS community_id FROM l{rounds})"


COMMUNITIES = _label_rounds(5)


@query("g6_label_propagation", GRAPH + COMMUNITIES + " SELECT id, community_id FROM communities")
def label_propagation(spark, sf):
    return graph.label_propagation(*_graph(spark, sf))


@query(
    "g7_combined_measures",
    GRAPH + RANKS + COMPONENTS + TRIANGLES + DEGREES + COMMUNITIES + """ SELECT id,
      round(coalesce(rank, 0), 6) AS pagerank_score, coalesce(component_id, 0) AS component_id,
      coalesce(triangle_count, 0) AS triangle_count, coalesce(num_opponents, 0) AS num_opponents,
      coalesce(community_id, 0) AS community_id
    FROM vertices LEFT JOIN ranks USING (id) LEFT JOIN components USING (id) LEFT JOIN triangles USING (id)
    LEFT JOIN degrees USING (id) LEFT JOIN communities USING (id)""",
)
def combined_measures(spark, sf):
    nodes, links = _graph(spark, sf)
    nodes = scale.shared_checkpoint(nodes)  # every measure starts from them
    out = graph.combine(
        nodes,
        [
            graph.pagerank(nodes, links), graph.connected_components(nodes, links),
            graph.triangle_count(nodes, links), graph.degrees(links).drop("degree"),
            graph.label_propagation(nodes, links),
        ],
    )
    return out.withColumn("pagerank_score", F.round("pagerank_score", 6))


@query(
    "j13_metric_chain",
    GRAPH + TRIANGLES + DEGREES + """ SELECT id, coalesce(triangle_count, 0) AS triangle_count,
      coalesce(degree, 0) AS degree, coalesce(num_opponents, 0) AS num_opponents
    FROM vertices LEFT JOIN triangles USING (id) LEFT JOIN degrees USING (id)""",
)
def metric_chain(spark, sf):
    nodes, links = _graph(spark, sf)
    return graph.combine(nodes, [graph.triangle_count(nodes, links), graph.degrees(links)])


@query(
    "g8_appearance_share",
    v.with_(v.BOUTS) + """, sides_of AS (SELECT name, sum(a) AS a, sum(b) AS b FROM (
        SELECT fighter1_name AS name, 1 AS a, 0 AS b FROM bouts UNION ALL SELECT fighter2_name, 0, 1 FROM bouts)
      GROUP BY name)
    SELECT name, CAST(a AS BIGINT) AS fights_as_f1, CAST(b AS BIGINT) AS fights_as_f2,
      CAST(a + b AS BIGINT) AS num_opponents, round((a + b) / max(a + b) OVER (), 6) AS pagerank_score,
      0::BIGINT AS component_id, 0::BIGINT AS triangle_count, 0::BIGINT AS community_id FROM sides_of""",
)
def appearance_share(spark, sf):
    out = graph.appearance_share(v.bouts(spark, sf))
    return out.withColumn("pagerank_score", F.round("pagerank_score", 6))
