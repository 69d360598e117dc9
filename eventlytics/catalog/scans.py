"""Sources, sinks, filters, sorts, limits, set operations, incremental loads."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from eventlytics.catalog import views as v
from eventlytics.catalog.registry import query
from eventlytics.functions import frames
from eventlytics.operators import incremental, profile, scale, store
from eventlytics.sources import files


def scratch(spark, name: str) -> str:
    """A fresh folder beside the checkpoints, which all executors share."""
    scale.checkpoint_dir(spark)
    root = spark.sparkContext.getCheckpointDir()
    if root.startswith("file:"):
        root = root[len("file:"):]
    if "://" in root:
        import uuid

        return f"{root}/{name}-{uuid.uuid4().hex}"
    return tempfile.mkdtemp(prefix=f"{name}-", dir=root)


@query(
    "s1_csv_round_trip",
    "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer",
)
def csv_round_trip(spark, sf):
    path = scratch(spark, "csv")
    df = v.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    files.write_csv(df.toDF("C_CUSTKEY", "C_NAME", "C_MKTSEGMENT"), path)
    return files.read_csv(spark, path, "C_CUSTKEY string, C_NAME string, C_MKTSEGMENT string")


@query(
    "s2_csv_all_text",
    """SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey
    FROM nation""",
)
def csv_all_text(spark, sf):
    path = scratch(spark, "text")
    files.write_csv(v.table(spark, sf, "nation"), path)
    return files.read_csv(spark, path)


@query("s3_parquet_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000")
def parquet_scan(spark, sf):
    return v.table(spark, sf, "orders").filter("o_totalprice > 400000").select("o_orderkey", "o_totalprice")


@query("s4_first_available", "SELECT s_suppkey, s_name FROM supplier")
def first_available(spark, sf):
    paths = [f"{sf}/absent.parquet", f"{sf}/supplier.parquet", f"{sf}/part.parquet"]
    return files.first_available(files.read_parquet, spark, paths).select("s_suppkey", "s_name")


@query(
    "s5_partitioned_parquet",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) = 1997""",
)
def partitioned_parquet(spark, sf):
    path = scratch(spark, "parquet")
    df = v.table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    files.write_parquet(df, path, ["year"])
    return files.read_parquet(spark, path).filter("year = 1997")


@query(
    "s6_csv_sink",
    "SELECT o_orderpriority AS event_name, count(*) AS n FROM orders GROUP BY o_orderpriority",
)
def csv_sink(spark, sf):
    path = scratch(spark, "sink")
    files.write_csv(profile.value_counts(v.table(spark, sf, "orders"), "o_orderpriority"), path)
    return files.read_csv(spark, path, "event_name string, n bigint")


METRICS = """SELECT round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae, round(avg(e * e), 6) AS mse,
  round(1 - avg(e * e) / var_pop(y), 6) AS r2, count(*) AS test_size
FROM (SELECT l_extendedprice AS y, l_extendedprice - l_quantity * 2000 AS e FROM lineitem)"""


@query("s7_metrics_sink", METRICS)
def metrics_sink(spark, sf):
    path = scratch(spark, "metrics")
    df = v.table(spark, sf, "lineitem").withColumn("guess", F.col("l_quantity") * 2000)
    files.write_metrics(profile.regression_metrics(df, "l_extendedprice", "guess"), path, {"num_features": 1})
    out = files.read_json(spark, path, "rmse double, mae double, mse double, r2 double, test_size bigint")
    return out.withColumns({c: F.round(c, 6) for c in ("rmse", "mae", "mse", "r2")})


@query("m6_regression_metrics", METRICS)
def regression_metrics(spark, sf):
    df = v.table(spark, sf, "lineitem").withColumn("guess", F.col("l_quantity") * 2000)
    out = profile.regression_metrics(df, "l_extendedprice", "guess")
    return out.withColumns({c: F.round(c, 6) for c in ("rmse", "mae", "mse", "r2")})


@query(
    "s9_kept_for_reuse",
    """SELECT c_mktsegment, count(*) AS customers, max(c_acctbal) AS best FROM customer GROUP BY c_mktsegment""",
)
def kept_for_reuse(spark, sf):
    kept = v.table(spark, sf, "customer").select("c_mktsegment", "c_acctbal").persist()
    count = kept.groupBy("c_mktsegment").agg(F.count("*").alias("customers"))
    best = kept.groupBy("c_mktsegment").agg(F.max("c_acctbal").alias("best"))
    out = scale.shared_checkpoint(count.join(best, "c_mktsegment"))
    kept.unpersist()
    return out


@query(
    "s10_head_sample",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100",
)
def head_sample(spark, sf):
    return profile.head(
        v.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"]
    )


@query(
    "s11_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS rows, count({c}) AS known, CAST(min({c}) AS DOUBLE) AS lowest,
        CAST(max({c}) AS DOUBLE) AS highest, round(avg({c}), 4) AS mean, count(DISTINCT {c}) AS "distinct"
        FROM lineitem""" for c in ("l_suppkey", "l_quantity", "l_extendedprice", "l_discount")
    ),
)
def table_profile(spark, sf):
    out = profile.profile(
        v.table(spark, sf, "lineitem"), ["l_suppkey", "l_quantity", "l_extendedprice", "l_discount"]
    )
    return out.withColumn("mean", F.round("mean", 4))


# -- incremental loads: the feed has all events, the store misses some ------

STORE = """parents AS (SELECT * FROM cards WHERE CAST(strftime(event_date, '%d') AS INTEGER) % 5 <> 0),
children AS (SELECT event_id, fight_id FROM bouts WHERE CAST(strftime(event_date, '%d') AS INTEGER) % 7 <> 0
  AND CAST(strftime(event_date, '%d') AS INTEGER) % 5 <> 0),
stale AS (
  SELECT event_id, 'new' AS reason FROM cards WHERE event_id NOT IN (SELECT event_id FROM parents)
  UNION ALL SELECT event_id, 'incomplete' FROM parents WHERE event_id NOT IN (SELECT event_id FROM children))"""
STALE = v.with_(v.BOUTS, v.CARDS, STORE)


def _store(spark, sf):
    day = F.dayofmonth("event_date")
    feed = v.cards(spark, sf)
    rows = v.bouts(spark, sf).select("event_id", "fight_id", "event_date")
    children = rows.filter((day % 7 != 0) & (day % 5 != 0)).select("event_id", "fight_id")
    return feed, feed.filter(day % 5 != 0), children, rows.select("event_id", "fight_id")


@query("s12_keys_to_load", STALE + "SELECT event_id, reason FROM stale")
def keys_to_load(spark, sf):
    feed, parents, children, _ = _store(spark, sf)
    return incremental.keys_to_load(feed, parents, children, "event_id")


@query(
    "s12_refresh_store",
    STALE + """SELECT event_id, fight_id FROM bouts WHERE event_id IN (SELECT event_id FROM stale)
    UNION ALL SELECT event_id, fight_id FROM children WHERE event_id NOT IN (SELECT event_id FROM stale)""",
)
def refresh_store(spark, sf):
    feed, parents, children, rows = _store(spark, sf)
    stale = incremental.keys_to_load(feed, parents, children, "event_id")
    fresh = rows.join(stale, "event_id", "left_semi")
    return incremental.refresh(children, fresh, stale, "event_id")


@query(
    "s12_refresh_stored",
    STALE + """, events_now AS (SELECT event_id, fight_id, 1 AS version FROM bouts WHERE event_id IN (SELECT event_id FROM stale)
      UNION ALL SELECT event_id, fight_id, 0 FROM children WHERE event_id NOT IN (SELECT event_id FROM stale))
    SELECT event_id, fight_id, version FROM events_now
    UNION ALL SELECT event_id, fight_id, -1 FROM children""",
)
def refresh_stored(spark, sf):
    """The stored table after a refresh, and (version -1) as it was before."""
    feed, parents, children, rows = _store(spark, sf)
    kept = store.Store(spark, scratch(spark, "store"), ("event_id",), buckets=16)
    before = kept.create(children.withColumn("version", F.lit(0)))
    stale = scale.shared_checkpoint(incremental.keys_to_load(feed, parents, kept.read(), "event_id"))
    fresh = rows.join(stale, "event_id", "left_semi").withColumn("version", F.lit(1))
    kept.refresh(fresh, stale)
    return kept.read().unionByName(kept.read(before).withColumn("version", F.lit(-1)))


MERGED = v.with_(v.CARDS) + """, a AS (SELECT event_name, event_date, location, 'sample' AS source FROM cards
    WHERE month(event_date) <= 6),
b AS (SELECT event_name, event_date, 'http://x.example/' || event_id AS wikipedia_url, 'page' AS source FROM cards
    WHERE month(event_date) >= 5),
merged AS (SELECT *, 0 AS rank FROM a UNION ALL BY NAME SELECT *, 1 AS rank FROM b)
SELECT event_name, event_date, location, wikipedia_url, source FROM (
  SELECT *, row_number() OVER (PARTITION BY event_name, event_date ORDER BY rank, source) AS rn FROM merged)
WHERE rn = 1"""


def merged(spark, sf):
    month = F.month("event_date")
    events = v.cards(spark, sf)
    a = events.filter(month <= 6).select("event_name", "event_date", "location", F.lit("sample").alias("source"))
    b = events.filter(month >= 5).select(
        "event_name", "event_date",
        F.concat(F.lit("http://x.example/"), "event_id").alias("wikipedia_url"), F.lit("page").alias("source"),
    )
    return incremental.merge_sources([a, b], order=["source"])


@query("s13_merge_sources", MERGED)
def merge_sources(spark, sf):
    return merged(spark, sf).select("event_name", "event_date", "location", "wikipedia_url", "source")


@query("t3_newest_first", MERGED)
def newest_first(spark, sf):
    out = incremental.newest_first(merged(spark, sf), ties=["event_name"])
    return out.select("event_name", "event_date", "location", "wikipedia_url", "source")


@query("s14_move_columns", "SELECT o_orderkey, o_orderdate::DATE AS day, o_totalprice, o_custkey FROM orders")
def move_columns(spark, sf):
    df = v.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("day")
    )
    return frames.move_columns(df, ["day", "o_totalprice"], "o_custkey", "before")


# -- filters ----------------------------------------------------------------


@query(
    "f1_known_and_non_empty",
    """SELECT doc_id, source FROM documents WHERE lang IS NOT NULL AND text <> ''""",
)
def known_and_non_empty(spark, sf):
    df = v.table(spark, sf, "documents")
    return df.filter(F.col("lang").isNotNull() & (F.col("text") != "")).select("doc_id", "source")


@query(
    "f2_membership",
    """SELECT o_orderkey, o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_pressing FROM orders
    WHERE o_orderstatus NOT IN ('P')""",
)
def membership(spark, sf):
    df = v.table(spark, sf, "orders").filter(~F.col("o_orderstatus").isin("P"))
    return df.select("o_orderkey", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("is_pressing"))


@query(
    "f3_date_range",
    """SELECT o_orderkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1998-12-31'""",
)
def date_range(spark, sf):
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("1997-01-01", "1998-12-31"))
    return v.table(spark, sf, "orders").filter(F.col("o_orderdate").between(low, high)).select("o_orderkey")


@query(
    "f4_not_after",
    "SELECT o_orderkey FROM orders WHERE o_orderdate <= TIMESTAMP '1999-06-30'",
)
def not_after(spark, sf):
    as_of = F.lit("1999-06-30").cast("timestamp_ntz")
    return v.table(spark, sf, "orders").filter(F.col("o_orderdate") <= as_of).select("o_orderkey")


@query(
    "f5_patterns",
    r"""SELECT p_partkey FROM part WHERE regexp_matches(p_brand, '#[1-3]$') OR contains(p_name, 'ring')
      OR starts_with(p_type, 'ECON')""",
)
def patterns(spark, sf):
    hit = F.col("p_brand").rlike("#[1-3]$") | F.col("p_name").contains("ring") | F.col("p_type").startswith("ECON")
    return v.table(spark, sf, "part").filter(hit).select("p_partkey")


@query(
    "f6_any_measure",
    """SELECT o_orderkey FROM orders WHERE (CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END) IS NOT NULL
      OR (CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END) IS NOT NULL""",
)
def any_measure(spark, sf):
    key = F.col("o_orderkey")
    a, b = F.when(key % 2 == 0, F.col("o_totalprice")), F.when(key % 3 == 0, F.col("o_custkey"))
    return v.table(spark, sf, "orders").filter(F.coalesce(a, b).isNotNull()).select("o_orderkey")


# -- sorts, limits, sets ----------------------------------------------------


@query(
    "t1_top_ten",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def top_ten(spark, sf):
    from eventlytics.operators.graph import top_by

    return top_by(v.table(spark, sf, "orders"), "o_totalprice", "o_orderkey").select("o_orderkey", "o_totalprice")


@query(
    "t2_largest_groups",
    """SELECT o_custkey, count(*) AS members FROM orders GROUP BY o_custkey
    ORDER BY members DESC, o_custkey LIMIT 5""",
)
def largest_groups(spark, sf):
    from eventlytics.operators.graph import group_sizes

    return group_sizes(v.table(spark, sf, "orders"), "o_custkey", 5)


@query("t5_first_entities", "SELECT DISTINCT o_custkey FROM orders ORDER BY o_custkey LIMIT 100")
def first_entities(spark, sf):
    return profile.first_entities(v.table(spark, sf, "orders"), "o_custkey", 100)


@query(
    "t6_first_per_group",
    """SELECT event_type, event_id FROM (SELECT event_type, event_id, row_number() OVER
      (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn <= 100""",
)
def first_per_group(spark, sf):
    df = v.table(spark, sf, "events").select("event_type", "event_id", "ts")
    return scale.keep_first_n(df, ["event_type"], ["ts", "event_id"], 100).select("event_type", "event_id")


@query(
    "u1_union_all",
    "SELECT l_orderkey AS k, l_suppkey AS v FROM lineitem UNION ALL SELECT o_orderkey, o_custkey FROM orders",
)
def union_all(spark, sf):
    a = v.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_suppkey").alias("v"))
    b = v.table(spark, sf, "orders").select(F.col("o_custkey").alias("v"), F.col("o_orderkey").alias("k"))
    return a.unionByName(b)


@query(
    "u2_union_distinct",
    v.with_(v.BOUTS) + "SELECT fighter1_name AS name FROM bouts UNION SELECT fighter2_name FROM bouts",
)
def union_distinct(spark, sf):
    from eventlytics.operators.graph import vertex_names

    return vertex_names(v.bouts(spark, sf))


@query(
    "u3_key_difference",
    "SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE year(o_orderdate) >= 2000",
)
def key_difference(spark, sf):
    late = v.table(spark, sf, "orders").filter(F.year("o_orderdate") >= 2000)
    bought = late.select(F.col("o_custkey").alias("c_custkey"))
    return incremental.key_difference(v.table(spark, sf, "customer"), bought, ["c_custkey"])


@query("u4_first_seen", "SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id")
def first_seen(spark, sf):
    return incremental.first_seen(v.table(spark, sf, "events"), ["user_id"], "event_id")


@query(
    "a16_first_by_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER
      (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def first_by_key(spark, sf):
    df = v.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return scale.keep_first(df, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")
