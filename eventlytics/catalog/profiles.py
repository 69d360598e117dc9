"""Distribution, box, correlation and stability summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlytics.catalog import views as v
from eventlytics.catalog.registry import query
from eventlytics.operators import profile


@query(
    "a11_histogram",
    """SELECT CAST(i AS INTEGER) AS bin, round(lo + w * i, 4) AS low, round(lo + w * (i + 1), 4) AS high, coalesce(n, 0) AS n
    FROM (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 30 AS w FROM orders), range(30) AS t(i)
    LEFT JOIN (SELECT least(floor((o_totalprice - (SELECT min(o_totalprice) FROM orders)) /
        (SELECT (max(o_totalprice) - min(o_totalprice)) / 30 FROM orders)), 29) AS b, count(*) AS n
      FROM orders GROUP BY 1) ON b = i""",
)
def histogram(spark, sf):
    out = profile.histogram(v.table(spark, sf, "orders"), "o_totalprice")
    return out.withColumns({"low": F.round("low", 4), "high": F.round("high", 4)})


@query(
    "a11_mean_and_median",
    "SELECT round(avg(o_totalprice), 4) AS mean, round(median(o_totalprice), 6) AS median FROM orders",
)
def mean_and_median(spark, sf):
    return profile.mean_and_median(v.table(spark, sf, "orders"), "o_totalprice").select(
        F.round("mean", 4).alias("mean"), F.round("median", 6).alias("median")
    )


@query(
    "a12_yearly_mean",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1""",
)
def yearly_mean(spark, sf):
    out = profile.yearly_mean(v.table(spark, sf, "orders"), "o_orderdate", "o_totalprice")
    return out.withColumn("mean", F.round("mean", 4))


def _box(table: str, category: str, value: str) -> str:
    return f"""WITH q AS (SELECT {category} AS c, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median,
      quantile_cont({value}, 0.75) AS q3 FROM {table} GROUP BY 1)
    SELECT {category}, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
      min({value}) FILTER (WHERE {value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
      max({value}) FILTER (WHERE {value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
      count(*) AS n,
      count(*) FILTER (WHERE {value} NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
    FROM {table} JOIN q ON {category} = c GROUP BY {category}, q1, median, q3"""


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@query("a13_box_by_priority", _box("orders", "o_orderpriority", "o_totalprice"))
def box_by_priority(spark, sf):
    return _rounded(profile.box(v.table(spark, sf, "orders"), "o_orderpriority", "o_totalprice"))


@query("a13_box_by_event_type", _box("events", "event_type", "value"))
def box_by_event_type(spark, sf):
    return _rounded(profile.box(v.table(spark, sf, "events"), "event_type", "value"))


MEASURES = ("l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_linenumber", "l_suppkey", "l_partkey")


def _pairs(names) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem"
        for i, a in enumerate(names) for b in names[i:]
    )


@query("a14_correlations", _pairs(MEASURES))
def correlations(spark, sf):
    return profile.correlations(v.spread_table(spark, sf, "lineitem"), MEASURES).withColumn("r", F.round("r", 6))


@query(
    "a14_top_correlations",
    f"""WITH pairs AS ({_pairs(MEASURES)}), near AS (SELECT b FROM pairs WHERE a = 'l_extendedprice' AND b <> a
      ORDER BY abs(r) DESC, b LIMIT 3), names AS (SELECT b AS name FROM near UNION ALL SELECT 'l_extendedprice')
    SELECT a, b, r FROM pairs WHERE a IN (SELECT name FROM names) AND b IN (SELECT name FROM names)""",
)
def top_correlations(spark, sf):
    out = profile.top_correlations(v.spread_table(spark, sf, "lineitem"), "l_extendedprice", MEASURES, 3)
    return out.withColumn("r", F.round("r", 6))


@query(
    "a15_stability",
    """SELECT round(avg(m), 6) AS mean, round(stddev_pop(m), 6) AS std, CASE WHEN stddev_pop(m) < 0.1 THEN 'stable'
      WHEN stddev_pop(m) < 0.2 THEN 'moderate' ELSE 'unstable' END AS stability
    FROM (SELECT avg(o_totalprice) / 500000 AS m FROM orders GROUP BY year(o_orderdate))""",
)
def stability(spark, sf):
    folds = v.table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("y")).agg(
        (F.avg("o_totalprice") / 500000).alias("m")
    )
    out = profile.stability(folds, "m")
    return out.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})
