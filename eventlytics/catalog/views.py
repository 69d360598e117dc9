"""The given tables seen as contests, entities, events, series and texts.

Each view exists as a DataFrame and as a SQL common table expression of the
same name and columns, so that queries and their SQL start from equal rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlytics.operators.scale import spread
from eventlytics.sources.files import read_parquet


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf}/{name}.parquet")


def spread_table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table for heavy per-row work: a file of few splits is spread out."""
    return spread(table(spark, sf, name))


def supplier_name(key: str | Column) -> Column:
    return F.concat(F.lit("Supplier#"), F.lpad(F.col(key).cast("string") if isinstance(key, str) else key, 9, "0"))


# -- contests ---------------------------------------------------------------

SIDES = """sides AS (
  SELECT l_orderkey, min(l_suppkey) AS low, max(l_suppkey) AS high
  FROM lineitem GROUP BY l_orderkey HAVING min(l_suppkey) < max(l_suppkey))"""

BOUTS = SIDES + """, bouts AS (
  SELECT o_orderkey AS fight_id, strftime(o_orderdate, '%Y-%m-%d') AS event_id,
    CAST(o_orderdate AS DATE) AS event_date,
    printf('Supplier#%09d', CASE WHEN o_orderkey % 2 = 0 THEN low ELSE high END) AS fighter1_name,
    printf('Supplier#%09d', CASE WHEN o_orderkey % 2 = 0 THEN high ELSE low END) AS fighter2_name,
    CASE o_orderstatus WHEN 'F' THEN printf('Supplier#%09d', CASE WHEN o_orderkey % 2 = 0 THEN low ELSE high END)
      WHEN 'O' THEN printf('Supplier#%09d', CASE WHEN o_orderkey % 2 = 0 THEN high ELSE low END) END AS winner_name,
    ['KO/TKO', 'Submission', 'Decision'][1 + o_orderkey % 3] AS method_category,
    o_totalprice > 400000 AS is_title_fight, o_orderpriority AS weight_class
  FROM sides JOIN orders ON l_orderkey = o_orderkey)"""


def sides(spark: SparkSession, sf: str) -> DataFrame:
    """Two different suppliers of an order; combined before the shuffle."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("low"), F.max("l_suppkey").alias("high")
    )
    return lines.filter("low < high")


def bouts(spark: SparkSession, sf: str) -> DataFrame:
    """Contests: one per order with two suppliers."""
    orders = table(spark, sf, "orders")
    even = F.col("o_orderkey") % 2 == 0
    one = supplier_name(F.when(even, F.col("low")).otherwise(F.col("high")).cast("string"))
    two = supplier_name(F.when(even, F.col("high")).otherwise(F.col("low")).cast("string"))
    date = F.to_date("o_orderdate")
    status = F.col("o_orderstatus")
    third = F.col("o_orderkey") % 3
    return sides(spark, sf).join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("fight_id"),
        date.cast("string").alias("event_id"),
        date.alias("event_date"),
        one.alias("fighter1_name"),
        two.alias("fighter2_name"),
        F.when(status == "F", one).when(status == "O", two).alias("winner_name"),
        F.when(third == 0, "KO/TKO").when(third == 1, "Submission").otherwise("Decision")
        .alias("method_category"),
        (F.col("o_totalprice") > 400000).alias("is_title_fight"),
        F.col("o_orderpriority").alias("weight_class"),
    )


STATS = """stats AS (
  SELECT l_orderkey AS fight_id, printf('Supplier#%09d', l_suppkey) AS fighter_name,
    CAST(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END AS INTEGER) AS sig_strikes_landed,
    CAST(l_quantity AS INTEGER) AS sig_strikes_attempted,
    CASE WHEN l_linestatus = 'O' THEN l_linenumber ELSE 0 END AS takedowns_landed,
    CASE WHEN l_linestatus = 'O' OR l_linenumber > 3 THEN l_linenumber ELSE 0 END AS takedowns_attempted
  FROM lineitem)"""


def stats(spark: SparkSession, sf: str) -> DataFrame:
    """Round rows: one per line of an order."""
    shipped = F.col("l_linestatus") == "O"
    line = F.col("l_linenumber")
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("fight_id"),
        supplier_name("l_suppkey").alias("fighter_name"),
        F.when(F.col("l_returnflag") == "N", F.col("l_quantity")).otherwise(0).cast("int")
        .alias("sig_strikes_landed"),
        F.col("l_quantity").cast("int").alias("sig_strikes_attempted"),
        F.when(shipped, line).otherwise(0).alias("takedowns_landed"),
        F.when(shipped | (line > 3), line).otherwise(0).alias("takedowns_attempted"),
    )


FIGHTERS = """fighters AS (
  SELECT s_suppkey AS fighter_id, s_name AS fighter_name,
    CAST(60 + s_suppkey % 20 AS INTEGER) AS height_inches,
    CASE WHEN s_suppkey % 11 <> 0 THEN CAST(62 + (s_suppkey * 7) % 25 AS INTEGER) END AS reach_inches,
    DATE '1960-01-01' + CAST((s_suppkey * 37) % 9000 AS INTEGER) AS dob
  FROM supplier)"""


def fighters(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        key.alias("fighter_id"),
        F.col("s_name").alias("fighter_name"),
        (60 + key % 20).cast("int").alias("height_inches"),
        F.when(key % 11 != 0, (62 + (key * 7) % 25).cast("int")).alias("reach_inches"),
        F.date_add(F.lit("1960-01-01").cast("date"), ((key * 37) % 9000).cast("int")).alias("dob"),
    )


# -- events -----------------------------------------------------------------

CARDS = """days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS event_date FROM orders),
numbered AS (SELECT event_date, dayofweek(event_date) AS dow,
    CAST(date_diff('day', DATE '1990-01-01', event_date) AS BIGINT) AS n FROM days),
cards AS (
  SELECT strftime(event_date, '%Y-%m-%d') AS event_id,
    CASE dow WHEN 6 THEN 'UFC ' || n || ': Main Card' WHEN 5 THEN 'UFC Fight Night: Card ' || n
      WHEN 4 THEN 'UFC on FOX ' || n WHEN 3 THEN 'The Ultimate Fighter ' || n || ' (TUF)'
      WHEN 2 THEN 'Contender Series ' || n ELSE 'Noche! ' || n END AS event_name,
    event_date,
    CASE dow WHEN 6 THEN 'PPV' WHEN 5 THEN 'Fight Night' WHEN 3 THEN 'TUF'
      WHEN 2 THEN 'DWCS' ELSE 'Other' END AS event_type,
    CASE n % 4 WHEN 0 THEN 'Las Vegas, Nevada, USA' WHEN 1 THEN 'London, England'
      WHEN 2 THEN 'Toronto, Ontario, Canada' ELSE 'Berlin' END AS location
  FROM numbered)"""


def cards(spark: SparkSession, sf: str) -> DataFrame:
    """Events: one per order date, named and placed by the calendar."""
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("event_date")).distinct()
    dow = F.dayofweek("event_date")
    n = F.datediff("event_date", F.lit("1990-01-01").cast("date")).cast("bigint")
    text = n.cast("string")
    name = (
        F.when(dow == 7, F.concat(F.lit("UFC "), text, F.lit(": Main Card")))
        .when(dow == 6, F.concat(F.lit("UFC Fight Night: Card "), text))
        .when(dow == 5, F.concat(F.lit("UFC on FOX "), text))
        .when(dow == 4, F.concat(F.lit("The Ultimate Fighter "), text, F.lit(" (TUF)")))
        .when(dow == 3, F.concat(F.lit("Contender Series "), text))
        .otherwise(F.concat(F.lit("Noche! "), text))
    )
    kind = (
        F.when(dow == 7, "PPV").when(dow == 6, "Fight Night").when(dow == 4, "TUF")
        .when(dow == 3, "DWCS").otherwise("Other")
    )
    place = (
        F.when(n % 4 == 0, "Las Vegas, Nevada, USA").when(n % 4 == 1, "London, England")
        .when(n % 4 == 2, "Toronto, Ontario, Canada").otherwise("Berlin")
    )
    return days.select(
        F.col("event_date").cast("string").alias("event_id"), name.alias("event_name"),
        "event_date", kind.alias("event_type"), place.alias("location"),
    )


LABELS = """feed AS (
  SELECT CASE WHEN n % 7 < 3 THEN upper(event_name) || ' - Live' WHEN n % 7 = 3 THEN NULL
      WHEN n % 7 < 6 THEN upper(event_name) ELSE event_name || '!' END AS event_name,
    event_date + CAST(n % 5 - 2 AS INTEGER) AS event_date,
    CASE WHEN n % 13 <> 0 THEN round((n % 97) / 100.0, 2) END AS sell_through
  FROM (SELECT c.*, CAST(date_diff('day', DATE '1990-01-01', event_date) AS BIGINT) AS n FROM cards c)
  WHERE n % 3 <> 1)"""


def labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of two thirds of the events, with shifted dates and noisy names."""
    n = F.datediff("event_date", F.lit("1990-01-01").cast("date")).cast("bigint")
    name = F.col("event_name")
    cased = F.when(n % 7 == 6, name).otherwise(F.upper(name))
    ending = F.when(n % 7 < 3, " - Live").when(n % 7 == 3, None).when(n % 7 < 6, "").otherwise("!")
    noisy = F.concat(cased, ending)
    return cards(spark, sf).filter(n % 3 != 1).select(
        noisy.alias("event_name"),
        F.date_add("event_date", (n % 5 - 2).cast("int")).alias("event_date"),
        F.when(n % 13 != 0, F.round((n % 97) / 100, 2)).alias("sell_through"),
    )


# -- series and odds --------------------------------------------------------

SERIES = """series AS (
  SELECT user_id AS entity, CAST(ts AS DATE) AS day, sum(value) AS total_,
    count(*) AS points_, max(value) AS peak_ FROM events WHERE value IS NOT NULL GROUP BY ALL)"""

ODDS = """odds AS (
  SELECT o_orderkey AS fight_id, printf('Supplier#%09d', low) AS fighter1_name,
    printf('Supplier#%09d', high) AS fighter2_name,
    CAST(CASE o_orderkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 100 + o_orderkey % 300 WHEN 2 THEN 100 + o_orderkey % 90
      ELSE -(100 + o_orderkey % 400) END AS INTEGER) AS fighter1_odds,
    CAST(CASE WHEN o_orderkey % 2 = 0 THEN 110 + o_orderkey % 250 ELSE -(101 + o_orderkey % 150) END AS INTEGER)
      AS fighter2_odds,
    CAST(CASE o_orderkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 100 + o_orderkey % 300 WHEN 2 THEN 100 + o_orderkey % 90
      ELSE -(100 + o_orderkey % 400) END - (o_orderkey % 161 - 80) AS INTEGER) AS opening_odds_f1,
    CAST(CASE WHEN o_orderkey % 2 = 0 THEN 110 + o_orderkey % 250 ELSE -(101 + o_orderkey % 150) END + o_orderkey % 61
      AS INTEGER) AS opening_odds_f2
  FROM sides JOIN orders ON l_orderkey = o_orderkey)"""


def odds(spark: SparkSession, sf: str) -> DataFrame:
    """American lines of both sides of every contest, made from the order key."""
    key = F.col("o_orderkey")
    one = (
        F.when(key % 5 == 0, 0).when(key % 5 == 1, 100 + key % 300)
        .when(key % 5 == 2, 100 + key % 90).otherwise(-(100 + key % 400))
    )
    two = F.when(key % 2 == 0, 110 + key % 250).otherwise(-(101 + key % 150))
    orders = table(spark, sf, "orders").select("o_orderkey")
    return sides(spark, sf).join(orders, F.col("l_orderkey") == key).select(
        key.alias("fight_id"),
        supplier_name("low").alias("fighter1_name"),
        supplier_name("high").alias("fighter2_name"),
        one.cast("int").alias("fighter1_odds"),
        two.cast("int").alias("fighter2_odds"),
        (one - (key % 161 - 80)).cast("int").alias("opening_odds_f1"),
        (two + key % 61).cast("int").alias("opening_odds_f2"),
    )


# -- graph ------------------------------------------------------------------

EDGES = """edges AS (
  SELECT src, dst, count(*) AS fight_count FROM (
    SELECT min(l_partkey) AS src, max(l_partkey) AS dst FROM lineitem
    GROUP BY l_orderkey HAVING min(l_partkey) < max(l_partkey)) GROUP BY ALL),
vertices AS (SELECT src AS id FROM edges UNION SELECT dst FROM edges)"""


def part_graph(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Parts that appear as the outer two of an order (vertices, edges)."""
    ends = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_partkey").alias("src"), F.max("l_partkey").alias("dst")
    ).filter("src < dst")
    edges = ends.groupBy("src", "dst").agg(F.count("*").alias("fight_count"))
    vertices = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    return vertices, edges


def with_(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"
