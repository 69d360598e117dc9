"""Scalar functions: text cleaning, dates, numbers, categories, odds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlytics.catalog import views as v
from eventlytics.catalog.registry import query
from eventlytics.functions import categories, dates, frames, numbers, odds, text

# -- raw contests: the bouts rendered back to text --------------------------

RAW = """raw AS (
  SELECT fight_id, event_id AS event,
    fighter1_name || CASE WHEN fight_id % 2 = 0 THEN ' vs. ' ELSE '  vs ' END || fighter2_name AS bout,
    CASE fight_id % 3 WHEN 0 THEN 'http://x.example/fight-details/f' || fight_id
      WHEN 1 THEN 'http://x.example/fight/f' || fight_id ELSE 'zzz' || fight_id END AS url,
    CASE WHEN winner_name = fighter1_name THEN 'W/L' WHEN winner_name = fighter2_name THEN 'L/W' ELSE 'D/D' END AS outcome,
    CASE WHEN is_title_fight THEN 'UFC ' || weight_class || ' Title Bout' ELSE weight_class || ' Bout' END AS weightclass,
    CASE WHEN fight_id % 7 = 0 THEN 'Overturned' WHEN method_category = 'Decision' THEN 'Decision - Unanimous'
      ELSE method_category END AS method,
    'Round ' || (1 + fight_id % 5) AS round, (fight_id % 5) || ':' || lpad(CAST(fight_id % 60 AS VARCHAR), 2, '0') AS time,
    fighter1_name, fighter2_name
  FROM bouts)"""


def raw_bouts(spark, sf):
    key = F.col("fight_id")
    return v.bouts(spark, sf).select(
        "fight_id", F.col("event_id").alias("event"),
        F.concat("fighter1_name", F.when(key % 2 == 0, " vs. ").otherwise("  vs "), "fighter2_name").alias("bout"),
        F.when(key % 3 == 0, F.concat(F.lit("http://x.example/fight-details/f"), key.cast("string")))
        .when(key % 3 == 1, F.concat(F.lit("http://x.example/fight/f"), key.cast("string")))
        .otherwise(F.concat(F.lit("zzz"), key.cast("string"))).alias("url"),
        F.when(F.col("winner_name") == F.col("fighter1_name"), "W/L")
        .when(F.col("winner_name") == F.col("fighter2_name"), "L/W").otherwise("D/D").alias("outcome"),
        F.when(F.col("is_title_fight"), F.concat(F.lit("UFC "), "weight_class", F.lit(" Title Bout")))
        .otherwise(F.concat("weight_class", F.lit(" Bout"))).alias("weightclass"),
        F.when(key % 7 == 0, "Overturned")
        .when(F.col("method_category") == "Decision", "Decision - Unanimous")
        .otherwise(F.col("method_category")).alias("method"),
        F.concat(F.lit("Round "), (1 + key % 5).cast("string")).alias("round"),
        F.concat((key % 5).cast("string"), F.lit(":"), F.lpad((key % 60).cast("string"), 2, "0")).alias("time"),
    )


RAW_BOUTS = v.with_(v.BOUTS, RAW)


@query(
    "p01_optional_columns",
    RAW_BOUTS + """SELECT fight_id, method, CAST(NULL AS VARCHAR) AS referee, 'Unknown' AS stance,
    CAST(NULL AS INTEGER) AS attendance FROM raw""",
)
def optional_columns(spark, sf):
    df = raw_bouts(spark, sf)
    return df.select(
        "fight_id", frames.optional(df, "method").alias("method"),
        frames.optional(df, "referee").alias("referee"),
        frames.optional(df, "stance", default="Unknown").alias("stance"),
        frames.optional(df, "attendance", "int").alias("attendance"),
    )


@query(
    "p02_multi_format_date",
    """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 4 THEN NULL WHEN 5 THEN NULL
      ELSE CAST(o_orderdate AS DATE) END AS event_date FROM orders""",
)
def multi_format_date(spark, sf):
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    spelt = (
        F.when(key % 6 == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(key % 6 == 1, F.concat(F.lit("held "), F.date_format(day, "yyyy-MM-dd"), F.lit(" (local)")))
        .when(key % 6 == 2, F.date_format(day, "MMMM d, yyyy"))
        .when(key % 6 == 3, F.date_format(day, "MMM d, yyyy"))
        .when(key % 6 == 4, F.date_format(day, "'Foo' d, yyyy"))
        .otherwise("")
    )
    return v.table(spark, sf, "orders").select(
        "o_orderkey", dates.parse_date(spelt).alias("event_date")
    )


@query(
    "p03a_event_type",
    v.with_(v.CARDS) + "SELECT event_id, event_type FROM cards",
)
def event_type(spark, sf):
    return v.cards(spark, sf).select(
        "event_id", categories.event_type(F.col("event_name")).alias("event_type")
    )


@query(
    "p03b_method_category",
    RAW_BOUTS + """SELECT fight_id, CASE WHEN fight_id % 7 = 0 THEN 'Other'
    WHEN method LIKE 'Decision%' THEN 'Decision' ELSE method END AS method_category FROM raw""",
)
def method_category(spark, sf):
    return raw_bouts(spark, sf).select(
        "fight_id", categories.method_category(F.col("method")).alias("method_category")
    )


@query(
    "p03c_base_event_type",
    v.with_(v.CARDS) + r"""SELECT event_id, CASE
    WHEN regexp_matches(lower(event_name), 'ufc\s+(ultimate\s+)?fight\s+night') THEN 'ufc fight night'
    WHEN regexp_matches(lower(event_name), 'the\s+ultimate\s+fighter') THEN 'the ultimate fighter'
    WHEN regexp_matches(lower(event_name), 'ufc\s+on\s+\w+') THEN regexp_extract(lower(event_name), '(ufc\s+on\s+\w+)', 1)
    WHEN regexp_matches(lower(event_name), 'ufc\s+\d+') THEN 'ufc'
    ELSE regexp_replace(lower(event_name), '[^a-z0-9]', '', 'g') END AS base_event_type FROM cards""",
)
def base_event_type(spark, sf):
    return v.cards(spark, sf).select(
        "event_id", categories.base_event_type(F.col("event_name")).alias("base_event_type")
    )


PLACES = v.with_(v.CARDS) + """SELECT event_id, string_split(location, ', ')[1] AS city,
  CASE string_split(location, ', ')[-1] WHEN 'England' THEN 'UK' WHEN 'Berlin' THEN NULL
    ELSE string_split(location, ', ')[-1] END AS country FROM cards"""


@query("p04_place_split", PLACES)
def place_split(spark, sf):
    place = F.col("location")
    return v.cards(spark, sf).select(
        "event_id", categories.city(place).alias("city"), categories.country(place).alias("country")
    )


@query(
    "p05_id_from_url",
    RAW_BOUTS + """SELECT fight_id, CASE fight_id % 3 WHEN 2 THEN 'zzz' || fight_id ELSE 'f' || fight_id END
    AS url_id FROM raw""",
)
def id_from_url(spark, sf):
    return raw_bouts(spark, sf).select("fight_id", text.id_from_url(F.col("url"), "fight").alias("url_id"))


@query(
    "p06_safe_int",
    RAW_BOUTS + """SELECT fight_id, CAST(1 + fight_id % 5 AS INTEGER) AS round,
    TRY_CAST(nullif(regexp_extract(outcome, '(\\d+)', 1), '') AS INTEGER) AS no_digits FROM raw""",
)
def safe_int(spark, sf):
    return raw_bouts(spark, sf).select(
        "fight_id", numbers.leading_int(F.col("round")).alias("round"),
        numbers.leading_int(F.col("outcome")).alias("no_digits"),
    )


def _body_texts(spark, sf):
    key = F.col("c_custkey")
    feet, inches = (4 + key % 3).cast("string"), (key % 12).cast("string")
    height = (
        F.when(key % 5 == 0, "--")
        .when(key % 5 == 1, F.concat(feet, F.lit("'")))
        .otherwise(F.concat(feet, F.lit("' "), inches, F.lit('"')))
    )
    born = F.date_add(F.lit("1960-01-01").cast("date"), (key * 31 % 9000).cast("int"))
    return v.table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_mktsegment",
        height.alias("height"),
        F.when(key % 4 == 0, "--").otherwise(F.concat((60 + key % 20).cast("string"), F.lit('"'))).alias("reach"),
        F.concat((115 + key % 150).cast("string"), F.lit(" lbs.")).alias("weight"),
        F.when(key % 6 == 0, "--").when(key % 6 == 1, "").when(key % 6 == 2, F.date_format(born, "MMM dd, yyyy"))
        .when(key % 6 == 3, F.date_format(born, "MMMM d, yyyy")).otherwise(F.date_format(born, "MMM d, yyyy"))
        .alias("dob"),
        F.when(key % 3 == 0, F.concat_ws("-", (key % 40).cast("string"), (key % 17).cast("string"), (key % 3 + key % 2).cast("string")))
        .when(key % 3 == 1, F.concat_ws("-", (key % 40).cast("string"), (key % 17).cast("string")))
        .otherwise("").alias("record"),
    )


@query(
    "p07_body_measures",
    """SELECT c_custkey, CAST(CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 12 * (4 + c_custkey % 3)
      ELSE 12 * (4 + c_custkey % 3) + c_custkey % 12 END AS INTEGER) AS height_inches,
    CAST(CASE WHEN c_custkey % 4 <> 0 THEN 60 + c_custkey % 20 END AS INTEGER) AS reach_inches,
    CAST(115 + c_custkey % 150 AS INTEGER) AS weight_lbs FROM customer""",
)
def body_measures(spark, sf):
    return _body_texts(spark, sf).select(
        "c_custkey", numbers.height_inches(F.col("height")).alias("height_inches"),
        numbers.leading_int(F.col("reach")).alias("reach_inches"),
        numbers.leading_int(F.col("weight")).alias("weight_lbs"),
    )


@query(
    "p08_birth_date",
    """SELECT c_custkey, CASE WHEN c_custkey % 6 > 1 THEN
      DATE '1960-01-01' + CAST(c_custkey * 31 % 9000 AS INTEGER) END AS dob FROM customer""",
)
def birth_date(spark, sf):
    return _body_texts(spark, sf).select("c_custkey", dates.parse_birth_date(F.col("dob")).alias("dob"))


@query(
    "p09_record_parts",
    """SELECT c_custkey, CAST(CASE WHEN c_custkey % 3 < 2 THEN c_custkey % 40 END AS INTEGER) AS wins,
    CAST(CASE WHEN c_custkey % 3 < 2 THEN c_custkey % 17 END AS INTEGER) AS losses,
    CAST(CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 3 + c_custkey % 2 ELSE 0 END AS INTEGER) AS draws
    FROM customer""",
)
def record_parts(spark, sf):
    record = F.col("record")
    return _body_texts(spark, sf).select(
        "c_custkey", numbers.record_wins(record).alias("wins"),
        numbers.record_losses(record).alias("losses"), numbers.record_draws(record).alias("draws"),
    )


@query(
    "p10_full_name",
    "SELECT c_custkey, concat_ws(' ', c_name, c_mktsegment) AS fighter_name FROM customer",
)
def full_name(spark, sf):
    return v.table(spark, sf, "customer").select(
        "c_custkey", text.full_name(F.col("c_name"), F.col("c_mktsegment")).alias("fighter_name")
    )


@query("p11_split_sides", RAW_BOUTS + "SELECT fight_id, fighter1_name, fighter2_name FROM raw")
def split_sides(spark, sf):
    bout = F.col("bout")
    return raw_bouts(spark, sf).select(
        "fight_id", text.side_one(bout).alias("fighter1_name"), text.side_two(bout).alias("fighter2_name")
    )


@query("p12_winner", v.with_(v.BOUTS) + "SELECT fight_id, winner_name FROM bouts")
def winner(spark, sf):
    bout = F.col("bout")
    won = categories.winner(F.col("outcome"), text.side_one(bout), text.side_two(bout))
    return raw_bouts(spark, sf).select("fight_id", won.alias("winner_name"))


@query(
    "p13_landed_of_attempted",
    """SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_linenumber % 4 <> 0 THEN CAST(l_quantity AS INTEGER) END
      AS landed, CASE WHEN l_linenumber % 4 <> 0 THEN CAST(l_quantity AS INTEGER) + l_linenumber END AS attempted
    FROM lineitem""",
)
def landed_of_attempted(spark, sf):
    landed, line = F.col("l_quantity").cast("int"), F.col("l_linenumber")
    cell = F.when(line % 4 == 0, "---").otherwise(
        F.concat_ws(" of ", landed.cast("string"), (landed + line).cast("string"))
    )
    df = v.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", cell.alias("sig.str."))
    found = F.col(f"`{frames.find_column(df, 'sig', 'str')}`")
    return df.select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        numbers.landed(found).alias("landed"), numbers.attempted(found).alias("attempted"),
    )


@query(
    "p14_guarded_cast",
    """SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_linenumber % 3 <> 0 THEN CAST(l_quantity AS INTEGER) END
      AS knockdowns, CASE WHEN l_linenumber % 5 <> 0 THEN l_discount END AS rate FROM lineitem""",
)
def guarded_cast(spark, sf):
    line = F.col("l_linenumber")
    kd = F.when(line % 3 == 0, "").otherwise(F.col("l_quantity").cast("string"))
    rate = F.when(line % 5 == 0, "n/a").otherwise(F.col("l_discount").cast("string"))
    return v.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        numbers.number(kd).alias("knockdowns"), numbers.number(rate, "double").alias("rate"),
    )


@query("p15_composite_key", RAW_BOUTS + "SELECT fight_id, event || '_' || bout AS fight_key FROM raw")
def composite_key(spark, sf):
    return raw_bouts(spark, sf).select(
        "fight_id", text.composite_key(F.col("event"), F.col("bout")).alias("fight_key")
    )


@query(
    "p16_normalize_name",
    """SELECT conv_id, turn, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') AS name_key FROM conversations""",
)
def normalize_name(spark, sf):
    return v.table(spark, sf, "conversations").select(
        "conv_id", "turn", text.normalize_name(F.col("text")).alias("name_key")
    )


@query(
    "p17_title_flag_and_class",
    v.with_(v.BOUTS) + "SELECT fight_id, is_title_fight, weight_class FROM bouts",
)
def title_flag_and_class(spark, sf):
    cls = F.col("weightclass")
    return raw_bouts(spark, sf).select(
        "fight_id", categories.is_title(cls).alias("is_title_fight"),
        categories.bare_class(cls).alias("weight_class"),
    )


@query(
    "p18_calendar_parts",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
    CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week, CAST(dayofweek(o_orderdate) = 6 AS INTEGER)
      AS is_saturday FROM orders""",
)
def calendar_parts(spark, sf):
    day = F.col("o_orderdate")
    return v.table(spark, sf, "orders").select(
        "o_orderkey", F.year(day).alias("year"), F.month(day).alias("month"),
        dates.day_of_week(day).alias("day_of_week"), dates.is_saturday(day).alias("is_saturday"),
    )


@query(
    "p19_place_flags",
    v.with_(v.CARDS) + """SELECT event_id, CAST(location LIKE 'Las Vegas%' AS INTEGER) AS is_vegas,
    CASE WHEN location <> 'Berlin' THEN CAST(location LIKE '%USA' AS INTEGER) END AS is_usa,
    CAST(event_type = 'PPV' AS INTEGER) AS is_ppv FROM cards""",
)
def place_flags(spark, sf):
    place = F.col("location")
    return v.cards(spark, sf).select(
        "event_id", categories.is_vegas(categories.city(place)).alias("is_vegas"),
        categories.is_usa(categories.country(place)).alias("is_usa"),
        categories.is_ppv(F.col("event_type")).alias("is_ppv"),
    )


@query(
    "p21_number_from_text",
    """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN NULL ELSE CAST(floor(o_totalprice) AS BIGINT) END AS loose,
    CASE WHEN o_orderkey % 4 <> 3 AND floor(o_totalprice) >= 100 THEN CAST(floor(o_totalprice) AS BIGINT) END AS strict
    FROM orders""",
)
def number_from_text(spark, sf):
    key, grouped = F.col("o_orderkey"), F.format_number(F.floor("o_totalprice"), 0)
    noisy = (
        F.when(key % 4 == 0, F.concat(F.lit("~"), grouped, F.lit("[3]")))
        .when(key % 4 == 1, F.concat(grouped, F.lit("+ (sold out)")))
        .when(key % 4 == 2, F.concat(F.lit("[1]* "), grouped))
        .otherwise("unknown[2]")
    )
    return v.table(spark, sf, "orders").select(
        "o_orderkey", numbers.parse_count(noisy).alias("loose"),
        numbers.parse_count(noisy, strict=True).alias("strict"),
    )


@query(
    "p22_money_from_text",
    """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN NULL
      WHEN 1 THEN round((o_orderkey % 90 + 10) / 10.0, 1) * 1e6 ELSE o_totalprice END AS amount FROM orders""",
)
def money_from_text(spark, sf):
    key, grouped = F.col("o_orderkey"), F.format_number("o_totalprice", 2)
    millions = F.format_number((key % 90 + 10) / 10, 1)
    noisy = (
        F.when(key % 4 == 0, F.concat(F.lit("$"), grouped))
        .when(key % 4 == 1, F.concat(F.lit("US$"), millions, F.lit(" Million")))
        .when(key % 4 == 2, F.concat(F.lit("€"), grouped, F.lit(" (est.)")))
        .otherwise("undisclosed")
    )
    return v.table(spark, sf, "orders").select("o_orderkey", numbers.parse_money(noisy).alias("amount"))


@query(
    "p23_guarded_ratio",
    """SELECT l_orderkey, l_linenumber, l_suppkey, round(CASE WHEN l_linenumber - 2 > 0
      THEN l_quantity / (l_linenumber - 2) END, 6) AS sell_through FROM lineitem""",
)
def guarded_ratio(spark, sf):
    ratio = numbers.guarded_ratio(F.col("l_quantity"), F.col("l_linenumber") - 2)
    return v.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.round(ratio, 6).alias("sell_through")
    )


PROBABILITY = """CASE WHEN {o} = 0 THEN 0.5 WHEN {o} > 0 THEN 100 / ({o} + 100)
  ELSE abs({o}) / (abs({o}) + 100) END"""
P1, P2 = PROBABILITY.format(o="fighter1_odds"), PROBABILITY.format(o="fighter2_odds")


@query(
    "p24_odds_conversions",
    v.with_(v.SIDES, v.ODDS) + f"""SELECT fight_id, round({P1}, 6) AS probability,
    round(CASE WHEN fighter1_odds > 0 THEN fighter1_odds / 100 + 1 WHEN fighter1_odds < 0
      THEN 100 / abs(fighter1_odds) + 1 END, 6) AS decimal_odds,
    round(CASE WHEN fighter2_odds > 0 THEN 1 / (fighter2_odds / 100 + 1)
      ELSE 1 / (100 / abs(fighter2_odds) + 1) END, 6) AS from_decimal FROM odds""",
)
def odds_conversions(spark, sf):
    one, two = F.col("fighter1_odds"), F.col("fighter2_odds")
    return v.odds(spark, sf).select(
        "fight_id", F.round(odds.implied_probability(one), 6).alias("probability"),
        F.round(odds.american_to_decimal(one), 6).alias("decimal_odds"),
        F.round(odds.decimal_to_probability(odds.american_to_decimal(two)), 6).alias("from_decimal"),
    )


@query(
    "p25_odds_features",
    v.with_(v.SIDES, v.ODDS, f"probs AS (SELECT *, {P1} AS p1, {P2} AS p2 FROM odds)")
    + """SELECT fight_id, round(p1, 6) AS fighter1_implied_prob, round(p2, 6) AS fighter2_implied_prob,
    CAST(p1 > p2 AS INTEGER) AS f1_is_favorite, round(abs(p1 - p2), 6) AS odds_spread,
    CAST(abs(p1 - p2) < 0.10 AS INTEGER) AS is_competitive_matchup,
    CAST(p1 > 0.70 OR p2 > 0.70 AS INTEGER) AS has_heavy_favorite,
    CAST(fighter1_odds - opening_odds_f1 AS INTEGER) AS line_movement_f1,
    CAST(fighter2_odds - opening_odds_f2 AS INTEGER) AS line_movement_f2,
    CAST(abs(fighter1_odds - opening_odds_f1) > 50 AS INTEGER) AS big_line_movement FROM probs""",
)
def odds_features(spark, sf):
    out = odds.odds_features(odds.line_movement(v.odds(spark, sf)))
    return out.select(
        "fight_id",
        *[F.round(c, 6).alias(c) for c in ("fighter1_implied_prob", "fighter2_implied_prob", "odds_spread")],
        "f1_is_favorite", "is_competitive_matchup", "has_heavy_favorite",
        "line_movement_f1", "line_movement_f2", "big_line_movement",
    )


@query(
    "p27_strip_label",
    """SELECT o_orderkey, o_orderpriority AS class, CAST(o_orderkey AS VARCHAR) || ': x' AS details,
      o_orderstatus || '/' || o_orderpriority AS outcome FROM orders""",
)
def strip_label(spark, sf):
    key = F.col("o_orderkey").cast("string")
    df = v.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority",
        F.concat(F.lit("\n  Class: "), F.col("o_orderpriority"), F.lit("\n")).alias("a"),
        F.concat(F.lit("Details:"), key, F.lit(": x")).alias("b"),
    )
    return df.select(
        "o_orderkey", text.strip_label(text.collapse_space(F.col("a"))).alias("class"),
        text.strip_label(F.col("b")).alias("details"),
        text.join_sides(F.col("o_orderstatus"), F.col("o_orderpriority"), "/").alias("outcome"),
    )


@query(
    "p28_name_to_url",
    v.with_(v.CARDS) + """SELECT event_id, 'https://en.wikipedia.org/wiki/' ||
      replace(replace(event_name, ' ', '_'), ':', '%3A') AS url FROM cards""",
)
def name_to_url(spark, sf):
    return v.cards(spark, sf).select(
        "event_id", text.name_to_url(F.concat(F.lit(" "), "event_name", F.lit(" "))).alias("url")
    )


@query(
    "p29_interactions",
    """SELECT o_orderkey, round(o_totalprice * (o_orderkey % 7), 6) AS price_by_key,
      (o_orderkey % 7) * (o_custkey % 5) AS key_by_customer FROM orders""",
)
def interactions(spark, sf):
    df = v.table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", (F.col("o_orderkey") % 7).alias("k"), (F.col("o_custkey") % 5).alias("c")
    )
    out, made = frames.interactions(
        df, {"price_by_key": ("o_totalprice", "k"), "key_by_customer": ("k", "c"), "absent": ("k", "nothing")}
    )
    return out.select("o_orderkey", *made).withColumn("price_by_key", F.round("price_by_key", 6))


@query(
    "p30_null_defaults",
    """SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END, 0.1) AS betting_spread,
    coalesce(CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_custkey % 2 AS INTEGER) END, 1) AS is_competitive,
    CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS status FROM orders""",
)
def null_defaults(spark, sf):
    key = F.col("o_orderkey")
    df = v.table(spark, sf, "orders").select(
        "o_orderkey", F.when(key % 3 != 0, F.col("o_totalprice")).alias("betting_spread"),
        F.when(key % 4 != 0, (F.col("o_custkey") % 2).cast("int")).alias("is_competitive"),
        F.when(key % 5 != 0, F.col("o_orderstatus")).alias("status"),
    )
    return frames.fill(df, {"betting_spread": 0.1, "is_competitive": 1, "has_heavy_favorite": 0})


@query(
    "p31_event_number",
    v.with_(v.CARDS) + r"SELECT event_id, regexp_extract(event_name, 'UFC\s*(\d+)', 1) AS number FROM cards",
)
def event_number(spark, sf):
    return v.cards(spark, sf).select("event_id", text.contest_number(F.col("event_name")).alias("number"))


@query(
    "p33_buckets",
    """SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_discount * 20 - 1 <= -1 THEN NULL
      WHEN l_discount * 20 - 1 <= -0.2 THEN 'Negative' WHEN l_discount * 20 - 1 <= 0.2 THEN 'Neutral'
      WHEN l_discount * 20 - 1 <= 1 THEN 'Positive' END AS category FROM lineitem""",
)
def buckets(spark, sf):
    return v.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        categories.sentiment_category(F.col("l_discount") * 20 - 1).alias("category"),
    )


@query(
    "p36_residuals",
    "SELECT o_orderkey, o_totalprice / 500000 - (o_orderkey % 100) / 100 AS residual FROM orders",
)
def residuals(spark, sf):
    from eventlytics.operators.profile import residuals as add

    df = v.table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_totalprice") / 500000).alias("sell_through"),
        (F.col("o_orderkey") % 100 / 100).alias("prediction"),
    )
    return add(df).select("o_orderkey", "residual")


@query(
    "p37_feature_list",
    """SELECT feature, present FROM (VALUES ('o_totalprice', TRUE), ('o_custkey', TRUE), ('num_fights', FALSE))
      AS t(feature, present) WHERE (SELECT count(*) FROM orders) > 0""",
)
def feature_list(spark, sf):
    df = v.table(spark, sf, "orders")
    present, missing = frames.pick_features(df, ["o_totalprice", "num_fights", "o_custkey"])
    flags = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.lit(c in present).alias("present")) for c in present + missing]
    )
    return df.agg(F.count("*").alias("n")).filter("n > 0").select(F.explode(flags).alias("f")).select("f.*")


_WANTED = ("o_totalprice", "c_acctbal", "num_fights", "s_acctbal", "o_custkey")
_HELD = {"orders": ("o_totalprice", "o_custkey"), "customer": ("c_acctbal",), "supplier": ("s_acctbal",)}


@query(
    "p37_feature_list_by_source",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "source", '{c}' AS feature, TRUE AS present, count({c}) AS known,
        CAST(min({c}) AS DOUBLE) AS lowest, CAST(max({c}) AS DOUBLE) AS highest FROM {t}""" if c in held else
        f"""SELECT '{t}' AS "source", '{c}' AS feature, FALSE AS present, CAST(0 AS BIGINT) AS known,
        CAST(NULL AS DOUBLE) AS lowest, CAST(NULL AS DOUBLE) AS highest"""
        for t, held in _HELD.items() for c in _WANTED
    ),
)
def feature_list_by_source(spark, sf):
    """One wish list over sources that hold different columns: what each has of it, and its values."""
    out = []
    for source in _HELD:
        df = v.table(spark, sf, source)
        present, missing = frames.pick_features(df, _WANTED)
        wide = df.select(*present).agg(
            *[f(c).alias(f"{c}_{i}") for c in present for i, f in enumerate((F.count, F.min, F.max))]
        )
        rows = [
            F.struct(
                F.lit(c).alias("feature"), F.lit(True).alias("present"), F.col(f"{c}_0").alias("known"),
                F.col(f"{c}_1").cast("double").alias("lowest"), F.col(f"{c}_2").cast("double").alias("highest"),
            )
            for c in present
        ] + [
            F.struct(
                F.lit(c).alias("feature"), F.lit(False).alias("present"), F.lit(0).cast("long").alias("known"),
                F.lit(None).cast("double").alias("lowest"), F.lit(None).cast("double").alias("highest"),
            )
            for c in missing
        ]
        out.append(wide.select(F.lit(source).alias("source"), F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, out)


@query(
    "p38_two_sided_combination",
    v.with_(v.BOUTS, v.FIGHTERS) + """SELECT fight_id,
      coalesce(a.reach_inches, 0) + coalesce(b.reach_inches, 0) AS total_reach,
      abs(coalesce(a.reach_inches, 0) - coalesce(b.reach_inches, 0)) AS reach_gap,
      CAST(a.reach_inches = b.reach_inches AS INTEGER) AS same_reach
    FROM bouts LEFT JOIN fighters a ON a.fighter_name = fighter1_name
    LEFT JOIN fighters b ON b.fighter_name = fighter2_name""",
)
def two_sided_combination(spark, sf):
    from eventlytics.operators.matchups import role_join

    df = role_join(
        v.bouts(spark, sf), v.fighters(spark, sf), "fighter_name",
        {"fighter1_name": "_1", "fighter2_name": "_2"}, ["reach_inches"],
    )
    out = frames.two_sided(df, "reach_inches_1", "reach_inches_2", "total_reach", "reach_gap", missing=0)
    same = frames.same_side("reach_inches_1", "reach_inches_2").alias("same_reach")
    return out.select("fight_id", "total_reach", "reach_gap", same)


@query(
    "p39_truncate_and_epoch",
    """SELECT doc_id, substring(text, 1, 500) AS text, strftime(make_timestamp(CAST(doc_id * 86461 * 1000000 AS BIGINT)),
      '%Y-%m-%d %H:%M:%S') AS created_utc FROM documents""",
)
def truncate_and_epoch(spark, sf):
    made = dates.epoch_to_timestamp(F.col("doc_id") * 86461)
    return v.table(spark, sf, "documents").select(
        "doc_id", text.truncate(F.col("text")).alias("text"),
        F.date_format(made, "yyyy-MM-dd HH:mm:ss").alias("created_utc"),
    )


@query(
    "r1_split_element",
    v.with_(v.CARDS) + """SELECT event_id, string_split(location, ', ')[2] AS second,
      len(string_split(location, ', ')) AS parts FROM cards""",
)
def split_element(spark, sf):
    parts = F.split("location", ", ")
    return v.cards(spark, sf).select(
        "event_id", F.try_element_at(parts, F.lit(2)).alias("second"), F.size(parts).cast("bigint").alias("parts")
    )


@query(
    "r2_near_days",
    v.with_(v.CARDS) + """SELECT event_id, CAST(event_date + k AS DATE) AS match_date FROM cards,
      (VALUES (-1), (0), (1)) AS t(k)""",
)
def near_days(spark, sf):
    from eventlytics.operators.linkage import on_near_days

    return on_near_days(v.cards(spark, sf)).select("event_id", "match_date")


@query(
    "r5_largest_number",
    """SELECT o_orderkey, CAST(greatest(floor(o_totalprice), o_custkey) AS BIGINT) AS capacity FROM orders""",
)
def largest_number(spark, sf):
    cell = F.concat(
        F.lit("Boxing: "), F.format_number(F.floor("o_totalprice"), 0), F.lit(" / hockey "),
        F.col("o_custkey").cast("string"), F.lit(", ,"),
    )
    return v.table(spark, sf, "orders").select("o_orderkey", numbers.largest_number(cell).alias("capacity"))
