"""Lexicon sentiment over whole texts and its roll-up."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlytics.catalog import views as v
from eventlytics.catalog.registry import query
from eventlytics.functions import sentiment
from eventlytics.operators import rollup

# words frequent in the given documents, next to the fixed lists
LIKED = sentiment.POSITIVE + ("the", "que", "und")
DISLIKED = sentiment.NEGATIVE + ("not", "pas", "nicht")


def _hits(column: str, phrases) -> str:
    quoted = [p.replace("'", "''") for p in phrases]
    return " + ".join(f"CAST(contains(lower({column}), '{p}') AS INTEGER)" for p in quoted)


def _scored(source: str, column: str, keep: str) -> str:
    return f"""hits AS (
  SELECT {keep}, {column} AS body, {_hits(column, LIKED)} AS p, {_hits(column, DISLIKED)} AS n,
    greatest(len(list_filter(regexp_split_to_array({column}, '[\\s\\v\\x{{85}}\\p{{Z}}]+'), lambda w: w <> '')), 1) AS words
  FROM {source}),
scored AS (
  SELECT *, CASE WHEN body IS NULL OR body = '' OR p + n = 0 THEN 0.0 ELSE (p - n) / (p + n) END AS polarity,
    CASE WHEN body IS NULL OR body = '' THEN 0.5 ELSE least(1.0, (p + n) / (words / 10)) END AS subjectivity
  FROM hits)"""


DOCUMENTS = v.with_(_scored("documents", "text", "doc_id, lang, source, n_chars"))
TURNS = v.with_(_scored("conversations", "text", "conv_id, turn, role"))


def scored(df, column="text"):
    return sentiment.score_texts(df, column, LIKED, DISLIKED)


@query(
    "p26_lexicon_sentiment",
    DOCUMENTS + "SELECT doc_id, round(polarity, 6) AS polarity, round(subjectivity, 6) AS subjectivity FROM scored",
)
def lexicon_sentiment(spark, sf):
    out = scored(v.spread_table(spark, sf, "documents"))
    return out.select("doc_id", F.round("polarity", 6).alias("polarity"), F.round("subjectivity", 6).alias("subjectivity"))


@query(
    "p26_lexicon_sentiment_turns",
    TURNS + """SELECT conv_id, turn, round(polarity, 6) AS polarity, round(subjectivity, 6) AS subjectivity FROM scored""",
)
def lexicon_sentiment_turns(spark, sf):
    out = scored(v.spread_table(spark, sf, "conversations"))
    return out.select(
        "conv_id", "turn", F.round("polarity", 6).alias("polarity"), F.round("subjectivity", 6).alias("subjectivity")
    )


LETTERS = "abcdefghijklmnopqrstuvwxyz"


@query(
    "p26_many_phrases",
    """SELECT doc_id, CAST(len(list_distinct(list_filter(list_transform(range(1, length(text)),
      lambda i: substr(lower(text), i, 2)), lambda s: regexp_full_match(s, '[a-z]{2}')))) AS INTEGER) AS found FROM documents""",
)
def many_phrases(spark, sf):
    """How many of all 676 pairs of letters a text holds, by one pattern."""
    pairs = [a + b for a in LETTERS for b in LETTERS]
    docs = v.spread_table(spark, sf, "documents")
    return docs.select("doc_id", sentiment.phrase_hits(F.lower("text"), pairs).alias("found"))


ROLLUP = """rolled AS (
  SELECT source AS event_name, avg(polarity) AS avg_sentiment, stddev_samp(polarity) AS sentiment_std,
    min(polarity) AS min_sentiment, max(polarity) AS max_sentiment, avg(subjectivity) AS avg_subjectivity,
    CAST(sum(n_chars) AS BIGINT) AS total_engagement, avg(n_chars) AS avg_comment_score,
    max(n_chars) AS top_comment_score, count(body) AS comment_count FROM scored GROUP BY source)"""
ROUNDED = (
    "avg_sentiment", "sentiment_std", "min_sentiment", "max_sentiment", "avg_subjectivity", "avg_comment_score",
)


def comments(spark, sf):
    df = v.spread_table(spark, sf, "documents").select(
        F.col("source").alias("event_name"), F.col("n_chars").alias("score"), F.col("text").alias("comment_text")
    )
    return scored(df, "comment_text")


@query(
    "a6_sentiment_rollup",
    DOCUMENTS.rstrip() + ",\n" + ROLLUP + " SELECT event_name, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in ROUNDED)
    + """, total_engagement, top_comment_score, comment_count,
    round(max_sentiment - min_sentiment, 6) AS sentiment_range,
    round((avg_sentiment + 1) / 2 * ln(1 + total_engagement) / 10, 6) AS hype_score,
    CASE WHEN avg_sentiment <= -1 THEN NULL WHEN avg_sentiment <= -0.2 THEN 'Negative'
      WHEN avg_sentiment <= 0.2 THEN 'Neutral' ELSE 'Positive' END AS sentiment_category FROM rolled""",
)
def sentiment_rollup(spark, sf):
    out = rollup.sentiment_rollup(comments(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in (*ROUNDED, "sentiment_range", "hype_score")})


@query(
    "p34_hype_and_range",
    """SELECT o_orderkey, round((o_orderkey % 200 / 100 - 1 + 1) / 2 * ln(1 + o_totalprice) / 10, 6) AS hype_score,
      round(o_totalprice - o_custkey, 6) AS sentiment_range FROM orders""",
)
def hype_and_range(spark, sf):
    df = v.table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_orderkey") % 200 / 100 - 1).alias("avg_sentiment"),
        F.col("o_totalprice").alias("total_engagement"), F.col("o_totalprice").alias("max_sentiment"),
        F.col("o_custkey").alias("min_sentiment"),
    )
    return rollup.derive_sentiment(df).select(
        "o_orderkey", F.round("hype_score", 6).alias("hype_score"),
        F.round("sentiment_range", 6).alias("sentiment_range"),
    )
