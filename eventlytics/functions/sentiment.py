"""Lexicon sentiment from column expressions (no UDF)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases counted as positive and negative.
POSITIVE = (
    "hype", "excited", "hyped", "amazing", "great", "awesome", "sick",
    "fire", "banger", "war", "lets go", "pumped", "stacked", "main event",
    "championship", "knockout", "ko", "finish", "dominant", "beast", "goat",
    "legend", "best", "favorite", "love", "can't wait", "crazy", "insane",
)
NEGATIVE = (
    "boring", "trash", "weak", "bad", "sucks", "terrible", "worst",
    "skip", "pass", "meh", "disappointed", "disappointing", "robbery",
    "overrated", "fraud", "ducking", "scared", "padded", "can", "joke",
)
EMPTY_SUBJECTIVITY = 0.5
WORDS_PER_HIT = 10


#: Up to so many phrases a search for each of them is quicker than one pattern.
FEW_PHRASES = 128


def phrase_hits(low: Column, phrases: Sequence[str]) -> Column:
    """How many of the phrases occur in a lower-cased text, each counted once."""
    if len(phrases) > FEW_PHRASES:
        return F.size(phrases_found(low, phrases))
    hits = F.lit(0)
    for phrase in phrases:
        hits = hits + low.contains(phrase).cast("int")
    return hits


def phrases_found(low: Column, phrases: Sequence[str]) -> Column:
    """The phrases that occur in a text, each once.

    The pattern is the phrases' trie. It looks ahead, so hits may overlap, and finds
    the longest phrase at a place. Phrases that others begin with are looked for once more
    by themselves, so there are as many passes as phrases that each begin the next,
    whatever the length of the list.
    """
    known = {p for p in phrases if p}
    found = F.array(F.lit("")) if "" in phrases else F.array().cast("array<string>")
    while known:
        pattern = f"(?s)(?=({trie_pattern(sorted(known))}))"
        found = F.array_union(found, F.regexp_extract_all(low, F.lit(pattern), F.lit(1)))
        known = {p[:n] for p in known for n in range(1, len(p)) if p[:n] in known}
    return found


def trie_pattern(phrases: Sequence[str]) -> str:
    """Regular expression of distinct, non-empty phrases, longest first at any place."""
    root: dict = {}
    for phrase in phrases:
        node = root
        for char in phrase:
            node = node.setdefault(char, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        # chains without a fork are written out, so nesting is bounded by forks
        out = ""
        while len(node) == 1 and "" not in node:
            char, node = next(iter(node.items()))
            out += re.escape(char)
        branches = [re.escape(c) + pattern(n) for c, n in sorted(node.items()) if c]
        if not branches:
            return out
        return f"{out}(?:{'|'.join(branches)})" + ("?" if "" in node else "")

    return pattern(root) if root else "(?!)"


def word_count(text: Column) -> Column:
    """Words between white space (any Unicode kind), at least 1."""
    words = F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")
    return F.greatest(F.size(words), F.lit(1))


def score_texts(
    df: DataFrame,
    column: str,
    positive: Sequence[str] = POSITIVE,
    negative: Sequence[str] = NEGATIVE,
) -> DataFrame:
    """Add polarity and subjectivity of a text column.

    Polarity is ``(p - n) / (p + n)``, 0 where nothing is found; subjectivity is
    hits per ten words, at most 1, and 0.5 for an empty text. The lower-cased
    text and the counts are columns of their own, so each is computed once.
    """
    low = F.col("low_")
    counted = df.withColumn("low_", F.lower(column)).withColumns(
        {
            "pos_": phrase_hits(low, positive),
            "neg_": phrase_hits(low, negative),
            "words_": word_count(low),
            "empty_": low.isNull() | (low == ""),
        }
    )
    p, n = F.col("pos_"), F.col("neg_")
    none = F.col("empty_") | (p + n == 0)
    return counted.withColumns(
        {
            "polarity": F.when(none, 0.0).otherwise((p - n) / (p + n)),
            "subjectivity": F.when(F.col("empty_"), EMPTY_SUBJECTIVITY).otherwise(
                F.least(F.lit(1.0), (p + n) / (F.col("words_") / WORDS_PER_HIT))
            ),
        }
    ).drop("low_", "pos_", "neg_", "words_", "empty_")


def hype_score(avg_sentiment: Column, engagement: Column) -> Column:
    """Sentiment scaled to 0–1 times log engagement, over ten."""
    return (avg_sentiment + 1) / 2 * F.log1p(engagement) / 10
