"""A corpus pipeline of five stages, each an operator of ``eventlytics.llm``.

Every stage takes the documents its predecessor kept, written as Parquet and
read again, and all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlytics.llm import jaccard, language, packing, repeats, secrets
from eventlytics.llm.common import fresh_name, table
from eventlytics.llm.hashstore import new_folder
from eventlytics.operators.scale import keep_first

VOCABULARY = "byte_bpe_50k.json"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; others go (no letter, no language likelier
    than all else, or a code too long for a text of the likeliest one)."""
    return language.keep_known(docs, language.fit(docs, spread=True))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that link by word shingles, directly or not, the smallest id stays.

    A row without an id takes part under a number made from its text, above all ids; of rows
    with one id (or none) and one text one stays.
    """
    key, text_key = fresh_name("key_", docs), fresh_name("text_key_", docs)
    made = F.lit(1 << 62) + F.pmod(F.xxhash64("text"), F.lit(1 << 61))
    keyed = docs.select(
        "*", F.coalesce(F.col("doc_id").cast("long"), made).alias(key),
        F.struct(F.xxhash64("text"), F.crc32(F.col("text").cast("binary")), F.length("text")).alias(text_key),
    )
    if not keyed.groupBy(key, text_key).count().filter("count > 1").isEmpty():
        keyed = keep_first(keyed, [key, text_key], [key])
    groups = jaccard.jaccard_components(keyed.select(key, "text"), id_col=key)
    gone = groups.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("gone_")).distinct()
    return keyed.join(gone, keyed[key] == gone["gone_"], "left_anti").select(*docs.columns)


def no_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated spans are cut out; documents of which nothing is left go."""
    cut = repeats.without_repeats(docs)
    left = (F.col("n_removed") == 0) | (F.length(F.trim("text")) > 0)
    return _recounted(cut.filter(F.coalesce(left, F.lit(True))), docs.columns)


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return _recounted(secrets.redact(docs, public_tokenizers.path(VOCABULARY)), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 ids."""
    return packing.pack(docs, public_tokenizers.path(VOCABULARY), payload="crc32").drop("ids")


def _recounted(docs: DataFrame, columns: list[str]) -> DataFrame:
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return docs.select(*columns)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("jaccard", one_of_each_group),
    ("repeats", no_repeated_passages),
    ("secrets", no_secrets),
    ("packing", packed),
]

#: The automata, models and tokenizers of the stages have no SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = new_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            place = f"{folder}/{number}-{name}"
            docs.write.parquet(place)
            docs = spark.read.parquet(place)
    return docs
