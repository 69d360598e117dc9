"""The dealt operators as queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlytics.llm import bpe_automaton, chat, chat_repair, chat_sql, cover_tree, fill_middle, graph_search, jaccard, language, ngram_lm, packing, repeats, secrets, toxicity
from eventlytics.llm.common import held_out, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kneser-Ney scores of all documents, learned from those whose remainder is not 1."""
    docs = table(spark, sf_dir, "documents")
    model = ngram_lm.fit(docs.filter(~held_out(docs["doc_id"], 5, 1)))
    return ngram_lm.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 5, 1).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity",
    )


@query
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from documents whose remainder is not 1."""
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.filter(~held_out(docs["doc_id"], 3, 1)))
    return language.predict(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "lang_pred", "score"
    )


@query
def op3_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of embeddings with a cosine of 0.95 or more."""
    return cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    found = secrets.scan(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    base = F.filter("spans", lambda s: s["kind"] != "random")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    return found.select(
        "doc_id", *map(number, secrets.KINDS[:3]),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )


@query
def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the sentences of spans that came before elsewhere."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.without_repeats(docs).select("doc_id", "n_sentences", "n_removed", "text")


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of documents with remainder 0 are not used."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(~held_out(labels["doc_id"], 5, 0)))
    return toxicity.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op7_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest embeddings of every embedding whose id is divisible by 100."""
    rows = table(spark, sf_dir, "embeddings")
    return graph_search.nearest(rows, rows.filter(rows["vec_id"] % 100 == 0))


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids."""
    return packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), payload="crc32"
    ).drop("ids")


@query
def op10_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents by the automaton, and their text again."""
    return bpe_automaton.encode_decode(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), digests=True
    )


@query
def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 5-word shingles have a similarity of 0.75 or more."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@query
def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts are control strings, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(chat_sql.CONTROLS_AS_TEXT).alias("text"),
    )
    read = chat.format_chats(turns.unionByName(planted)).select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"),
        chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("pieces")).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


@query
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents for fill-in-the-middle training, and their texts rebuilt."""
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


@query
def op13_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by rule, and the cheapest edits that mend them."""
    rows = chat_repair.damaged(table(spark, sf_dir, "conversations"))
    lines = F.transform("turns", lambda t: F.concat_ws(":", t["role"], t["text"]))
    return chat_repair.repair(rows, gone_col="gone").withColumn(
        "repaired_sha256", F.sha2(F.array_join(lines, "\n"), 256)
    ).drop("turns")


ORACLES |= {
    "op11_chat_format": chat_sql.FORMAT, "op12_fill_middle": chat_sql.FILL, "op13_chat_repair": chat_sql.REPAIR,
}
