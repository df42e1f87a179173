"""The queries of this subpackage over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, divergence, langid, licenses, lines, lm, mixing, negatives, neighbours, packing, quality, simhash, vectors
from .text import documents, fold


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    d = simhash.near_duplicates(documents(spark, sf_dir))
    return d.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every draw of every document, by block and position."""
    return mixing.mixture(documents(spark, sf_dir))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; crc32 of the id modulo 3 is 1 for rows held out of learning."""
    docs = documents(spark, sf_dir)
    held = fold("doc_id", 3) == 1
    model = langid.train(docs.filter(~held).select("doc_id", "text", "lang"))
    return langid.predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices found in every document."""
    return licenses.scan_documents(documents(spark, sf_dir)).drop("matches")


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model log10 probability of every document; crc32 of the id modulo 10 is 0 for rows held out of learning."""
    return lm.score_documents(documents(spark, sf_dir), fold("doc_id", 10) == 0)


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return vectors.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 2048 tokens."""
    return packing.pack(packing.tokens(documents(spark, sf_dir), with_ids=False, special=True))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of line-first cleaning for every document."""
    return lines.clean_lines(documents(spark, sf_dir), with_text=False)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; crc32 of the id modulo 5 is 0 for rows held out of learning."""
    docs = documents(spark, sf_dir)
    held = fold("doc_id", 5) == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    net = quality.train(docs.filter(~held), labels.filter((F.col("quality") == 1) & ~held))
    return quality.score(docs, net).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation as read back from its formatted text."""
    turns = chat.turn_rows(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    tricky = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.write_turns(turns.unionByName(own)))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ in their frequent terms."""
    return divergence.source_divergence(documents(spark, sf_dir))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector; every 7th has the next label."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(e.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every 100th."""
    return neighbours.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_language_id, op3_license_scan, op4_lm_score, op5_embedding_dedup, op6_pack, op7_quality_rules, op8_quality_classifier, op9_chat_format, op10_simhash_dedup, op11_source_divergence, op12_hard_negatives, op13_nearest_neighbours)}
SQL = {"op1_mix_sources": mixing.mixture_sql(), "op7_quality_rules": lines.clean_sql(), "op11_source_divergence": divergence.divergence_sql(), "op12_hard_negatives": negatives.hard_negatives_sql(), "op13_nearest_neighbours": neighbours.nearest_sql()}
