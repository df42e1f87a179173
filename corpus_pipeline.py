"""From raw documents to packed training sequences, in stages that each read what the one before wrote.

All stages take any documents table: nulls, empty and very long texts and extra columns are handled as
the operators' docstrings say. Each but the last returns the columns it was given.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from spanforge.llm import langid, lines, mixing, packing, simhash
from spanforge.llm.text import documents, small_batches
from spanforge.session import shared_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language stay, with the language found; learned from the rows that name one.

    Null texts, texts without a letter and those of unsure language (below one half) go.
    """
    small_batches(spark)
    return langid.sure(docs, langid.train(docs))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that break a rule go, then documents that lost too much; texts and their length are those left."""
    small_batches(spark)
    return lines.keep_clean(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id.

    Groups are those of the operator's contract: four-word fingerprints within four bits.
    """
    small_batches(spark)
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, those of small sources again until the sources have their tempered weights."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of every drawn document in sequences of 2048 tokens."""
    small_batches(spark)
    return packing.pack(packing.tokens(docs, with_ids=False, special=True))


STAGES = [
    ("language_id", language),
    ("quality_rules", quality),
    ("simhash_dedup", dedup),
    ("mix_sources", mix),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet in the shared folder and read again."""

    def step(docs: DataFrame, stage) -> DataFrame:
        name, function = stage
        path = shared_path(spark, f"pipeline-{name}")
        function(spark, docs, sf_dir).write.parquet(path)
        return spark.read.parquet(path)

    return functools.reduce(step, STAGES, documents(spark, sf_dir))


#: Languages, fingerprints and tokens have no SQL form; tests compare each stage with brute force.
ORACLE_SQL = None
