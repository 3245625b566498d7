"""A training corpus from raw documents: each stage calls one operator of ``vialis.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vialis.llm import decontaminate, langid, mixing, ngram_join, sharding
from vialis.llm.common import table, written


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a language that could be learned; texts without letters go.

    The model learns from the labelled documents of all thirds.
    """
    return langid.known(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the least id, then the least text hash."""
    return ngram_join.first_of_each(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, left out or repeated so that sources come near their target weights."""
    return mixing.resample(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard."""
    return sharding.place(docs)


STAGES = [
    ("known_language", known_language),
    ("one_of_each", one_of_each),
    ("without_benchmarks", without_benchmarks),
    ("mix_sources", mix_sources),
    ("assign_shards", assign_shards),
]

# Trained models, similarity search and alignment have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
