"""A corpus from documents to shards: language ID, near-duplicates, decontamination, mixing, sharding."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from gristmill.llm import decontaminate, langid, mixing, nearcopies, sharding
from gristmill.llm.session import remove, shared_dir


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those without letters and those of no clear language go."""
    return langid.accepted(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles of similarity 0.8 or more."""
    return nearcopies.one_of_each(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of the benchmark occurs."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.repeated(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with its shard and its place there."""
    return sharding.sharded(docs)


STAGES = [("language_id", known_language), ("near_duplicates", one_of_each), ("decontamination", clean_of_benchmark), ("mixing", mixed), ("sharding", shards)]
#: Trained networks and Newton iterations are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove(spark, f"{folder}/{before}")  # the stage's own rows are written; the last table stays, as the result is read from it
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
