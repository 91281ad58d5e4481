"""A corpus pipeline over documents: language, near copies, benchmark leaks, mixture, shards.

Stages take any columns beside those of documents, whatever their names, and an empty table gives an empty one. Null and
empty texts go with the first stage; rows that repeat an id are judged by their own texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayforge.llm.common import Staging
from wayforge.llm.decontamination import keep_uncontaminated
from wayforge.llm.language_id import keep_identified
from wayforge.llm.mixing import keep_mixture
from wayforge.llm.ngram_join import keep_one_of_each
from wayforge.llm.resharding import shard_documents


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go: null texts, those without letters, and those that are far from all
    languages; of equal distances the first language by name counts. Repeated rows are judged alike."""
    return keep_identified(spark, docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that with the smallest doc_id, of equal ones that with the smallest
    hash of its text. Rows without an id stay; rows that repeat an id with unlinked texts stay both."""
    return keep_one_of_each(spark, docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, whole or edited, go; items without words leak nowhere."""
    return keep_uncontaminated(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens have smoothed shares of sources, languages and topics, nulls being values of their own; rows
    that repeat an id are sampled together."""
    return keep_mixture(spark, docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every document left; repeated rows have a slot each."""
    return shard_documents(spark, docs)


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("decontaminate", decontaminate),
    ("mixture", mixture),
    ("shards", shards),
]

#: The first four stages can't be said in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = Staging(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staging.keep(stage(spark, docs, sf_dir), name)
    return docs
