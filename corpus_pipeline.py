"""A training corpus from ``documents``: language, near-duplicates, benchmark passages, mixture, shards.

Each stage takes (spark, docs, sf_dir), works on all rows of its docs and returns the columns of documents; the last adds the shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import discard, table, written
from tidemark.llm.decontam import drop_contaminated
from tidemark.llm.langid import keep_identified
from tidemark.llm.mixing import mixed
from tidemark.llm.near_dup import drop_near_duplicates
from tidemark.llm.sharding import balanced_shards


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in no language (null, or without a letter) go."""
    return keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the smallest doc_id stays."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated by a Poisson count; sources weigh as the square root of their bytes."""
    return mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of each row; equal texts (a document's copies as well) are linked."""
    return balanced_shards(docs)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix_sources", mix_sources), ("shard", shard)]

#: Mixture models and signatures have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        kept = written(stage(spark, docs, sf_dir))
        discard(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
