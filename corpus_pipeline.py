"""A corpus from raw documents to shards, in five stages; each works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierkeep.llm import decontaminate, kd_shards, mixing, near_copies, quality_model
from tierkeep.session import cut


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labelled ones among them, does not reject."""
    model = quality_model.learn(docs, _table(spark, sf_dir, "labels"))
    return quality_model.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group whose five-word shingles have a Jaccard similarity of 0.8 or more."""
    return near_copies.without_near_copies(docs)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.decontaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for."""
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their size, shard and slot."""
    return kd_shards.sharded(docs)


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", clean_of_benchmarks),
    ("source_mixing", mix),
    ("sharding", shards),
]

#: SQL cannot express the classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
