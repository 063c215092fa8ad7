"""The corpus pipeline: text operators one after another over the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, jaccard, mixing, quality_classifier, sharding
from tidemark.llm.common import stored, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier rejects."""
    return quality_classifier.good_documents(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, by five-word shingles and Jaccard 0.8."""
    return jaccard.one_of_each(docs, like=jaccard.Likeness(shingle=5, percent=80))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that a passage of the benchmark occurs in."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents of small sources, at most twice, until sources have their target weights.

    Every document is drawn at least once: what the filters kept is not lost to the mixture.
    """
    return mixing.mixed_documents(docs, mixing.Target(entropy=0.95, repeats=2.0, budget=None))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place every row in one of 40 contiguous shards of nearly equal bytes."""
    return sharding.shard_documents(docs, shards=40)


STAGES = [
    ("quality classifier", good),
    ("n-gram Jaccard join", distinct),
    ("benchmark decontamination", clean),
    ("mixing sources to target weights", mixed),
    ("sharding", shard),
]

# The first stage learns a model and the second follows links; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
