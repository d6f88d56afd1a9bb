"""A training corpus in five stages, each a Spark job over all that the one before kept.

Quality rules drop bad texts, near-dedup keeps one document of each group of
0.8 similarity in five-word shingles, decontamination drops
documents that hold test items, mixing repeats and drops documents for the source weights, sharding deals
the rows out.  Every stage writes Parquet to the shared folder, and the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tokenloom.llm import decontamination, mixing, quality, sharding
from tokenloom.llm import near_dedup as near_dedup_texts
from tokenloom.llm.storage import staged
from tokenloom.plans.catalog import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fitted quality and toxicity thresholds."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group linked by a five-word similarity of 0.8 or more."""
    return near_dedup_texts.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that align with no benchmark item."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_rows(docs, mixing.label_quality(table(spark, sf_dir, "labels")))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix."""
    return sharding.contract(sharding.shard_by_bytes(docs))


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

# The quality stage fits a model, which SQL cannot say; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; an empty table passes through as empty."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{number}")
    return docs
