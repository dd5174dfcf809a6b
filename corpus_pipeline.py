"""A training corpus from `documents`: five stages, each an operator of cloakwork.llm.

Each stage takes what its predecessor kept, written as Parquet and reread. All but the last
return the columns of documents; the last adds each record's shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cloakwork.llm import decontamination, mixing, near_dedup, quality, sharding
from cloakwork.llm.common import materialize, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier selects go on; the rest go."""
    return quality.select(docs, quality.graded(table(spark, sf_dir, "labels"))).select(*docs.columns)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays: the one with the least id."""
    return near_dedup.deduplicate(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.take_mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix, shuffled into shards."""
    return sharding.shuffle_into_shards(docs)


STAGES = [
    ("quality", quality_classifier),
    ("near_dedup", near_deduplication),
    ("decontamination", benchmark_decontamination),
    ("mixing", source_mixing),
    ("sharding", sharded),
]

#: The stages' models, signatures and seeded shuffles can't be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
