"""The corpus pipeline: documents to shards of a mixture, one stage after the other.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from callpay.llm import decontaminate, jaccard, mixing, quality_rules, sharding
from callpay.llm.shared import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule, or whose host is rejected, go."""
    return quality_rules.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts stays, that of the smallest id."""
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share ten words in a row with a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.repeat_taken(mixing.mix(docs), docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds shard and slot."""
    return sharding.shard(docs)


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard", near_copies),
    ("decontamination", decontamination),
    ("source_mixture", mixture),
    ("sharding", shards),
]

#: Seeded choices, a knapsack and groups of similar texts: not for SQL; the tests hold it against plain restatements.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
