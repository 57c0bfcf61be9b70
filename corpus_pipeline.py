"""A corpus pipeline of five stages over ``documents``; each is one operator of ``cashbook.llm``.

Every stage is written as Parquet to the shared folder and read again as the
documents of the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cashbook.llm.common import stored, table
from cashbook.llm.decontaminate import clean_documents
from cashbook.llm.jaccard_join import one_per_group
from cashbook.llm.mixing import mixed_documents
from cashbook.llm.sharding import shard
from cashbook.llm.toxicity import keep_clean


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return keep_clean(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five-word shingles, similarity 0.8)."""
    return one_per_group(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a document mostly made of them goes."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated or left out so that the sources meet their target weights."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sixteen shards of near-equal bytes, with each row's place in its shard."""
    return shard(docs, 16)


STAGES = [("toxicity", toxicity), ("jaccard_join", near_duplicates), ("decontamination", decontamination),
          ("mixing", mixing), ("sharding", sharding)]

#: The first stages score with trained models and search similar texts: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
