"""Training corpus from raw documents, one operator per stage.

Each stage takes the rows its predecessor kept and hands on the columns of
``documents``; the last returns the shard and slot of every row. ``run``
writes each stage's rows to the shared folder and reads them again, so a lost
executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.common import Scratch
from quarry.llm.flow_mix import mixture
from quarry.llm.label_shards import shard_documents
from quarry.llm.queries import table
from quarry.llm.suffix_decon import decontaminate
from quarry.llm.tensor_minhash import near_dedup
from quarry.llm.zstd_quality import keep_good, train


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return keep_good(docs, train(docs, table(spark, sf_dir, "labels")))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class (five words, 0.8)."""
    return near_dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixture(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix."""
    return shard_documents(docs)


STAGES = [("quality", quality), ("near_dedup", near), ("decontamination", decontamination), ("mixing", mixing), ("sharding", sharding)]
#: a classifier, hash tables and label propagation have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: one row per document copy with its shard."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
