"""Documents to a sharded training mix, in five stages that are each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from graphloom.llm._shared import WRITTEN, remove_tables, table
from graphloom.llm.decontaminate import without_passages
from graphloom.llm.mixing import mixed
from graphloom.llm.ngram_join import keep_one
from graphloom.llm.quality_rules import keep_good
from graphloom.llm.sharding import shard_documents


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: that with the least doc_id."""
    return keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark passage stands."""
    return without_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def weighted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their slot in it."""
    return shard_documents(docs, shards=24)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", good_quality),
    ("ngram_join", one_of_each),
    ("decontaminate", uncontaminated),
    ("source_mix", weighted),
    ("sharding", sharded),
]

#: Expectation-maximisation and near copies are not for SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        before = len(WRITTEN)
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = table(docs)
            mine = WRITTEN.pop()
            remove_tables(spark, before)  # what the stage wrote on its way; its result stays
            WRITTEN.append(mine)
    return docs
