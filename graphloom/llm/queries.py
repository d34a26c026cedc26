"""The queries opN_<name> and pipeline: each operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm import oracles
from graphloom.llm.decontaminate import find_passages
from graphloom.llm.license_scan import scan_licenses
from graphloom.llm.line_dedup import dedup_lines
from graphloom.llm.mixing import mix_sources
from graphloom.llm.ngram_join import link_documents
from graphloom.llm.quality_classifier import score_quality
from graphloom.llm.quality_rules import quality_rules
from graphloom.llm.ranked_search import rank_documents
from graphloom.llm.sharding import shard_documents
from graphloom.llm.substring_dedup import dedup_substrings
from graphloom.llm.token_counts import count_tokens
from graphloom.llm.warc import read_bundles, write_bundles
from graphloom.llm.whitening import whiten


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents", "doc_id", "text"), carry=["doc_id"])


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(read(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed_lines", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_content_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(read(spark, sf_dir, "documents", "doc_id", "text"), words=50)
    return out.select("doc_id", "n_lines", "n_removed_lines", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_substrings(read(spark, sf_dir, "documents", "doc_id", "text"), window=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix_sources(read(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(read(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "n_shingles", "component_id")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read(spark, sf_dir, "documents", "doc_id", "text"), shards=24, carry=["doc_id"])


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "labels", "doc_id", "quality"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "n_words", "n_tokens", "n_bytes")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_bundles(write_bundles(read(spark, sf_dir, "pages", "page_id", "url", "html")))
    number = lambda c: F.regexp_extract(c, r"^urn:page:(.*)$", 1).cast("long")
    size = F.when(F.col("record_type") == "response", F.length("payload")).otherwise(F.col("payload_bytes")).cast("long")
    digest = F.when(F.col("record_type") == "response", F.sha1("payload")).otherwise(F.col("payload_digest"))
    return records.select(number("record_id").alias("page_id"), size.alias("payload_bytes"), digest.alias("payload_digest"), "record_type", number("refers_to").alias("refers_to"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_passages(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents", "doc_id", "text"), carry=["doc_id"]).drop("detections")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, fitted = whiten(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), components=32, carry=["vec_id"])
    shares = F.array(*[F.lit(float(x)) for x in fitted.explained]) if fitted else F.array().cast("array<double>")
    long = out.select("vec_id", "n", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return long.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened", F.get(shares, F.col("at")).alias("explained"), F.lit(fitted.identity_error if fitted else 0.0).alias("identity_error"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"), k=20)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality_rules, op2_line_dedup, op2_content_dedup, op3_substring_dedup, op4_source_mix, op5_ngram_join, op6_sharding, op7_quality_classifier, op8_token_counts, op9_warc, op10_decontaminate, op11_license_scan, op12_embedding_whitening, op13_ranked_search, pipeline)}


def oracle_sql() -> dict[str, str]:
    return oracles.SQL
