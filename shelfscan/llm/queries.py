"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfscan.llm import (alignment, bpe, license_scan, line_dedup, minhash, mixing,
                           quality_model, quality_rules, sharding, simhash, substring, whitening,
                           winnow)
from shelfscan.llm.common import prepare
from shelfscan.llm.oracle import ORACLE  # noqa: F401


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_dup_groups(_documents(spark, sf_dir))
    return groups.select("doc_id", simhash.fingerprint_hex("fp").alias("fingerprint"),
                         "component_id")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return line_dedup.digests(docs, line_dedup.keep_bitmaps(docs))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.edit_report(_documents(spark, sf_dir))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_documents(spark, sf_dir))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir)).select(
        "doc_id", "domain", "lang", "source", "tokens", "copies")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.report(_documents(spark, sf_dir))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(_documents(spark, sf_dir))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_model.classify(docs, labels).drop("k1", "k2")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.substring_dedup(_documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_documents(spark, sf_dir))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(prepare(spark).read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_documents(spark, sf_dir))


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_dup_groups(_documents(spark, sf_dir)).drop("k1", "k2")


QUERIES = {f.__name__: f for f in (
    op1_simhash_near_dedup, op2_line_dedup, op3_document_fingerprints, op4_sharding,
    op5_source_mixing, op6_license_scan, op7_quality_rules, op8_quality_classifier,
    op9_substring_dedup, op10_bpe, op11_embedding_whitening, op12_tokenizer_alignment,
    op13_minhash_near_dedup)}
