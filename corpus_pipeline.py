"""A training corpus from raw documents: five stages, each on all that the one
before kept, written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfscan.llm import bpe, line_dedup, mixing, quality_model, simhash
from shelfscan.llm.common import prepare
from shelfscan.session import scratch_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    labels = prepare(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return quality_model.keep_good(docs, labels)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in many documents go; ``n_chars`` follows the text."""
    prepare(spark)
    return line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    prepare(spark)
    return simhash.keep_one_per_group(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target weights; a document taken by n epochs is there n times."""
    prepare(spark)
    return mixing.mixed_rows(docs, mixing.mix(docs))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    prepare(spark)
    return bpe.encode(docs).select("doc_id", "n_tokens", "ids")


STAGES = [("quality classifier", quality_classifier), ("line dedup", line_dedup_stage),
          ("simhash near-dedup", near_dedup), ("source mixing", source_mixing),
          ("bpe encoding", bpe_encoding)]

# A trained classifier, SimHash and BPE have no SQL form; tests/llm compares
# run() with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; each stage's rows are written to the
    shared folder, read again by the next, and removed when the application ends."""
    prepare(spark)
    base = scratch_path(spark, "corpus")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{base}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
