"""From raw documents to packed training sequences: five stages, each stored before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfline.llm import exact_dedup, ngram_join, packing, quality, suffix_dedup
from shelfline.llm import prepare
from shelfline.sources.workspace import new_run_root, stored


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality.drop_poor(docs, labels)


def one_of_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest doc_id."""
    prepare(spark)
    return exact_dedup.drop_exact_copies(spark, docs)


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by a Jaccard similarity of 0.8 on five words, the one with the smallest doc_id."""
    prepare(spark)
    return ngram_join.drop_near_copies(spark, docs, n=5, percent=80)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words or more that an earlier document holds."""
    prepare(spark)
    return suffix_dedup.cut_repeats(spark, docs)


def in_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 2,048 tokens."""
    prepare(spark)
    return packing.packed(spark, docs, packing.default_tokenizer())


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", one_of_equal),
    ("near_dedup", one_of_similar),
    ("passage_dedup", without_repeats),
    ("packing", in_sequences),
]

#: The fit of the classifier and the tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    root = new_run_root(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), root, name)
    return docs
