"""Registered queries of the operators: name -> function of (spark, data folder)."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import (
    exact_dedup,
    filter_audit,
    fingerprints,
    html_extraction,
    ngram_join,
    packing,
    quality,
    sentence_pieces,
    substring_dedup,
    suffix_dedup,
    token_alignment,
    token_counts,
    toxicity,
)
from shelfline.llm import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    @wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        prepare(spark)
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return run


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")


@query
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_counts.section_tokens(_documents(spark, folder), token_counts.default_ranks())
    return counts.withColumn("n_tokens", F.col("n_tokens").cast("long"))


@query
def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(spark, _documents(spark, folder), packing.default_tokenizer())


@query
def op3_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found, _ = ngram_join.similar_documents(spark, _documents(spark, folder), n=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op4_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return sentence_pieces.round_trips(_documents(spark, folder), sentence_pieces.default_model())


@query
def op5_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compared(_documents(spark, folder)).select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_string(F.col("fingerprint")).alias("fingerprint"),
        fingerprints.as_string(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    model = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic"))
    return toxicity.scored(docs, model).select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op7_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.repeated_passages(spark, _documents(spark, folder))


@query
def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    model = quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality"))
    return quality.scored(docs, model).select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = exact_dedup.exact_groups(spark, _documents(spark, folder))
    return groups.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


@query
def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeated_units(spark, _documents(spark, folder))


@query
def op11_filter_interaction_audit(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality", "toxic")
    counters = filter_audit.part_counters(spark, f"{folder}/documents.parquet", labels)
    return filter_audit.audit(spark, counters)


@query
def op12_cross_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    found, _ = token_alignment.alignment(
        spark, _documents(spark, folder), token_alignment.default_a(), token_alignment.default_b()
    )
    return found


@query
def op13_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return html_extraction.main_texts(pages).select("page_id", "url", "text", "n_chars")


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
