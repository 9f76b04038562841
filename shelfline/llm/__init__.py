"""Operators that prepare text for training, one module each, and their registered queries."""

from pyspark.sql import SparkSession

from shelfline.sources.workspace import let_workers_import, small_batches


def prepare(spark: SparkSession) -> None:
    """What the operators' Python workers need of a session."""
    let_workers_import(spark)
    small_batches(spark)
