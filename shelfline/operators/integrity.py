"""Checks across tables: orphan references and late arrivals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphan_counts(facts: DataFrame, dimension: DataFrame, key: str, check: str) -> DataFrame:
    """Keys and rows of ``facts`` whose ``key`` is missing in ``dimension``.

    Facts are counted per key before the join, so a popular key is one row.
    """
    per_key = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = dimension.select(key)
    return per_key.join(known, key, "left_anti").agg(
        F.lit(check).alias("check_name"),
        F.count(F.lit(1)).alias("orphan_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("orphan_rows"),
    )


def late_arrival_profile(bronze: DataFrame, date_column: str) -> DataFrame:
    """Rows by days between the business date and the day the row arrived."""
    return (
        bronze.groupBy(F.datediff("_ingestion_date", F.col(date_column).cast("date")).alias("days_late"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
