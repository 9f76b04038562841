"""Raw feeds from files, and the run log from a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shelfline.functions.columns import as_declared
from shelfline.operators.batches import distinct_names


def read_text_feed(spark: SparkSession, path: str, infer_types: bool = False) -> DataFrame:
    """CSV with a header, every column as text, names stripped of blanks.

    Columns are taken by header name, so a new or moved column is seen as such.
    ``infer_types`` lets Spark guess the types instead, in an extra pass over the
    data; feeds with a declared schema do not need it.
    """
    reader = spark.read.option("header", "true").option("inferSchema", str(infer_types).lower())
    df = reader.csv(path)
    return df.toDF(*distinct_names(header_names(df.columns)))


def header_names(columns: list[str]) -> list[str]:
    """The names in a CSV header; where some are equal but for their case, the reader puts their places behind them."""
    stems = [c.removesuffix(str(i)).lower() if c.endswith(str(i)) else None for i, c in enumerate(columns)]
    return [
        c.removesuffix(str(i)) if stem and stems.count(stem) > 1 else c for i, (c, stem) in enumerate(zip(columns, stems, strict=True))
    ]


def typed_feed(text: DataFrame, schema: T.StructType) -> DataFrame:
    """Give declared columns their types; unreadable text becomes null.

    Columns outside ``schema`` stay as text, missing ones stay missing: both are
    for the contract to judge.
    """
    declared = {f.name: f.dataType for f in schema}
    return text.selectExpr(
        *[f"{as_declared(text, c, declared[c])} AS `{c}`" if c in declared else f"`{c}`" for c in text.columns]
    )


def read_feed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return typed_feed(read_text_feed(spark, path), schema)


def write_feed(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def sample_rows(df: DataFrame, order_by: list[str], rows: int = 20) -> DataFrame:
    """The first rows in a fixed order, as a sample for people to look at."""
    return df.orderBy(*order_by).limit(rows)


def read_run_log_jdbc(
    spark: SparkSession,
    url: str,
    table: str = "dag_run",
    properties: dict[str, str] | None = None,
    split_on: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """The scheduler's run table over JDBC, in parallel ranges of ``split_on``."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if split_on and bounds:
        reader = (
            reader.option("partitionColumn", split_on)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.options(**(properties or {})).load()
