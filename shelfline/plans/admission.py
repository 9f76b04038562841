"""Admission of files to bronze: each file is judged by itself, and what is refused is kept aside.

A file that breaks its contract does not hold back the files that came with it. The contract is judged for all
files of a batch in one aggregate per header; rows are then routed by an anti-join on their
file: to bronze, or to the rejects of the table, with the rules that their file broke.
"""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.names import FEED_SCHEMAS, REJECTS, STOREFRONT_TABLE
from shelfline.operators.batches import Batch, add_batch_columns, distinct_names
from shelfline.operators.contract import CRITICAL, STOREFRONT_CONTRACT, Contract, ContractField, contract_report
from shelfline.sources.feeds import header_names
from shelfline.sources.ledger import read_loads, store_load
from shelfline.sources.workspace import new_run_root, stored

SOURCE_FILE = "_source_file"
RULES = "_rules"

_TYPE_NAMES = {T.StringType: "string", T.DateType: "date", T.IntegerType: "integer", T.DoubleType: "double", T.TimestampType: "timestamp"}


def default_contract(table: str) -> Contract:
    """The contract of a feed; for one without, that its declared columns are there."""
    if table == STOREFRONT_TABLE:
        return STOREFRONT_CONTRACT
    fields = [ContractField(f.name, _TYPE_NAMES[type(f.dataType)]) for f in FEED_SCHEMAS[table]]
    return Contract(table, "1.0", tuple(fields), missing_optional_fields="reject")


def broken_rules(frames: list[DataFrame], contract: Contract, unit: str) -> DataFrame:
    """(unit, rules): the critical rules that each unit breaks, such as ``validation:quantity``."""
    reports = [contract_report(df, contract, (unit,)) for df in frames]
    broken = reduce(DataFrame.unionByName, reports).where((F.col("severity") == CRITICAL) & (F.col("n") > 0))
    rule = F.concat_ws(":", "rule", "field")
    return broken.groupBy(unit).agg(F.array_join(F.array_sort(F.collect_set(rule)), "; ").alias(RULES))


def store_rejects(spark: SparkSession, root: str, table: str, refused: DataFrame, batch: Batch) -> int:
    """Keep refused rows, which carry ``_rules``, as a load of the table's rejects."""
    text = refused.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in refused.columns])
    stamped = add_batch_columns(text, table, batch.batch_id, batch.ingested_at)
    return store_load(spark, root, REJECTS, table, stamped, batch, replaces=True)


def read_rejects(spark: SparkSession, root: str, table: str) -> DataFrame:
    """What was refused, with the rules it broke and the file it came in (null for a whole batch)."""
    df = read_loads(spark, root, REJECTS, table)
    absent = [F.lit(None).cast("string").alias(c) for c in (SOURCE_FILE, RULES) if c not in df.columns]
    return df.select("*", *absent)


def headers(lines: DataFrame) -> dict[str, list[str]]:
    """First line -> files that begin with it. ``lines`` has (file, value) of the first block of every file.

    The rows of a file's first block are read by one task and in their order.
    """
    found: dict[str, list[str]] = {}
    for r in lines.groupBy("file").agg(F.first("value").alias("header")).orderBy("file").collect():
        found.setdefault(r.header, []).append(r.file)
    return found


def plain_path(file: str) -> str:
    """A file's address in row metadata as a path that names just this file, odd characters included."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file))


def frames_by_header(spark: SparkSession, found: dict[str, list[str]], known: list[str]) -> list[DataFrame]:
    """One frame of text columns for each different header, every row with its file."""
    frames = []
    for files in found.values():
        df = spark.read.option("header", "true").csv([plain_path(f) for f in files])
        names = distinct_names(header_names(df.columns), known)
        frames.append(df.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE)).toDF(*names, SOURCE_FILE))
    return frames


def route(
    spark: SparkSession, frames: list[DataFrame], contract: Contract, label: str
) -> tuple[DataFrame, DataFrame, dict[str, str]]:
    """Rows of admitted files, rows of refused files with their rules, and file -> rules of those."""
    root = new_run_root(spark, label)
    verdicts = stored(spark, broken_rules(frames, contract, SOURCE_FILE), root, "refused")
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    admitted = rows.join(verdicts, SOURCE_FILE, "left_anti").drop(SOURCE_FILE)
    refused = rows.join(verdicts, SOURCE_FILE)
    return admitted, refused, {r[SOURCE_FILE]: r[RULES] for r in verdicts.collect()}
