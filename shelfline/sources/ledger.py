"""Batch ledger and schema history of the tables that are loaded batch by batch.

A load writes a folder of its own. When its rows are stored, one ledger row is written, and only
loads that the ledger has count. So a run that is lost on the way leaves files that nobody
reads, and the same batch can be loaded again at any time, on another day as well:

* a load that ``replaces`` takes the place of all earlier loads of its batch, whatever their day and
  also with no rows at all;
* other loads of a batch are added to it.

The schema history has one row for each time that a table gained columns. Readers take the latest, so they
ask no file for its columns, and a table without a row has its columns, too.

Both are small tables, one row per load or per change. Only they are brought to the driver.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from shelfline.names import BATCH_COLUMNS, FEED_SCHEMAS, LOAD_COLUMN
from shelfline.operators.batches import Batch
from shelfline.sources.tables import partition_folder, path_exists, read_table, table_path, write_table

LEDGER = "number long, batch_id string, load_id string, ingestion_date date, replaces boolean, row_count long, recorded_at string, dataset string"
HISTORY = "version int, batch_id string, columns array<string>, added array<string>, dataset string"


#: Batch columns that are the same for all rows of a load, and partitions within it.
_OF_THE_LOAD = ("_ingestion_date", "_batch_id")


@dataclass(frozen=True)
class Load:
    batch_id: str
    load_id: str
    row_count: int


def _rows(spark: SparkSession, root: str, table: str, schema: str) -> DataFrame:
    path = table_path(root, "ops", table)
    return read_table(spark, path, schema=T.StructType.fromDDL(schema)) if path_exists(spark, path) else spark.createDataFrame([], schema)


def _add(spark: SparkSession, root: str, table: str, schema: str, rows: list[tuple]) -> None:
    df = spark.createDataFrame(rows, schema).coalesce(1)
    write_table(df, table_path(root, "ops", table), "append", "dataset", rebalance=False)


def batch_ledger(spark: SparkSession, root: str) -> DataFrame:
    """One row per load, whether it still counts or not."""
    own = Window.partitionBy("dataset", "batch_id")
    since = F.max(F.when(F.col("replaces"), F.col("number"))).over(own)
    return _rows(spark, root, "batch_ledger", LEDGER).withColumn("is_live", F.col("number") >= F.coalesce(since, F.lit(0)))


def all_live_loads(spark: SparkSession, root: str) -> dict[str, list[Load]]:
    """The loads that count, per dataset in the order of their loading; one without rows records that its batch is empty."""
    found: dict[str, list[Load]] = {}
    for r in sorted(batch_ledger(spark, root).where("is_live").collect(), key=lambda r: r.number):
        found.setdefault(r.dataset, []).append(Load(r.batch_id, r.load_id, r.row_count))
    return found


def live_loads(spark: SparkSession, root: str, layer: str, table: str) -> list[Load]:
    return all_live_loads(spark, root).get(f"{layer}.{table}", [])


def is_loaded(spark: SparkSession, root: str, layer: str, table: str, batch_id: str) -> bool:
    """Is ``batch_id`` stored, on whatever day?"""
    return any(load.batch_id == batch_id for load in live_loads(spark, root, layer, table))


def record_loads(
    spark: SparkSession, root: str, layer: str, table: str, loads: Sequence[Load], day: str, replaces: Sequence[bool]
) -> None:
    """Enter loads in the ledger; their numbers are the time of entry, so later ones are larger."""
    number, now = time.time_ns(), datetime.now(timezone.utc).isoformat()
    rows = [
        (number + i, load.batch_id, load.load_id, datetime.fromisoformat(day).date(), first, load.row_count, now, f"{layer}.{table}")
        for i, (load, first) in enumerate(zip(loads, replaces, strict=True))
    ]
    _add(spark, root, "batch_ledger", LEDGER, rows)


def schema_history(spark: SparkSession, root: str) -> DataFrame:
    return _rows(spark, root, "schema_history", HISTORY)


@dataclass(frozen=True)
class Known:
    """Source columns of a table: the declared ones and what its batches brought, in the order they came."""

    version: int
    columns: tuple[str, ...]


def known_schemas(spark: SparkSession, root: str) -> dict[str, Known]:
    """The latest schema of every dataset that has one."""
    rows = schema_history(spark, root).select("dataset", "version", "columns").collect()
    return {r.dataset: Known(r.version, tuple(r.columns)) for r in sorted(rows, key=lambda r: r.version)}


def known_schema(spark: SparkSession, root: str, layer: str, table: str, schemas: dict[str, Known] | None = None) -> Known:
    schemas = known_schemas(spark, root) if schemas is None else schemas
    return schemas.get(f"{layer}.{table}") or Known(0, tuple(FEED_SCHEMAS[table].fieldNames()))


def known_columns(spark: SparkSession, root: str, layer: str, table: str) -> list[str]:
    return list(known_schema(spark, root, layer, table).columns)


def grow_schema(
    spark: SparkSession, root: str, layer: str, table: str, batch_id: str, columns: Iterable[str], known: Known | None = None
) -> list[str]:
    """Columns of the table with those of a batch; a change is recorded."""
    known = known or known_schema(spark, root, layer, table)
    added = [c for c in columns if c not in known.columns]
    grown = [*known.columns, *added]
    if added or not known.version:
        row = (known.version + 1, batch_id, grown, added if known.version else grown, f"{layer}.{table}")
        _add(spark, root, "schema_history", HISTORY, [row])
    return grown


def stored_schema(columns: Iterable[str]) -> T.StructType:
    """Source columns as the text that came, the batch columns, and the load."""
    text = [*columns, *(c for c in BATCH_COLUMNS if c != "_ingestion_date")]
    fields = [*(T.StructField(c, T.StringType()) for c in text), T.StructField("_ingestion_date", T.DateType())]
    return T.StructType([*fields, T.StructField(LOAD_COLUMN, T.StringType())])


def store_load(
    spark: SparkSession, root: str, layer: str, table: str, stamped: DataFrame, batch: Batch, replaces: bool, known: Known | None = None
) -> int:
    """Store the rows of a batch as one load, and then enter it in the ledger; returns the number of rows."""
    load_id = uuid4().hex
    source = [c for c in stamped.columns if c not in BATCH_COLUMNS]
    columns = grow_schema(spark, root, layer, table, batch.batch_id, source, known)
    df = stamped.select(
        *[F.col(f"`{c}`") if c in source else F.lit(None).cast("string").alias(c) for c in columns],
        *(c for c in BATCH_COLUMNS if c not in _OF_THE_LOAD),
    )
    # all rows go to the one folder of the load, so nothing is sorted by partition before it is written
    names = {LOAD_COLUMN: load_id, "_ingestion_date": batch.ingestion_date, "_batch_id": batch.batch_id}
    folder = "/".join(partition_folder(c, v) for c, v in names.items())
    rows = write_table(df, f"{table_path(root, layer, table)}/{folder}", "append", rebalance=False)
    record_loads(spark, root, layer, table, [Load(batch.batch_id, load_id, rows)], batch.ingestion_date, [replaces])
    return rows


def read_loads(
    spark: SparkSession,
    root: str,
    layer: str,
    table: str,
    loads: Sequence[Load] | None = None,
    schemas: dict[str, Known] | None = None,
) -> DataFrame:
    """The rows of some loads, of all that count by default, with every column that any batch brought.

    Folders are taken from the ledger and columns from the schema history: files are neither listed beyond
    those folders nor opened for their schema. Days and batches are partitions within a load.
    """
    schema = stored_schema(known_schema(spark, root, layer, table, schemas).columns)
    path = table_path(root, layer, table)
    chosen = live_loads(spark, root, layer, table) if loads is None else loads
    folders = [f"{path}/{LOAD_COLUMN}={load.load_id}" for load in chosen if load.row_count]
    if not folders:
        return spark.createDataFrame([], schema).drop(LOAD_COLUMN)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).drop(LOAD_COLUMN)
