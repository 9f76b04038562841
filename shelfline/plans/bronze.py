"""Bronze layer: feeds stamped with their batch, the contract at the door."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.columns import as_declared
from shelfline.names import (
    FEED_SCHEMAS,
    INVENTORY_TABLE,
    MARKETPLACE_TABLE,
    REJECTS,
    STOREFRONT_TABLE,
)
from shelfline.operators.batches import Batch, add_batch_columns, clean_column_names, set_clashing_apart, with_distinct_names
from shelfline.operators.expectations import QualityFailure
from shelfline.operators.contract import (
    STOREFRONT_CONTRACT,
    Contract,
    ContractViolation,
    contract_gate,
    enforce,
)
from shelfline.plans.admission import (
    RULES,
    default_contract,
    frames_by_header,
    headers,
    route,
    store_rejects,
)
from shelfline.plans.lineage import COMPLETE, FAIL, START, JobLog
from shelfline.plans.quality import failed_checks
from shelfline.sources.feeds import read_text_feed
from shelfline.sources.ledger import Known, is_loaded, known_schema, known_schemas, store_load, stored_schema


def stamp(feed: DataFrame, source_system: str, batch: Batch) -> DataFrame:
    return add_batch_columns(clean_column_names(feed), source_system, batch.batch_id, batch.ingested_at)


def bronze_storefront(feed: DataFrame, batch: Batch, contract: Contract = STOREFRONT_CONTRACT) -> DataFrame:
    """Storefront batch; empty when the batch breaks its contract."""
    return stamp(contract_gate(clean_column_names(feed), contract), STOREFRONT_TABLE, batch)


def bronze_marketplace(feed: DataFrame, batch: Batch) -> DataFrame:
    return stamp(feed, MARKETPLACE_TABLE, batch)


def bronze_inventory(feed: DataFrame, batch: Batch) -> DataFrame:
    return stamp(feed, INVENTORY_TABLE, batch)


def arrived_on(bronze: DataFrame, day: str) -> DataFrame:
    """Replay: everything that arrived on ``day`` (one partition)."""
    return bronze.where(F.col("_ingestion_date") == F.lit(day).cast("date"))


def arrived_until(bronze: DataFrame, day: str) -> DataFrame:
    """The table as it stood at the end of ``day``."""
    return bronze.where(F.col("_ingestion_date") <= F.lit(day).cast("date"))


def as_arrived(feed: DataFrame, table: str) -> DataFrame:
    """Every source column as text; declared columns that did not come are null.

    Bronze keeps what came, readable or not. Types are given on the way to silver.
    """
    came = [F.col(f"`{c}`").cast("string").alias(c) for c in feed.columns]
    absent = [F.lit(None).cast("string").alias(c) for c in FEED_SCHEMAS[table].fieldNames() if c not in feed.columns]
    return feed.select(*came, *absent)


def _unreadable(text: DataFrame, table: str) -> dict[str, Column]:
    """Per declared column that is not text: rows whose text cannot be read as its type."""
    return {
        f.name: F.count_if(F.col(f.name).isNotNull() & F.expr(as_declared(text, f.name, f.dataType)).isNull())
        for f in FEED_SCHEMAS[table]
        if not isinstance(f.dataType, T.StringType)
    }


@dataclass
class IngestResult:
    """Rows written per table, values that cannot be read as their type, why tables or files were left out, and rows kept aside."""

    rows: dict[str, int] = field(default_factory=dict)
    unreadable: dict[str, dict[str, int]] = field(default_factory=dict)
    skipped: dict[str, str] = field(default_factory=dict)
    refused: dict[str, int] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)


RELOADS = ("append", "skip_loaded", "replace_batch")


def store_batch(
    spark: SparkSession, root: str, table: str, feed: DataFrame, batch: Batch, reload: str, result: IngestResult, known: Known
) -> None:
    """Store the rows of a batch in bronze and count what cannot be read."""
    text, lost = as_arrived(feed, table), Observation()
    counts = [n.alias(c) for c, n in _unreadable(text, table).items()]
    stamped = stamp(text.observe(lost, *counts), table, batch)
    result.rows[table] = store_load(spark, root, "bronze", table, stamped, batch, replaces=reload == "replace_batch", known=known)
    result.unreadable[table] = {c: n for c, n in lost.get.items() if n}


def ingest(
    spark: SparkSession,
    root: str,
    feeds: dict[str, str | DataFrame],
    batch: Batch | None = None,
    contract: Contract = STOREFRONT_CONTRACT,
    reload: str = "append",
    gate: bool = False,
    log: JobLog | None = None,
) -> IngestResult:
    """Write one batch of every feed into bronze, as text.

    ``feeds`` maps a table to a CSV path or to a frame. A missing path raises
    before anything is written. A storefront batch that breaks the contract is
    kept aside as a whole (``read_rejects``), and the other feeds go on. With ``gate`` each batch must pass the
    critical checks of its table, too: one that does not is kept aside before it can spoil the table, and
    ``QualityFailure`` is raised when the other feeds are stored.

    ``reload`` decides what a second run of a batch does: ``append`` stores it
    again, ``skip_loaded`` leaves it out, and ``replace_batch`` replaces what the
    same batch stored before, on whatever day, also by nothing. Other batches stay. A run that is
    lost before a load is in the ledger has stored nothing.
    """
    if reload not in RELOADS:
        raise ValueError(f"unknown reload mode: {reload}")
    batch = batch or Batch()
    texts = {t: read_text_feed(spark, f) if isinstance(f, str) else f for t, f in feeds.items()}
    result = IngestResult()
    failures: list[str] = []
    schemas = known_schemas(spark, root)
    for table, raw in texts.items():
        if reload == "skip_loaded" and is_loaded(spark, root, "bronze", table, batch.batch_id):
            result.skipped[table] = "already loaded"
            continue
        known = known_schema(spark, root, "bronze", table, schemas)
        feed = set_clashing_apart(with_distinct_names(raw, known.columns))
        if table == STOREFRONT_TABLE:
            try:
                result.warnings += enforce(feed, contract)["warnings"]
            except ContractViolation as violation:
                result.skipped[table] = str(violation)
        if gate and table not in result.skipped:
            failed = failed_checks(stamp(as_arrived(feed, table), table, batch), "bronze", table)
            if failed:
                failures.append(failed)
                result.skipped[table] = failed
        if table in result.skipped:
            result.refused[table] = store_rejects(spark, root, table, feed.withColumn(RULES, F.lit(result.skipped[table])), batch)
            continue
        source = [f"source.{table}_csv"]
        if log:
            log.add(START, f"bronze.{table}", source)
        try:
            store_batch(spark, root, table, feed, batch, reload, result, known)
        except BaseException:
            if log:
                log.add(FAIL, f"bronze.{table}", source)
            raise
        if log:
            log.add(COMPLETE, f"bronze.{table}", source, stored_schema(dict.fromkeys([*known.columns, *feed.columns])))
    if failures:
        raise QualityFailure("; ".join(failures))
    return result


def ingest_files(
    spark: SparkSession, root: str, table: str, lines: DataFrame, batch: Batch, contract: Contract | None = None
) -> IngestResult:
    """Load CSV files, each admitted or refused by itself, as one batch that replaces what it stored before.

    ``lines`` holds (file, value) of the files' first blocks. Columns are taken by the
    names in each file's own header. Rows of refused files are kept aside with the rules their file broke.
    """
    result = IngestResult()
    found = headers(lines)
    if not found:
        return result
    known = known_schema(spark, root, "bronze", table)
    frames = frames_by_header(spark, found, known.columns)
    admitted, refused, why = route(spark, frames, contract or default_contract(table), "admission")
    if why:
        result.skipped[table] = "; ".join(f"{file}: {rules}" for file, rules in sorted(why.items()))
    # a repeated load takes the place of the lost one before it, with fewer rejects as well
    if why or is_loaded(spark, root, REJECTS, table, batch.batch_id):
        result.refused[table] = store_rejects(spark, root, table, refused, batch)
    if len(why) < sum(map(len, found.values())):
        store_batch(spark, root, table, set_clashing_apart(admitted), batch, "replace_batch", result, known)
    return result
