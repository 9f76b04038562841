"""Registered queries: name -> function of (spark, data folder).

Each one runs over the whole tables of the folder. Single results are one lazy
plan. Where several results need the same table, or the point is the stored
layout, tables are first written to a fresh folder below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.columns import as_int
from shelfline.names import (
    AS_OF_DAY,
    BATCH_COLUMNS,
    DRIFT_START,
    INVENTORY_TABLE,
    LATER_DAY,
    MARKETPLACE_FEED,
    MARKETPLACE_TABLE,
    MONTHS,
    PERIOD,
    REPLAY_DAY,
    STOREFRONT_TABLE,
)
from shelfline.operators.batches import Batch, clean_column_names
from shelfline.operators.contract import contract_gate, contract_report, drift_columns
from shelfline.operators.dedup import latest_per_key
from shelfline.operators.defects import (
    inject_duplicates,
    inject_late_arrivals,
    inject_nulls,
    inject_schema_drift,
)
from shelfline.operators.expectations import table_status
from shelfline.operators.integrity import late_arrival_profile, orphan_counts
from shelfline.plans import admission, bronze, catalog, gold, health, lineage, quality, runs, silver
from shelfline.sources import derived_feeds as derived
from shelfline.sources import ledger, versions
from shelfline.sources.compaction import compact_table
from shelfline.sources.feeds import sample_rows as first_rows
from shelfline.sources.feeds import typed_feed, write_feed
from shelfline.sources.tables import read_bronze, read_layer, read_table, write_layer, write_table
from shelfline.sources.workspace import new_run_root
from shelfline.sources.workspace import stored as _stored
from shelfline.streaming.file_drop import load_new_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BATCH = Batch("batch-1", "2024-01-31T00:00:00+00:00")
SECOND_BATCH = Batch("batch-2", "2024-01-31T06:00:00+00:00")


def query(function: Query) -> Query:
    """Register under the function's name; ``_query`` keeps it apart from an operator."""
    QUERIES[function.__name__.removesuffix("_query")] = function
    return function


def _now():
    return F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return silver.orders(*derived.raw_sales(spark, folder))


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return silver.customers(*derived.raw_sales(spark, folder)).drop("_created_at")


def _products(spark: SparkSession, folder: str) -> DataFrame:
    return silver.products(*derived.raw_feeds(spark, folder).values()).drop("_created_at")


def _inventory(spark: SparkSession, folder: str) -> DataFrame:
    return silver.inventory(derived.raw_inventory(spark, folder))


def _stored_feeds(spark: SparkSession, folder: str, root: str) -> dict[str, DataFrame]:
    return {t: _stored(spark, f, root, f"raw/{t}") for t, f in derived.raw_feeds(spark, folder).items()}


# feeds and their defects


@query
def inject_nulls_query(spark: SparkSession, folder: str) -> DataFrame:
    clean = derived.clean_storefront(spark, folder)
    return inject_nulls(clean, ["order_status", "customer_id"], derived.KEY).drop(derived.KEY)


@query
def inject_duplicates_query(spark: SparkSession, folder: str) -> DataFrame:
    return inject_duplicates(derived.clean_storefront(spark, folder), derived.KEY).drop(derived.KEY)


@query
def inject_late_arrivals_query(spark: SparkSession, folder: str) -> DataFrame:
    clean = derived.clean_marketplace(spark, folder)
    return inject_late_arrivals(clean, "order_timestamp", derived.KEY).drop(derived.KEY)


@query
def inject_schema_drift_query(spark: SparkSession, folder: str) -> DataFrame:
    return inject_schema_drift(derived.clean_storefront(spark, folder), derived.KEY).drop(derived.KEY)


@query
def sample_rows(spark: SparkSession, folder: str) -> DataFrame:
    order = ["order_id", "order_date", "revenue", "product_id"]
    return first_rows(derived.raw_storefront(spark, folder), order)


# bronze


@query
def clean_column_names_query(spark: SparkSession, folder: str) -> DataFrame:
    part = derived.table(spark, folder, "part")
    return clean_column_names(part.toDF(*[f"  {c} " for c in part.columns]))


@query
def bronze_storefront(spark: SparkSession, folder: str) -> DataFrame:
    return bronze.bronze_storefront(derived.raw_storefront(spark, folder), BATCH)


@query
def bronze_marketplace(spark: SparkSession, folder: str) -> DataFrame:
    return bronze.bronze_marketplace(derived.raw_marketplace(spark, folder), BATCH)


@query
def bronze_inventory(spark: SparkSession, folder: str) -> DataFrame:
    return bronze.bronze_inventory(derived.raw_inventory(spark, folder), BATCH)


@query
def bronze_replay(spark: SparkSession, folder: str) -> DataFrame:
    """What arrived on a day, from the stored tables of both order feeds: one partition of each is read."""
    root = new_run_root(spark, "replay")
    keys = {STOREFRONT_TABLE: "order_id", MARKETPLACE_TABLE: "marketplace_order_id"}
    shown = []
    for (table, key), feed in zip(keys.items(), derived.sales_history(spark, folder), strict=True):
        write_table(feed, f"{root}/{table}", partition_by="_ingestion_date")
        arrived = bronze.arrived_on(read_table(spark, f"{root}/{table}", schema=feed.schema), REPLAY_DAY)
        shown.append(
            arrived.select(
                F.lit(table).alias("feed"), F.col(key).alias("line_id"), "customer_id", F.col("quantity").cast("string").alias("quantity"), "_batch_id", "_ingestion_date"
            )
        )
    return reduce(DataFrame.unionByName, shown)


@query
def bronze_schema_evolution(spark: SparkSession, folder: str) -> DataFrame:
    """Batches before a day lack the promo column, later ones have it."""
    path = f"{new_run_root(spark, 'evolution')}/bronze"
    feed = derived.raw_storefront(spark, folder)
    started = F.col("order_date") >= F.lit(DRIFT_START).cast("date")
    write_table(feed.where(~started).drop("promo_code_applied"), path, mode="append")
    write_table(feed.where(started), path, mode="append")
    return read_table(spark, path, schema=feed.schema)


@query
def idempotent_reload(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches of one day, each loaded twice under each reload mode."""
    root = new_run_root(spark, "reload")
    feed = _stored(spark, derived.raw_marketplace(spark, folder), root, "raw")
    counts = []
    for mode in bronze.RELOADS:
        for batch in (BATCH, SECOND_BATCH, BATCH, SECOND_BATCH):
            bronze.ingest(spark, f"{root}/{mode}", {MARKETPLACE_TABLE: feed}, batch, reload=mode)
        stored = read_bronze(spark, f"{root}/{mode}", MARKETPLACE_TABLE)
        counts.append(stored.agg(F.lit(mode).alias("reload"), F.count(F.lit(1)).alias("row_count")))
    return reduce(DataFrame.unionByName, counts)


@query
def batch_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Under each reload mode: a batch loaded before and after midnight, another one replaced by nothing, and one that was lost
    before it got into the ledger and came again."""
    root = new_run_root(spark, "ledger")
    feed = _stored(spark, derived.raw_marketplace(spark, folder), root, "raw")
    late = F.col("order_timestamp") >= F.lit(DRIFT_START).cast("timestamp")
    shown = []
    for mode in bronze.RELOADS:
        place = f"{root}/{mode}"

        def load(batch_id: str, at: str, rows: DataFrame, reload: str = mode) -> None:
            bronze.ingest(spark, place, {MARKETPLACE_TABLE: rows}, Batch(batch_id, at), reload=reload)

        load("night", "2024-01-30T23:59:00+00:00", feed)
        load("night", "2024-01-31T00:01:00+00:00", feed.where(~late))
        load("emptied", "2024-01-31T01:00:00+00:00", feed)
        load("emptied", "2024-02-01T01:00:00+00:00", feed.where("false"), "replace_batch")
        # rows of a run that was lost: they are stored, but no ledger row names them
        text = bronze.stamp(bronze.as_arrived(feed, MARKETPLACE_TABLE), MARKETPLACE_TABLE, Batch("lost", BATCH.ingested_at))
        write_table(
            text.withColumn("_load_id", F.lit("lost")), f"{place}/bronze/{MARKETPLACE_TABLE}", "append",
            ("_load_id", "_ingestion_date", "_batch_id"), rebalance=False,
        )
        load("lost", "2024-01-31T02:00:00+00:00", feed.where(late))
        entries = ledger.batch_ledger(spark, place).groupBy("batch_id").agg(
            F.count(F.lit(1)).alias("loads"), F.count_if("is_live").alias("live_loads")
        )
        rows = read_bronze(spark, place, MARKETPLACE_TABLE).groupBy(F.col("_batch_id").alias("batch_id")).agg(
            F.count(F.lit(1)).alias("row_count"), F.countDistinct("_ingestion_date").alias("days")
        )
        shown.append(entries.join(rows, "batch_id", "left").fillna(0, ["row_count", "days"]).withColumn("reload", F.lit(mode)))
    return reduce(DataFrame.unionByName, shown)


@query
def bronze_odd_headers(spark: SparkSession, folder: str) -> DataFrame:
    """A feed with nothing but a header, then one whose header has other case, blanks, a batch column's name and a new column."""
    root = new_run_root(spark, "headers")
    feed = derived.raw_inventory(spark, folder)
    write_feed(feed.where("false"), f"{root}/empty")
    odd = feed.select(
        F.col("inventory_id").alias("Inventory_ID"), F.col("product_id").alias(" PRODUCT_ID "), "warehouse_id", "quantity_available",
        "quantity_reserved", "last_updated", F.concat(F.lit("theirs-"), "inventory_id").alias("_batch_id"), F.col("warehouse_id").alias("shelf.no"),
    )
    write_feed(odd, f"{root}/odd")
    empty = runs.run_layers(spark, root, {INVENTORY_TABLE: f"{root}/empty"}, BATCH)
    bronze.ingest(spark, root, {INVENTORY_TABLE: f"{root}/odd"}, SECOND_BATCH)
    history = ledger.schema_history(spark, root).where("version > 1")
    return read_bronze(spark, root, INVENTORY_TABLE).select(
        "inventory_id", "product_id", "_batch_id", "source_batch_id", F.col("`shelf.no`").alias("shelf_no"),
        F.lit(empty.rows["bronze"][INVENTORY_TABLE]).cast("long").alias("rows_of_the_empty_feed"),
        history.agg(F.max(F.array_join("added", ","))).scalar().alias("added"),
    )


def _drop_storefront(feed: DataFrame, path: str) -> None:
    """Files of three kinds, each written where its rows are: no task gathers the rows of a kind."""
    day = F.dayofmonth("order_date")
    files = {
        "good": feed.where(day <= 20),
        "without_quantity": feed.where(day.between(21, 25)).withColumn("quantity", F.lit(0)),
        "without_customers": feed.where(day > 25).drop("customer_id"),
    }
    for name, rows in files.items():
        rows.withColumn("kind", F.lit(name)).write.mode("append").option("header", "true").csv(path)


@query
def file_drop_mixed(spark: SparkSession, folder: str) -> DataFrame:
    """Good and bad storefront files dropped together, and the drop read twice: what is in bronze and what in the rejects."""
    root = new_run_root(spark, "mixed")
    feed = _stored(spark, derived.raw_storefront(spark, folder), root, "raw")
    _drop_storefront(feed, f"{root}/drop")
    for _ in range(2):
        load_new_files(spark, f"{root}/drop", STOREFRONT_TABLE, root, f"{root}/checkpoint", BATCH)
    loaded = read_bronze(spark, root, STOREFRONT_TABLE).withColumn("_rules", F.lit(""))
    refused = admission.read_rejects(spark, root, STOREFRONT_TABLE)
    counts = [
        rows.groupBy("kind", F.col("_rules").alias("rules")).agg(F.lit(place).alias("place"), F.count(F.lit(1)).alias("row_count"))
        for place, rows in (("bronze", loaded), ("rejects", refused))
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def file_drop_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Dropped files are loaded once: the second call finds nothing new."""
    root = new_run_root(spark, "drop")
    write_feed(derived.raw_marketplace(spark, folder), f"{root}/drop")
    for _ in range(2):
        load_new_files(spark, f"{root}/drop", MARKETPLACE_TABLE, root, f"{root}/checkpoint", BATCH)
    columns = [*MARKETPLACE_FEED.fieldNames(), *BATCH_COLUMNS]
    return typed_feed(read_bronze(spark, root, MARKETPLACE_TABLE), MARKETPLACE_FEED).select(*columns)


def _drop_dirty_inventory(spark: SparkSession, folder: str, path: str) -> None:
    """Inventory as CSV text: reserved figures such as ``79.0``, some that cannot be read, some empty."""
    reserved = F.when(F.substring("inventory_id", 5, 9).cast("int") % 7 == 0, "n/a").when(
        F.col("quantity_reserved").isNotNull(), F.concat(F.col("quantity_reserved").cast("string"), F.lit(".0"))
    )
    text = derived.raw_inventory(spark, folder).withColumns(
        {"quantity_reserved": reserved, "last_updated": F.date_format("last_updated", "yyyy-MM-dd HH:mm:ss")}
    )
    write_feed(text, path)


@query
def bronze_from_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Text stays as it came, is counted where it cannot be read, and is read on the way to silver."""
    root = new_run_root(spark, "csv")
    _drop_dirty_inventory(spark, folder, f"{root}/in")
    result = bronze.ingest(spark, root, {INVENTORY_TABLE: f"{root}/in"}, BATCH)
    kept = read_bronze(spark, root, INVENTORY_TABLE)
    return kept.selectExpr(
        "inventory_id", "product_id", "warehouse_id", "quantity_available", "quantity_reserved AS reserved_text",
        "last_updated", f"{as_int(kept, 'quantity_reserved')} AS reserved_read",
        f"{result.unreadable[INVENTORY_TABLE].get('quantity_reserved', 0)}L AS unreadable",
    )


@query
def file_drop_inventory(spark: SparkSession, folder: str) -> DataFrame:
    root = new_run_root(spark, "drop")
    _drop_dirty_inventory(spark, folder, f"{root}/in")
    load_new_files(spark, f"{root}/in", INVENTORY_TABLE, root, f"{root}/checkpoint", BATCH)
    return silver.inventory(read_bronze(spark, root, INVENTORY_TABLE))


@query
def stream_then_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Dropped files and a batch share a table."""
    root = new_run_root(spark, "both")
    feed = _stored(spark, derived.raw_marketplace(spark, folder), root, "raw")
    write_feed(feed, f"{root}/in")
    load_new_files(spark, f"{root}/in", MARKETPLACE_TABLE, root, f"{root}/checkpoint", BATCH)
    bronze.ingest(spark, root, {MARKETPLACE_TABLE: feed}, SECOND_BATCH)
    return read_bronze(spark, root, MARKETPLACE_TABLE).groupBy("_batch_id").agg(F.count(F.lit(1)).alias("row_count"))


@query
def schema_growth(spark: SparkSession, folder: str) -> DataFrame:
    """A batch without the status column, then one with a new column: both are seen in silver and in the catalog."""
    root = new_run_root(spark, "growth")
    feed = _stored(spark, derived.raw_storefront(spark, folder), root, "raw")
    later = F.col("order_date") >= F.lit(DRIFT_START).cast("date")
    prefix = f"grown_{root[-8:]}_"
    for part, batch in ((feed.where(~later).drop("order_status", "promo_code_applied"), BATCH), (feed.where(later), SECOND_BATCH)):
        bronze.ingest(spark, root, {STOREFRONT_TABLE: part}, batch)
        catalog.register(spark, root, prefix)
    orders = silver.orders(read_bronze(spark, root, STOREFRONT_TABLE), read_bronze(spark, root, MARKETPLACE_TABLE))
    seen = spark.table(f"{prefix}bronze.{STOREFRONT_TABLE}").groupBy("_batch_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("order_status").alias("with_status"),
        F.count("promo_code_applied").alias("with_promo"),
    )
    counted = orders.agg(F.count(F.lit(1)).alias("silver_orders"))
    result = _stored(spark, seen.withColumn("silver_orders", counted.scalar()), root, "seen")
    catalog.unregister(spark, prefix)
    return result


# contract


@query
def contract_report_clean(spark: SparkSession, folder: str) -> DataFrame:
    return contract_report(derived.raw_storefront(spark, folder)).drop("message")


@query
def contract_report_dirty(spark: SparkSession, folder: str) -> DataFrame:
    return contract_report(derived.broken_storefront(spark, folder)).drop("message")


@query
def contract_gate_query(spark: SparkSession, folder: str) -> DataFrame:
    batches = {
        "clean": derived.raw_storefront(spark, folder),
        "broken": derived.broken_storefront(spark, folder),
    }
    counts = [
        feed.agg(F.count(F.lit(1)).alias("rows_in")).select(
            F.lit(name).alias("batch"),
            "rows_in",
            contract_gate(feed).agg(F.count(F.lit(1))).scalar().alias("rows_out"),
        )
        for name, feed in batches.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def schema_drift_columns(spark: SparkSession, folder: str) -> DataFrame:
    return drift_columns(derived.raw_storefront(spark, folder))


# silver


@query
def conform_storefront(spark: SparkSession, folder: str) -> DataFrame:
    return silver.conform_storefront(derived.raw_storefront(spark, folder))


@query
def conform_marketplace(spark: SparkSession, folder: str) -> DataFrame:
    return silver.conform_marketplace(derived.raw_marketplace(spark, folder))


@query
def dedup_latest(spark: SparkSession, folder: str) -> DataFrame:
    ties = ["revenue", "quantity", "product_id", "customer_id", "order_status", "promo_code_applied"]
    return latest_per_key(derived.raw_storefront(spark, folder), ["order_id"], "order_date", ties)


@query
def silver_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _orders(spark, folder)


@query
def silver_customers(spark: SparkSession, folder: str) -> DataFrame:
    return _customers(spark, folder)


@query
def silver_products(spark: SparkSession, folder: str) -> DataFrame:
    return _products(spark, folder)


@query
def silver_inventory(spark: SparkSession, folder: str) -> DataFrame:
    return _inventory(spark, folder)


@query
def silver_period(spark: SparkSession, folder: str) -> DataFrame:
    """A business period of the stored table: only its day partitions are read."""
    root = new_run_root(spark, "period")
    write_layer(_orders(spark, folder), root, "silver", "orders")
    return silver.in_period(read_layer(spark, root, "silver", "orders"), *PERIOD)


def _two_versions(spark: SparkSession, folder: str, label: str) -> tuple[str, runs.RunResult]:
    """A run over what arrived until a day, and one over what arrived in the month after it, late rows included."""
    root = new_run_root(spark, label)
    history = zip((STOREFRONT_TABLE, MARKETPLACE_TABLE), derived.sales_history(spark, folder), strict=True)
    feeds = {t: _stored(spark, feed, root, f"raw/{t}") for t, feed in history}
    until, after = F.lit(AS_OF_DAY).cast("date"), F.lit(LATER_DAY).cast("date")
    arrived = F.col("_ingestion_date")
    first = {t: feed.where(arrived <= until).drop(*BATCH_COLUMNS) for t, feed in feeds.items()}
    second = {t: feed.where((arrived > until) & (arrived <= after)).drop(*BATCH_COLUMNS) for t, feed in feeds.items()}
    first[INVENTORY_TABLE] = derived.raw_inventory(spark, folder)
    runs.run_layers(spark, root, first, Batch("until", f"{AS_OF_DAY}T23:00:00+00:00"), _now(), gates=False)
    return root, runs.run_layers(spark, root, second, Batch("after", f"{LATER_DAY}T23:00:00+00:00"), _now())


@query
def silver_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Silver orders as they were at the end of a day, from the bronze that was stored until then: later days are not read."""
    root = new_run_root(spark, "as-of")
    seen = []
    for table, feed in zip((STOREFRONT_TABLE, MARKETPLACE_TABLE), derived.sales_history(spark, folder), strict=True):
        # months of arrival as folders: one per day is too fine for tables of this size
        path = f"{root}/{table}"
        write_table(feed.withColumn("_ingestion_month", F.date_format("_ingestion_date", "yyyy-MM")), path, partition_by="_ingestion_month")
        schema = T.StructType([*feed.schema.fields, T.StructField("_ingestion_month", T.StringType())])
        arrived = read_table(spark, path, schema=schema).where(F.col("_ingestion_month") <= AS_OF_DAY[:7])
        seen.append(bronze.arrived_until(arrived, AS_OF_DAY))
    return silver.orders(*seen)


@query
def silver_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Silver orders by version: as published on a day, before a later run, and now."""
    root, _ = _two_versions(spark, folder, "versions")
    shown = [
        versions.read_version(spark, root, "silver", "orders", **which).withColumn("version", F.lit(name))
        for name, which in (("as_of", {"day": AS_OF_DAY}), ("latest", {}))
    ]
    return reduce(DataFrame.unionByName, shown).groupBy("version", "channel", F.date_format("order_date", "yyyy-MM").alias("order_month")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("quantity").alias("units")
    )


def _differing(one: DataFrame, other: DataFrame) -> DataFrame:
    """Rows that one table has more often than the other, in one shuffle of both."""
    sides = one.withColumn("_n", F.lit(1)).unionByName(other.withColumn("_n", F.lit(-1)))
    apart = sides.groupBy(*one.columns).agg(F.abs(F.sum("_n")).alias("_n"))
    return apart.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("differing_rows"))


@query
def incremental_rebuild(spark: SparkSession, folder: str) -> DataFrame:
    """After a second batch with late rows: rows of every table, rows that differ from a whole rebuild, and partitions written."""
    root, result = _two_versions(spark, folder, "rebuild")
    changed = {n: read for n, read in ((n, versions.read_version(spark, root, *n.split("."))) for n in result.version.tables)}
    whole = runs.build_version(spark, root, Batch("whole", f"{LATER_DAY}T23:30:00+00:00"), _now(), gates=False, whole=True)
    by_day = ("silver.orders", "gold.revenue_mart", "gold.channel_performance_mart")
    shown = []
    for name, state in whole.version.tables.items():
        again = versions.read_version(spark, root, *name.split(".")).drop("_created_at")
        own = changed[name].drop("_created_at")
        shown.append(
            _differing(own, again).select(
                F.lit(name).alias("dataset"),
                F.lit(state.rows).cast("long").alias("row_count"),
                "differing_rows",
                F.lit(len(result.rebuilt[name]) if name in by_day else None).cast("long").alias("written_partitions"),
            )
        )
    return reduce(DataFrame.unionByName, shown)


# gold


@query
def revenue_mart(spark: SparkSession, folder: str) -> DataFrame:
    return gold.revenue_mart(_orders(spark, folder))


@query
def channel_performance_mart(spark: SparkSession, folder: str) -> DataFrame:
    return gold.channel_performance_mart(_orders(spark, folder)).orderBy("order_month", "channel")


@query
def customer_360_mart(spark: SparkSession, folder: str) -> DataFrame:
    root = new_run_root(spark, "customers")
    feeds = zip((STOREFRONT_TABLE, MARKETPLACE_TABLE), derived.raw_sales(spark, folder), strict=True)
    sales = [_stored(spark, feed, root, table) for table, feed in feeds]
    return gold.customer_360_mart(silver.orders(*sales), silver.customers(*sales).drop("_created_at"))


@query
def money_extremes(spark: SparkSession, folder: str) -> DataFrame:
    """The revenue mart over amounts below a cent, negative ones, very large ones and such as no decimal holds."""
    amounts = {
        0: ("tenths of a cent", "0.004D"),
        1: ("very large", "18014398509481984D"),
        2: ("beyond the decimal", "1.2676506002282294e30D"),
        3: ("negative", "-0.004D"),
    }
    kind = "CASE " + " ".join(f"WHEN o_orderkey % 4 = {k} THEN '{name}'" for k, (name, _) in amounts.items()) + " END"
    amount = "CASE " + " ".join(f"WHEN o_orderkey % 4 = {k} THEN {value}" for k, (_, value) in amounts.items()) + " END"
    orders = derived.table(spark, folder, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS order_id", "DATE '2024-01-01' AS order_date", "'shopify' AS channel",
        f"{kind} AS order_status", "1 AS quantity", f"{amount} AS revenue",
    )
    return gold.revenue_mart(orders)


@query
def inventory_turnover_mart(spark: SparkSession, folder: str) -> DataFrame:
    return gold.inventory_turnover_mart(_inventory(spark, folder), _orders(spark, folder))


@query
def gold_period(spark: SparkSession, folder: str) -> DataFrame:
    root = new_run_root(spark, "period")
    write_layer(gold.revenue_mart(_orders(spark, folder)), root, "gold", "revenue_mart")
    return gold.in_months(read_layer(spark, root, "gold", "revenue_mart"), *MONTHS)


@query
def channel_mom(spark: SparkSession, folder: str) -> DataFrame:
    return gold.month_over_month(gold.channel_performance_mart(_orders(spark, folder)))


# quality


@query
def dq_bronze_storefront(spark: SparkSession, folder: str) -> DataFrame:
    stamped = bronze.stamp(derived.raw_storefront(spark, folder), STOREFRONT_TABLE, BATCH)
    return quality.check_table(stamped, "bronze", STOREFRONT_TABLE)


@query
def dq_bronze_marketplace(spark: SparkSession, folder: str) -> DataFrame:
    stamped = bronze.bronze_marketplace(derived.raw_marketplace(spark, folder), BATCH)
    return quality.check_table(stamped, "bronze", MARKETPLACE_TABLE)


@query
def dq_bronze_inventory(spark: SparkSession, folder: str) -> DataFrame:
    stamped = bronze.bronze_inventory(derived.raw_inventory(spark, folder), BATCH)
    return quality.check_table(stamped, "bronze", INVENTORY_TABLE)


@query
def dq_silver_orders(spark: SparkSession, folder: str) -> DataFrame:
    stored = _stored(spark, _orders(spark, folder), new_run_root(spark, "suite"), "orders")
    return quality.check_table(stored, "silver", "orders")


@query
def dq_silver_customers(spark: SparkSession, folder: str) -> DataFrame:
    return quality.check_table(_customers(spark, folder), "silver", "customers")


@query
def dq_silver_products(spark: SparkSession, folder: str) -> DataFrame:
    return quality.check_table(_products(spark, folder), "silver", "products")


@query
def dq_silver_inventory(spark: SparkSession, folder: str) -> DataFrame:
    return quality.check_table(_inventory(spark, folder), "silver", "inventory")


@query
def dq_status(spark: SparkSession, folder: str) -> DataFrame:
    """Status of all bronze and silver tables, from feeds stored once."""
    root = new_run_root(spark, "status")
    feeds = _stored_feeds(spark, folder, root)
    storefront, marketplace, stock = feeds.values()
    stamped = {t: bronze.stamp(f, t, BATCH) for t, f in feeds.items()}
    tables = {
        "orders": silver.orders(storefront, marketplace),
        "customers": silver.customers(storefront, marketplace),
        "products": silver.products(storefront, marketplace, stock),
        "inventory": silver.inventory(stock),
    }
    results = quality.check_layer(stamped, "bronze").unionByName(quality.check_layer(tables, "silver"))
    return table_status(results)


@query
def dq_gold_nonempty(spark: SparkSession, folder: str) -> DataFrame:
    root = new_run_root(spark, "marts")
    orders = _stored(spark, _orders(spark, folder), root, "orders")
    return quality.gold_nonempty(
        {
            "revenue_mart": gold.revenue_mart(orders),
            "channel_performance_mart": gold.channel_performance_mart(orders),
            "customer_360_mart": gold.customer_360_mart(orders, _customers(spark, folder)),
            "inventory_turnover_mart": gold.inventory_turnover_mart(_inventory(spark, folder), orders),
        }
    )


@query
def referential_orphans(spark: SparkSession, folder: str) -> DataFrame:
    root = new_run_root(spark, "orphans")
    storefront, marketplace, stock = _stored_feeds(spark, folder, root).values()
    orders = _stored(spark, silver.orders(storefront, marketplace), root, "orders")
    customers = silver.customers(storefront, marketplace)
    products = _stored(spark, silver.products(storefront, marketplace, stock), root, "products")
    inventory = silver.inventory(stock)
    checks = [
        orphan_counts(orders, customers, "customer_id", "orders.customer_id -> customers"),
        orphan_counts(orders, products, "product_id", "orders.product_id -> products"),
        orphan_counts(orders, inventory, "product_id", "orders.product_id -> inventory"),
        orphan_counts(inventory, products, "product_id", "inventory.product_id -> products"),
    ]
    return reduce(DataFrame.unionByName, checks)


@query
def late_arrival_profile_query(spark: SparkSession, folder: str) -> DataFrame:
    storefront, marketplace = derived.sales_history(spark, folder)
    marketplace = marketplace.withColumn("order_date", F.to_date("order_timestamp"))
    profiles = [
        late_arrival_profile(feed, "order_date").withColumn("feed", F.lit(table))
        for table, feed in ((STOREFRONT_TABLE, storefront), (MARKETPLACE_TABLE, marketplace))
    ]
    return reduce(DataFrame.unionByName, profiles)


# run health


@query
def run_status_24h(spark: SparkSession, folder: str) -> DataFrame:
    return health.run_status(derived.run_log(spark, folder), _now())


@query
def run_duration_7d(spark: SparkSession, folder: str) -> DataFrame:
    return health.run_durations(derived.run_log(spark, folder), _now())


@query
def runs_success_total(spark: SparkSession, folder: str) -> DataFrame:
    return health.runs_in_state(derived.run_log(spark, folder), "success")


@query
def runs_failed_total(spark: SparkSession, folder: str) -> DataFrame:
    return health.runs_in_state(derived.run_log(spark, folder), "failed")


# lineage and catalog


@query
def lineage_events(spark: SparkSession, folder: str) -> DataFrame:
    """Event log with one finished run per row of ``events``."""
    events = derived.table(spark, folder, "events")
    fields = ", ".join(
        f"named_struct('name', '{f.name}', 'type', '{f.dataType.simpleString().upper()}')" for f in events.schema
    )
    return events.select(
        "event_id",
        lineage.event_json(
            run_id=F.expr("concat('run-', event_id)"),
            parent_run_id=F.expr("concat('day-', date_format(ts, 'yyyy-MM-dd'))"),
            event_time=F.expr("concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), '+00:00')"),
            job=F.col("event_type"),
            inputs=F.expr("array(concat('src.', event_type), concat('u', user_id))"),
            output=F.expr("concat('out.', event_type)"),
            fields=F.expr(f"array({fields})"),
        ).alias("event"),
    )


@query
def lineage_edges(spark: SparkSession, folder: str) -> DataFrame:
    return lineage.lineage_edges(lineage_events(spark, folder))


@query
def lineage_fields(spark: SparkSession, folder: str) -> DataFrame:
    return lineage.lineage_fields(lineage_events(spark, folder))


def _full_run(spark: SparkSession, folder: str, label: str) -> tuple[str, runs.RunResult]:
    root = new_run_root(spark, label)
    return root, runs.run_layers(spark, root, derived.raw_feeds(spark, folder), BATCH)


@query
def layer_run_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows written per table by a whole run, as counted by the writes."""
    _, result = _full_run(spark, folder, "run")
    return spark.createDataFrame(result.counts(), "layer string, table_name string, row_count bigint")


@query
def layer_run_lineage(spark: SparkSession, folder: str) -> DataFrame:
    """Edges of a whole run from its event log, with the rows of each output."""
    root, result = _full_run(spark, folder, "lineage")
    log = read_table(spark, runs.log_lineage(spark, root, result, "run-1", BATCH.ingested_at))
    written = spark.createDataFrame(
        [(f"{layer}.{table}", n) for layer, table, n in result.counts()], "output string, output_rows bigint"
    )
    return lineage.lineage_edges(log).join(written, "output", "left")


@query
def layer_run_skipped(spark: SparkSession, folder: str) -> DataFrame:
    """A run on a new root whose storefront breaks its contract: rows and events of what was written."""
    root = new_run_root(spark, "skipped")
    lines = derived.stored_lines(spark, folder, root)
    feeds = derived.raw_feeds(spark, folder, lines) | {STOREFRONT_TABLE: derived.broken_storefront(spark, folder, lines)}
    result = runs.run_layers(spark, root, feeds, BATCH)
    log = read_table(spark, runs.log_lineage(spark, root, result, "run-1", BATCH.ingested_at))
    written = spark.createDataFrame(result.counts(), "layer string, table_name string, row_count bigint")
    events = lineage.lineage_edges(log).groupBy("output").agg(F.max("run_count").alias("events"))
    return written.join(events, F.expr("concat(layer, '.', table_name) = output"), "full").drop("output")


@query
def catalog_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Registered tables of a whole run, counted through the catalog."""
    root, _ = _full_run(spark, folder, "catalog")
    prefix = f"run_{root[-8:]}_"
    catalog.register(spark, root, prefix)
    counted = catalog.row_counts(spark, prefix).join(catalog.summary(spark, prefix), ["layer", "table_name"])
    result = _stored(spark, counted, root, "summary")
    catalog.unregister(spark, prefix)
    return result


# layout of stored tables


@query
def compact_partition(spark: SparkSession, folder: str) -> DataFrame:
    """The revenue mart published in many small files, packed into few per month: files and rows before and after."""
    root = new_run_root(spark, "compact")
    mart = gold.revenue_mart(_orders(spark, folder))
    by_day = mart.repartition(6, F.dayofmonth("order_date") % 6)
    state = versions.write_version(spark, root, "gold", "revenue_mart", by_day, 1, rebalance=False)
    versions.publish(spark, root, versions.Version(1, "2024-01-31", "b", {"gold.revenue_mart": state}))
    packed, report = compact_table(spark, root, "gold", "revenue_mart", "2024-01-31")
    rows = versions.read_version(spark, root, "gold", "revenue_mart").groupBy("order_month").agg(F.count(F.lit(1)).alias("row_count"))
    return report.select(
        F.regexp_extract("partition", "order_month=(.*)", 1).alias("order_month"),
        "files_after",
        (F.col("files_before") >= F.col("files_after")).alias("no_more_files"),
        F.col("rows_files_before").alias("rows_before"),
    ).join(rows, "order_month", "full")


@query
def turnover_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The turnover mart from silver tables that are bucketed by product: neither side is shuffled."""
    root = new_run_root(spark, "bucketed")
    prefix = f"b_{root[-8:]}_"
    tables = {"orders": _orders(spark, folder), "inventory": _inventory(spark, folder)}
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucketed = catalog.register_bucketed(spark, root, tables, buckets, prefix)
    result = _stored(spark, gold.inventory_turnover_mart(bucketed["inventory"], bucketed["orders"]), root, "mart")
    spark.sql(f"DROP DATABASE IF EXISTS {prefix}silver_bucketed CASCADE")
    return result


@query
def quarter_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers per quarter from monthly sketches beside the exact count, and whether they agree within the stated error."""
    orders = _stored(spark, _orders(spark, folder), new_run_root(spark, "sketches"), "orders")
    estimated = gold.quarter_customers(gold.channel_customers(orders))
    quarter = F.concat(F.year("order_date"), F.lit("-Q"), F.quarter("order_date")).alias("quarter")
    exact = orders.groupBy(quarter, "channel").agg(F.countDistinct("customer_id").alias("unique_customers"))
    within = F.abs(F.col("estimated_customers") - F.col("unique_customers")) <= F.ceil(F.col("unique_customers") * gold.SKETCH_ERROR)
    return exact.join(estimated, ["quarter", "channel"], "full").select("quarter", "channel", "unique_customers", within.alias("within_error"))
