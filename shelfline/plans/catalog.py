"""Catalog: databases per layer, tables over the stored files, summary."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.names import (
    BRONZE_TABLES,
    GOLD_TABLES,
    INVENTORY_TABLE,
    LOAD_COLUMN,
    MARKETPLACE_TABLE,
    PARTITION_COLUMN,
    SILVER_TABLES,
    STOREFRONT_TABLE,
    VERSION_COLUMN,
)
from shelfline.sources.ledger import known_columns, live_loads, stored_schema
from shelfline.sources.tables import as_columns, child_folders, table_path
from shelfline.sources.versions import find_version

LAYERS = {"bronze": BRONZE_TABLES, "silver": SILVER_TABLES, "gold": GOLD_TABLES}

COMMENTS = {
    STOREFRONT_TABLE: "Raw storefront orders, stored as they arrived",
    MARKETPLACE_TABLE: "Raw marketplace orders, stored as they arrived",
    INVENTORY_TABLE: "Raw warehouse inventory feed, stored as it arrived",
    "orders": "Orders of both channels, deduplicated",
    "customers": "Distinct customers of all channels",
    "products": "Distinct products of all sources",
    "inventory": "Newest stock position per inventory id",
    "revenue_mart": "Revenue, units and orders for each day, channel and status (Analytics Team)",
    "channel_performance_mart": "What each channel sold in a month, and to how many customers (Analytics Team)",
    "customer_360_mart": "All that a known customer bought so far (CRM Team)",
    "inventory_turnover_mart": "Units sold beside the stock of each warehouse (Supply Chain Team)",
}


#: Partitions that one statement adds or drops.
PARTITIONS_AT_ONCE = 500


def stored_columns(spark: SparkSession, root: str, layer: str, table: str) -> tuple[T.StructType, list[str]] | None:
    """Columns of a stored table with those that its folders add, and its partition columns; nothing if there is no such table."""
    by = as_columns(PARTITION_COLUMN[layer][table])
    if layer == "bronze":
        loads = live_loads(spark, root, layer, table)
        return (stored_schema(known_columns(spark, root, layer, table)), by) if loads else None
    version = find_version(spark, root)
    if version is None or f"{layer}.{table}" not in version.tables:
        return None
    schema = version.tables[f"{layer}.{table}"].schema
    return T.StructType([*schema.fields, T.StructField(VERSION_COLUMN, T.StringType())]), [VERSION_COLUMN, *by]


def live_partitions(spark: SparkSession, root: str, layer: str, table: str) -> set[str]:
    """Folders below the table that count: those of its live loads, or of its latest version."""
    if layer != "bronze":
        folders = find_version(spark, root).tables[f"{layer}.{table}"].folders
        # of a compacted partition, single files may count: its folders cannot be listed as a whole
        if any(f.endswith(".parquet") for f in folders):
            raise ValueError(f"{layer}.{table} holds single files of packed partitions; rebuild it to list it in the catalog")
        return set(folders)
    path = table_path(root, layer, table)
    loads = [f"{LOAD_COLUMN}={x.load_id}" for x in live_loads(spark, root, layer, table) if x.row_count]
    days = [f"{load}/{day}" for load in loads for day in child_folders(spark, f"{path}/{load}")]
    return {f"{day}/{batch}" for day in days for batch in child_folders(spark, f"{path}/{day}")}


def _spec(folder: str) -> str:
    """A folder such as ``a=1/b=2`` as a partition in SQL."""
    parts = []
    for part in folder.split("/"):
        name, _, value = part.partition("=")
        text = "'" + unquote(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
        parts.append(f"`{name}` = " + ("NULL" if value in ("__HIVE_DEFAULT_PARTITION__", "null") else text))
    return f"PARTITION ({', '.join(parts)})"


def _sync_partitions(spark: SparkSession, name: str, wanted: set[str], path: str) -> None:
    """Make the catalog list exactly the ``wanted`` folders."""
    listed = {r[0].replace("=null", "=__HIVE_DEFAULT_PARTITION__") for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    new, gone = sorted(wanted - listed), sorted(listed - wanted)
    for i in range(0, len(new), PARTITIONS_AT_ONCE):
        specs = " ".join(f"{_spec(f)} LOCATION '{path}/{f}'" for f in new[i : i + PARTITIONS_AT_ONCE])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")
    for i in range(0, len(gone), PARTITIONS_AT_ONCE):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(map(_spec, gone[i : i + PARTITIONS_AT_ONCE]))}")


def register(spark: SparkSession, root: str, prefix: str = "") -> None:
    """Create one database per layer and a table over each stored folder.

    Called again, it adds the columns that a table gained, and lists the loads and versions that count now.
    """
    for layer, tables in LAYERS.items():
        database = f"{prefix}{layer}"
        spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {database} COMMENT 'Retail {layer} layer' "
            f"LOCATION '{root}/_databases/{database}'"
        )
        for table in tables:
            found = stored_columns(spark, root, layer, table)
            if found is None:
                continue  # a feed that was never delivered
            schema, by = found
            path, name = table_path(root, layer, table), f"{database}.{table}"
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(by)}) "
                f"COMMENT '{COMMENTS[table]}' LOCATION '{path}'"
            )
            known = set(spark.table(name).columns)
            grown = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name not in known)
            if grown:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({grown})")
            _sync_partitions(spark, name, live_partitions(spark, root, layer, table), path)
            spark.catalog.refreshTable(name)


#: Databases of the bucketed copies, and the key of each table.
BUCKET_KEYS = {"orders": "product_id", "inventory": "product_id"}


def register_bucketed(spark: SparkSession, root: str, tables: dict[str, DataFrame], buckets: int, prefix: str = "") -> dict[str, DataFrame]:
    """Store silver tables bucketed and sorted by the key that the turnover mart joins them by.

    Both sides have the same number of buckets, so the aggregate and the join read them without a shuffle. The
    number should be that of ``spark.sql.shuffle.partitions`` or more, else Spark may prefer to shuffle.
    """
    database = f"{prefix}silver_bucketed"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/_databases/{database}'")
    for name, key in BUCKET_KEYS.items():
        writer = tables[name].repartition(buckets, key).write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key)
        writer.option("path", f"{root}/silver_bucketed/{name}").saveAsTable(f"{database}.{name}")
    return {name: spark.table(f"{database}.{name}") for name in BUCKET_KEYS}


def summary(spark: SparkSession, prefix: str = "") -> DataFrame:
    """Registered tables per layer."""
    shown = [
        spark.sql(f"SHOW TABLES IN {prefix}{layer}").select(
            F.lit(layer).alias("layer"), F.col("tableName").alias("table_name")
        )
        for layer in LAYERS
    ]
    return reduce(DataFrame.unionByName, shown)


def row_counts(spark: SparkSession, prefix: str = "") -> DataFrame:
    """Rows of every registered table, read through the catalog."""
    counts = [
        spark.table(f"{prefix}{layer}.{table}").agg(
            F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("row_count")
        )
        for layer, tables in LAYERS.items()
        for table in tables
        if spark.catalog.tableExists(f"{prefix}{layer}.{table}")
    ]
    return reduce(DataFrame.unionByName, counts)


def unregister(spark: SparkSession, prefix: str = "") -> None:
    """Drop the databases of :func:`register`; the stored files stay."""
    for layer in LAYERS:
        spark.sql(f"DROP DATABASE IF EXISTS {prefix}{layer} CASCADE")
