"""File sizes of a published table, and the packing of its small files into fewer.

Only files below half the target are read and written again, and only where a partition has several of them. They are dealt
to groups of about the target size; each group becomes a file of a new version's folder. All other
files stay where they are and are named again by the new version, which is published like any other, so readers
see the same rows before and after.
"""

from __future__ import annotations

from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline.names import PARTITION_COLUMN, VERSION_COLUMN
from shelfline.sources.tables import as_columns, child_folders, table_path, write_table
from shelfline.sources.versions import TableState, Version, find_version, publish, scan_state
from shelfline.sources.workspace import new_run_root, stored

TARGET_BYTES = 128 << 20


def file_sizes(spark: SparkSession, root: str, layer: str, table: str, state: TableState) -> DataFrame:
    """One row per file: its address, size, number of rows and partition (such as ``order_month=2024-01``)."""
    files = (
        scan_state(spark, root, layer, table, state)
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
        .groupBy("file", "bytes")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    place = F.regexp_extract("file", f"/{VERSION_COLUMN}=[^/]*/(?:(.*)/)?[^/]*$", 1)
    return files.withColumn("partition", place)


def packing_plan(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """The files to write again and the group (of their partition) that each goes to."""
    small = files.where(F.col("bytes") < target_bytes / 2)
    in_order = Window.partitionBy("partition").orderBy("bytes", "file")
    reached = F.sum("bytes").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    several = F.count(F.lit(1)).over(Window.partitionBy("partition")) > 1
    return (
        small.withColumn("several", several)
        .withColumn("pack", F.floor(F.coalesce(reached, F.lit(0)) / target_bytes))
        .where("several")
        .drop("several")
    )


def compact_table(
    spark: SparkSession, root: str, layer: str, table: str, day: str, target_bytes: int = TARGET_BYTES
) -> tuple[Version, DataFrame]:
    """Pack the small files of a published table and publish the result as a new version.

    Returns that version and a report: files before and after and rows written again, per partition.
    """
    last = find_version(spark, root)
    state = last.tables[f"{layer}.{table}"]
    scratch = new_run_root(spark, "compaction")
    before = stored(spark, file_sizes(spark, root, layer, table, state), scratch, "files")
    plan = stored(spark, packing_plan(before, target_bytes), scratch, "plan")
    chosen = {r.file for r in plan.select("file").collect()}
    tables = dict(last.tables)
    number = last.number + 1
    if chosen:
        path = table_path(root, layer, table)
        own = f"{VERSION_COLUMN}={number:08d}"
        relative = {f: unquote(urlsplit(f).path).rsplit(f"/{layer}/{table}/", 1)[1] for f in (r.file for r in before.select("file").collect())}
        old = TableState(sorted(relative[f] for f in chosen), state.schema, 0)
        rows = scan_state(spark, root, layer, table, old).withColumn("file", F.col("_metadata.file_path"))
        packs = plan.select("file", "pack", "partition")
        grouped = rows.join(F.broadcast(packs), "file").repartition(max(1, packs.select("partition", "pack").distinct().count()), "partition", "pack")
        by = as_columns(PARTITION_COLUMN[layer][table])
        write_table(grouped.select(*state.schema.fieldNames()), f"{path}/{own}", "overwrite", by, rebalance=False)
        new = [f"{own}/{f}" for f in child_folders(spark, f"{path}/{own}")] if by else [own]
        kept = [place for f, place in relative.items() if f not in chosen]
        tables[f"{layer}.{table}"] = TableState(sorted(kept + new), state.schema, state.rows)
    version = Version(number, day, last.batch_id, tables, last.loads)
    publish(spark, root, version)
    after = file_sizes(spark, root, layer, table, tables[f"{layer}.{table}"])

    def per_partition(files: DataFrame, name: str) -> DataFrame:
        return files.groupBy("partition").agg(F.count(F.lit(1)).alias(name), F.sum("row_count").alias(f"rows_{name}"))

    report = per_partition(before, "files_before").join(per_partition(after, "files_after"), "partition", "full")
    return version, stored(spark, report, scratch, "report")
