"""Layer tables: paths, reads, writes with row counts, schema growth, compaction."""

from __future__ import annotations

import re
from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.names import BATCH_COLUMNS, FEED_SCHEMAS, PARTITION_COLUMN


def table_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    merge_schema: bool = False,
    fmt: str = "parquet",
) -> DataFrame:
    """Read a stored table.

    After a feed gains a column, older files read null in it. Passing the wider
    ``schema`` gives that without touching file footers; ``merge_schema`` finds
    the union of all file schemas, at the price of reading every footer.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def read_layer(spark: SparkSession, root: str, layer: str, table: str, **options) -> DataFrame:
    """A stored table: what counts of it, where its root has a ledger or published versions, else its folder."""
    from shelfline.sources import ledger, versions

    if layer == "bronze":
        return ledger.read_loads(spark, root, layer, table)
    if versions.has_versions(spark, root):
        return versions.read_version(spark, root, layer, table)
    return read_table(spark, table_path(root, layer, table), **options)


def partition_folder(column: str, value: str) -> str:
    """The folder of a partition value, with the characters set apart that Spark sets apart in such names."""
    name = re.sub(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""", lambda found: f"%{ord(found[0]):02X}", value)
    return f"{column}={name or '__HIVE_DEFAULT_PARTITION__'}"


def as_columns(names: str | Sequence[str] | None) -> list[str]:
    return [names] if isinstance(names, str) else list(names or ())


def bronze_schema(table: str, extra: Sequence[str] = ()) -> T.StructType:
    """Declared and ``extra`` source columns, all as the text that came, and the batch columns."""
    text = [*FEED_SCHEMAS[table].fieldNames(), *extra, *(c for c in BATCH_COLUMNS if c != "_ingestion_date")]
    return T.StructType([*(T.StructField(c, T.StringType()) for c in text), T.StructField("_ingestion_date", T.DateType())])


def read_bronze(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A bronze table with every column that any batch brought; no rows if there is no table yet."""
    return read_layer(spark, root, "bronze", table)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: str | Sequence[str] | None = None,
    rebalance: bool = True,
    only_touched_partitions: bool = False,
    fmt: str = "parquet",
) -> int:
    """Write ``df`` and return the number of rows written, in a single job.

    ``rebalance`` gathers the rows of a partition value to hold the file count
    down, and lets adaptive execution split a value that is too big for one task,
    so a hot day or month does not end up in one writer. ``build_session`` keeps
    small shuffle partitions from being merged too far: merging saves
    no files here, and thousands of days in one task are slow to write. A batch
    that carries a single partition value needs no gathering and is written from
    its own splits.
    """
    counter = Observation()
    columns = as_columns(partition_by)
    out = df.hint("rebalance", *columns) if columns and rebalance else df
    out = out.observe(counter, F.count(F.lit(1)).alias("rows"))
    writer = out.write.format(fmt).mode(mode)
    if only_touched_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if columns:
        writer = writer.partitionBy(*columns)
    writer.save(path)
    return counter.get["rows"]


def write_layer(
    df: DataFrame, root: str, layer: str, table: str, mode: str = "overwrite", **options
) -> int:
    partition_by = PARTITION_COLUMN[layer][table]
    return write_table(df, table_path(root, layer, table), mode, partition_by, **options)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def _folder(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``."""
    place, files = _folder(spark, path)
    return [x.getPath().getName() for x in files.listStatus(place) if x.isDirectory()] if files.exists(place) else []


def create_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not exist yet. It is written beside its place and then takes its name."""
    place, files = _folder(spark, path)
    draft, _ = _folder(spark, f"{place.getParent()}/.{uuid4().hex}")
    out = files.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    if files.exists(place) or not files.rename(draft, place):
        files.delete(draft, False)
        raise FileExistsError(path)


def read_files(spark: SparkSession, path: str, only_last: bool = False) -> dict[str, str]:
    """Name and content of the small files right below ``path``, or of the one whose name comes last."""
    place, files = _folder(spark, path)
    if not files.exists(place):
        return {}
    found = {x.getPath().getName(): x.getPath() for x in files.listStatus(place) if x.isFile()}
    names = sorted(n for n in found if not n.startswith("."))
    reader = spark._jvm.org.apache.commons.io.IOUtils
    texts = {}
    for name in names[-1:] if only_last else names:
        stream = files.open(found[name])
        texts[name] = reader.toString(stream, "UTF-8")
        stream.close()
    return texts


def compact(
    spark: SparkSession, path: str, target: str, partition_by: str, where: Column | None = None
) -> int:
    """Rewrite a table, or the partitions chosen by ``where``, into fewer files.

    The result goes to ``target``, never over the files being read; a lost run
    leaves the source whole, and the caller switches over once it is complete.
    """
    source = spark.read.parquet(path)
    chosen = source if where is None else source.where(where)
    return write_table(chosen, target, "overwrite", partition_by)
