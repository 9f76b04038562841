"""Versions of the layers: folders that are never overwritten, and one manifest per version.

A run writes what it rebuilt into folders of its own version, below the tables they belong to. Then one file, the
manifest, names the folders of all tables together; creating it is what publishes them. A reader
takes the latest manifest, one of a number, or the last one of a day, and sees the tables of one run.
Partitions that a run did not touch are named again from where they are, and are not copied. A run that
dies before its manifest leaves the version before it whole.

A manifest is complete in itself. It holds one line per partition of silver and gold and per load of bronze: metadata
of the size of a folder listing, which is what the driver reads.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.names import PARTITION_COLUMN, VERSION_COLUMN
from shelfline.sources.ledger import Load, live_loads, read_loads, record_loads
from shelfline.sources.tables import as_columns, child_folders, create_file, path_exists, read_files, table_path, write_table

FOLDER = "_versions"


@dataclass
class TableState:
    """A table in a version: its folders, or single files, below the table's path, its schema and its number of rows."""

    folders: list[str]
    schema: T.StructType
    rows: int

    def partitions(self) -> dict[str, list[str]]:
        """Partition (such as ``order_date=2024-01-31``, or nothing) -> its folders and single files."""
        found: dict[str, list[str]] = {}
        for f in self.folders:
            parts = [p for p in f.split("/")[1:] if "=" in p]
            found.setdefault("/".join(parts), []).append(f)
        return found


@dataclass
class Version:
    number: int
    day: str
    batch_id: str
    tables: dict[str, TableState] = field(default_factory=dict)
    loads: dict[str, list[Load]] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(
            {
                "number": self.number,
                "day": self.day,
                "batch_id": self.batch_id,
                "tables": {n: {"folders": t.folders, "schema": t.schema.jsonValue(), "rows": t.rows} for n, t in self.tables.items()},
                "loads": {n: [[x.batch_id, x.load_id, x.row_count] for x in loads] for n, loads in self.loads.items()},
            }
        )

    @classmethod
    def from_json(cls, text: str) -> "Version":
        found = json.loads(text)
        tables = {n: TableState(t["folders"], T.StructType.fromJson(t["schema"]), t["rows"]) for n, t in found["tables"].items()}
        loads = {n: [Load(*x) for x in loads] for n, loads in found["loads"].items()}
        return cls(found["number"], found["day"], found["batch_id"], tables, loads)


def versions(spark: SparkSession, root: str) -> list[Version]:
    """All published versions, in order."""
    path = f"{root.rstrip('/')}/{FOLDER}"
    return [Version.from_json(text) for _, text in sorted(read_files(spark, path).items())]


def find_version(spark: SparkSession, root: str, number: int | None = None, day: str | None = None) -> Version | None:
    """The latest version, the one of a ``number``, or the last one that was published on or before a ``day``."""
    path = f"{root.rstrip('/')}/{FOLDER}"
    if number is None and day is None:
        last = read_files(spark, path, only_last=True)
        return Version.from_json(*last.values()) if last else None
    chosen = [v for v in versions(spark, root) if (number is None or v.number == number) and (day is None or v.day <= day)]
    return chosen[-1] if chosen else None


def publish(spark: SparkSession, root: str, version: Version) -> None:
    """Write the manifest. Of two runs that build the same version, the second one fails here and publishes nothing."""
    create_file(spark, f"{root.rstrip('/')}/{FOLDER}/{version.number:08d}.json", version.to_json())


def write_version(spark: SparkSession, root: str, layer: str, table: str, df: DataFrame, number: int, rebalance: bool = True) -> TableState:
    """Write ``df`` as (partitions of) a table in a version that is not published yet."""
    path = f"{table_path(root, layer, table)}/{VERSION_COLUMN}={number:08d}"
    partitions = as_columns(PARTITION_COLUMN[layer][table])
    rows = write_table(df, path, "overwrite", partitions, rebalance)
    own = path.rsplit("/", 1)[1]
    folders = [f"{own}/{f}" for f in child_folders(spark, path)] if partitions else [own] if rows else []
    return TableState(sorted(folders), df.schema, rows)


def scan_state(spark: SparkSession, root: str, layer: str, table: str, state: TableState, only: Sequence[str] | None = None) -> DataFrame:
    """The files of a state, or only of some of its ``partitions()``, with the column of their version."""
    path = table_path(root, layer, table)
    schema = T.StructType([*state.schema.fields, T.StructField(VERSION_COLUMN, T.StringType())])
    reader = spark.read.schema(schema).option("basePath", path)
    if only is not None:
        chosen = [f for p in dict.fromkeys(only) for f in state.partitions().get(p, [])]
        return reader.parquet(*[f"{path}/{f}" for f in chosen]) if chosen else spark.createDataFrame([], schema)
    # a version's folder is read as one, without the partitions that later versions replaced
    places, gone = [], F.lit(False)
    by_version: dict[str, list[str]] = {}
    for f in state.folders:
        by_version.setdefault(f.partition("/")[0], []).append(f)
    for own, folders in by_version.items():
        names = {f.partition("/")[2] for f in folders}
        replaced = set() if names == {""} else set(child_folders(spark, f"{path}/{own}")) - names
        if len(replaced) > len(names) or any(f.endswith(".parquet") for f in folders):
            places += folders
            continue
        places.append(own)
        if replaced:
            gone |= (F.col(VERSION_COLUMN) == own.partition("=")[2]) & _in_partitions(state.schema, replaced)
    if not places:
        return spark.createDataFrame([], schema)
    df = reader.parquet(*[f"{path}/{f}" for f in places])
    return df if places == state.folders else df.where(~gone)


def _in_partitions(schema: T.StructType, names: set[str]) -> Column:
    """Is a row in one of the partitions (such as ``order_date=2024-01-31``)?"""
    column = next(iter(names)).partition("=")[0]
    values = [unquote(n.partition("=")[2]) for n in sorted(names)]
    filled = [F.lit(v).cast(schema[column].dataType) for v in values if v != "__HIVE_DEFAULT_PARTITION__"]
    without = F.col(column).isNull() if len(filled) < len(values) else F.lit(False)
    return (F.coalesce(F.col(column).isin(*filled), F.lit(False)) if filled else F.lit(False)) | without


def read_state(spark: SparkSession, root: str, layer: str, table: str, state: TableState, only: Sequence[str] | None = None) -> DataFrame:
    """A table as of a state, or only some of its ``partitions()``."""
    return scan_state(spark, root, layer, table, state, only).select(*state.schema.fieldNames())


def read_version(
    spark: SparkSession, root: str, layer: str, table: str, number: int | None = None, day: str | None = None
) -> DataFrame:
    """A published table: the latest version, the one of a ``number``, or as it was at the end of a ``day``."""
    version = find_version(spark, root, number, day)
    if version is None:
        raise ValueError(f"{root} has no published version" + (f" up to {day}" if day else "") + (f" {number}" if number else ""))
    if layer == "bronze":
        return read_loads(spark, root, layer, table, version.loads.get(f"{layer}.{table}", []))
    return read_state(spark, root, layer, table, version.tables[f"{layer}.{table}"])


def restore(spark: SparkSession, root: str, number: int, day: str) -> Version:
    """Publish the tables of an earlier version again, as a new one.

    The ledger of the batches follows: batches that came later no longer count, and loads that
    were replaced later count again. No table file is written.
    """
    old, last = find_version(spark, root, number=number), find_version(spark, root)
    if old is None:
        raise ValueError(f"{root} has no version {number}")
    for dataset in sorted(old.loads.keys() | last.loads.keys()):
        layer, table = dataset.split(".")
        wanted, now = old.loads.get(dataset, []), live_loads(spark, root, layer, table)
        changed = dict.fromkeys(x.batch_id for x in [*now, *wanted] if (x in now) != (x in wanted))
        loads, replaces = [], []
        for batch_id in changed:
            own = [x for x in wanted if x.batch_id == batch_id] or [Load(batch_id, "", 0)]
            loads += own
            replaces += [True] + [False] * (len(own) - 1)
        if loads:
            record_loads(spark, root, layer, table, loads, day, replaces)
    new = Version(last.number + 1, day, old.batch_id, old.tables, old.loads)
    publish(spark, root, new)
    return new


def has_versions(spark: SparkSession, root: str) -> bool:
    return path_exists(spark, f"{root.rstrip('/')}/{FOLDER}")
