"""Shared folder for tables that a run writes and reads back."""

from __future__ import annotations

import os
from pathlib import Path
from uuid import uuid4

from pyspark.sql import SparkSession


def shared_base(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where that is unset, a folder below the session's warehouse, which driver and
    executors share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    return base.rstrip("/") if base else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_runs"


def new_run_root(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing folder below the shared one."""
    return f"{shared_base(spark)}/shelfline/{label}-{uuid4().hex}"


def stored(spark: SparkSession, df, root: str, name: str):
    """``df`` written below ``root`` and read back: lineage ends at the shared folder."""
    path = f"{root}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let_workers_import(spark: SparkSession) -> None:
    """Let Python workers find this package where it runs from a checkout and is not installed."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    here = str(Path(__file__).resolve().parents[2])
    if here not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([here, *paths])
    # idle workers stay alive: arrays go back to the system when they are freed
    for name, value in (("MALLOC_MMAP_THRESHOLD_", "131072"), ("MALLOC_TRIM_THRESHOLD_", "131072"), ("ARROW_DEFAULT_MEMORY_POOL", "system")):
        environment.setdefault(name, value)


def small_batches(spark: SparkSession) -> None:
    """Hand Python workers at most 4 MB of rows at a time, however long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
