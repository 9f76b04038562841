"""Daily file drop, picked up once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.operators.batches import Batch
from shelfline.operators.contract import Contract
from shelfline.plans.bronze import IngestResult, ingest_files


def load_new_files(
    spark: SparkSession,
    drop_path: str,
    table: str,
    root: str,
    checkpoint: str,
    batch: Batch,
    contract: Contract | None = None,
    max_files: int | None = None,
) -> list[IngestResult]:
    """Load the files that came since the last call into a bronze table of ``root``.

    The stream finds the files; their rows go the same way as batches do: text stays text,
    columns are taken by name, and both kinds of load can share a table. Each file is held to the contract by itself:
    a good file that came with a bad one is loaded, and the bad one is kept in the rejects with
    the rules it broke (``read_rejects``). Each micro-batch is a batch of its own, ``<batch id>-<number>``, and replaces only
    itself, so a repeated call, or one that follows a lost run, adds no row twice.
    ``max_files`` bounds a micro-batch. A file without a single line is not seen.
    """
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    results: list[IngestResult] = []

    def load(lines: DataFrame, number: int) -> None:
        own = Batch(f"{batch.batch_id}-{number}", batch.ingested_at)
        results.append(ingest_files(spark, root, table, lines, own, contract))

    query = (
        reader.load(drop_path)
        .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
        .where("at = 0")
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return results
