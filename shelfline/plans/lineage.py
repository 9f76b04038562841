"""Lineage: events of started, finished and failed jobs, and the tables derived from the event log.

An event is one row of nested JSON: run, parent run, job, inputs, outputs and
the schema of each output.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NAMESPACE = "shelfline"
PRODUCER = "shelfline"
PARENT_JOB = "dq_lineage_checkpoint"

# Public schema addresses of the event facets.
SCHEMA_FACET = "https://openlineage.io/spec/facets/1-0-0/SchemaDatasetFacet.json"
PARENT_FACET = "https://openlineage.io/spec/facets/1-0-0/ParentRunFacet.json"

# Parts of an event that each reader of the log needs; the rest is skipped.
EDGE_PARTS = "eventType string, job struct<name: string>, inputs array<struct<name: string>>, outputs array<struct<name: string>>"
FIELD_PARTS = (
    "eventType string, outputs array<struct<name: string, facets: struct<"
    "schema: struct<fields: array<struct<name: string, type: string>>>>>>"
)


START, COMPLETE, FAIL = "START", "COMPLETE", "FAIL"


def job_name(dataset: str) -> str:
    """The job that writes a table: ``ingest_`` and ``build_`` with the table's name, silver tables with their layer."""
    layer, table = dataset.split(".")
    return f"ingest_{table}" if layer == "bronze" else f"build_silver_{table}" if layer == "silver" else f"build_{table}"


def datasets_read(root: str, frames: Iterable[DataFrame]) -> list[str]:
    """The tables below ``root`` whose files the frames read, by the frames' own account."""
    place = urlsplit(root).path.rstrip("/") + "/"
    files = {unquote(urlsplit(f).path) for df in frames for f in df.inputFiles()}
    return sorted({".".join(f.removeprefix(place).split("/")[:2]) for f in files if f.startswith(place)})


@dataclass
class JobLog:
    """Events of the jobs of one run, as they start, complete or fail; a row per event."""

    parent_run_id: str
    event_time: str
    rows: list[tuple] = field(default_factory=list)

    def add(self, kind: str, dataset: str, inputs: Iterable[str], schema: T.StructType | None = None) -> None:
        job = job_name(dataset)
        fields = [(f.name, f.dataType.simpleString().upper()) for f in schema or ()]
        self.rows.append((f"{self.parent_run_id}/{job}", kind, job, sorted(inputs), dataset, fields))

    def events(self, spark: SparkSession) -> DataFrame:
        jobs = spark.createDataFrame(
            self.rows,
            "run_id string, kind string, job string, inputs array<string>, output string, "
            "fields array<struct<name: string, type: string>>",
        )
        return jobs.select(
            "job",
            event_json(
                F.col("run_id"), F.lit(self.parent_run_id), F.lit(self.event_time),
                F.col("job"), F.col("inputs"), F.col("output"), F.col("fields"), F.col("kind"),
            ).alias("event"),
        )


def event_json(
    run_id: Column, parent_run_id: Column, event_time: Column, job: Column,
    inputs: Column, output: Column, fields: Column, kind: Column | None = None,
) -> Column:
    """One event as JSON text, of a finished job unless ``kind`` says otherwise.

    ``inputs`` is an array of dataset names, ``fields`` an array of
    ``struct<name, type>`` with the schema of ``output``.
    """

    def named(name: Column) -> Column:
        return F.struct(F.lit(NAMESPACE).alias("namespace"), name.alias("name"))

    parent = F.struct(
        F.lit(PRODUCER).alias("_producer"),
        F.lit(PARENT_FACET).alias("_schemaURL"),
        F.struct(parent_run_id.alias("runId")).alias("run"),
        named(F.lit(PARENT_JOB)).alias("job"),
    )
    schema = F.struct(
        F.lit(PRODUCER).alias("_producer"),
        F.lit(SCHEMA_FACET).alias("_schemaURL"),
        fields.alias("fields"),
    )
    written = F.struct(
        F.lit(NAMESPACE).alias("namespace"),
        output.alias("name"),
        F.struct(schema.alias("schema")).alias("facets"),
    )
    return F.to_json(
        F.struct(
            (F.lit(COMPLETE) if kind is None else kind).alias("eventType"),
            event_time.alias("eventTime"),
            F.struct(run_id.alias("runId"), F.struct(parent.alias("parent")).alias("facets")).alias("run"),
            named(job).alias("job"),
            F.transform(inputs, named).alias("inputs"),
            F.array(written).alias("outputs"),
            F.lit(PRODUCER).alias("producer"),
        )
    )


def _parsed(log: DataFrame, parts: str) -> DataFrame:
    """Parts of the events of finished jobs as columns. ``inline`` keeps Spark from parsing once per part."""
    return log.select(F.inline(F.array(F.from_json("event", parts)))).where(F.col("eventType") == COMPLETE)


def lineage_edges(log: DataFrame) -> DataFrame:
    """Which job read what to write what, and in how many runs."""
    return (
        _parsed(log, EDGE_PARTS)
        .select(F.col("job.name").alias("job"), F.explode("inputs.name").alias("input"), "outputs")
        .select("job", "input", F.explode("outputs.name").alias("output"))
        .groupBy("job", "input", "output")
        .agg(F.count(F.lit(1)).alias("run_count"))
    )


def lineage_fields(log: DataFrame) -> DataFrame:
    """Fields and types seen per written dataset."""
    return (
        _parsed(log, FIELD_PARTS)
        .select(F.explode("outputs").alias("output"))
        .select(F.col("output.name").alias("dataset"), F.explode("output.facets.schema.fields").alias("field"))
        .groupBy("dataset", F.col("field.name").alias("field"), F.col("field.type").alias("type"))
        .agg(F.count(F.lit(1)).alias("event_count"))
    )
