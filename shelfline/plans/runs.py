"""A whole run: bronze, silver, gold, with the checks between the layers."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession

from shelfline.operators.batches import Batch
from shelfline.plans import bronze, gold, lineage, rebuild, silver
from shelfline.plans.catalog import LAYERS
from shelfline.plans.quality import gold_gate, layer_gate
from shelfline.sources.ledger import Load, all_live_loads, known_schemas, read_loads
from shelfline.sources.tables import bronze_schema, read_layer, table_path, write_table
from shelfline.sources.versions import Version, find_version, publish, read_state
from shelfline.sources.workspace import new_run_root


def layer_tables(spark: SparkSession, root: str, layer: str) -> dict[str, DataFrame]:
    """The tables of a layer as they count now: live loads of bronze, the latest version of silver and gold.

    Without published versions silver and gold are read with the schemas that the plans have, so a table without a
    row, which has no file to ask, reads as an empty one.
    """
    if layer == "bronze":
        loads, schemas = bronze_loads(spark, root), known_schemas(spark, root)
        return {t: read_loads(spark, root, layer, t, loads[f"{layer}.{t}"], schemas) for t in LAYERS[layer]}
    version = find_version(spark, root)
    if version:
        return {t: read_state(spark, root, layer, t, version.tables[f"{layer}.{t}"]) for t in LAYERS[layer]}
    plans = silver.tables({t: spark.createDataFrame([], bronze_schema(t)) for t in LAYERS["bronze"]})
    if layer == "gold":
        plans = gold.tables(plans)
    return {table: read_layer(spark, root, layer, table, schema=plans[table].schema) for table in LAYERS[layer]}


@dataclass
class RunResult:
    """``rows``: rows of the batch per bronze table, and of the silver and gold tables; ``rebuilt``: the partitions that were written, per table."""

    ingest: bronze.IngestResult
    rows: dict[str, dict[str, int]]
    version: Version | None = None
    rebuilt: dict[str, list[str]] = field(default_factory=dict)
    log: lineage.JobLog = field(default_factory=lambda: lineage.JobLog("", ""))

    def counts(self) -> list[tuple[str, str, int]]:
        return [(layer, table, n) for layer, rows in self.rows.items() for table, n in rows.items()]


def bronze_loads(spark: SparkSession, root: str) -> dict[str, list[Load]]:
    live = all_live_loads(spark, root)
    return {f"bronze.{t}": live.get(f"bronze.{t}", []) for t in LAYERS["bronze"]}


def changed_loads(before: Version, loads: dict[str, list[Load]]) -> dict[str, list[Load]]:
    """The loads that came or went since a version was built, per bronze table that has any with rows."""
    found = {}
    for table in LAYERS["bronze"]:
        was, now = before.loads.get(f"bronze.{table}", []), loads[f"bronze.{table}"]
        changed = [x for x in now if x not in was] + [x for x in was if x not in now]
        if any(x.row_count for x in changed):
            found[table] = changed
    return found


def build_version(
    spark: SparkSession,
    root: str,
    batch: Batch,
    created_at: Column | None = None,
    gates: bool = True,
    whole: bool = False,
    log: lineage.JobLog | None = None,
) -> rebuild.Build:
    """Build silver and gold from the live loads of bronze and publish them together as the next version.

    After the first version only what changed is built again, unless ``whole`` asks for everything. A
    failed check or a lost run publishes nothing.
    """

    def watch(name: str, sources: dict[str, DataFrame], state, outcome) -> None:
        if log is None:
            return
        inputs = lineage.datasets_read(root, sources.values())
        if outcome is None:
            log.add(lineage.START, name, inputs)
        elif isinstance(outcome, BaseException):
            log.add(lineage.FAIL, name, inputs)
        else:
            log.add(lineage.COMPLETE, name, inputs, state.schema)

    before, loads, schemas = find_version(spark, root), bronze_loads(spark, root), known_schemas(spark, root)
    number = before.number + 1 if before else 1
    version = Version(number, batch.ingestion_date, batch.batch_id, loads=loads)
    build = rebuild.Build(spark, root, new_run_root(spark, "rebuild"), version, before, watch)
    tables = {t: read_loads(spark, root, "bronze", t, loads[f"bronze.{t}"], schemas) for t in LAYERS["bronze"]}
    if before is None or whole:
        rebuild.full(build, tables, created_at)
    else:
        changed = {t: read_loads(spark, root, "bronze", t, x, schemas) for t, x in changed_loads(before, loads).items()}
        rebuild.incremental(build, tables, changed, created_at)
    if gates:
        built = {t: build.table("silver", t) for t in LAYERS["silver"]}
        layer_gate(built, "silver")
        # a mart may be empty only if no feed has rows for it
        gold_gate({t: build.table("gold", t) for t in LAYERS["gold"]}, built)
    publish(spark, root, version)
    return build


def run_layers(
    spark: SparkSession,
    root: str,
    feeds: dict[str, str | DataFrame],
    batch: Batch | None = None,
    created_at: Column | None = None,
    gates: bool = True,
    reload: str = "append",
    whole: bool = False,
    run_id: str | None = None,
) -> RunResult:
    """Ingest ``feeds``, rebuild what they change in silver and gold, and publish both as one version.

    With ``gates``, each batch is checked before it is stored. One that fails is kept aside and the run
    stops; the next run is not held up by it. A run that fails later leaves the version
    before it. ``run_id`` logs the events of its jobs, those of a failed run as well.
    """
    batch = batch or Batch()
    log = lineage.JobLog(run_id or batch.batch_id, batch.ingested_at)
    try:
        ingested = bronze.ingest(spark, root, feeds, batch, reload=reload, gate=gates, log=log)
        rows = {"bronze": ingested.rows}
        built = build_version(spark, root, batch, created_at, gates, whole, log)
    except BaseException:
        if run_id:
            write_events(spark, root, log)
        raise
    if run_id:
        write_events(spark, root, log)
    return RunResult(ingested, rows | built.rows, built.version, built.rebuilt, log)


def write_events(spark: SparkSession, root: str, log: lineage.JobLog) -> str:
    """Append the events of a run to the event log; returns its path."""
    path = table_path(root, "ops", "lineage_events")
    if log.rows:
        write_table(log.events(spark), path, mode="append")
    return path


def log_lineage(spark: SparkSession, root: str, result: RunResult, run_id: str, event_time: str) -> str:
    """Append the events of a finished run to the event log under another run id and time; returns its path."""
    renamed = lineage.JobLog(run_id, event_time)
    renamed.rows = [(f"{run_id}/{job}", kind, job, *rest) for _, kind, job, *rest in result.log.rows]
    return write_events(spark, root, renamed)
