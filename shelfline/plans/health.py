"""Run health: status, duration and totals over the scheduler's run log.

A run log has ``dag_id``, ``state``, ``execution_date``, ``start_date`` and
``end_date``. ``now`` is given by the caller, so results can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.columns import seconds_between


def _since(now: Column, interval: str) -> Column:
    return F.col("execution_date") > now - F.expr(f"INTERVAL {interval}")


def run_status(runs: DataFrame, now: Column) -> DataFrame:
    """Runs of the last 24 hours by job and state."""
    return (
        runs.where(_since(now, "24 HOURS"))
        .groupBy("dag_id", "state")
        .agg(F.count(F.lit(1)).alias("run_count"))
        .orderBy("dag_id", "state")
    )


def run_durations(runs: DataFrame, now: Column) -> DataFrame:
    """Seconds taken by each finished run of the last 7 days, as a time series."""
    finished = F.col("start_date").isNotNull() & F.col("end_date").isNotNull()
    return (
        runs.where(finished & _since(now, "7 DAYS"))
        .select(
            F.col("execution_date").alias("time"),
            F.col("dag_id").alias("metric"),
            F.expr(f"{seconds_between('start_date', 'end_date')} AS value"),
        )
        .orderBy("time", "metric", "value")
    )


def runs_in_state(runs: DataFrame, state: str) -> DataFrame:
    """Number of runs in ``state`` as a one-row frame."""
    return runs.where(F.col("state") == state).agg(F.count(F.lit(1)).alias("value"))
