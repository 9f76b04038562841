"""Rows in one global sort order, compared with their neighbours.

A key may hold any share of the rows: the sort is by range over key and place, so
a hot key spreads over several tasks, each of which streams its rows. What is known
only across the border of two tasks is settled from one row per border key, at most
two for each partition of the sort.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, doc_id, place, more) in order; out come those whose key has another row, with the first row of the key.

    Rows of the first and the last key of the partition always come out, as ``border``.
    """
    part = TaskContext.get().partitionId()
    held: np.ndarray | None = None
    names: list[str] = []
    lead: np.ndarray | None = None
    first_key = None

    def out(rows: np.ndarray, leads: np.ndarray, border: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(np.ascontiguousarray(c)) for c in (*rows.T, *leads[:, 1:3].T)]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(np.full(len(rows), part, np.int32)), pa.array(border)],
            names=[*names, "lead_doc", "lead_place", "part", "border"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.schema.names
        new = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(np.int64)
        rows = new if held is None else np.concatenate([held, new])
        starts = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]])
        if first_key is None:
            first_key = rows[0, 0]
        sizes = np.diff(starts, append=len(rows))
        leads = np.repeat(rows[starts], sizes, axis=0)
        several = np.repeat(sizes > 1, sizes)
        if lead is not None and lead[0] == rows[0, 0]:
            leads[: sizes[0]] = lead
            several[: sizes[0]] = True
        border = rows[:, 0] == first_key
        # the last key may go on: a lone row of it waits, longer runs come out with what is known
        if sizes[-1] == 1 and not several[-1]:
            held, rows, leads, several, border = rows[-1:], rows[:-1], leads[:-1], several[:-1], border[:-1]
            lead = None
        else:
            held, lead = None, leads[-1].copy()
        keep = several | border
        if keep.any():
            yield out(rows[keep], leads[keep], border[keep])
    if held is not None:
        yield out(held, held, np.ones(1, bool))
    elif lead is not None:
        # marks the last key as a border key; the row itself came out before
        yield out(lead[None], lead[None], np.array([True])).set_column(1, "doc_id", pa.nulls(1, pa.int64()))


def repeated(rows: DataFrame, stored, more: tuple[str, ...] = ()) -> DataFrame:
    """Rows (key, doc_id, place) whose key occurs again, with the first (doc_id, place) of that key.

    ``rows`` should be a stored table, as the range sort samples it first. ``stored``
    writes a frame to the shared folder and gives it back. ``more`` names further long
    columns, which go along.
    """
    carried = "".join(f"{c} long, " for c in more)
    found = stored(
        rows.select("key", "doc_id", F.col("place").cast("long").alias("place"), *more)
        .repartitionByRange("key", "doc_id", "place")
        .sortWithinPartitions("key", "doc_id", "place")
        .mapInArrow(
            _mark, f"key long, doc_id long, place long, {carried}lead_doc long, lead_place long, part int, border boolean"
        )
    )
    # two keys per partition of the sort at most, so their number does not follow the data
    border_keys = [r.key for r in found.where("border").select("key").distinct().collect()]
    borders = (
        found.where(F.col("key").isin(border_keys))
        .groupBy("key")
        .agg(
            F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "place"))).alias("first"),
            F.count("doc_id").alias("n"),
        )
    )
    return (
        found.where("doc_id is not null")
        .join(F.broadcast(borders), "key", "left")
        .where("n is null or n > 1")
        .select(
            "key",
            "doc_id",
            "place",
            *more,
            F.coalesce("first.doc_id", "lead_doc").alias("lead_doc"),
            F.coalesce("first.place", "lead_place").alias("lead_place"),
        )
    )
