"""Batch columns and header clean-up for incoming feeds."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone
from uuid import uuid4

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.names import BATCH_COLUMNS


@dataclass(frozen=True)
class Batch:
    """Identity of one ingestion run; the timestamp is ISO-8601 text in UTC."""

    batch_id: str = field(default_factory=lambda: str(uuid4()))
    ingested_at: str = field(default_factory=lambda: datetime.now(timezone.utc).isoformat())

    @property
    def ingestion_date(self) -> str:
        return self.ingested_at[:10]


def add_batch_columns(
    df: DataFrame,
    source_system: str,
    batch_id: str | Column,
    ingested_at: str | Column,
) -> DataFrame:
    """Add the four batch columns; a source column of the same name is kept as ``source`` + its name.

    ``batch_id`` and ``ingested_at`` are plain values for a fresh batch, or
    columns when a table holding many past batches is stamped in one go.
    """
    stamp = ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at)
    batch = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    return set_clashing_apart(df).withColumns(
        {
            "_ingestion_timestamp": stamp,
            "_source_system": F.lit(source_system),
            "_batch_id": batch,
            "_ingestion_date": F.to_date(F.substring(stamp, 1, 10)),
        }
    )


def set_clashing_apart(df: DataFrame) -> DataFrame:
    """Rename source columns that are named like a batch column, in any case: ``_batch_id`` to ``source_batch_id``."""
    taken = {c.lower() for c in df.columns}
    names = []
    for c in df.columns:
        if c.lower() in BATCH_COLUMNS:
            c = f"source{c}"
            while c.lower() in taken:
                c = f"source_{c}"
            taken.add(c.lower())
        names.append(c)
    return df if names == df.columns else df.toDF(*names)


def distinct_names(names: Iterable[str], known: Iterable[str] = ()) -> list[str]:
    """Column names without blanks round them that differ in more than their case.

    A name that equals a ``known`` one but for its case becomes that one. Of several
    that are equal then, an exactly equal one keeps the name, else the first; the others are numbered: ``a``, ``a_2``, ``a_3``.
    """
    stripped = [n.strip() for n in names]
    spelled = {k.lower(): k for k in known}
    wanted = [spelled.get(n.lower(), n) for n in stripped]
    exact = {n.lower() for n in stripped if spelled.get(n.lower()) == n}
    taken: set[str] = set()
    reserved = {n.lower() for n in wanted}
    out = []
    for n, w in zip(stripped, wanted, strict=True):
        first = w.lower() not in taken and not (w.lower() in exact and n != w)
        if not first:
            k = 2
            while f"{w}_{k}".lower() in taken | reserved:
                k += 1
            w = f"{w}_{k}"
        taken.add(w.lower())
        out.append(w)
    return out


def with_distinct_names(df: DataFrame, known: Iterable[str] = ()) -> DataFrame:
    return df.toDF(*distinct_names(df.columns, known))


def clean_column_names(df: DataFrame) -> DataFrame:
    """Strip blanks round every column name."""
    return df.toDF(*[c.strip() for c in df.columns])
