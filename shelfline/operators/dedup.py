"""One row per key, with a survivor that does not depend on row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    tie_breaks: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the row with the newest ``order_col`` for every key.

    Ties are settled by ``tie_breaks`` (largest first, nulls last); by default by
    all remaining columns, so only fully equal rows can still be swapped.

    The ``row_number() == 1`` filter lets Spark cut every key to one row inside
    each map task before the shuffle, so a key that holds much of the table
    sends at most one row per task.
    """
    if tie_breaks is None:
        tie_breaks = [c for c in df.columns if c not in {*keys, order_col}]
    newest_first = ", ".join(f"`{c}` DESC NULLS LAST" for c in (order_col, *tie_breaks))
    per_key = ", ".join(f"`{c}`" for c in keys)
    rank = F.expr(f"row_number() OVER (PARTITION BY {per_key} ORDER BY {newest_first})")
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def first_source(feeds: Sequence[tuple[str, DataFrame]], key: str) -> DataFrame:
    """Distinct non-null ``key`` values with the first feed that has each one.

    ``feeds`` is ordered by priority. The priority is a small integer, so the
    grouping stays a hash aggregate with partial results before the shuffle.
    """
    union: DataFrame | None = None
    for priority, (_, feed) in enumerate(feeds):
        part = feed.selectExpr(key, f"{priority} AS _priority")
        union = part if union is None else union.unionByName(part)
    labels = ", ".join(f"'{label}'" for label, _ in feeds)
    return (
        union.where(f"{key} IS NOT NULL")
        .groupBy(key)
        .agg(F.min("_priority").alias("_priority"))
        .selectExpr(key, f"get(array({labels}), _priority) AS source")
    )
