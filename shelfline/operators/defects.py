"""Controlled damage to a feed: nulls, repeated rows, late dates, a new column.

Which rows are hit follows from an integer key column, not from a random draw:
a lost task rebuilds the same rows, and the same rule can be written in SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Default share of rows hit by each defect, and days of delay.
NULL_RATE = 0.03
DUPLICATE_RATE = 0.02
LATE_RATE = 0.02
DRIFT_RATE = 0.01
MAX_LATE_DAYS = 3

_SLOTS = 10_000
_STEP = 7919  # shares no factor with the slot count, so every slot is reached once


def hit(key: str, rate: float, shift: int = 0) -> str:
    """SQL predicate, true for ``rate`` of all keys; another ``shift`` hits other keys."""
    return f"(pmod(pmod({key}, {_SLOTS}) * {_STEP} + {shift}, {_SLOTS}) < {round(rate * _SLOTS)})"


def _hit(df: DataFrame, key: str, rate: float, shift: int, at_least_one: bool) -> Column:
    by_rate = F.expr(hit(key, rate, shift))
    return by_rate | (F.col(key) == df.agg(F.min(key)).scalar()) if at_least_one else by_rate


def inject_nulls(
    df: DataFrame, columns: Sequence[str], key: str, rate: float = NULL_RATE, shift: int = 0
) -> DataFrame:
    """Null out ``columns`` on a share of the rows."""
    return df.withColumns({c: F.expr(f"CASE WHEN NOT {hit(key, rate, shift)} THEN `{c}` END") for c in columns})


def inject_duplicates(
    df: DataFrame, key: str, rate: float = DUPLICATE_RATE, shift: int = 0, at_least_one: bool = False
) -> DataFrame:
    """Repeat a share of the rows once, in one pass over the input."""
    copies = F.when(_hit(df, key, rate, shift, at_least_one), F.expr("array(0, 1)")).otherwise(F.expr("array(0)"))
    return df.withColumn("_copy", F.explode(copies)).drop("_copy")


def inject_late_arrivals(
    df: DataFrame,
    date_column: str,
    key: str,
    rate: float = LATE_RATE,
    shift: int = 0,
    at_least_one: bool = False,
) -> DataFrame:
    """Move the date of a share of the rows back by one to three days."""
    days = f"CAST(pmod({key}, {MAX_LATE_DAYS}) + 1 AS INT)"
    is_date = isinstance(df.schema[date_column].dataType, T.DateType)
    moved = F.expr(f"date_sub({date_column}, {days})" if is_date else f"{date_column} - make_dt_interval({days})")
    late = _hit(df, key, rate, shift, at_least_one)
    return df.withColumn(date_column, F.when(late, moved).otherwise(F.col(date_column)))


def inject_schema_drift(
    df: DataFrame,
    key: str,
    rate: float = DRIFT_RATE,
    shift: int = 0,
    column: str = "promo_code_applied",
    at_least_one: bool = False,
) -> DataFrame:
    """Add a column the contract does not know, filled on a share of the rows."""
    code = F.expr(f"concat('PROMO-', lpad(CAST(pmod({key}, 10000) AS STRING), 4, '0'))")
    return df.withColumn(column, F.when(_hit(df, key, rate, shift, at_least_one), code))
