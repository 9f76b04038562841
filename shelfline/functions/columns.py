"""Expressions shared by the layers, as SQL text.

They are meant for ``selectExpr`` and ``expr``: a projection written that way is
handed to Spark in one call, where a tree of ``Column`` objects takes dozens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfline.names import MONEY


def as_double(name: str) -> str:
    """Number or text to double. Text that is no number, and NaN, become null."""
    return f"nanvl(try_cast({name} AS DOUBLE), CAST(NULL AS DOUBLE))"


def as_int(df: DataFrame, name: str) -> str:
    """Number or text to int; text such as ``79.0`` counts as a number."""
    if isinstance(df.schema[name].dataType, (T.StringType, T.DoubleType, T.FloatType)):
        return f"try_cast({as_double(name)} AS INT)"
    return f"try_cast({name} AS INT)"


def as_date(name: str) -> str:
    """Date, timestamp or ISO text (with or without a time part) to date."""
    return f"try_cast({name} AS DATE)"


def as_timestamp(name: str) -> str:
    return f"try_cast({name} AS TIMESTAMP)"


def as_declared(df: DataFrame, name: str, kind: T.DataType) -> str:
    """``name`` as the type its feed declares; null where it cannot be read so."""
    if isinstance(kind, T.IntegerType):
        return as_int(df, f"{name}")
    if isinstance(kind, T.DoubleType):
        return as_double(f"`{name}`")
    return f"try_cast(`{name}` AS {kind.simpleString()})"


def money(name: str) -> str:
    return f"try_cast({name} AS {MONEY.simpleString()})"


def total(name: str) -> str:
    """Sum of money as a double, independent of row order.

    Amounts beyond 22 digits before the point do not fit the decimal; a group that
    holds one is added up as doubles instead.
    """
    fits = f"count({money(name)}) = count({as_double(name)})"
    return f"CASE WHEN {fits} THEN CAST(try_sum({money(name)}) AS DOUBLE) ELSE sum({as_double(name)}) END"


def average(name: str) -> str:
    """Average of the money values that are not null."""
    return f"try_divide({total(name)}, CAST(count({as_double(name)}) AS DOUBLE))"


def month_of(name: str) -> str:
    """Month as ``yyyy-MM`` text, the partition key of the gold tables."""
    return f"date_format({name}, 'yyyy-MM')"


def ratio(numerator: str, denominator: str) -> str:
    """``numerator / denominator``, or 0.0 unless the denominator is positive."""
    return f"CASE WHEN {denominator} > 0 THEN ({numerator}) / ({denominator}) ELSE CAST(0 AS DOUBLE) END"


def padded_id(prefix: str, key: str, width: int) -> str:
    """``prefix`` + ``key`` with zeros in front up to ``width`` digits.

    Longer keys are kept whole (``lpad`` alone would cut them).
    """
    digits = f"CAST({key} AS STRING)"
    return f"concat('{prefix}', CASE WHEN length({digits}) < {width} THEN lpad({digits}, {width}, '0') ELSE {digits} END)"


def seconds_between(start: str, end: str) -> str:
    """Seconds from ``start`` to ``end`` with microseconds kept."""
    return f"(unix_micros(CAST({end} AS TIMESTAMP)) - unix_micros(CAST({start} AS TIMESTAMP))) / 1e6D"
