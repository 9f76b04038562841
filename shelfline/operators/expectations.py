"""Quality suites: expectations, their evaluation, severity and gate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Public names of the checks, as they appear in result rows.
NOT_NULL = "expect_column_values_to_not_be_null"
BETWEEN = "expect_column_values_to_be_between"
UNIQUE = "expect_column_values_to_be_unique"
IN_SET = "expect_column_values_to_be_in_set"
EXISTS = "expect_column_to_exist"

# Checks whose failure is critical, per layer; the rest only warn.
CRITICAL_CHECKS = {
    "bronze": frozenset({NOT_NULL, EXISTS}),
    "silver": frozenset({NOT_NULL, UNIQUE, IN_SET}),
}


class QualityFailure(Exception):
    """At least one table failed a critical expectation."""


@dataclass(frozen=True)
class Expectation:
    check: str
    column: str
    min_value: float | None = None
    max_value: float | None = None
    allowed: tuple[str, ...] = ()
    mostly: float = 1.0


def not_null(column: str) -> Expectation:
    return Expectation(NOT_NULL, column)


def unique(column: str) -> Expectation:
    return Expectation(UNIQUE, column)


def exists(column: str) -> Expectation:
    return Expectation(EXISTS, column)


def between(
    column: str, min_value: float | None = None, max_value: float | None = None, mostly: float = 1.0
) -> Expectation:
    return Expectation(BETWEEN, column, min_value, max_value, mostly=mostly)


def in_set(column: str, allowed: Sequence[str]) -> Expectation:
    return Expectation(IN_SET, column, allowed=tuple(allowed))


def _unexpected(e: Expectation) -> Column:
    """Predicate that is true on an offending row; nulls offend only NOT_NULL."""
    value = F.col(e.column)
    if e.check == NOT_NULL:
        return value.isNull()
    if e.check == IN_SET:
        return ~value.isin(*e.allowed)
    number = value.try_cast("double")
    outside = F.lit(False)
    if e.min_value is not None:
        outside = outside | (number < e.min_value)
    if e.max_value is not None:
        outside = outside | (number > e.max_value)
    return outside


def _measures(df: DataFrame, columns: Sequence[str], row_checks: Sequence[tuple[int, Expectation]]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(c).alias(f"_filled_{c}") for c in columns],
        *[F.count_if(_unexpected(e)).alias(f"_n{i}") for i, e in row_checks],
    ]


def evaluate(df: DataFrame, table_name: str, layer: str, suite: Sequence[Expectation]) -> DataFrame:
    """One row per expectation: checked and offending rows, severity, success.

    The row checks are one pass without a shuffle of rows. A column that must be
    unique takes a pass over that column alone, which on a stored table reads nothing
    else.
    """
    numbered = list(enumerate(suite))
    present = [(i, e) for i, e in numbered if e.column in df.columns and e.check != EXISTS]
    row_checks = [(i, e) for i, e in present if e.check != UNIQUE]
    unique_checks = [(i, e) for i, e in present if e.check == UNIQUE]
    columns = sorted({e.column for _, e in present})
    measures = _measures(df, columns, row_checks)

    # one row per task for the row checks; keys alone are shuffled, and partly counted before
    totals = df.agg(*measures)
    for i, e in unique_checks:
        per_value = df.where(F.col(e.column).isNotNull()).groupBy(e.column).count()
        repeats = per_value.where("count > 1").agg(F.coalesce(F.sum("count"), F.lit(0)))
        totals = totals.withColumn(f"_n{i}", repeats.scalar())

    def row(i: int, e: Expectation) -> Column:
        if e.check == EXISTS:
            found = e.column in df.columns
            checked, offending, success = F.lit(1), F.lit(0 if found else 1), F.lit(found)
        elif e.column not in df.columns:
            checked, offending, success = F.lit(0), F.lit(0), F.lit(False)
        else:
            checked = F.col("_rows" if e.check == NOT_NULL else f"_filled_{e.column}")
            offending = F.col(f"_n{i}")
            share = F.try_divide((checked - offending).cast("double"), checked.cast("double"))
            success = F.coalesce(share >= e.mostly, F.lit(True))
        return F.struct(
            F.lit(table_name).alias("table_name"),
            F.lit(e.check).alias("expectation"),
            F.lit(e.column).alias("column_name"),
            F.lit("critical" if e.check in CRITICAL_CHECKS[layer] else "warning").alias("severity"),
            checked.cast("bigint").alias("checked_rows"),
            offending.cast("bigint").alias("unexpected_rows"),
            success.alias("success"),
        )

    return totals.select(F.inline(F.array(*[row(i, e) for i, e in numbered])))


def table_status(results: DataFrame) -> DataFrame:
    """Per table: PASSED or FAILED, and the failed checks as ``; ``-joined text."""
    message = F.format_string("%s failed on column '%s'", "expectation", "column_name")  # fixed value: text in result rows
    failed = F.when(~F.col("success"), message)

    def joined(severity: str) -> Column:
        return F.array_join(F.sort_array(F.collect_list(F.when(F.col("severity") == severity, failed))), "; ")

    def failures(severity: str) -> Column:
        return F.count_if(~F.col("success") & (F.col("severity") == severity))

    return results.groupBy("table_name").agg(
        F.when(failures("critical") > 0, "FAILED").otherwise("PASSED").alias("status"),
        failures("critical").alias("critical_count"),
        failures("warning").alias("warning_count"),
        joined("critical").alias("critical"),
        joined("warning").alias("warnings"),
    )


def require_passed(results: DataFrame) -> DataFrame:
    """Raise :class:`QualityFailure` if any table failed; else the status frame."""
    status = table_status(results)
    failed = [r.table_name for r in status.where("status = 'FAILED'").orderBy("table_name").collect()]
    if failed:
        raise QualityFailure(f"Critical expectations failed on: {failed}")
    return status
