"""Quality suites of the bronze and silver tables, and the gold presence check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.names import BATCH_COLUMNS, CHANNELS, INVENTORY_TABLE, MARKETPLACE_TABLE, STOREFRONT_TABLE
from shelfline.operators.expectations import (
    Expectation,
    between,
    QualityFailure,
    evaluate,
    exists,
    in_set,
    not_null,
    require_passed,
    unique,
)

_BATCH_CHECKS = [check for c in BATCH_COLUMNS for check in (exists(c), not_null(c))]

# The checks of each table and their thresholds.
SUITES: dict[str, dict[str, list[Expectation]]] = {
    "bronze": {
        STOREFRONT_TABLE: [
            not_null("order_id"),
            between("revenue", min_value=0, mostly=0.99),
            between("quantity", min_value=1, mostly=0.99),
            *_BATCH_CHECKS,
        ],
        MARKETPLACE_TABLE: [
            not_null("marketplace_order_id"),
            between("revenue", min_value=0, mostly=0.99),
            *_BATCH_CHECKS,
        ],
        INVENTORY_TABLE: [
            not_null("inventory_id"),
            between("quantity_available", min_value=0, mostly=0.99),
            *_BATCH_CHECKS,
        ],
    },
    "silver": {
        "orders": [
            not_null("order_id"),
            unique("order_id"),
            between("revenue", min_value=0),
            between("quantity", min_value=1),
            in_set("channel", CHANNELS),
            not_null("order_date"),
        ],
        "customers": [not_null("customer_id"), unique("customer_id"), in_set("source", CHANNELS)],
        "products": [not_null("product_id"), unique("product_id")],
        "inventory": [
            not_null("inventory_id"),
            between("quantity_available", min_value=0),
            not_null("quantity_reserved"),
        ],
    },
}


def check_table(df: DataFrame, layer: str, table: str) -> DataFrame:
    return evaluate(df, f"{layer}.{table}", layer, SUITES[layer][table])


def check_layer(tables: dict[str, DataFrame], layer: str) -> DataFrame:
    """Results of every suite of a layer, one pass per table."""
    return reduce(DataFrame.unionByName, [check_table(df, layer, t) for t, df in tables.items()])


def layer_gate(tables: dict[str, DataFrame], layer: str) -> DataFrame:
    """Status per table; raises when a critical expectation failed."""
    return require_passed(check_layer(tables, layer))


def failed_checks(df: DataFrame, layer: str, table: str) -> str | None:
    """Why a table, or a batch on its way into it, does not pass; nothing if it does."""
    try:
        require_passed(check_table(df, layer, table))
    except QualityFailure as failure:
        return str(failure)
    return None


def gold_nonempty(marts: dict[str, DataFrame]) -> DataFrame:
    """Row count and status per mart."""
    counts = [
        mart.agg(F.lit(name).alias("mart"), F.count(F.lit(1)).alias("row_count")) for name, mart in marts.items()
    ]
    return reduce(DataFrame.unionByName, counts).withColumn(
        "status", F.when(F.col("row_count") > 0, "PASSED").otherwise("FAILED")
    )


# What each mart is made of: it may be empty only where that is empty, too.
_MADE_OF = {
    "revenue_mart": "orders",
    "channel_performance_mart": "orders",
    "customer_360_mart": "customers",
    "inventory_turnover_mart": "inventory",
}


def gold_gate(marts: dict[str, DataFrame], silver: dict[str, DataFrame] | None = None) -> DataFrame:
    """Status per mart; raises when a mart is empty.

    With ``silver`` given, a mart whose source has no rows may be empty.
    """
    status = gold_nonempty(marts)
    empty = [r.mart for r in status.where("status = 'FAILED'").collect()]
    failed = [m for m in empty if silver is None or not silver[_MADE_OF[m]].isEmpty()]
    if failed:
        raise QualityFailure(f"no rows in {', '.join(sorted(failed))}")
    return status
