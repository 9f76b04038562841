"""Feeds derived from the order-line, part and event tables of a data folder.

``lineitem`` joined to ``orders`` gives the lines of both sales channels: lines
returned go through the marketplace, all others through the storefront, so each
line belongs to exactly one feed. Repeated (order, line) keys occur in the table
by itself. Nulls, the drift column and late dates are put in by key rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.columns import padded_id
from shelfline.names import INVENTORY_TABLE, MARKETPLACE_TABLE, STOREFRONT_TABLE
from shelfline.operators.batches import add_batch_columns
from shelfline.operators.defects import (
    hit,
    inject_late_arrivals,
    inject_nulls,
    inject_schema_drift,
)
from shelfline.sources.workspace import stored

# Integer key carried through the defect rules and dropped at the end.
KEY = "_key"
LATE_SHIFT = 5000
COPY_SHIFT = 100


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with their order. Both feeds are cut from this one frame."""
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    # Both tables grow with the data, so neither is broadcast; a hot order key is
    # split by the adaptive skew join.
    return lines.join(orders.hint("merge"), F.expr("l_orderkey = o_orderkey"))


#: What the feeds are made of, of an order line.
LINE_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_shipdate", "l_quantity", "l_extendedprice",
    "o_custkey", "o_orderstatus",
)


def stored_lines(spark: SparkSession, folder: str, root: str) -> DataFrame:
    """The lines as a table below ``root``, for runs that read the feeds several times: they are joined once."""
    return stored(spark, order_lines(spark, folder).select(*LINE_COLUMNS), root, "raw/lines")


_LINE_KEY = f"l_orderkey * 10 + l_linenumber AS {KEY}"
_CUSTOMER = f"{padded_id('CUST-', 'o_custkey', 5)} AS customer_id"
_PRODUCT = padded_id("PROD-", "l_partkey", 4)


def _line_id(prefix: str) -> str:
    return f"concat({padded_id(prefix, 'l_orderkey', 6)}, '-', l_linenumber)"


def _clean_storefront(lines: DataFrame) -> DataFrame:
    return lines.where("NOT l_returnflag <=> 'R'").selectExpr(
        _LINE_KEY,
        f"{_line_id('SHOP-')} AS order_id",
        _CUSTOMER,
        f"{_PRODUCT} AS product_id",
        "CAST(l_shipdate AS DATE) AS order_date",
        "CAST(l_quantity AS INT) AS quantity",
        "l_extendedprice AS revenue",
        "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'placed' WHEN 'P' THEN 'shipped' END AS order_status",
    )


def _clean_marketplace(lines: DataFrame) -> DataFrame:
    return lines.where("l_returnflag <=> 'R'").selectExpr(
        _LINE_KEY,
        f"{_line_id('AMZN-')} AS marketplace_order_id",
        _CUSTOMER,
        f"{_PRODUCT} AS sku",
        "CAST(l_quantity AS INT) AS quantity",
        "l_extendedprice AS revenue",
        "l_shipdate AS order_timestamp",
    )


def _damaged_storefront(lines: DataFrame) -> DataFrame:
    return inject_schema_drift(inject_nulls(_clean_storefront(lines), ["order_status"], KEY), KEY)


def _damaged_marketplace(lines: DataFrame) -> DataFrame:
    return inject_nulls(_clean_marketplace(lines), ["customer_id"], KEY)


def clean_storefront(spark: SparkSession, folder: str) -> DataFrame:
    """Storefront lines without defects, with their key."""
    return _clean_storefront(order_lines(spark, folder))


def clean_marketplace(spark: SparkSession, folder: str) -> DataFrame:
    """Marketplace lines without defects, with their key."""
    return _clean_marketplace(order_lines(spark, folder))


def raw_storefront(spark: SparkSession, folder: str) -> DataFrame:
    return _damaged_storefront(order_lines(spark, folder)).drop(KEY)


def raw_marketplace(spark: SparkSession, folder: str) -> DataFrame:
    return _damaged_marketplace(order_lines(spark, folder)).drop(KEY)


def raw_sales(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Storefront and marketplace feed, cut from ``lines`` where those are stored."""
    lines = order_lines(spark, folder) if lines is None else lines
    return _damaged_storefront(lines).drop(KEY), _damaged_marketplace(lines).drop(KEY)


def raw_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Stock positions per part; some are sent again later with new figures."""
    resent = hit("p_partkey", 0.02, COPY_SHIFT)
    never_sold = "CASE WHEN p_partkey % 40 = 0 THEN p_partkey + 1000000 ELSE p_partkey END"
    return (
        table(spark, folder, "part")
        .selectExpr(
            "p_partkey", "p_size", f"explode(CASE WHEN {resent} THEN array(0, 1) ELSE array(0) END) AS _copy"
        )
        .selectExpr(
            f"{padded_id('INV-', 'p_partkey', 5)} AS inventory_id",
            f"{padded_id('PROD-', never_sold, 4)} AS product_id",
            f"{padded_id('WH-', '(p_partkey % 5 + 1)', 2)} AS warehouse_id",
            "(p_size - 1) * 20 + _copy * 5 AS quantity_available",
            f"CASE WHEN _copy = 1 THEN 3 WHEN NOT {hit('p_partkey', 0.03)} THEN CAST(p_partkey % 100 AS INT) END "
            "AS quantity_reserved",
            "CAST(CASE WHEN _copy = 1 THEN '2001-11-03 09:00:00' WHEN p_partkey % 2 = 0 THEN '2001-10-30 10:00:00' "
            "ELSE '2001-11-02 11:30:00' END AS TIMESTAMP) AS last_updated",
        )
    )


def raw_feeds(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> dict[str, DataFrame]:
    storefront, marketplace = raw_sales(spark, folder, lines)
    return {
        STOREFRONT_TABLE: storefront,
        MARKETPLACE_TABLE: marketplace,
        INVENTORY_TABLE: raw_inventory(spark, folder),
    }


def _stamped(feed: DataFrame, source_system: str, date_column: str) -> DataFrame:
    """One batch per day; afterwards some dates are moved before their batch."""
    day = f"date_format({date_column}, 'yyyy-MM-dd')"
    stamped = add_batch_columns(
        feed, source_system, F.expr(f"concat('batch-', {day})"), F.expr(f"concat({day}, 'T00:00:00+00:00')")
    )
    return inject_late_arrivals(stamped, date_column, KEY, shift=LATE_SHIFT).drop(KEY)


def sales_history(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Bronze storefront and marketplace filled by one batch a day, some rows late."""
    lines = order_lines(spark, folder)
    return (
        _stamped(_damaged_storefront(lines), STOREFRONT_TABLE, "order_date"),
        _stamped(_damaged_marketplace(lines), MARKETPLACE_TABLE, "order_timestamp"),
    )


def broken_storefront(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    """Storefront batch as text, breaking every kind of contract rule."""

    def spoiled(column: str, *defects: tuple[str, int]) -> str:
        cases = " ".join(f"WHEN {hit(KEY, 0.01, shift)} THEN {value}" for value, shift in defects)
        return f"CASE {cases} ELSE CAST({column} AS STRING) END AS {column}"

    return _damaged_storefront(order_lines(spark, folder) if lines is None else lines).selectExpr(
        "order_id",
        spoiled("product_id", ("NULL", 4000)),
        spoiled("order_date", ("'soon'", 5000)),
        spoiled("quantity", ("'0'", 1000), ("'n/a'", 2000)),
        spoiled("revenue", ("'-10.00'", 3000)),
        spoiled("order_status", ("'lost'", 6000)),
        "promo_code_applied",
    )


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """Scheduler run log: one run per event; some failed, some still running."""
    return table(spark, folder, "events").selectExpr(
        "event_type AS dag_id",
        "CASE event_id % 10 WHEN 0 THEN 'failed' WHEN 1 THEN 'running' ELSE 'success' END AS state",
        "ts AS execution_date",
        "ts AS start_date",
        "CASE WHEN event_id % 10 <> 1 THEN ts + make_dt_interval(0, 0, 0, floor(value)) END AS end_date",
    )
