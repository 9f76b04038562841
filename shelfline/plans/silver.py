"""Silver layer: conformed orders, customers, products and inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.columns import as_date, as_double, as_int, as_timestamp
from shelfline.names import (
    INVENTORY,
    INVENTORY_COLUMNS,
    INVENTORY_TABLE,
    MARKETPLACE,
    MARKETPLACE_TABLE,
    ORDER_COLUMNS,
    STOREFRONT,
    STOREFRONT_TABLE,
    UNKNOWN,
)
from shelfline.operators.dedup import first_source, latest_per_key


def conform_storefront(bronze: DataFrame) -> DataFrame:
    """Storefront lines; the status may be missing as a value or as a column."""
    status = f"coalesce(order_status, '{UNKNOWN}')" if "order_status" in bronze.columns else f"'{UNKNOWN}'"
    return bronze.selectExpr(
        "order_id",
        "customer_id",
        "product_id",
        f"{as_date('order_date')} AS order_date",
        f"{as_int(bronze, 'quantity')} AS quantity",
        f"{as_double('revenue')} AS revenue",
        f"{status} AS order_status",
        f"'{STOREFRONT}' AS channel",
    )


def conform_marketplace(bronze: DataFrame) -> DataFrame:
    """Marketplace lines; this source has no status, and may lack the customer."""
    return bronze.selectExpr(
        "marketplace_order_id AS order_id",
        f"coalesce(customer_id, '{UNKNOWN}') AS customer_id",
        "sku AS product_id",
        f"{as_date('order_timestamp')} AS order_date",
        f"{as_int(bronze, 'quantity')} AS quantity",
        f"{as_double('revenue')} AS revenue",
        f"'{UNKNOWN}' AS order_status",
        f"'{MARKETPLACE}' AS channel",
    )


def orders(storefront: DataFrame, marketplace: DataFrame) -> DataFrame:
    """Lines of both channels, newest version of each (order_id, channel)."""
    lines = conform_storefront(storefront).unionByName(conform_marketplace(marketplace))
    return latest_per_key(
        lines.where("order_id IS NOT NULL"),
        keys=["order_id", "channel"],
        order_col="order_date",
        tie_breaks=["revenue", "quantity", "product_id", "customer_id", "order_status"],
    ).select(*ORDER_COLUMNS)


def _created(df: DataFrame, created_at: Column | None) -> DataFrame:
    return df.withColumn("_created_at", F.current_timestamp() if created_at is None else created_at)


def customers(storefront: DataFrame, marketplace: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Known customers with the first channel that has them."""
    feeds = [
        (STOREFRONT, storefront.select("customer_id")),
        (MARKETPLACE, marketplace.select("customer_id")),
    ]
    return _created(first_source(feeds, "customer_id"), created_at)


def products(
    storefront: DataFrame, marketplace: DataFrame, inventory_feed: DataFrame, created_at: Column | None = None
) -> DataFrame:
    """Known products with the first source that has them."""
    feeds = [
        (STOREFRONT, storefront.select("product_id")),
        (MARKETPLACE, marketplace.select(F.col("sku").alias("product_id"))),
        (INVENTORY, inventory_feed.select("product_id")),
    ]
    return _created(first_source(feeds, "product_id"), created_at)


def inventory(inventory_feed: DataFrame) -> DataFrame:
    """Newest stock position per inventory_id.

    Nothing reserved is 0; a reserved figure that cannot be read stays unknown.
    """
    reserved = as_int(inventory_feed, "quantity_reserved")
    positions = inventory_feed.where("inventory_id IS NOT NULL").selectExpr(
        "inventory_id",
        "product_id",
        "warehouse_id",
        f"{as_int(inventory_feed, 'quantity_available')} AS quantity_available",
        f"CASE WHEN quantity_reserved IS NULL THEN 0 ELSE {reserved} END AS quantity_reserved",
        f"{as_timestamp('last_updated')} AS last_updated",
    )
    return (
        latest_per_key(
            positions,
            keys=["inventory_id"],
            order_col="last_updated",
            tie_breaks=["quantity_available", "quantity_reserved", "product_id", "warehouse_id"],
        )
        .withColumn("order_date", F.expr(as_date("last_updated")))
        .select(*INVENTORY_COLUMNS)
    )


def in_period(table: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Rows of a table stored by ``order_date`` for a business period."""
    return table.where(F.col("order_date").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date")))


def tables(bronze: dict[str, DataFrame], created_at: Column | None = None) -> dict[str, DataFrame]:
    """All silver tables as plans over the bronze ones."""
    storefront, marketplace, stock = (
        bronze[t] for t in (STOREFRONT_TABLE, MARKETPLACE_TABLE, INVENTORY_TABLE)
    )
    return {
        "orders": orders(storefront, marketplace),
        "customers": customers(storefront, marketplace, created_at),
        "products": products(storefront, marketplace, stock, created_at),
        "inventory": inventory(stock),
    }
