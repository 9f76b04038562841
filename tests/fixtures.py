"""Small hand-made feeds."""

from __future__ import annotations

import datetime as dt

STOREFRONT_DDL = (
    "order_id string, customer_id string, product_id string, order_date date, "
    "quantity int, revenue double, order_status string"
)
MARKETPLACE_DDL = (
    "marketplace_order_id string, customer_id string, sku string, "
    "quantity int, revenue double, order_timestamp timestamp"
)
INVENTORY_DDL = (
    "inventory_id string, product_id string, warehouse_id string, "
    "quantity_available int, quantity_reserved int, last_updated timestamp"
)


def day(n: int, month: int = 6) -> dt.date:
    return dt.date(2026, month, n)


def at(n: int, hour: int = 10) -> dt.datetime:
    return dt.datetime(2026, 6, n, hour, 0, 0)


def storefront(spark):
    return spark.createDataFrame(
        [
            ("SHOP-1", "CUST-1", "PROD-1", day(1), 2, 100.0, "placed"),
            ("SHOP-1", "CUST-1", "PROD-1", day(2), 2, 100.0, "shipped"),
            ("SHOP-2", "CUST-2", "PROD-2", day(1), 1, 50.0, None),
            ("SHOP-3", "CUST-1", "PROD-1", day(1), 1, 25.5, "placed"),
        ],
        STOREFRONT_DDL,
    )


def marketplace(spark):
    return spark.createDataFrame(
        [
            ("AMZN-1", "CUST-1", "PROD-1", 4, 10.0, at(3)),
            ("AMZN-2", None, "PROD-3", 3, 30.0, at(4)),
            ("AMZN-3", "CUST-9", "PROD-2", 1, 5.0, at(4)),
            (None, "CUST-9", "PROD-2", 1, 5.0, at(4)),
        ],
        MARKETPLACE_DDL,
    )


def inventory(spark):
    return spark.createDataFrame(
        [
            ("INV-1", "PROD-1", "WH-01", 10, 3, at(1)),
            ("INV-1", "PROD-1", "WH-01", 20, 4, at(2)),
            ("INV-2", "PROD-1", "WH-02", 0, None, at(1)),
            ("INV-3", "PROD-7", "WH-01", 5, 9, at(1)),
            ("INV-4", "PROD-2", "WH-01", None, 1, at(1)),
            (None, "PROD-2", "WH-01", 1, 1, at(1)),
        ],
        INVENTORY_DDL,
    )


def feeds(spark):
    from shelfline.names import INVENTORY_TABLE, MARKETPLACE_TABLE, STOREFRONT_TABLE

    return {
        STOREFRONT_TABLE: storefront(spark),
        MARKETPLACE_TABLE: marketplace(spark),
        INVENTORY_TABLE: inventory(spark),
    }
