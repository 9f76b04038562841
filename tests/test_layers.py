import datetime as dt
import random

import fixtures as fx
import pytest

from shelfline.names import ORDER_COLUMNS
from shelfline.plans import gold, silver


@pytest.fixture
def orders(spark):
    return silver.orders(fx.storefront(spark), fx.marketplace(spark))


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_orders_are_conformed(orders):
    rows = by(orders, "order_id")
    assert orders.columns == list(ORDER_COLUMNS)
    assert set(rows) == {"SHOP-1", "SHOP-2", "SHOP-3", "AMZN-1", "AMZN-2", "AMZN-3"}
    assert rows["SHOP-1"].order_date == fx.day(2) and rows["SHOP-1"].order_status == "shipped"
    assert rows["SHOP-2"].order_status == "unknown"
    assert rows["AMZN-2"].customer_id == "unknown" and rows["AMZN-2"].channel == "amazon"
    assert rows["AMZN-1"].order_date == fx.day(3) and rows["AMZN-1"].order_status == "unknown"


def test_storefront_customer_stays_null(spark):
    feed = spark.createDataFrame([("SHOP-9", None, "PROD-1", fx.day(1), 1, 1.0, "placed")], fx.STOREFRONT_DDL)
    assert silver.conform_storefront(feed).first().customer_id is None


def test_text_feeds_do_not_raise(spark):
    feed = spark.createDataFrame(
        [("S", "C", "P", "soon", "many", "cheap", "placed"), ("T", "C", "P", "2026-06-14 00:00:00", "2.0", "9.5", None)],
        "order_id string, customer_id string, product_id string, order_date string, quantity string, revenue string, order_status string",
    )
    rows = by(silver.conform_storefront(feed), "order_id")
    assert (rows["S"].order_date, rows["S"].quantity, rows["S"].revenue) == (None, None, None)
    assert (rows["T"].order_date, rows["T"].quantity, rows["T"].revenue) == (dt.date(2026, 6, 14), 2, 9.5)


def test_customers_and_products_name_their_first_source(spark):
    customers = by(silver.customers(fx.storefront(spark), fx.marketplace(spark)), "customer_id")
    assert {k: r.source for k, r in customers.items()} == {"CUST-1": "shopify", "CUST-2": "shopify", "CUST-9": "amazon"}
    products = by(silver.products(fx.storefront(spark), fx.marketplace(spark), fx.inventory(spark)), "product_id")
    assert {k: r.source for k, r in products.items()} == {
        "PROD-1": "shopify", "PROD-2": "shopify", "PROD-3": "amazon", "PROD-7": "inventory",
    }
    assert all(r._created_at for r in products.values())


def test_inventory_keeps_newest_position(spark):
    rows = by(silver.inventory(fx.inventory(spark)), "inventory_id")
    assert set(rows) == {"INV-1", "INV-2", "INV-3", "INV-4"}
    assert (rows["INV-1"].quantity_available, rows["INV-1"].order_date) == (20, fx.day(2))
    assert rows["INV-2"].quantity_reserved == 0


def test_revenue_mart(spark):
    orders = spark.createDataFrame(
        [
            ("O1", "c", "p", fx.day(1), 2, 100.0, "placed", "shopify"),
            ("O2", "c", "p", fx.day(1), 1, 50.0, "placed", "shopify"),
            ("O3", "c", "p", fx.day(2), 1, None, "placed", "shopify"),
            ("O4", "c", "p", fx.day(3), None, None, "placed", "shopify"),
            ("O5", "c", "p", fx.day(3), 1, 5.0, "placed", "shopify"),
            ("O6", "c", "p", fx.day(4), 1, -5.0, "placed", "shopify"),
        ],
        "order_id string, customer_id string, product_id string, order_date date, quantity int, revenue double, order_status string, channel string",
    )
    rows = by(gold.revenue_mart(orders), "order_date")
    assert set(rows) == {fx.day(1), fx.day(3)}
    first = rows[fx.day(1)]
    assert (first.total_revenue, first.total_quantity, first.order_count) == (150.0, 3, 2)
    assert (first.avg_order_value, first.order_month) == (75.0, "2026-06")
    assert (rows[fx.day(3)].avg_order_value, rows[fx.day(3)].order_count) == (5.0, 2)


def test_channel_mart_counts_unknown_as_a_customer(orders):
    rows = by(gold.channel_performance_mart(orders), "channel")
    assert rows["amazon"].unique_customers == 3
    assert rows["shopify"].total_units_sold == 4
    assert rows["shopify"].total_revenue == 175.5


def test_customer_360(spark, orders):
    customers = silver.customers(fx.storefront(spark), fx.marketplace(spark)).unionByName(
        spark.sql("SELECT 'CUST-0' customer_id, 'amazon' source, current_timestamp() _created_at")
    )
    rows = by(gold.customer_360_mart(orders, customers), "customer_id")
    assert "unknown" not in rows
    one = rows["CUST-1"]
    assert (one.lifetime_revenue, one.total_orders, one.channels_used) == (135.5, 3, 2)
    assert (one.first_order_date, one.last_order_date, one.order_month) == (fx.day(1), fx.day(3), "2026-06")
    none = rows["CUST-0"]
    assert (none.lifetime_revenue, none.total_orders, none.total_units_purchased, none.order_month) == (0.0, 0, None, None)
    missing = 175.5 + 45.0 - sum(r.lifetime_revenue for r in rows.values())
    assert missing == 30.0  # the order of the unknown customer


def test_inventory_turnover(spark, orders):
    rows = by(gold.inventory_turnover_mart(silver.inventory(fx.inventory(spark)), orders), "inventory_id")
    assert (rows["INV-1"].total_units_sold, rows["INV-1"].turnover_ratio, rows["INV-1"].net_available) == (7, 0.35, 16)
    assert (rows["INV-2"].total_units_sold, rows["INV-2"].turnover_ratio) == (7, 0.0)
    assert (rows["INV-3"].total_units_sold, rows["INV-3"].turnover_ratio, rows["INV-3"].net_available) == (0, 0.0, -4)
    assert (rows["INV-4"].turnover_ratio, rows["INV-4"].net_available) == (0.0, None)


def test_month_over_month(spark):
    mart = spark.createDataFrame(
        [("a", "2026-01", 100.0), ("a", "2026-03", 150.0), ("b", "2026-03", 0.0), ("b", "2026-04", 5.0)],
        "channel string, order_month string, total_revenue double",
    )
    out = {(r.channel, r.order_month): (r.previous_revenue, r.revenue_change) for r in gold.month_over_month(mart).collect()}
    assert out == {
        ("a", "2026-01"): (None, None), ("a", "2026-03"): (100.0, 0.5),
        ("b", "2026-03"): (None, None), ("b", "2026-04"): (0.0, None),
    }


def test_sums_agree_across_marts(orders):
    daily = gold.revenue_mart(orders).selectExpr("sum(total_revenue) s").first().s
    monthly = gold.channel_performance_mart(orders).selectExpr("sum(total_revenue) s").first().s
    assert daily == monthly == orders.selectExpr("sum(revenue) s").first().s


def test_row_order_does_not_matter(spark, same_rows):
    storefront, marketplace = fx.storefront(spark).collect(), fx.marketplace(spark).collect()
    marts = []
    for seed in (1, 2):
        random.Random(seed).shuffle(storefront)
        random.Random(seed).shuffle(marketplace)
        orders = silver.orders(
            spark.createDataFrame(storefront, fx.STOREFRONT_DDL), spark.createDataFrame(marketplace, fx.MARKETPLACE_DDL)
        )
        marts.append(gold.revenue_mart(orders))
    same_rows(*marts)


def test_monthly_sums_agree_on_the_test_tables(spark):
    from shelfline.registry import QUERIES

    folder = "/root/testdata/sf0.001"
    orders = QUERIES["silver_orders"](spark, folder)
    daily = gold.revenue_mart(orders).groupBy("order_month", "channel").sum("order_count", "total_quantity")
    monthly = gold.channel_performance_mart(orders).select("order_month", "channel", "total_orders", "total_units_sold")
    assert {tuple(r) for r in daily.collect()} == {tuple(r) for r in monthly.collect()}


def test_unknown_customers_are_missing_from_customer_360(spark):
    from shelfline.registry import QUERIES

    folder = "/root/testdata/sf0.001"
    orders = QUERIES["silver_orders"](spark, folder)
    known = QUERIES["customer_360_mart"](spark, folder).selectExpr("sum(total_orders) n").first().n
    unknown = orders.where("customer_id = 'unknown'").count()
    assert unknown > 0
    assert known + unknown == orders.count()
