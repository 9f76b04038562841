"""Gold layer: the four marts, and questions asked of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.columns import average, month_of, ratio, total
from shelfline.names import CHANNELS


def revenue_mart(orders: DataFrame) -> DataFrame:
    """One row per day, channel and order status, without days of negative revenue."""
    return (
        orders.groupBy("order_date", "channel", "order_status")
        .agg(
            F.expr(f"{total('revenue')} AS total_revenue"),
            F.expr("sum(quantity) AS total_quantity"),
            F.expr("count(order_id) AS order_count"),
            F.expr(f"{average('revenue')} AS avg_order_value"),
        )
        .withColumn("order_month", F.expr(month_of("order_date")))
        .where("total_revenue >= 0")
    )


def channel_performance_mart(orders: DataFrame) -> DataFrame:
    """Monthly figures per channel; ``unknown`` counts as one customer."""
    return orders.groupBy(F.expr(f"{month_of('order_date')} AS order_month"), "channel").agg(
        F.expr(f"{total('revenue')} AS total_revenue"),
        F.expr("sum(quantity) AS total_units_sold"),
        F.expr("count(order_id) AS total_orders"),
        F.expr(f"{average('revenue')} AS avg_order_value"),
        F.expr("count(DISTINCT customer_id) AS unique_customers"),
    )


def customer_360_mart(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Lifetime figures of every known customer, buying or not."""
    # two channels are counted as two flags, so one shuffle by customer is enough
    used = [f"max(CASE WHEN channel = '{c}' THEN 1L ELSE 0L END)" for c in CHANNELS]
    metrics = (
        orders.where("customer_id IS NOT NULL")
        .groupBy("customer_id")
        .agg(
            F.expr(f"{total('revenue')} AS lifetime_revenue"),
            F.expr("count(order_id) AS total_orders"),
            F.expr("sum(quantity) AS total_units_purchased"),
            F.expr(f"{average('revenue')} AS avg_order_value"),
            F.expr("min(order_date) AS first_order_date"),
            F.expr("max(order_date) AS last_order_date"),
            F.expr(f"{' + '.join(used)} AS channels_used"),
        )
    )
    return customers.join(metrics, "customer_id", "left").withColumns(
        {
            "lifetime_revenue": F.expr("coalesce(lifetime_revenue, CAST(0 AS DOUBLE))"),
            "total_orders": F.expr("coalesce(total_orders, 0L)"),
            "order_month": F.expr(month_of("last_order_date")),
        }
    )


def units_sold(orders: DataFrame) -> DataFrame:
    return orders.groupBy("product_id").agg(F.sum("quantity").alias("total_units_sold"))


def inventory_turnover_mart(inventory: DataFrame, orders: DataFrame) -> DataFrame:
    """Units sold against stock; each warehouse shows the product's full sales."""
    sold = "coalesce(total_units_sold, 0L)"
    return inventory.join(units_sold(orders), "product_id", "left").selectExpr(
        "inventory_id",
        "product_id",
        "warehouse_id",
        "quantity_available",
        "quantity_reserved",
        "quantity_available - quantity_reserved AS net_available",
        f"{sold} AS total_units_sold",
        f"{ratio(sold, 'quantity_available')} AS turnover_ratio",
        "last_updated",
        f"{month_of('last_updated')} AS order_month",
    )


#: Sketches of distinct customers: 2**12 registers, a standard error of 1.63 per cent; three of these are what is stated.
SKETCH_LOG_K = 12
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_LOG_K / 2)


def channel_customers(orders: DataFrame) -> DataFrame:
    """Distinct customers per channel and month, exactly and as a sketch that can be merged over months."""
    return orders.groupBy(F.expr(f"{month_of('order_date')} AS order_month"), "channel").agg(
        F.expr("count(DISTINCT customer_id) AS unique_customers"),
        F.hll_sketch_agg("customer_id", F.lit(SKETCH_LOG_K)).alias("customer_sketch"),
    )


def quarter_customers(monthly: DataFrame) -> DataFrame:
    """Estimated distinct customers per channel and quarter, from the monthly sketches alone."""
    quarter = "concat(substring(order_month, 1, 4), '-Q', CAST(ceil(CAST(substring(order_month, 6, 2) AS INT) / 3) AS STRING))"
    return (
        monthly.groupBy(F.expr(f"{quarter} AS quarter"), "channel")
        .agg(F.hll_union_agg("customer_sketch").alias("customer_sketch"))
        .select("quarter", "channel", F.hll_sketch_estimate("customer_sketch").alias("estimated_customers"))
    )


def in_months(mart: DataFrame, first_month: str, last_month: str) -> DataFrame:
    """Rows of a mart for a range of months; prunes the month partitions."""
    return mart.where(F.col("order_month").between(first_month, last_month))


def month_over_month(channel_mart: DataFrame) -> DataFrame:
    """Each channel's month beside the month it last traded in.

    One row per channel and month is left here, so a window per channel is small.
    """
    earlier = Window.partitionBy("channel").orderBy("order_month")
    previous = F.lag("total_revenue").over(earlier)
    return channel_mart.select(
        "channel",
        "order_month",
        "total_revenue",
        previous.alias("previous_revenue"),
        F.try_divide(F.col("total_revenue") - previous, previous).alias("revenue_change"),
    )


def tables(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All marts as plans over the silver tables."""
    orders = silver["orders"]
    return {
        "revenue_mart": revenue_mart(orders),
        "channel_performance_mart": channel_performance_mart(orders),
        "customer_360_mart": customer_360_mart(orders, silver["customers"]),
        "inventory_turnover_mart": inventory_turnover_mart(silver["inventory"], orders),
    }
