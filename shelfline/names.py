"""Labels that are stored in the data, and the schemas of every table."""

from __future__ import annotations

from pyspark.sql import types as T

# Labels found in result rows. They must stay as they are so that
# existing tables, dashboards and checks keep working.
STOREFRONT = "shopify"
MARKETPLACE = "amazon"
INVENTORY = "inventory"
UNKNOWN = "unknown"
CHANNELS = (STOREFRONT, MARKETPLACE)
ORDER_STATUSES = ("placed", "shipped", "delivered", "cancelled")

STOREFRONT_TABLE = "shopify_orders"
MARKETPLACE_TABLE = "amazon_orders"
INVENTORY_TABLE = "inventory_feed"

BRONZE_TABLES = (STOREFRONT_TABLE, MARKETPLACE_TABLE, INVENTORY_TABLE)
SILVER_TABLES = ("orders", "customers", "products", "inventory")
GOLD_TABLES = (
    "revenue_mart",
    "channel_performance_mart",
    "customer_360_mart",
    "inventory_turnover_mart",
)

BATCH_COLUMNS = ("_ingestion_timestamp", "_source_system", "_batch_id", "_ingestion_date")

# Folder of the rows that were not let into bronze.
REJECTS = "rejects"

# Partition columns of one load of a batch, and of one version of a table.
LOAD_COLUMN = "_load_id"
VERSION_COLUMN = "_version"

# Partition columns of each stored table (None = not partitioned).
PARTITION_COLUMN = {
    "bronze": {t: (LOAD_COLUMN, "_ingestion_date", "_batch_id") for t in BRONZE_TABLES},
    "silver": {"orders": "order_date", "customers": None, "products": None, "inventory": "order_date"},
    "gold": {t: "order_month" for t in GOLD_TABLES},
}

# Columns of the stored tables, and the schemas of the feeds below.
ORDER_COLUMNS = (
    "order_id", "customer_id", "product_id", "order_date",
    "quantity", "revenue", "order_status", "channel",
)
INVENTORY_COLUMNS = (
    "inventory_id", "product_id", "warehouse_id",
    "quantity_available", "quantity_reserved", "last_updated", "order_date",
)

# Money is added up as a decimal, so that sums do not depend on row order.
MONEY = T.DecimalType(30, 8)

# Days and months that the registered period, replay and as-of queries ask for.
PERIOD = ("1998-03-01", "1998-03-31")
MONTHS = ("1998-01", "1998-03")
REPLAY_DAY = "1998-03-15"
AS_OF_DAY = "1998-06-30"
LATER_DAY = "1998-07-31"
DRIFT_START = "1998-07-01"


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


STOREFRONT_FEED = _struct(
    ("order_id", T.StringType()),
    ("customer_id", T.StringType()),
    ("product_id", T.StringType()),
    ("order_date", T.DateType()),
    ("quantity", T.IntegerType()),
    ("revenue", T.DoubleType()),
    ("order_status", T.StringType()),
    ("promo_code_applied", T.StringType()),
)
MARKETPLACE_FEED = _struct(
    ("marketplace_order_id", T.StringType()),
    ("customer_id", T.StringType()),
    ("sku", T.StringType()),
    ("quantity", T.IntegerType()),
    ("revenue", T.DoubleType()),
    ("order_timestamp", T.TimestampType()),
)
INVENTORY_FEED = _struct(
    ("inventory_id", T.StringType()),
    ("product_id", T.StringType()),
    ("warehouse_id", T.StringType()),
    ("quantity_available", T.IntegerType()),
    ("quantity_reserved", T.IntegerType()),
    ("last_updated", T.TimestampType()),
)
FEED_SCHEMAS = {
    STOREFRONT_TABLE: STOREFRONT_FEED,
    MARKETPLACE_TABLE: MARKETPLACE_FEED,
    INVENTORY_TABLE: INVENTORY_FEED,
}
