"""SQL twins of the registered queries, for DuckDB over the same tables.

Shared steps are common table expressions; :func:`sql` puts the ones a query
names, and those they need, in front of its text.
"""

from __future__ import annotations

from shelfline.names import AS_OF_DAY, DRIFT_START, LATER_DAY, MONTHS, PERIOD, REPLAY_DAY


def hit(key: str, rate: float, shift: int = 0) -> str:
    return f"((({key}) % 10000) * 7919 + {shift}) % 10000 < {round(rate * 10000)}"


_BATCH = """
  '2024-01-31T00:00:00+00:00' AS _ingestion_timestamp, '{source}' AS _source_system,
  'batch-1' AS _batch_id, DATE '2024-01-31' AS _ingestion_date"""

_LATEST_ORDER = """
  ROW_NUMBER() OVER (PARTITION BY order_id, channel
    ORDER BY order_date DESC NULLS LAST, revenue DESC NULLS LAST, quantity DESC NULLS LAST,
      product_id DESC NULLS LAST, customer_id DESC NULLS LAST, order_status DESC NULLS LAST) AS rn"""


def _latest(conformed: str) -> str:
    return f"""
SELECT order_id, customer_id, product_id, order_date, quantity, revenue, order_status, channel
FROM (SELECT *, {_LATEST_ORDER} FROM {conformed} WHERE order_id IS NOT NULL) WHERE rn = 1"""


def _conform_storefront(source: str, where: str = "TRUE") -> str:
    return f"""
SELECT order_id, customer_id, product_id, order_date, quantity, revenue,
  COALESCE(order_status, 'unknown') AS order_status, 'shopify' AS channel
FROM {source} WHERE {where}"""


def _conform_marketplace(source: str, where: str = "TRUE") -> str:
    return f"""
SELECT marketplace_order_id AS order_id, COALESCE(customer_id, 'unknown') AS customer_id,
  sku AS product_id, CAST(order_timestamp AS DATE) AS order_date, quantity, revenue,
  'unknown' AS order_status, 'amazon' AS channel
FROM {source} WHERE {where}"""


_MONEY = "CAST(revenue AS DECIMAL(18, 2))"
_TOTAL = f"CAST(SUM({_MONEY}) AS DOUBLE)"
_AVERAGE = f"{_TOTAL} / NULLIF(COUNT(revenue), 0)"

# name -> (steps it needs, text)
STEPS: dict[str, tuple[tuple[str, ...], str]] = {
    "order_lines": (
        (),
        """SELECT l.*, o.o_custkey, o.o_orderstatus, l.l_orderkey * 10 + l.l_linenumber AS k
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    ),
    "clean_storefront": (
        ("order_lines",),
        """SELECT k, printf('SHOP-%06d-%d', l_orderkey, l_linenumber) AS order_id,
  printf('CUST-%05d', o_custkey) AS customer_id, printf('PROD-%04d', l_partkey) AS product_id,
  CAST(l_shipdate AS DATE) AS order_date, CAST(FLOOR(l_quantity) AS INTEGER) AS quantity,
  l_extendedprice AS revenue,
  CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'placed' WHEN 'P' THEN 'shipped' END AS order_status
FROM order_lines WHERE l_returnflag IS DISTINCT FROM 'R'""",
    ),
    "damaged_storefront": (
        ("clean_storefront",),
        f"""SELECT * REPLACE (CASE WHEN NOT ({hit('k', 0.03)}) THEN order_status END AS order_status),
  CASE WHEN {hit('k', 0.01)} THEN printf('PROMO-%04d', k % 10000) END AS promo_code_applied
FROM clean_storefront""",
    ),
    "raw_storefront": (("damaged_storefront",), "SELECT * EXCLUDE (k) FROM damaged_storefront"),
    "clean_marketplace": (
        ("order_lines",),
        """SELECT k, printf('AMZN-%06d-%d', l_orderkey, l_linenumber) AS marketplace_order_id,
  printf('CUST-%05d', o_custkey) AS customer_id, printf('PROD-%04d', l_partkey) AS sku,
  CAST(FLOOR(l_quantity) AS INTEGER) AS quantity, l_extendedprice AS revenue, l_shipdate AS order_timestamp
FROM order_lines WHERE l_returnflag IS NOT DISTINCT FROM 'R'""",
    ),
    "damaged_marketplace": (
        ("clean_marketplace",),
        f"""SELECT * REPLACE (CASE WHEN NOT ({hit('k', 0.03)}) THEN customer_id END AS customer_id)
FROM clean_marketplace""",
    ),
    "raw_marketplace": (("damaged_marketplace",), "SELECT * EXCLUDE (k) FROM damaged_marketplace"),
    "raw_inventory": (
        (),
        f"""SELECT printf('INV-%05d', p_partkey) AS inventory_id,
  printf('PROD-%04d', CASE WHEN p_partkey % 40 = 0 THEN p_partkey + 1000000 ELSE p_partkey END) AS product_id,
  printf('WH-%02d', p_partkey % 5 + 1) AS warehouse_id,
  CAST((p_size - 1) * 20 + c * 5 AS INTEGER) AS quantity_available,
  CAST(CASE WHEN c = 1 THEN 3 WHEN NOT ({hit('p_partkey', 0.03)}) THEN p_partkey % 100 END AS INTEGER)
    AS quantity_reserved,
  CASE WHEN c = 1 THEN TIMESTAMP '2001-11-03 09:00:00'
       WHEN p_partkey % 2 = 0 THEN TIMESTAMP '2001-10-30 10:00:00'
       ELSE TIMESTAMP '2001-11-02 11:30:00' END AS last_updated
FROM part JOIN (VALUES (0), (1)) AS copies(c) ON c = 0 OR {hit('p_partkey', 0.02, 100)}""",
    ),
    "bronze_storefront": (("raw_storefront",), f"SELECT *, {_BATCH.format(source='shopify_orders')} FROM raw_storefront"),
    "bronze_marketplace": (("raw_marketplace",), f"SELECT *, {_BATCH.format(source='amazon_orders')} FROM raw_marketplace"),
    "bronze_inventory": (("raw_inventory",), f"SELECT *, {_BATCH.format(source='inventory_feed')} FROM raw_inventory"),
    "storefront_history": (
        ("damaged_storefront",),
        f"""SELECT * EXCLUDE (k) REPLACE (CAST(CASE WHEN {hit('k', 0.02, 5000)}
      THEN order_date - CAST(1 + k % 3 AS INTEGER) ELSE order_date END AS DATE) AS order_date),
  strftime(order_date, '%Y-%m-%d') || 'T00:00:00+00:00' AS _ingestion_timestamp,
  'shopify_orders' AS _source_system, 'batch-' || strftime(order_date, '%Y-%m-%d') AS _batch_id,
  order_date AS _ingestion_date
FROM damaged_storefront""",
    ),
    "marketplace_history": (
        ("damaged_marketplace",),
        f"""SELECT * EXCLUDE (k) REPLACE (CASE WHEN {hit('k', 0.02, 5000)}
      THEN order_timestamp - to_days(CAST(1 + k % 3 AS INTEGER)) ELSE order_timestamp END AS order_timestamp),
  strftime(order_timestamp, '%Y-%m-%d') || 'T00:00:00+00:00' AS _ingestion_timestamp,
  'amazon_orders' AS _source_system, 'batch-' || strftime(order_timestamp, '%Y-%m-%d') AS _batch_id,
  CAST(order_timestamp AS DATE) AS _ingestion_date
FROM damaged_marketplace""",
    ),
    "conform_storefront": (("raw_storefront",), _conform_storefront("raw_storefront")),
    "conform_marketplace": (("raw_marketplace",), _conform_marketplace("raw_marketplace")),
    "market_orders": (("conform_marketplace",), _latest("conform_marketplace")),
    "dirty_inventory": (
        ("raw_inventory",),
        """SELECT *, CASE WHEN CAST(substr(inventory_id, 5) AS INTEGER) % 7 = 0 THEN 'n/a'
  WHEN quantity_reserved IS NOT NULL THEN CAST(quantity_reserved AS VARCHAR) || '.0' END AS reserved_text
FROM raw_inventory""",
    ),
    "conformed": (
        ("conform_storefront", "conform_marketplace"),
        "SELECT * FROM conform_storefront UNION ALL BY NAME SELECT * FROM conform_marketplace",
    ),
    "silver_orders": (("conformed",), _latest("conformed")),
    "silver_customers": (
        ("raw_storefront", "raw_marketplace"),
        """SELECT customer_id, CASE MIN(p) WHEN 0 THEN 'shopify' ELSE 'amazon' END AS source
FROM (SELECT customer_id, 0 AS p FROM raw_storefront UNION ALL SELECT customer_id, 1 FROM raw_marketplace)
WHERE customer_id IS NOT NULL GROUP BY customer_id""",
    ),
    "silver_products": (
        ("raw_storefront", "raw_marketplace", "raw_inventory"),
        """SELECT product_id, CASE MIN(p) WHEN 0 THEN 'shopify' WHEN 1 THEN 'amazon' ELSE 'inventory' END AS source
FROM (SELECT product_id, 0 AS p FROM raw_storefront UNION ALL SELECT sku, 1 FROM raw_marketplace
      UNION ALL SELECT product_id, 2 FROM raw_inventory)
WHERE product_id IS NOT NULL GROUP BY product_id""",
    ),
    "silver_inventory": (
        ("raw_inventory",),
        """SELECT inventory_id, product_id, warehouse_id, quantity_available,
  COALESCE(quantity_reserved, 0) AS quantity_reserved, last_updated, CAST(last_updated AS DATE) AS order_date
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY inventory_id
        ORDER BY last_updated DESC NULLS LAST, quantity_available DESC NULLS LAST) AS rn
      FROM raw_inventory WHERE inventory_id IS NOT NULL) WHERE rn = 1""",
    ),
    "revenue_mart": (
        ("silver_orders",),
        f"""SELECT order_date, channel, order_status, {_TOTAL} AS total_revenue,
  CAST(SUM(quantity) AS BIGINT) AS total_quantity, COUNT(order_id) AS order_count,
  {_AVERAGE} AS avg_order_value, strftime(order_date, '%Y-%m') AS order_month
FROM silver_orders GROUP BY order_date, channel, order_status HAVING SUM({_MONEY}) >= 0""",
    ),
    "channel_performance_mart": (
        ("silver_orders",),
        f"""SELECT strftime(order_date, '%Y-%m') AS order_month, channel, {_TOTAL} AS total_revenue,
  CAST(SUM(quantity) AS BIGINT) AS total_units_sold, COUNT(order_id) AS total_orders,
  {_AVERAGE} AS avg_order_value, COUNT(DISTINCT customer_id) AS unique_customers
FROM silver_orders GROUP BY 1, 2""",
    ),
    "customer_360_mart": (
        ("silver_orders", "silver_customers"),
        f"""SELECT c.customer_id, c.source, COALESCE(m.total, 0.0) AS lifetime_revenue,
  COALESCE(m.n, 0) AS total_orders, m.units AS total_units_purchased, m.average AS avg_order_value,
  m.first_day AS first_order_date, m.last_day AS last_order_date, m.channels AS channels_used,
  strftime(m.last_day, '%Y-%m') AS order_month
FROM silver_customers c LEFT JOIN (
  SELECT customer_id, {_TOTAL} AS total, COUNT(order_id) AS n, CAST(SUM(quantity) AS BIGINT) AS units,
    {_AVERAGE} AS average, MIN(order_date) AS first_day, MAX(order_date) AS last_day,
    COUNT(DISTINCT channel) AS channels
  FROM silver_orders WHERE customer_id IS NOT NULL GROUP BY customer_id) m USING (customer_id)""",
    ),
    "inventory_turnover_mart": (
        ("silver_orders", "silver_inventory"),
        """SELECT i.inventory_id, i.product_id, i.warehouse_id, i.quantity_available, i.quantity_reserved,
  i.quantity_available - i.quantity_reserved AS net_available,
  COALESCE(s.units, 0) AS total_units_sold,
  CASE WHEN i.quantity_available > 0
       THEN CAST(COALESCE(s.units, 0) AS DOUBLE) / i.quantity_available ELSE 0.0 END AS turnover_ratio,
  i.last_updated, strftime(i.last_updated, '%Y-%m') AS order_month
FROM silver_inventory i LEFT JOIN (
  SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS units FROM silver_orders GROUP BY product_id) s
USING (product_id)""",
    ),
    "broken_storefront": (
        ("damaged_storefront",),
        f"""SELECT {hit('k', 0.01, 1000)} AS zero_quantity, {hit('k', 0.01, 2000)} AS no_quantity,
  {hit('k', 0.01, 3000)} AS negative_revenue, {hit('k', 0.01, 4000)} AS no_product,
  {hit('k', 0.01, 5000)} AS no_date, {hit('k', 0.01, 6000)} AS lost, order_status, promo_code_applied
FROM damaged_storefront""",
    ),
    "run_log": (
        (),
        """SELECT event_type AS dag_id,
  CASE event_id % 10 WHEN 0 THEN 'failed' WHEN 1 THEN 'running' ELSE 'success' END AS state,
  ts AS execution_date, ts AS start_date,
  CASE WHEN event_id % 10 <> 1 THEN ts + to_seconds(CAST(FLOOR(value) AS BIGINT)) END AS end_date
FROM events""",
    ),
}


def sql(select: str, *steps: str) -> str:
    """``select`` with the common table expressions it needs."""
    needed: list[str] = []

    def add(step: str) -> None:
        if step not in needed:
            for other in STEPS[step][0]:
                add(other)
            needed.append(step)

    for step in steps:
        add(step)
    if not needed:
        return select
    return "WITH " + ",\n".join(f"{s} AS ({STEPS[s][1]})" for s in needed) + f"\n{select}"


def step(name: str, columns: str = "*") -> str:
    return sql(f"SELECT {columns} FROM {name}", name)


def _union(selects: list[str]) -> str:
    return "\nUNION ALL\n".join(selects)


def _count_if(predicate: str) -> str:
    return f"COUNT(*) FILTER (WHERE {predicate})"


def _contract(source: str, rules: list[tuple[str, str, str, str]]) -> str:
    """Rows (rule, field, severity, n) with n as an aggregate over ``source``."""
    return sql(
        _union([
            f"SELECT '{rule}' AS rule, '{field}' AS field, '{severity}' AS severity, CAST({n} AS BIGINT) AS n FROM {source}"
            for rule, field, severity, n in rules
        ]),
        source,
    )


_ALLOWED = "('placed', 'shipped', 'delivered', 'cancelled')"

CLEAN_RULES = [
    ("unknown_field", "promo_code_applied", "warning", "MIN(1)"),
    *[("null_required", f, "critical", _count_if(f"{f} IS NULL"))
      for f in ("order_id", "customer_id", "product_id", "order_date", "quantity", "revenue")],
    ("outside_allowed", "order_status", "warning", _count_if(f"order_status NOT IN {_ALLOWED}")),
    ("validation", "quantity", "critical", _count_if("NOT quantity > 0")),
    ("validation", "revenue", "critical", _count_if("NOT revenue >= 0")),
]

BROKEN_RULES = [
    ("missing_required", "customer_id", "critical", "MIN(1)"),
    ("unknown_field", "promo_code_applied", "warning", "MIN(1)"),
    ("null_required", "order_id", "critical", "MIN(0)"),
    ("null_required", "product_id", "critical", _count_if("no_product")),
    ("null_required", "order_date", "critical", "MIN(0)"),
    ("null_required", "quantity", "critical", "MIN(0)"),
    ("null_required", "revenue", "critical", "MIN(0)"),
    ("wrong_type", "order_date", "warning", _count_if("no_date")),
    ("wrong_type", "quantity", "critical", _count_if("no_quantity AND NOT zero_quantity")),
    ("wrong_type", "revenue", "critical", "MIN(0)"),
    ("outside_allowed", "order_status", "warning", _count_if("lost")),
    ("validation", "quantity", "critical", _count_if("zero_quantity")),
    ("validation", "revenue", "critical", _count_if("negative_revenue")),
]


def _check(table: str, source: str, layer: str, check: str, column: str, bad: str, mostly: float = 1.0) -> str:
    """One expectation as a row; ``bad`` is the offending-row predicate or count."""
    critical = {
        "bronze": ("not_be_null", "to_exist"),
        "silver": ("not_be_null", "be_unique", "be_in_set"),
    }[layer]
    severity = "critical" if any(c in check for c in critical) else "warning"
    checked = "COUNT(*)" if "not_be_null" in check else f"COUNT({column})"
    offending = bad if bad.startswith("(SELECT") else _count_if(bad)
    if "to_exist" in check:
        checked, offending = "MIN(1)", "MIN(0)"
    return (
        f"SELECT '{table}' AS table_name, '{check}' AS expectation, '{column}' AS column_name, "
        f"'{severity}' AS severity, CAST({checked} AS BIGINT) AS checked_rows, "
        f"CAST({offending} AS BIGINT) AS unexpected_rows, "
        f"COALESCE(CAST({checked} - {offending} AS DOUBLE) / NULLIF({checked}, 0) >= {mostly}, TRUE) AS success "
        f"FROM {source}"
    )


NULL = "expect_column_values_to_not_be_null"
BETWEEN = "expect_column_values_to_be_between"
UNIQUE = "expect_column_values_to_be_unique"
IN_SET = "expect_column_values_to_be_in_set"
EXISTS = "expect_column_to_exist"


def _suite(layer: str, table: str, source: str, checks: list[tuple]) -> str:
    return _union([_check(f"{layer}.{table}", source, layer, *c) for c in checks])


def _null(c: str) -> tuple:
    return (NULL, c, f"{c} IS NULL")


def _unique(source: str, c: str) -> tuple:
    repeats = f"SELECT COUNT(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1"
    return (UNIQUE, c, f"(SELECT COALESCE(SUM(n), 0) FROM ({repeats}))")


_BATCH_CHECKS = [
    check
    for c in ("_ingestion_timestamp", "_source_system", "_batch_id", "_ingestion_date")
    for check in ((EXISTS, c, "FALSE"), _null(c))
]

SUITES = {
    "dq_bronze_storefront": ("bronze_storefront", "bronze", "shopify_orders", [
        _null("order_id"),
        (BETWEEN, "revenue", "revenue < 0", 0.99),
        (BETWEEN, "quantity", "quantity < 1", 0.99),
        *_BATCH_CHECKS,
    ]),
    "dq_bronze_marketplace": ("bronze_marketplace", "bronze", "amazon_orders", [
        _null("marketplace_order_id"),
        (BETWEEN, "revenue", "revenue < 0", 0.99),
        *_BATCH_CHECKS,
    ]),
    "dq_bronze_inventory": ("bronze_inventory", "bronze", "inventory_feed", [
        _null("inventory_id"),
        (BETWEEN, "quantity_available", "quantity_available < 0", 0.99),
        *_BATCH_CHECKS,
    ]),
    "dq_silver_orders": ("silver_orders", "silver", "orders", [
        _null("order_id"),
        _unique("silver_orders", "order_id"),
        (BETWEEN, "revenue", "revenue < 0"),
        (BETWEEN, "quantity", "quantity < 1"),
        (IN_SET, "channel", "channel NOT IN ('shopify', 'amazon')"),
        _null("order_date"),
    ]),
    "dq_silver_customers": ("silver_customers", "silver", "customers", [
        _null("customer_id"),
        _unique("silver_customers", "customer_id"),
        (IN_SET, "source", "source NOT IN ('shopify', 'amazon')"),
    ]),
    "dq_silver_products": ("silver_products", "silver", "products", [
        _null("product_id"),
        _unique("silver_products", "product_id"),
    ]),
    "dq_silver_inventory": ("silver_inventory", "silver", "inventory", [
        _null("inventory_id"),
        (BETWEEN, "quantity_available", "quantity_available < 0"),
        _null("quantity_reserved"),
    ]),
}


def _suite_sql(name: str) -> str:
    source, layer, table, checks = SUITES[name]
    return sql(_suite(layer, table, source, checks), source)


def _status_sql() -> str:
    sources = [s[0] for s in SUITES.values()]
    results = _union([_suite(layer, table, source, checks) for source, layer, table, checks in SUITES.values()])

    def failed(severity: str) -> str:
        return f"NOT success AND severity = '{severity}'"

    def joined(severity: str) -> str:
        message = "expectation || ' failed on column ''' || column_name || ''''"
        return f"COALESCE(STRING_AGG({message}, '; ' ORDER BY {message}) FILTER (WHERE {failed(severity)}), '')"

    return sql(
        f"""SELECT table_name,
  CASE WHEN {_count_if(failed('critical'))} > 0 THEN 'FAILED' ELSE 'PASSED' END AS status,
  {_count_if(failed('critical'))} AS critical_count, {_count_if(failed('warning'))} AS warning_count,
  {joined('critical')} AS critical, {joined('warning')} AS warnings
FROM ({results}) GROUP BY table_name""",
        *sources,
    )


def _orphans(check: str, facts: str, dimension: str, key: str) -> str:
    return (
        f"SELECT '{check}' AS check_name, COUNT(DISTINCT {key}) AS orphan_keys, COUNT(*) AS orphan_rows "
        f"FROM {facts} WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {dimension})"
    )


LAYER_STEPS = [
    ("bronze", "shopify_orders", "raw_storefront"),
    ("bronze", "amazon_orders", "raw_marketplace"),
    ("bronze", "inventory_feed", "raw_inventory"),
    ("silver", "orders", "silver_orders"),
    ("silver", "customers", "silver_customers"),
    ("silver", "products", "silver_products"),
    ("silver", "inventory", "silver_inventory"),
    ("gold", "revenue_mart", "revenue_mart"),
    ("gold", "channel_performance_mart", "channel_performance_mart"),
    ("gold", "customer_360_mart", "customer_360_mart"),
    ("gold", "inventory_turnover_mart", "inventory_turnover_mart"),
]


def _layer_counts() -> str:
    return sql(
        _union([
            f"SELECT '{layer}' AS layer, '{table}' AS table_name, COUNT(*) AS row_count FROM {source}"
            for layer, table, source in LAYER_STEPS
        ]),
        *[source for _, _, source in LAYER_STEPS],
    )


LINEAGE_EDGES = [
    ("ingest_shopify_orders", ["source.shopify_orders_csv"], "bronze.shopify_orders", "raw_storefront"),
    ("ingest_amazon_orders", ["source.amazon_orders_csv"], "bronze.amazon_orders", "raw_marketplace"),
    ("ingest_inventory_feed", ["source.inventory_feed_csv"], "bronze.inventory_feed", "raw_inventory"),
    ("build_silver_orders", ["bronze.shopify_orders", "bronze.amazon_orders"], "silver.orders", "silver_orders"),
    ("build_silver_customers", ["bronze.shopify_orders", "bronze.amazon_orders"], "silver.customers",
     "silver_customers"),
    ("build_silver_products", ["bronze.shopify_orders", "bronze.amazon_orders", "bronze.inventory_feed"],
     "silver.products", "silver_products"),
    ("build_silver_inventory", ["bronze.inventory_feed"], "silver.inventory", "silver_inventory"),
    ("build_revenue_mart", ["silver.orders"], "gold.revenue_mart", "revenue_mart"),
    ("build_channel_performance_mart", ["silver.orders"], "gold.channel_performance_mart",
     "channel_performance_mart"),
    ("build_customer_360_mart", ["silver.orders", "silver.customers"], "gold.customer_360_mart",
     "customer_360_mart"),
    ("build_inventory_turnover_mart", ["silver.inventory", "silver.orders"], "gold.inventory_turnover_mart",
     "inventory_turnover_mart"),
]


def _run_lineage() -> str:
    return sql(
        _union([
            f"SELECT '{job}' AS job, '{i}' AS input, '{output}' AS output, CAST(1 AS BIGINT) AS run_count, "
            f"COUNT(*) AS output_rows FROM {source}"
            for job, inputs, output, source in LINEAGE_EDGES
            for i in inputs
        ]),
        *[source for *_, source in LINEAGE_EDGES],
    )


_EVENT = """'{"eventType":"COMPLETE","eventTime":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00"'
  || ',"run":{"runId":"run-' || event_id || '","facets":{"parent":{"_producer":"shelfline",'
  || '"_schemaURL":"https://openlineage.io/spec/facets/1-0-0/ParentRunFacet.json",'
  || '"run":{"runId":"day-' || strftime(ts, '%Y-%m-%d') || '"},'
  || '"job":{"namespace":"shelfline","name":"dq_lineage_checkpoint"}}}}'
  || ',"job":{"namespace":"shelfline","name":"' || event_type || '"}'
  || ',"inputs":[{"namespace":"shelfline","name":"src.' || event_type || '"},'
  || '{"namespace":"shelfline","name":"u' || user_id || '"}]'
  || ',"outputs":[{"namespace":"shelfline","name":"out.' || event_type || '","facets":{"schema":{'
  || '"_producer":"shelfline","_schemaURL":"https://openlineage.io/spec/facets/1-0-0/SchemaDatasetFacet.json",'
  || '"fields":[{"name":"event_id","type":"BIGINT"},{"name":"ts","type":"TIMESTAMP_NTZ"},'
  || '{"name":"user_id","type":"BIGINT"},{"name":"event_type","type":"STRING"},'
  || '{"name":"value","type":"DOUBLE"},{"name":"props","type":"STRING"}]}}}]'
  || ',"producer":"shelfline"}'"""

_EVENT_FIELDS = """(VALUES ('event_id', 'BIGINT'), ('ts', 'TIMESTAMP_NTZ'), ('user_id', 'BIGINT'),
  ('event_type', 'STRING'), ('value', 'DOUBLE'), ('props', 'STRING')) AS f(field, type)"""

NOW = "TIMESTAMP '2024-01-31 00:00:00'"

_STOREFRONT_COLUMNS = "order_id, customer_id, product_id, order_date, quantity, revenue, order_status"
_IN_PERIOD = "BETWEEN DATE '{}' AND DATE '{}'".format(*PERIOD)

def _history(*asked: tuple[str, str]) -> str:
    """Common table expressions: the feeds as they arrived, and for each (name, day) ``orders_<name>``, the silver orders of that day."""
    steps = [
        (x, STEPS[x][1])
        for x in (
            "order_lines", "clean_storefront", "damaged_storefront", "storefront_history",
            "clean_marketplace", "damaged_marketplace", "marketplace_history",
        )
    ]
    for name, day in asked:
        seen = f"_ingestion_date <= DATE '{day}'"
        steps += [
            (f"storefront_{name}", _conform_storefront("storefront_history", seen)),
            (f"marketplace_{name}", _conform_marketplace("marketplace_history", seen)),
            (f"lines_{name}", f"SELECT * FROM storefront_{name} UNION ALL BY NAME SELECT * FROM marketplace_{name}"),
            (f"orders_{name}", _latest(f"lines_{name}")),
        ]
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in steps)


def _ledger_sql() -> str:
    late = f"order_timestamp >= TIMESTAMP '{DRIFT_START}'"
    every, early, after = "COUNT(*)", _count_if(f"NOT {late}"), _count_if(late)
    rows = {
        "append": (2, 2, f"{every} + {early}", 2),
        "skip_loaded": (1, 1, every, 1),
        "replace_batch": (2, 1, early, 1),
    }
    return sql(
        _union([
            f"SELECT '{mode}' AS reload, '{batch}' AS batch_id, CAST({loads} AS BIGINT) AS loads, CAST({live} AS BIGINT) AS live_loads, "
            f"CAST({n} AS BIGINT) AS row_count, CAST({days} AS BIGINT) AS days FROM raw_marketplace"
            for mode, night in rows.items()
            for batch, loads, live, n, days in (("night", *night), ("emptied", 2, 1, "MIN(0)", 0), ("lost", 1, 1, after, 1))
        ]),
        "raw_marketplace",
    )


ORACLES: dict[str, str] = {
    # feeds and their defects
    "inject_nulls": sql(
        f"SELECT * EXCLUDE (k) REPLACE (CASE WHEN NOT ({hit('k', 0.03)}) THEN order_status END AS order_status, "
        f"CASE WHEN NOT ({hit('k', 0.03)}) THEN customer_id END AS customer_id) FROM clean_storefront",
        "clean_storefront",
    ),
    "inject_duplicates": sql(
        "SELECT * EXCLUDE (k) FROM clean_storefront UNION ALL "
        f"SELECT * EXCLUDE (k) FROM clean_storefront WHERE {hit('k', 0.02)}",
        "clean_storefront",
    ),
    "inject_late_arrivals": sql(
        f"""SELECT * EXCLUDE (k) REPLACE (CASE WHEN {hit('k', 0.02)}
    THEN order_timestamp - to_days(CAST(1 + k % 3 AS INTEGER)) ELSE order_timestamp END AS order_timestamp)
FROM clean_marketplace""",
        "clean_marketplace",
    ),
    "inject_schema_drift": sql(
        f"SELECT * EXCLUDE (k), CASE WHEN {hit('k', 0.01)} THEN printf('PROMO-%04d', k % 10000) END "
        "AS promo_code_applied FROM clean_storefront",
        "clean_storefront",
    ),
    "sample_rows": sql(
        f"SELECT {_STOREFRONT_COLUMNS}, promo_code_applied FROM raw_storefront "
        f"ORDER BY order_id, order_date, revenue, product_id LIMIT 20",
        "raw_storefront",
    ),
    # bronze
    "clean_column_names": "SELECT * FROM part",
    "bronze_storefront": step("bronze_storefront"),
    "bronze_marketplace": step("bronze_marketplace"),
    "bronze_inventory": step("bronze_inventory"),
    "bronze_replay": sql(
        _union([
            f"SELECT '{table}' AS feed, {key} AS line_id, customer_id, CAST(quantity AS VARCHAR) AS quantity, "
            f"_batch_id, _ingestion_date FROM {source} WHERE _ingestion_date = DATE '{REPLAY_DAY}'"
            for table, key, source in (
                ("shopify_orders", "order_id", "storefront_history"),
                ("amazon_orders", "marketplace_order_id", "marketplace_history"),
            )
        ]),
        "storefront_history", "marketplace_history",
    ),
    "bronze_schema_evolution": sql(
        f"SELECT {_STOREFRONT_COLUMNS}, CASE WHEN order_date >= DATE '{DRIFT_START}' THEN promo_code_applied END "
        "AS promo_code_applied FROM raw_storefront",
        "raw_storefront",
    ),
    "idempotent_reload": sql(
        _union([
            f"SELECT '{mode}' AS reload, {runs} * COUNT(*) AS row_count FROM raw_marketplace"
            for mode, runs in (("append", 4), ("skip_loaded", 2), ("replace_batch", 2))
        ]),
        "raw_marketplace",
    ),
    "batch_ledger": _ledger_sql(),
    "bronze_odd_headers": sql(
        "SELECT inventory_id, product_id, 'batch-2' AS _batch_id, 'theirs-' || inventory_id AS source_batch_id, "
        "warehouse_id AS shelf_no, CAST(0 AS BIGINT) AS rows_of_the_empty_feed, 'source_batch_id,shelf.no' AS added FROM raw_inventory",
        "raw_inventory",
    ),
    "file_drop_mixed": sql(
        _union([
            f"SELECT '{kind}' AS kind, '{rules}' AS rules, '{place}' AS place, COUNT(*) AS row_count "
            f"FROM raw_storefront WHERE day(order_date) BETWEEN {first} AND {last}"
            for kind, rules, place, first, last in (
                ("good", "", "bronze", 1, 20),
                ("without_quantity", "validation:quantity", "rejects", 21, 25),
                ("without_customers", "missing_required:customer_id", "rejects", 26, 31),
            )
        ]),
        "raw_storefront",
    ),
    "file_drop_stream": step("bronze_marketplace", "* REPLACE ('batch-1-0' AS _batch_id)"),
    "bronze_from_csv": sql(
        "SELECT inventory_id, product_id, warehouse_id, CAST(quantity_available AS VARCHAR) AS quantity_available, "
        "reserved_text, strftime(last_updated, '%Y-%m-%d %H:%M:%S') AS last_updated, "
        "CASE WHEN reserved_text <> 'n/a' THEN quantity_reserved END AS reserved_read, "
        "COUNT(*) FILTER (WHERE reserved_text = 'n/a') OVER () AS unreadable FROM dirty_inventory",
        "dirty_inventory",
    ),
    "file_drop_inventory": sql(
        """SELECT inventory_id, product_id, warehouse_id, quantity_available,
  CASE WHEN reserved_text IS NULL THEN 0 WHEN reserved_text <> 'n/a' THEN quantity_reserved END AS quantity_reserved,
  last_updated, CAST(last_updated AS DATE) AS order_date
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY inventory_id
        ORDER BY last_updated DESC NULLS LAST, quantity_available DESC NULLS LAST) AS rn
      FROM dirty_inventory) WHERE rn = 1""",
        "dirty_inventory",
    ),
    "stream_then_batch": sql(
        "SELECT 'batch-1-0' AS _batch_id, COUNT(*) AS row_count FROM raw_marketplace "
        "UNION ALL SELECT 'batch-2', COUNT(*) FROM raw_marketplace",
        "raw_marketplace",
    ),
    "schema_growth": sql(
        f"""SELECT CASE WHEN order_date >= DATE '{DRIFT_START}' THEN 'batch-2' ELSE 'batch-1' END AS _batch_id,
  COUNT(*) AS row_count,
  COUNT(CASE WHEN order_date >= DATE '{DRIFT_START}' THEN order_status END) AS with_status,
  COUNT(CASE WHEN order_date >= DATE '{DRIFT_START}' THEN promo_code_applied END) AS with_promo,
  (SELECT COUNT(DISTINCT order_id) FROM raw_storefront) AS silver_orders
FROM raw_storefront GROUP BY 1""",
        "raw_storefront",
    ),
    "money_extremes": """SELECT DATE '2024-01-01' AS order_date, 'shopify' AS channel, kind AS order_status,
  unit_total AS total_revenue, CAST(n AS BIGINT) AS total_quantity, n AS order_count,
  unit_total / n AS avg_order_value, '2024-01' AS order_month
FROM (SELECT kind, COUNT(*) AS n, CASE kind
        WHEN 'tenths of a cent' THEN CAST(COUNT(*) * 4 AS DOUBLE) / CAST(1000 AS DOUBLE)
        WHEN 'very large' THEN CAST(COUNT(*) AS DOUBLE) * 18014398509481984.0::DOUBLE
        ELSE CAST(COUNT(*) AS DOUBLE) * 1.2676506002282294e30::DOUBLE END AS unit_total
      FROM (SELECT CASE o_orderkey % 4 WHEN 0 THEN 'tenths of a cent' WHEN 1 THEN 'very large'
                   WHEN 2 THEN 'beyond the decimal' END AS kind FROM orders)
      WHERE kind IS NOT NULL GROUP BY kind)""",
    "layer_run_skipped": sql(
        _union([
            f"SELECT '{layer}' AS layer, '{table}' AS table_name, ({n}) AS row_count, CAST(1 AS BIGINT) AS events"
            for layer, table, n in (
                ("bronze", "amazon_orders", "SELECT COUNT(*) FROM raw_marketplace"),
                ("bronze", "inventory_feed", "SELECT COUNT(*) FROM raw_inventory"),
                ("silver", "orders", "SELECT COUNT(*) FROM market_orders"),
                ("silver", "customers",
                 "SELECT COUNT(DISTINCT customer_id) FROM raw_marketplace"),
                ("silver", "products",
                 "SELECT COUNT(*) FROM (SELECT sku FROM raw_marketplace WHERE sku IS NOT NULL "
                 "UNION SELECT product_id FROM raw_inventory)"),
                ("silver", "inventory", "SELECT COUNT(*) FROM silver_inventory"),
                ("gold", "revenue_mart", "SELECT COUNT(DISTINCT order_date) FROM market_orders"),
                ("gold", "channel_performance_mart",
                 "SELECT COUNT(DISTINCT strftime(order_date, '%Y-%m')) FROM market_orders"),
                ("gold", "customer_360_mart", "SELECT COUNT(DISTINCT customer_id) FROM raw_marketplace"),
                ("gold", "inventory_turnover_mart", "SELECT COUNT(*) FROM silver_inventory"),
            )
        ]),
        "raw_marketplace", "raw_inventory", "market_orders", "silver_inventory",
    ),
    # contract
    "contract_report_clean": _contract("raw_storefront", CLEAN_RULES),
    "contract_report_dirty": _contract("broken_storefront", BROKEN_RULES),
    "contract_gate": sql(
        "SELECT 'clean' AS batch, COUNT(*) AS rows_in, COUNT(*) AS rows_out FROM raw_storefront "
        "UNION ALL SELECT 'broken', COUNT(*), 0 FROM broken_storefront",
        "raw_storefront", "broken_storefront",
    ),
    "schema_drift_columns": sql(
        "SELECT 'promo_code_applied' AS column_name, COUNT(*) AS row_count, "
        "COUNT(promo_code_applied) AS filled_rows FROM raw_storefront",
        "raw_storefront",
    ),
    # silver
    "conform_storefront": step("conform_storefront"),
    "conform_marketplace": step("conform_marketplace"),
    "dedup_latest": sql(
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id "
        "ORDER BY order_date DESC NULLS LAST, revenue DESC NULLS LAST, quantity DESC NULLS LAST, "
        "product_id DESC NULLS LAST, customer_id DESC NULLS LAST, order_status DESC NULLS LAST, "
        "promo_code_applied DESC NULLS LAST) AS rn FROM raw_storefront) WHERE rn = 1",
        "raw_storefront",
    ),
    "silver_orders": step("silver_orders"),
    "silver_customers": step("silver_customers"),
    "silver_products": step("silver_products"),
    "silver_inventory": step("silver_inventory"),
    "silver_period": sql(f"SELECT * FROM silver_orders WHERE order_date {_IN_PERIOD}", "silver_orders"),
    # gold
    "revenue_mart": step("revenue_mart"),
    "channel_performance_mart": step("channel_performance_mart"),
    "customer_360_mart": step("customer_360_mart"),
    "inventory_turnover_mart": step("inventory_turnover_mart"),
    "gold_period": sql(
        "SELECT * FROM revenue_mart WHERE order_month BETWEEN '{}' AND '{}'".format(*MONTHS), "revenue_mart"
    ),
    "channel_mom": sql(
        """SELECT channel, order_month, total_revenue, previous_revenue,
  (total_revenue - previous_revenue) / NULLIF(previous_revenue, 0) AS revenue_change
FROM (SELECT *, LAG(total_revenue) OVER (PARTITION BY channel ORDER BY order_month) AS previous_revenue
      FROM channel_performance_mart)""",
        "channel_performance_mart",
    ),
    # quality
    **{name: _suite_sql(name) for name in SUITES},
    "dq_status": _status_sql(),
    "dq_gold_nonempty": sql(
        _union([
            f"SELECT '{mart}' AS mart, COUNT(*) AS row_count, "
            f"CASE WHEN COUNT(*) > 0 THEN 'PASSED' ELSE 'FAILED' END AS status FROM {mart}"
            for layer, mart, _ in LAYER_STEPS if layer == "gold"
        ]),
        *[mart for layer, mart, _ in LAYER_STEPS if layer == "gold"],
    ),
    "referential_orphans": sql(
        _union([
            _orphans("orders.customer_id -> customers", "silver_orders", "silver_customers", "customer_id"),
            _orphans("orders.product_id -> products", "silver_orders", "silver_products", "product_id"),
            _orphans("orders.product_id -> inventory", "silver_orders", "silver_inventory", "product_id"),
            _orphans("inventory.product_id -> products", "silver_inventory", "silver_products", "product_id"),
        ]),
        "silver_orders", "silver_customers", "silver_products", "silver_inventory",
    ),
    "late_arrival_profile": sql(
        "SELECT feed, days_late, COUNT(*) AS row_count FROM ("
        "SELECT 'shopify_orders' AS feed, CAST(_ingestion_date - order_date AS INTEGER) AS days_late "
        "FROM storefront_history UNION ALL SELECT 'amazon_orders', "
        "CAST(_ingestion_date - CAST(order_timestamp AS DATE) AS INTEGER) FROM marketplace_history) GROUP BY 1, 2",
        "storefront_history", "marketplace_history",
    ),
    # run health
    "run_status_24h": sql(
        f"SELECT dag_id, state, COUNT(*) AS run_count FROM run_log "
        f"WHERE execution_date > {NOW} - INTERVAL '24 hours' GROUP BY dag_id, state ORDER BY dag_id, state",
        "run_log",
    ),
    "run_duration_7d": sql(
        "SELECT execution_date AS time, dag_id AS metric, EXTRACT(EPOCH FROM (end_date - start_date)) AS value "
        "FROM run_log WHERE start_date IS NOT NULL AND end_date IS NOT NULL "
        f"AND execution_date > {NOW} - INTERVAL '7 days' ORDER BY execution_date",
        "run_log",
    ),
    "runs_success_total": sql("SELECT COUNT(*) AS value FROM run_log WHERE state = 'success'", "run_log"),
    "runs_failed_total": sql("SELECT COUNT(*) AS value FROM run_log WHERE state = 'failed'", "run_log"),
    # lineage and catalog
    "lineage_events": f"SELECT event_id, {_EVENT} AS event FROM events",
    "lineage_edges": """SELECT event_type AS job, i AS input, 'out.' || event_type AS output, COUNT(*) AS run_count
FROM (SELECT event_type, UNNEST(['src.' || event_type, 'u' || user_id]) AS i FROM events) GROUP BY 1, 2, 3""",
    "lineage_fields": f"""SELECT 'out.' || event_type AS dataset, field, type, COUNT(*) AS event_count
FROM events, {_EVENT_FIELDS} GROUP BY 1, 2, 3""",
    "layer_run_counts": _layer_counts(),
    "layer_run_lineage": _run_lineage(),
    "catalog_summary": _layer_counts(),
    # layout of stored tables
    "silver_as_of": _history(("seen", AS_OF_DAY)) + "\nSELECT * FROM orders_seen",
    "silver_versions": _history(("old", AS_OF_DAY), ("new", LATER_DAY)) + _union([
        f"""
SELECT '{version}' AS version, channel, strftime(order_date, '%Y-%m') AS order_month, COUNT(*) AS row_count,
  CAST(SUM(quantity) AS BIGINT) AS units
FROM orders_{which} GROUP BY ALL"""
        for version, which in (("as_of", "old"), ("latest", "new"))
    ]),
    "incremental_rebuild": _history(("old", AS_OF_DAY), ("new", LATER_DAY)) + f"""
, raw_inventory AS ({STEPS["raw_inventory"][1]}), silver_inventory AS ({STEPS["silver_inventory"][1]})
, came AS (
  SELECT order_id, 'shopify' AS channel FROM storefront_history
  WHERE _ingestion_date > DATE '{AS_OF_DAY}' AND _ingestion_date <= DATE '{LATER_DAY}'
  UNION
  SELECT marketplace_order_id, 'amazon' FROM marketplace_history
  WHERE _ingestion_date > DATE '{AS_OF_DAY}' AND _ingestion_date <= DATE '{LATER_DAY}'
), touched AS (
  SELECT order_date FROM orders_old SEMI JOIN came USING (order_id, channel)
  UNION SELECT order_date FROM orders_new SEMI JOIN came USING (order_id, channel)
), buyers AS (
  SELECT customer_id FROM storefront_history WHERE _ingestion_date <= DATE '{LATER_DAY}' AND customer_id IS NOT NULL
  UNION SELECT customer_id FROM marketplace_history WHERE _ingestion_date <= DATE '{LATER_DAY}' AND customer_id IS NOT NULL
), goods AS (
  SELECT product_id FROM storefront_history WHERE _ingestion_date <= DATE '{LATER_DAY}'
  UNION SELECT sku FROM marketplace_history WHERE _ingestion_date <= DATE '{LATER_DAY}'
  UNION SELECT product_id FROM raw_inventory
)
""" + _union([
        f"SELECT '{name}' AS dataset, CAST(({n}) AS BIGINT) AS row_count, CAST(0 AS BIGINT) AS differing_rows, "
        f"CAST(({written}) AS BIGINT) AS written_partitions"
        for name, n, written in (
            ("silver.orders", "SELECT COUNT(*) FROM orders_new", "SELECT COUNT(*) FROM touched"),
            ("silver.customers", "SELECT COUNT(*) FROM buyers", "NULL"),
            ("silver.products", "SELECT COUNT(product_id) FROM goods", "NULL"),
            ("silver.inventory", "SELECT COUNT(*) FROM silver_inventory", "NULL"),
            ("gold.revenue_mart", "SELECT COUNT(DISTINCT (order_date, channel, order_status)) FROM orders_new",
             "SELECT COUNT(DISTINCT strftime(order_date, '%Y-%m')) FROM touched"),
            ("gold.channel_performance_mart", "SELECT COUNT(DISTINCT (strftime(order_date, '%Y-%m'), channel)) FROM orders_new",
             "SELECT COUNT(DISTINCT strftime(order_date, '%Y-%m')) FROM touched"),
            ("gold.customer_360_mart", "SELECT COUNT(*) FROM buyers", "NULL"),
            ("gold.inventory_turnover_mart", "SELECT COUNT(*) FROM silver_inventory", "NULL"),
        )
    ]),
    "compact_partition": sql(
        "SELECT order_month, CAST(1 AS BIGINT) AS files_after, TRUE AS no_more_files, COUNT(*) AS rows_before, "
        "COUNT(*) AS row_count FROM revenue_mart GROUP BY order_month",
        "revenue_mart",
    ),
    "turnover_bucketed": step("inventory_turnover_mart"),
    "quarter_customers": sql(
        "SELECT year(order_date) || '-Q' || quarter(order_date) AS quarter, channel, "
        "COUNT(DISTINCT customer_id) AS unique_customers, TRUE AS within_error FROM silver_orders GROUP BY ALL",
        "silver_orders",
    ),
}
