"""Silver and gold from what changed: only partitions that a change touches are written again.

A change is the difference between the loads that the last version was made of and those that count now; late rows,
replaced batches and withdrawn ones are all of that kind. Its rows name the keys whose result may differ. For
these keys the results are made anew from all their rows; the days and months that hold one of them, before or
after, are written again, with the other keys' rows taken over from the last version. Everything else keeps the
folder that it has.

Changed keys are found by semi-joins, whose small side adaptive execution broadcasts as far as its size allows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.names import INVENTORY_TABLE, MARKETPLACE, MARKETPLACE_TABLE, PARTITION_COLUMN, STOREFRONT, STOREFRONT_TABLE
from shelfline.plans import gold, silver
from shelfline.sources.versions import TableState, Version, read_state, write_version
from shelfline.sources.workspace import stored

#: Called before and after a table is built: name of the table, the frames it is made of, its rows or the exception.
Watcher = Callable[[str, dict[str, DataFrame], "TableState | None", "int | BaseException | None"], None]


def partition_names(df: DataFrame, column: str) -> list[str]:
    """Folder names of the partition values of ``df``; as many as it has days or months."""
    value = F.coalesce(F.col(column).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    return sorted(f"{column}={r[0]}" for r in df.select(value).distinct().collect())


@dataclass
class Build:
    """A version in the making."""

    spark: SparkSession
    root: str
    scratch: str
    version: Version
    before: Version | None
    watch: Watcher | None = None
    # rows of each table, and the partitions that were written
    rows: dict[str, dict[str, int]] = field(default_factory=lambda: {"silver": {}, "gold": {}})
    rebuilt: dict[str, list[str]] = field(default_factory=dict)
    # frames over whole tables, whose folders need listing only once
    frames: dict[tuple, DataFrame] = field(default_factory=dict)

    def whole(self, layer: str, table: str, state: TableState) -> DataFrame:
        key = (layer, table, *state.folders)
        if key not in self.frames:
            self.frames[key] = read_state(self.spark, self.root, layer, table, state)
        return self.frames[key]

    def old(self, layer: str, table: str) -> TableState:
        return self.before.tables[f"{layer}.{table}"]

    def old_table(self, layer: str, table: str) -> DataFrame:
        return self.whole(layer, table, self.old(layer, table))

    def table(self, layer: str, table: str, only: list[str] | None = None) -> DataFrame:
        state = self.version.tables[f"{layer}.{table}"]
        return self.whole(layer, table, state) if only is None else read_state(self.spark, self.root, layer, table, state, only)

    def write(self, layer: str, table: str, df: DataFrame, touched: list[str] | None = None, sources: dict[str, DataFrame] | None = None) -> None:
        """Write a table, or its ``touched`` partitions, and keep the other partitions of the last version."""
        name = f"{layer}.{table}"
        if self.watch:
            self.watch(name, sources or {}, None, None)
        try:
            state = write_version(self.spark, self.root, layer, table, df, self.version.number)
        except BaseException as failure:
            if self.watch:
                self.watch(name, sources or {}, None, failure)
            raise
        self.rebuilt[name] = sorted(state.partitions()) if touched is None else touched
        if touched is not None:
            old = self.old(layer, table)
            kept = [f for p, own in old.partitions().items() if p not in set(touched) for f in own]
            replaced = read_state(self.spark, self.root, layer, table, old, touched).count()
            state = TableState(sorted(kept + state.folders), state.schema, old.rows - replaced + state.rows)
        self.version.tables[name] = state
        self.rows[layer][table] = state.rows
        if self.watch:
            self.watch(name, sources or {}, state, state.rows)

    def keep(self, layer: str, table: str) -> None:
        self.version.tables[f"{layer}.{table}"] = self.old(layer, table)
        self.rows[layer][table] = self.old(layer, table).rows
        self.rebuilt[f"{layer}.{table}"] = []

    def merge(self, layer: str, table: str, fresh: DataFrame, keys: DataFrame, sources: dict[str, DataFrame]) -> list[str]:
        """Put ``fresh``, the new rows of all ``keys``, in the place of their old ones; returns the touched partitions."""
        column, by = PARTITION_COLUMN[layer][table], keys.columns
        fresh = stored(self.spark, fresh, self.scratch, f"fresh-{layer}-{table}")
        gone = self.old_table(layer, table).join(keys, by, "left_semi")
        touched = partition_names(gone.select(column).union(fresh.select(column)), column)
        if not touched:
            self.keep(layer, table)
            return touched
        old = self.old(layer, table)
        others = read_state(self.spark, self.root, layer, table, old, touched).join(keys, by, "left_anti")
        self.write(layer, table, others.unionByName(fresh).select(*old.schema.fieldNames()), touched, sources)
        return touched


def full(build: Build, bronze: dict[str, DataFrame], created_at: Column | None = None) -> None:
    """Build all tables from all of bronze."""
    used = silver_sources(bronze)
    for name, df in silver.tables(bronze, created_at).items():
        build.write("silver", name, df, sources=used[name])
    tables = {name: build.table("silver", name) for name in used}
    used = gold_sources(tables)
    for name, df in gold.tables(tables).items():
        build.write("gold", name, df, sources=used[name])


def silver_sources(bronze: dict[str, DataFrame]) -> dict[str, dict[str, DataFrame]]:
    """The frames that each silver table is made of."""
    named = {f"bronze.{t}": df for t, df in bronze.items()}
    sales = {n: df for n, df in named.items() if n != f"bronze.{INVENTORY_TABLE}"}
    stock = {n: df for n, df in named.items() if n not in sales}
    return {"orders": sales, "customers": sales, "products": named, "inventory": stock}


def gold_sources(tables: dict[str, DataFrame]) -> dict[str, dict[str, DataFrame]]:
    named = {f"silver.{t}": df for t, df in tables.items()}
    orders = {n: df for n, df in named.items() if n == "silver.orders"}
    return {
        "revenue_mart": orders,
        "channel_performance_mart": orders,
        "customer_360_mart": orders | {n: df for n, df in named.items() if n == "silver.customers"},
        "inventory_turnover_mart": orders | {n: df for n, df in named.items() if n == "silver.inventory"},
    }


def _order_keys(changed: dict[str, DataFrame]) -> DataFrame:
    feeds = ((STOREFRONT_TABLE, "order_id", STOREFRONT), (MARKETPLACE_TABLE, "marketplace_order_id", MARKETPLACE))
    found = [
        changed[t].select(F.col(key).alias("order_id"), F.lit(channel).alias("channel")) for t, key, channel in feeds if t in changed
    ]
    keys = found[0] if len(found) == 1 else found[0].union(found[1])
    return keys.where("order_id IS NOT NULL").distinct()


def _of_keys(bronze: dict[str, DataFrame], keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All bronze lines of both channels with one of the keys."""

    def of(channel: str, name: str) -> DataFrame:
        return keys.where(F.col("channel") == channel).select(F.col("order_id").alias(name))

    return (
        bronze[STOREFRONT_TABLE].join(of(STOREFRONT, "order_id"), "order_id", "left_semi"),
        bronze[MARKETPLACE_TABLE].join(of(MARKETPLACE, "marketplace_order_id"), "marketplace_order_id", "left_semi"),
    )


def _distinct(frames: list[DataFrame], column: str) -> DataFrame:
    found = frames[0].select(column)
    for df in frames[1:]:
        found = found.union(df.select(column))
    return found.where(F.col(column).isNotNull()).distinct()


def incremental(
    build: Build, bronze: dict[str, DataFrame], changed: dict[str, DataFrame], created_at: Column | None = None
) -> None:
    """Rebuild what the ``changed`` rows of bronze touch; tables whose feeds did not change are kept."""

    def kept(df: DataFrame, name: str) -> DataFrame:
        return stored(build.spark, df, build.scratch, name)

    sales = [changed[t] for t in (STOREFRONT_TABLE, MARKETPLACE_TABLE) if t in changed]
    used = silver_sources(bronze)
    days: list[str] = []
    lines = None
    if sales:
        keys = kept(_order_keys(changed), "order-keys")
        fresh = kept(silver.orders(*_of_keys(bronze, keys)), "orders")
        # lines of these keys as they were and as they are
        old_lines = build.old_table("silver", "orders").join(keys, ["order_id", "channel"], "left_semi")
        lines = kept(old_lines.unionByName(fresh).select("customer_id", "product_id").distinct(), "lines")
        days = build.merge("silver", "orders", fresh, keys, used["orders"])
    else:
        build.keep("silver", "orders")
    whole = silver.tables(bronze, created_at)
    for name, needed in (("customers", bool(sales)), ("products", bool(changed))):
        if needed:
            build.write("silver", name, whole[name], sources=used[name])
        else:
            build.keep("silver", name)
    stock_keys = None
    if INVENTORY_TABLE in changed:
        stock_keys = kept(changed[INVENTORY_TABLE].select("inventory_id").where("inventory_id IS NOT NULL").distinct(), "stock-keys")
        fresh = silver.inventory(bronze[INVENTORY_TABLE].join(stock_keys, "inventory_id", "left_semi"))
        build.merge("silver", "inventory", fresh, stock_keys, used["inventory"])
    else:
        build.keep("silver", "inventory")

    tables = {name: build.table("silver", name) for name in used}
    used = gold_sources(tables)
    # marts of whole months: from the days of the touched months
    months = {day.partition("=")[2][:7] for day in days if day != "order_date=__HIVE_DEFAULT_PARTITION__"}
    undated = "order_date=__HIVE_DEFAULT_PARTITION__" in days
    for name, mart in (("revenue_mart", gold.revenue_mart), ("channel_performance_mart", gold.channel_performance_mart)):
        if not days:
            build.keep("gold", name)
            continue
        of_months = [
            p
            for p in build.version.tables["silver.orders"].partitions()
            if p.partition("=")[2][:7] in months or (undated and p == "order_date=__HIVE_DEFAULT_PARTITION__")
        ]
        touched = sorted(f"order_month={m}" for m in months) + ["order_month=__HIVE_DEFAULT_PARTITION__"] * undated
        build.write("gold", name, mart(build.table("silver", "orders", of_months)), touched, used[name])
    if sales:
        buyers = kept(_distinct([lines, *sales], "customer_id"), "buyers")
        fresh = gold.customer_360_mart(
            tables["orders"].join(buyers, "customer_id", "left_semi"), tables["customers"].join(buyers, "customer_id", "left_semi")
        )
        build.merge("gold", "customer_360_mart", fresh, buyers, used["customer_360_mart"])
    else:
        build.keep("gold", "customer_360_mart")
    if lines is not None or stock_keys is not None:
        of_stock = [] if stock_keys is None else [stock_keys]
        if lines is not None:
            sold = _distinct([lines], "product_id")
            positions = [tables["inventory"], build.old_table("silver", "inventory")]
            of_stock += [p.join(sold, "product_id", "left_semi").select("inventory_id") for p in positions]
        touched_stock = kept(_distinct(of_stock, "inventory_id"), "turnover-keys")
        positions = tables["inventory"].join(touched_stock, "inventory_id", "left_semi")
        orders = tables["orders"].join(positions.select("product_id"), "product_id", "left_semi")
        build.merge("gold", "inventory_turnover_mart", gold.inventory_turnover_mart(positions, orders), touched_stock, used["inventory_turnover_mart"])
    else:
        build.keep("gold", "inventory_turnover_mart")
