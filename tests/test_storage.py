import datetime as dt
import json

import fixtures as fx
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from shelfline import registry
from shelfline.names import (
    BRONZE_TABLES,
    INVENTORY_FEED,
    INVENTORY_TABLE,
    MARKETPLACE_TABLE,
    STOREFRONT_FEED,
    STOREFRONT_TABLE,
)
from shelfline.operators.batches import Batch
from shelfline.operators.expectations import QualityFailure
from shelfline.plans import bronze, catalog, gold, health, lineage, rebuild, runs, silver
from shelfline.plans.admission import read_rejects
from shelfline.sources import ledger, versions
from shelfline.sources.compaction import compact_table, file_sizes
from shelfline.sources.feeds import read_feed, read_text_feed, sample_rows, write_feed
from shelfline.sources.tables import compact, read_bronze, read_layer, read_table, write_table
from shelfline.sources.workspace import new_run_root, shared_base
from shelfline.streaming.file_drop import load_new_files

BATCH = Batch("b-1", "2026-06-05T01:00:00+00:00")


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def files(root):
    from pathlib import Path

    return [p for p in Path(root).rglob("part-*") if p.suffix == ".parquet"]


# feeds


def test_feed_is_read_by_header_name(spark, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text(
        "product_id , inventory_id,warehouse_id,quantity_available,quantity_reserved,last_updated,extra\n"
        "PROD-1,INV-1,WH-01,10,79.0,2026-06-01 10:00:00,e\n"
        "PROD-2,INV-2,WH-01,x,,soon,\n"
    )
    df = read_feed(spark, str(path), INVENTORY_FEED)
    assert df.columns == [
        "product_id", "inventory_id", "warehouse_id", "quantity_available", "quantity_reserved", "last_updated", "extra",
    ]
    rows = {r.inventory_id: r for r in df.collect()}
    assert (rows["INV-1"].quantity_reserved, rows["INV-1"].last_updated) == (79, dt.datetime(2026, 6, 1, 10))
    assert (rows["INV-2"].quantity_available, rows["INV-2"].quantity_reserved, rows["INV-2"].last_updated) == (None,) * 3


def test_feed_round_trip_and_sample(spark, root, same_rows):
    write_feed(fx.storefront(spark), f"{root}/feed")
    same_rows(read_feed(spark, f"{root}/feed", STOREFRONT_FEED), fx.storefront(spark))
    assert [r.order_id for r in sample_rows(fx.storefront(spark), ["order_id", "order_date"], 3).collect()] == [
        "SHOP-1", "SHOP-1", "SHOP-2",
    ]


def test_types_can_be_inferred(spark, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text(" a,b\n1,x\n2,y\n")
    assert read_text_feed(spark, str(path)).dtypes == [("a", "string"), ("b", "string")]
    assert read_text_feed(spark, str(path), infer_types=True).dtypes == [("a", "int"), ("b", "string")]


# tables


def test_write_counts_rows_and_keeps_one_file_per_value(spark, root):
    df = spark.range(1_000).selectExpr("id", "id % 5 AS p").repartition(4)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionSize", None)
    assert write_table(df, f"{root}/t", partition_by="p") == 1_000
    assert len(files(f"{root}/t")) == 5
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionSize", None) == before


def test_partition_filter_is_pruned(spark, root):
    df = spark.range(100).selectExpr("id", "date_add(date'2026-06-01', CAST(id % 10 AS INT)) AS order_date")
    write_table(df, f"{root}/t", partition_by="order_date")
    period = silver.in_period(read_table(spark, f"{root}/t"), "2026-06-02", "2026-06-03")
    plan = period._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in plan
    assert period.count() == 20


def test_month_partition_stays_text_and_null_comes_back(spark, root):
    df = spark.createDataFrame([("a", "2026-06"), ("b", None)], "k string, order_month string")
    write_table(df, f"{root}/t", partition_by="order_month")
    assert {tuple(r) for r in read_table(spark, f"{root}/t").collect()} == {("a", "2026-06"), ("b", None)}
    assert gold.in_months(read_table(spark, f"{root}/t"), "2026-05", "2026-07").count() == 1


def test_new_column_reads_null_in_old_files(spark, root):
    write_table(spark.sql("SELECT 1 AS a"), f"{root}/t", mode="append")
    write_table(spark.sql("SELECT 2 AS a, 'x' AS b"), f"{root}/t", mode="append")
    wide = spark.sql("SELECT 2 AS a, 'x' AS b").schema
    for df in (read_table(spark, f"{root}/t", schema=wide), read_table(spark, f"{root}/t", merge_schema=True)):
        assert {tuple(r) for r in df.collect()} == {(1, None), (2, "x")}


def test_compaction_keeps_rows_and_source(spark, root, same_rows):
    df = spark.range(300).selectExpr("id", "id % 3 AS p").repartition(4)
    write_table(df, f"{root}/t", partition_by="p", rebalance=False)
    assert len(files(f"{root}/t")) == 12
    assert compact(spark, f"{root}/t", f"{root}/c", "p", where=F.col("p") < 2) == 200
    assert len(files(f"{root}/c")) == 2
    assert len(files(f"{root}/t")) == 12
    same_rows(spark.read.parquet(f"{root}/c"), spark.read.parquet(f"{root}/t").where("p < 2"))


def test_workspace_is_below_the_shared_folder(spark):
    assert new_run_root(spark, "x").startswith(f"{shared_base(spark)}/shelfline/x-")
    assert new_run_root(spark, "x") != new_run_root(spark, "x")


# ingestion


def test_ingest_from_files(spark, root):
    paths = {}
    for table, feed in fx.feeds(spark).items():
        write_feed(feed, f"{root}/in/{table}")
        paths[table] = f"{root}/in/{table}"
    result = bronze.ingest(spark, root, paths, BATCH)
    assert result.rows == {"shopify_orders": 4, "amazon_orders": 4, "inventory_feed": 6}
    row = read_layer(spark, root, "bronze", STOREFRONT_TABLE).first()
    assert (row._batch_id, row._ingestion_date, row._source_system) == ("b-1", dt.date(2026, 6, 5), "shopify_orders")


def test_missing_source_raises_before_anything_is_written(spark, root):
    feeds = {MARKETPLACE_TABLE: fx.marketplace(spark), STOREFRONT_TABLE: f"{root}/nowhere.csv"}
    with pytest.raises(AnalysisException):
        bronze.ingest(spark, root, feeds, BATCH)
    assert files(root) == []


def test_contract_violation_skips_only_the_storefront(spark, root):
    feeds = fx.feeds(spark)
    feeds[STOREFRONT_TABLE] = feeds[STOREFRONT_TABLE].withColumn("quantity", F.lit(0))
    result = bronze.ingest(spark, root, feeds, BATCH)
    assert set(result.rows) == {"amazon_orders", "inventory_feed"}
    assert "quantity" in result.skipped["shopify_orders"]


@pytest.mark.parametrize(("mode", "runs_stored"), [("append", 2), ("skip_loaded", 1), ("replace_batch", 1)])
def test_reload_modes(spark, root, mode, runs_stored):
    feeds = {MARKETPLACE_TABLE: fx.marketplace(spark)}
    other_day, same_day = Batch("b-0", "2026-06-04T01:00:00+00:00"), Batch("007", "2026-06-05T09:00:00+00:00")
    for batch in (other_day, BATCH, same_day, BATCH):
        bronze.ingest(spark, root, feeds, batch, reload=mode)
    stored = read_bronze(spark, root, MARKETPLACE_TABLE)
    assert bronze.arrived_on(stored, "2026-06-05").count() == 4 * (runs_stored + 1)
    assert stored.where("_batch_id = '007'").count() == 4
    assert bronze.arrived_on(stored, "2026-06-04").count() == 4
    assert bronze.arrived_until(stored, "2026-06-04").count() == 4


def test_dropped_files_are_loaded_once(spark, root):
    def load():
        load_new_files(spark, f"{root}/drop", MARKETPLACE_TABLE, root, f"{root}/cp", BATCH, max_files=1)
        return read_bronze(spark, root, MARKETPLACE_TABLE).count()

    fx.marketplace(spark).coalesce(1).write.mode("append").option("header", "true").csv(f"{root}/drop")
    assert [load(), load()] == [4, 4]
    fx.marketplace(spark).limit(1).coalesce(1).write.mode("append").option("header", "true").csv(f"{root}/drop")
    assert load() == 5
    bronze.ingest(spark, root, {MARKETPLACE_TABLE: fx.marketplace(spark)}, Batch("by hand", BATCH.ingested_at))
    assert read_bronze(spark, root, MARKETPLACE_TABLE).count() == 9


def test_dropped_file_with_moved_columns_is_read_by_name(spark, root, same_rows):
    columns = ["customer_id", "marketplace_order_id", "sku", "quantity", "revenue", "order_timestamp"]
    fx.marketplace(spark).select(*columns).coalesce(1).write.option("header", "true").csv(f"{root}/drop")
    load_new_files(spark, f"{root}/drop", MARKETPLACE_TABLE, root, f"{root}/cp", BATCH)
    came = read_text_feed(spark, f"{root}/drop")
    same_rows(read_bronze(spark, root, MARKETPLACE_TABLE).select(*columns), came.select(*columns))


def test_dropped_file_with_other_columns_is_kept_aside(spark, root):
    fx.marketplace(spark).drop("sku").coalesce(1).write.mode("append").option("header", "true").csv(f"{root}/drop")
    fx.marketplace(spark).limit(2).coalesce(1).write.mode("append").option("header", "true").csv(f"{root}/drop")
    (result,) = load_new_files(spark, f"{root}/drop", MARKETPLACE_TABLE, root, f"{root}/cp", BATCH)
    assert (result.rows, result.refused) == ({MARKETPLACE_TABLE: 2}, {MARKETPLACE_TABLE: 4})
    assert {r._rules for r in read_rejects(spark, root, MARKETPLACE_TABLE).collect()} == {"missing_optional:sku"}


def test_good_files_come_in_beside_bad_ones(spark, root):
    """Also with odd file names, and when the load is repeated after it was lost."""
    from pathlib import Path

    header = "order_id,customer_id,product_id,order_date,quantity,revenue,order_status\n"
    drop = Path(root) / "drop"
    drop.mkdir()
    (drop / "good 1%.csv").write_text(header + "S-1,C-1,P-1,2026-06-01,1,5.0,placed\nS-2,C-1,P-1,2026-06-01,1,5.0,placed\n")
    (drop / "bad.csv").write_text(header + "S-3,C-1,P-1,2026-06-01,0,5.0,placed\nS-4,C-1,P-1,2026-06-01,1,-1,placed\n")
    (drop / "moved.csv").write_text("extra,revenue,order_id,customer_id,product_id,order_date,quantity\nx,1.5,S-5,C-1,P-1,2026-06-01,2\n")
    (drop / "only header.csv").write_text(header)
    for _ in range(2):
        load_new_files(spark, str(drop), STOREFRONT_TABLE, root, f"{root}/cp", BATCH)
    stored = {r.order_id: r for r in read_bronze(spark, root, STOREFRONT_TABLE).collect()}
    assert set(stored) == {"S-1", "S-2", "S-5"}
    assert (stored["S-5"].revenue, stored["S-5"].extra, stored["S-1"].extra) == ("1.5", "x", None)
    rejects = read_rejects(spark, root, STOREFRONT_TABLE).collect()
    assert {(r.order_id, r._rules) for r in rejects} == {(o, "validation:quantity; validation:revenue") for o in ("S-3", "S-4")}
    assert {Path(r._source_file).name for r in rejects} == {"bad.csv"}
    # the offsets of a lost run were not kept: the same micro-batch comes again and replaces itself
    load_new_files(spark, str(drop), STOREFRONT_TABLE, root, f"{root}/cp-2", BATCH)
    assert read_bronze(spark, root, STOREFRONT_TABLE).count() == 3
    assert read_rejects(spark, root, STOREFRONT_TABLE).count() == 2


def test_dropped_files_are_held_to_the_contract(spark, root):
    bad = fx.storefront(spark).withColumns({"quantity": F.lit(0), "revenue": F.lit(-5.0), "promo_code_applied": F.lit("x")})
    columns = STOREFRONT_FEED.fieldNames()
    bad.select(*columns).coalesce(1).write.option("header", "true").csv(f"{root}/drop")
    (result,) = load_new_files(spark, f"{root}/drop", STOREFRONT_TABLE, root, f"{root}/cp", BATCH)
    assert "quantity" in result.skipped[STOREFRONT_TABLE] and result.rows == {}
    assert read_bronze(spark, root, STOREFRONT_TABLE).count() == 0


def test_unreadable_text_is_kept_and_counted(spark, root):
    feed = fx.inventory(spark).withColumn("quantity_reserved", F.lit("n/a"))
    result = bronze.ingest(spark, root, {INVENTORY_TABLE: feed}, BATCH)
    stored = read_bronze(spark, root, INVENTORY_TABLE)
    assert result.unreadable[INVENTORY_TABLE]["quantity_reserved"] == 6
    assert {r.quantity_reserved for r in stored.collect()} == {"n/a"}
    assert {r.quantity_reserved for r in silver.inventory(stored).collect()} == {None}


def test_columns_come_and_stay_away(spark, root):
    bronze.ingest(spark, root, {STOREFRONT_TABLE: fx.storefront(spark).drop("order_status")}, BATCH)
    assert {r.order_status for r in silver.conform_storefront(read_bronze(spark, root, STOREFRONT_TABLE)).collect()} == {"unknown"}
    wider = fx.storefront(spark).withColumn("gift", F.lit("yes"))
    bronze.ingest(spark, root, {STOREFRONT_TABLE: wider}, Batch("b-2", BATCH.ingested_at))
    assert read_bronze(spark, root, STOREFRONT_TABLE).where("gift = 'yes'").count() == 4


# batch ledger and schema history


@pytest.mark.parametrize(("mode", "stored"), [("append", 8), ("skip_loaded", 4), ("replace_batch", 4)])
def test_batch_reloaded_after_midnight(spark, root, mode, stored):
    feeds = {MARKETPLACE_TABLE: fx.marketplace(spark)}
    for at in ("2026-06-05T23:59:00+00:00", "2026-06-06T00:01:00+00:00"):
        bronze.ingest(spark, root, feeds, Batch("night", at), reload=mode)
    assert read_bronze(spark, root, MARKETPLACE_TABLE).count() == stored
    bronze.ingest(spark, root, feeds, Batch("night", "2026-06-09T00:01:00+00:00"), reload="skip_loaded")
    assert read_bronze(spark, root, MARKETPLACE_TABLE).count() == stored


def test_batch_replaced_by_nothing(spark, root):
    feed = fx.marketplace(spark)
    bronze.ingest(spark, root, {MARKETPLACE_TABLE: feed}, BATCH)
    bronze.ingest(spark, root, {MARKETPLACE_TABLE: feed}, Batch("other", BATCH.ingested_at))
    bronze.ingest(spark, root, {MARKETPLACE_TABLE: feed.where("false")}, BATCH, reload="replace_batch")
    assert {r._batch_id for r in read_bronze(spark, root, MARKETPLACE_TABLE).collect()} == {"other"}
    assert ledger.is_loaded(spark, root, "bronze", MARKETPLACE_TABLE, BATCH.batch_id)


@pytest.mark.parametrize("mode", bronze.RELOADS)
def test_load_that_is_lost_before_the_ledger(spark, root, mode, monkeypatch):
    feeds = {MARKETPLACE_TABLE: fx.marketplace(spark)}
    bronze.ingest(spark, root, feeds, Batch("first", BATCH.ingested_at))

    def lost(*_):
        raise RuntimeError("executor and driver are gone")

    with monkeypatch.context() as m:
        m.setattr(ledger, "record_loads", lost)
        with pytest.raises(RuntimeError):
            bronze.ingest(spark, root, feeds, BATCH, reload=mode)
    assert read_bronze(spark, root, MARKETPLACE_TABLE).count() == 4
    bronze.ingest(spark, root, feeds, BATCH, reload=mode)
    assert read_bronze(spark, root, MARKETPLACE_TABLE).count() == 8


def test_odd_headers(spark, root):
    path = f"{root}/odd.csv"
    with open(path, "w") as f:
        f.write("Marketplace_Order_Id, customer_id ,SKU,sku,quantity,revenue,order_timestamp,_batch_id,a.b\nA-1,C,P,Q,1,2.5,2026-06-01 10:00:00,theirs,dot\n")
    bronze.ingest(spark, root, {MARKETPLACE_TABLE: path}, BATCH)
    (row,) = read_bronze(spark, root, MARKETPLACE_TABLE).collect()
    assert (row.marketplace_order_id, row.customer_id, row.sku, row.sku_2) == ("A-1", "C", "P", "Q")
    assert (row._batch_id, row.source_batch_id, row["a.b"]) == ("b-1", "theirs", "dot")


def test_feed_of_a_header_only(spark, root):
    path = f"{root}/header.csv"
    with open(path, "w") as f:
        f.write("inventory_id,product_id,warehouse_id,quantity_available,quantity_reserved,last_updated,shelf\n")
    result = runs.run_layers(spark, root, {INVENTORY_TABLE: path}, BATCH)
    assert result.rows["bronze"] == {INVENTORY_TABLE: 0} and result.rows["silver"]["inventory"] == 0
    assert "shelf" in read_bronze(spark, root, INVENTORY_TABLE).columns
    runs.run_layers(spark, root, keyed_feeds(spark), Batch("b-2", BATCH.ingested_at))
    assert read_layer(spark, root, "silver", "inventory").count() == 4


def test_schema_history(spark, root):
    feed = fx.marketplace(spark)
    for batch_id, df in (("1", feed.drop("revenue")), ("2", feed.withColumn("Gift", F.lit("y"))), ("3", feed.withColumn("gift", F.lit("n")))):
        bronze.ingest(spark, root, {MARKETPLACE_TABLE: df}, Batch(batch_id, BATCH.ingested_at))
    history = [(r.version, r.batch_id, r.added) for r in ledger.schema_history(spark, root).orderBy("version").collect()]
    assert [(v, b) for v, b, _ in history] == [(1, "1"), (2, "2")] and history[1][2] == ["Gift"]
    df = read_bronze(spark, root, MARKETPLACE_TABLE)
    assert sorted(df.where("Gift is not null").groupBy("Gift").count().collect()) == [("n", 4), ("y", 4)]


def test_reading_opens_no_footer(spark, root):
    """A file that is no Parquet at all does no harm until its rows are asked for."""
    bronze.ingest(spark, root, {MARKETPLACE_TABLE: fx.marketplace(spark)}, BATCH)
    for file in files(f"{root}/bronze"):
        file.write_bytes(b"not parquet")
    assert "sku" in read_bronze(spark, root, MARKETPLACE_TABLE).columns


def test_refused_batch_is_kept_aside_and_holds_up_nothing(spark, root):
    with pytest.raises(QualityFailure, match="bronze.amazon_orders"):
        runs.run_layers(spark, root, {MARKETPLACE_TABLE: fx.marketplace(spark)}, BATCH)
    assert read_rejects(spark, root, MARKETPLACE_TABLE).count() == 4
    result = runs.run_layers(spark, root, {MARKETPLACE_TABLE: keyed_feeds(spark)[MARKETPLACE_TABLE]}, Batch("b-2", BATCH.ingested_at))
    assert result.rows["silver"]["orders"] == 3


# versions


def published(spark, root, **which):
    return {
        f"{layer}.{t}": sorted(map(str, versions.read_version(spark, root, layer, t, **which).drop("_created_at").collect()))
        for layer in ("silver", "gold")
        for t in catalog.LAYERS[layer]
    }


def later_feeds(spark):
    """Another status for an order of the first batch, which moves its day, a new order, and a new stock position."""
    storefront = spark.createDataFrame(
        [("SHOP-2", "CUST-2", "PROD-2", fx.day(9), 5, 60.0, "delivered"), ("SHOP-8", "CUST-8", "PROD-7", fx.day(1, 5), 1, 8.0, "placed")],
        fx.STOREFRONT_DDL,
    )
    inventory = spark.createDataFrame([("INV-3", "PROD-2", "WH-01", 6, 1, fx.at(8))], fx.INVENTORY_DDL)
    return {STOREFRONT_TABLE: storefront, INVENTORY_TABLE: inventory}


LATER = Batch("b-2", "2026-06-06T01:00:00+00:00")


@pytest.fixture(scope="module")
def two_versions(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("versions"))
    runs.run_layers(spark, root, keyed_feeds(spark), BATCH)
    return root, published(spark, root), runs.run_layers(spark, root, later_feeds(spark), LATER)


def rebuilt_whole(spark, root, at):
    """The same loads, built from scratch elsewhere."""
    import shutil

    shutil.copytree(root, at, ignore=shutil.ignore_patterns("_versions", "silver", "gold"))
    runs.build_version(spark, at, LATER)
    return published(spark, at)


def test_changes_only_are_rebuilt(spark, two_versions, tmp_path):
    root, _, second = two_versions
    assert published(spark, root) == rebuilt_whole(spark, root, f"{tmp_path}/whole")
    assert second.rebuilt["silver.orders"] == ["order_date=2026-05-01", "order_date=2026-06-01", "order_date=2026-06-09"]
    assert second.rebuilt["silver.inventory"] == ["order_date=2026-06-01", "order_date=2026-06-08"]
    assert second.rebuilt["gold.revenue_mart"] == ["order_month=2026-05", "order_month=2026-06"]
    kept = [f for f in second.version.tables["silver.orders"].folders if f.startswith("_version=00000001")]
    assert kept == ["_version=00000001/order_date=2026-06-02", "_version=00000001/order_date=2026-06-03", "_version=00000001/order_date=2026-06-04"]


def test_versions_are_read_by_number_and_day(spark, two_versions):
    root, first, _ = two_versions
    assert published(spark, root, number=1) == first == published(spark, root, day="2026-06-05")
    assert published(spark, root, number=2) == published(spark, root) == published(spark, root, day="2027-01-01")
    with pytest.raises(ValueError, match="no published version up to 2026-06-01"):
        published(spark, root, day="2026-06-01")
    assert versions.read_version(spark, root, "bronze", STOREFRONT_TABLE, number=1).count() == 4
    old = versions.read_version(spark, root, "silver", "orders", day="2026-06-05")
    plan = silver.in_period(old, "2026-06-02", "2026-06-03")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in plan


def test_replaced_and_withdrawn_batches(spark, root, tmp_path):
    runs.run_layers(spark, root, keyed_feeds(spark), BATCH)
    runs.run_layers(spark, root, later_feeds(spark), LATER)
    fewer = {STOREFRONT_TABLE: later_feeds(spark)[STOREFRONT_TABLE].where("order_id = 'SHOP-8'"), INVENTORY_TABLE: fx.inventory(spark).where("false")}
    runs.run_layers(spark, root, fewer, LATER, reload="replace_batch")
    assert published(spark, root) == rebuilt_whole(spark, root, f"{tmp_path}/whole")
    orders = {r.order_id: r.order_date for r in read_layer(spark, root, "silver", "orders").collect()}
    assert orders["SHOP-2"] == fx.day(1) and "SHOP-8" in orders


def test_restored_version(spark, root, tmp_path):
    runs.run_layers(spark, root, keyed_feeds(spark), BATCH)
    first = published(spark, root)
    runs.run_layers(spark, root, later_feeds(spark), LATER)
    runs.run_layers(spark, root, {MARKETPLACE_TABLE: keyed_feeds(spark)[MARKETPLACE_TABLE].limit(1)}, BATCH, reload="replace_batch")
    assert published(spark, root) != first
    assert versions.restore(spark, root, 1, "2026-06-07").number == 4
    assert published(spark, root) == first
    # the next run goes on from there, without the batches that were taken back
    more = {INVENTORY_TABLE: later_feeds(spark)[INVENTORY_TABLE]}
    runs.run_layers(spark, root, more, Batch("b-3", "2026-06-08T01:00:00+00:00"))
    assert published(spark, root) == rebuilt_whole(spark, root, f"{tmp_path}/whole")
    assert {r.order_id for r in read_layer(spark, root, "silver", "orders").collect()} == {"SHOP-1", "SHOP-2", "SHOP-3", "AMZN-1", "AMZN-2", "AMZN-3"}


def test_run_that_dies_between_two_tables(spark, root, monkeypatch):
    runs.run_layers(spark, root, keyed_feeds(spark), BATCH)
    before = published(spark, root)
    write = rebuild.write_version

    def dies(spark, root, layer, table, df, number):
        if table == "customer_360_mart":
            raise RuntimeError("lost")
        return write(spark, root, layer, table, df, number)

    with monkeypatch.context() as m:
        m.setattr(rebuild, "write_version", dies)
        with pytest.raises(RuntimeError):
            runs.run_layers(spark, root, later_feeds(spark), LATER, run_id="run-2")
    assert published(spark, root) == before
    log = [json.loads(r.event) for r in read_table(spark, f"{root}/ops/lineage_events").collect()]
    ended = {(e["job"]["name"], e["eventType"]) for e in log}
    assert ("build_customer_360_mart", "FAIL") in ended and ("build_silver_orders", "COMPLETE") in ended
    assert not any(job == "build_inventory_turnover_mart" for job, _ in ended)
    # the batch is in bronze; the next run, also one without a feed, makes up for it
    runs.run_layers(spark, root, {}, Batch("b-3", "2026-06-07T01:00:00+00:00"))
    assert {r.order_id for r in read_layer(spark, root, "silver", "orders").collect()} >= {"SHOP-8"}


def test_two_runs_cannot_publish_one_version(spark, root):
    version = versions.Version(1, "2026-06-05", "b")
    versions.publish(spark, root, version)
    with pytest.raises(FileExistsError):
        versions.publish(spark, root, version)


# file sizes and bucketing


def test_small_files_are_packed_and_large_ones_left(spark, root, same_rows):
    rows = spark.range(6_000).selectExpr(
        "date'2026-06-01' AS order_date", "'shopify' AS channel", "uuid() AS order_status", "1.0D AS total_revenue", "1L AS total_quantity",
        "id AS order_count", "1.0D AS avg_order_value", "CASE WHEN id < 4000 THEN '2026-05' WHEN id < 5900 THEN '2026-06' END AS order_month",
    )
    # one large file and five small ones in May, four in June, a single one without a month
    spread = "CASE WHEN id < 3500 THEN 0 WHEN id < 4000 THEN 1 + id % 5 WHEN id < 5900 THEN 10 + id % 4 ELSE 20 END"
    parts = [r.k for r in spark.range(6_000).selectExpr(f"{spread} AS k").distinct().collect()]
    state = None
    for k in sorted(parts):
        part = rows.where(spread.replace("id", "order_count") + f" = {k}").coalesce(1)
        new = versions.write_version(spark, root, "gold", "revenue_mart", part, k + 1, rebalance=False)
        state = versions.TableState((state.folders if state else []) + new.folders, new.schema, (state.rows if state else 0) + new.rows)
    versions.publish(spark, root, versions.Version(30, "2026-06-05", "b", {"gold.revenue_mart": state}))
    before = {r.file: r.bytes for r in file_sizes(spark, root, "gold", "revenue_mart", state).collect()}
    large = max(before, key=before.get)
    target = before[large] * 2 - 2
    version, report = compact_table(spark, root, "gold", "revenue_mart", "2026-06-06", target)
    counts = {r.partition: (r.files_before, r.files_after, r.rows_files_before, r.rows_files_after) for r in report.collect()}
    assert counts["order_month=2026-05"] == (6, 2, 4000, 4000)
    assert counts["order_month=2026-06"][0] == 4 and counts["order_month=2026-06"][1] in (1, 2)
    assert counts["order_month=__HIVE_DEFAULT_PARTITION__"] == (1, 1, 100, 100)
    after = {r.file for r in file_sizes(spark, root, "gold", "revenue_mart", version.tables["gold.revenue_mart"]).collect()}
    assert large in after
    same_rows(versions.read_version(spark, root, "gold", "revenue_mart"), versions.read_version(spark, root, "gold", "revenue_mart", number=30))
    assert gold.in_months(versions.read_version(spark, root, "gold", "revenue_mart"), "2026-05", "2026-05").count() == 4000
    again, _ = compact_table(spark, root, "gold", "revenue_mart", "2026-06-07", target)
    assert again.tables["gold.revenue_mart"].folders == version.tables["gold.revenue_mart"].folders or counts["order_month=2026-06"][1] == 2


def test_turnover_of_bucketed_tables_is_not_shuffled(spark, root, same_rows):
    tables = {"orders": silver.orders(fx.storefront(spark), fx.marketplace(spark)), "inventory": silver.inventory(fx.inventory(spark))}
    bucketed = catalog.register_bucketed(spark, root, tables, 4, "t_")
    mart = gold.inventory_turnover_mart(bucketed["inventory"], bucketed["orders"])
    with_broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = mart._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_broadcast)
    assert "Exchange" not in plan and "SelectedBucketsCount" in plan
    same_rows(mart, gold.inventory_turnover_mart(tables["inventory"], tables["orders"]))
    spark.sql("DROP DATABASE t_silver_bucketed CASCADE")


def test_sketches_merge_over_months(spark):
    orders = spark.range(3000).selectExpr(
        "concat('C', id % 1000) AS customer_id", "date_add(date'2026-01-01', CAST(id % 90 AS INT)) AS order_date", "'shopify' AS channel"
    )
    (row,) = gold.quarter_customers(gold.channel_customers(orders)).collect()
    assert row.quarter == "2026-Q1" and abs(row.estimated_customers - 1000) <= 1000 * gold.SKETCH_ERROR


# whole runs


def keyed_feeds(spark):
    """The feeds without the rows that lack their id."""
    return {table: feed.where(F.col(feed.columns[0]).isNotNull()) for table, feed in fx.feeds(spark).items()}


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("run"))
    return root, runs.run_layers(spark, root, keyed_feeds(spark), BATCH)


def test_run_writes_every_table(spark, run):
    root, result = run
    counts = {(layer, table): n for layer, table, n in result.counts()}
    assert len(counts) == 11
    assert counts["silver", "orders"] == 6
    assert counts["gold", "inventory_turnover_mart"] == 4
    for (layer, table), n in counts.items():
        assert read_layer(spark, root, layer, table).count() == n


def test_stored_silver_satisfies_its_keys(spark, run):
    root, _ = run
    orders = read_layer(spark, root, "silver", "orders")
    assert orders.select("order_id", "channel").distinct().count() == orders.count()


def test_second_run_with_skip_changes_nothing(spark, run, same_rows):
    root, first = run
    again = runs.run_layers(spark, root, keyed_feeds(spark), BATCH, reload="skip_loaded")
    assert again.rows["silver"] == first.rows["silver"] and again.rows["gold"] == first.rows["gold"]
    assert set(again.ingest.skipped) == set(BRONZE_TABLES)


def test_gates_stop_a_bad_run(spark, root):
    with pytest.raises(QualityFailure, match="bronze.amazon_orders.*bronze.inventory_feed"):
        runs.run_layers(spark, f"{root}/a", fx.feeds(spark), BATCH)
    feeds = keyed_feeds(spark)
    feeds[MARKETPLACE_TABLE] = feeds[MARKETPLACE_TABLE].withColumn("marketplace_order_id", F.lit("SHOP-2"))
    with pytest.raises(QualityFailure, match="silver.orders"):
        runs.run_layers(spark, f"{root}/b", feeds, BATCH)


def test_a_failed_check_leaves_the_published_tables(spark, root):
    runs.run_layers(spark, root, keyed_feeds(spark), BATCH)
    before = {t: read_layer(spark, root, "silver", t).count() for t in ("orders", "inventory")}
    feeds = {MARKETPLACE_TABLE: fx.marketplace(spark).where("marketplace_order_id is not null").withColumn("marketplace_order_id", F.lit("SHOP-2"))}
    with pytest.raises(QualityFailure, match="silver.orders"):
        runs.run_layers(spark, root, feeds, Batch("b-2", "2026-06-06T01:00:00+00:00"))
    assert {t: read_layer(spark, root, "silver", t).count() for t in before} == before


def test_a_skipped_feed_stops_nothing_and_leaves_no_event(spark, root):
    feeds = keyed_feeds(spark)
    feeds[STOREFRONT_TABLE] = feeds[STOREFRONT_TABLE].withColumn("quantity", F.lit(0))
    result = runs.run_layers(spark, root, feeds, BATCH)
    assert STOREFRONT_TABLE in result.ingest.skipped and STOREFRONT_TABLE not in result.rows["bronze"]
    log = read_table(spark, runs.log_lineage(spark, root, result, "run-1", BATCH.ingested_at))
    jobs = {r.job for r in log.select("job").collect()}
    assert "ingest_shopify_orders" not in jobs and "ingest_amazon_orders" in jobs and len(jobs) == 10
    assert not any(r.input == "bronze.shopify_orders" for r in lineage.lineage_edges(log).collect())


def test_a_run_with_some_feeds_only(spark, root):
    result = runs.run_layers(spark, root, {INVENTORY_TABLE: keyed_feeds(spark)[INVENTORY_TABLE]}, BATCH)
    assert result.rows["silver"]["orders"] == 0 and result.rows["gold"]["inventory_turnover_mart"] == 4


def test_lineage_of_a_run(spark, run):
    root, result = run
    log = read_table(spark, runs.log_lineage(spark, root, result, "run-1", BATCH.ingested_at))
    assert log.count() == 22 and log.where("event like '%\"START\"%'").count() == 11
    edges = {(r.job, r.input, r.output) for r in lineage.lineage_edges(log).collect()}
    assert len(edges) == 17
    assert ("build_silver_products", "bronze.inventory_feed", "silver.products") in edges
    fields = {(r.dataset, r.field): r.type for r in lineage.lineage_fields(log).collect()}
    assert fields["gold.revenue_mart", "total_quantity"] == "BIGINT"
    assert fields["silver.orders", "revenue"] == "DOUBLE"


def test_catalog_over_a_run(spark, run):
    root, result = run
    catalog.register(spark, root, "t_")
    catalog.register(spark, root, "t_")
    assert catalog.summary(spark, "t_").count() == 11
    counted = {(r.layer, r.table_name): r.row_count for r in catalog.row_counts(spark, "t_").collect()}
    assert counted == {(layer, table): n for layer, table, n in result.counts()}


# run health


def test_run_health(spark):
    def at(day, hour=0):
        return dt.datetime(2024, 1, day, hour)

    log = spark.createDataFrame(
        [
            ("a", "success", at(30, 5), at(30, 5), at(30, 6)),
            ("a", "failed", at(30, 1), at(30, 1), at(30, 2)),
            ("b", "running", at(30, 7), at(30, 7), None),
            ("b", "success", at(26), at(26), at(26, 1)),
            ("b", "success", at(10), at(10), at(10, 1)),
        ],
        "dag_id string, state string, execution_date timestamp, start_date timestamp, end_date timestamp",
    )
    now = F.lit(at(31, 2))
    assert [tuple(r) for r in health.run_status(log, now).collect()] == [("a", "success", 1), ("b", "running", 1)]
    durations = health.run_durations(log, now).collect()
    assert [(r.time, r.metric, r.value) for r in durations] == [
        (at(26), "b", 3600.0), (at(30, 1), "a", 3600.0), (at(30, 5), "a", 3600.0),
    ]
    assert health.runs_in_state(log, "success").first().value == 3
    assert health.runs_in_state(log, "none").first().value == 0


# command line


def test_command_line_steps(spark, root, capsys, monkeypatch):
    from shelfline import __main__ as cli

    monkeypatch.setattr(cli, "build_session", lambda name: spark)
    paths = []
    for option, (table, feed) in zip(("storefront", "marketplace", "inventory"), keyed_feeds(spark).items()):
        write_feed(feed, f"{root}/in/{table}")
        paths += [f"--{option}", f"{root}/in/{table}"]
    for step in ("bronze", "silver", "gold", "quality"):
        cli.main([step, "--root", f"{root}/t", "--batch-id", "b-1", *paths])
    out = capsys.readouterr().out
    assert "'orders': 6" in out and "'inventory_turnover_mart': 4" in out and "PASSED" in out
    cli.main(["run", "--root", f"{root}/t", "--batch-id", "b-1", "--reload", "skip_loaded", *paths])
    assert "gold inventory_turnover_mart 4" in capsys.readouterr().out


def test_a_kind_of_dropped_files_is_written_by_several_tasks(spark, root):
    feed = spark.range(40).selectExpr("date_add(DATE '2026-06-01', CAST(id % 28 AS INT)) AS order_date", "id AS quantity", "'c' AS customer_id")
    registry._drop_storefront(feed.repartition(4), f"{root}/drop")
    dropped = spark.read.text(f"{root}/drop").select("_metadata.file_path", "value")
    good = dropped.where("value LIKE '%,good'").groupBy("file_path").count().collect()
    assert len(good) > 1 and dropped.where("value NOT LIKE 'order_date,%'").count() == 40


def test_a_load_is_written_without_a_sort_by_its_own_partition(spark, root, monkeypatch):
    written = []

    def write(df, path, mode, partition_by=None, **options):
        written.append(partition_by)
        return write_table(df, path, mode, partition_by, **options)

    monkeypatch.setattr(ledger, "write_table", write)
    for batch_id in ("a/b c%=é: [1]", "plain"):
        bronze.ingest(spark, root, {MARKETPLACE_TABLE: fx.marketplace(spark)}, Batch(batch_id, BATCH.ingested_at))
    assert written.count(None) == 2 and all(by in (None, "dataset") for by in written)
    rows = read_bronze(spark, root, MARKETPLACE_TABLE)
    n = fx.marketplace(spark).count()
    assert {(r[0], str(r[1])): r[2] for r in rows.groupBy("_batch_id", "_ingestion_date").count().collect()} == {
        ("a/b c%=é: [1]", BATCH.ingestion_date): n, ("plain", BATCH.ingestion_date): n
    }


def test_differing_rows_are_counted_in_one_shuffle(spark, same_rows):
    """As many as both differences of the bags together, and each table is shuffled once."""
    one = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "n int, t string")
    other = spark.createDataFrame([("a", 1), (None, 2), ("d", 3), ("d", 3)], "t string, n int")
    found = registry._differing(one, other)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1
    named = other.select(*one.columns)
    assert found.collect()[0][0] == one.exceptAll(named).count() + named.exceptAll(one).count() == 6
    assert registry._differing(one, one.where("true")).collect()[0][0] == 0
    assert registry._differing(one.where("false"), one.where("false")).collect()[0][0] == 0
