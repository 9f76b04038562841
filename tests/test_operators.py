import datetime as dt
from collections import Counter

from fixtures import day
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfline.functions.columns import (
    as_date,
    as_declared,
    as_double,
    as_int,
    money,
    padded_id,
    ratio,
    seconds_between,
)
from shelfline.names import INVENTORY_FEED
from shelfline.operators.batches import Batch, add_batch_columns, clean_column_names
from shelfline.operators.dedup import first_source, latest_per_key
from shelfline.operators.defects import (
    inject_duplicates,
    inject_late_arrivals,
    inject_nulls,
    inject_schema_drift,
)
from shelfline.operators.integrity import late_arrival_profile, orphan_counts


def values(df, column):
    return [r[column] for r in df.collect()]


# columns


def test_numbers_from_text(spark):
    df = spark.createDataFrame([("79.0",), ("2.7",), ("abc",), ("NaN",), ("99999999999",), (None,)], "x string")
    assert values(df.selectExpr(f"{as_int(df, 'x')} AS y"), "y") == [79, 2, None, None, None, None]
    assert values(df.selectExpr(f"{as_double('x')} AS y"), "y") == [79.0, 2.7, None, None, 99999999999.0, None]


def test_declared_types_from_text(spark):
    df = spark.createDataFrame([("79.0", "2026-06-01 10:00:00"), ("x", "soon")], "q string, t string")
    out = df.selectExpr(
        f"{as_declared(df, 'q', INVENTORY_FEED['quantity_reserved'].dataType)} AS q",
        f"{as_declared(df, 't', INVENTORY_FEED['last_updated'].dataType)} AS t",
    ).collect()
    assert [tuple(r) for r in out] == [(79, dt.datetime(2026, 6, 1, 10)), (None, None)]


def test_dates_with_and_without_time(spark):
    df = spark.createDataFrame([("2026-06-14",), ("2026-06-14 00:00:00",), ("14 June",)], "x string")
    assert values(df.selectExpr(f"{as_date('x')} AS y"), "y") == [dt.date(2026, 6, 14)] * 2 + [None]


def test_padded_id_keeps_long_keys_whole(spark):
    df = spark.createDataFrame([(7,), (1234567,)], "k long")
    assert values(df.selectExpr(f"{padded_id('P-', 'k', 4)} AS y"), "y") == ["P-0007", "P-1234567"]


def test_ratio_is_zero_without_stock(spark):
    df = spark.createDataFrame([(10, 4), (10, 0), (10, None), (0, 5)], "n int, d int")
    assert values(df.selectExpr(f"{ratio('n', 'd')} AS y"), "y") == [2.5, 0.0, 0.0, 0.0]


def test_money_sum_does_not_depend_on_order(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (1e9,), (-1e9,), (0.3,)], "x double")
    sums = {df.orderBy(F.expr(o)).coalesce(1).selectExpr(f"sum({money('x')}) s").first().s for o in ("x", "-x")}
    assert [float(s) for s in sums] == [0.6]


def test_seconds_between_keeps_micros(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' a, timestamp_ntz'2024-01-01 00:01:00.5' b")
    assert df.selectExpr(f"{seconds_between('a', 'b')} AS s").first().s == 60.5


# batches


def test_batch_columns(spark):
    df = spark.createDataFrame([("SHOP-001", 10.0)], "order_id string, revenue double")
    batch = Batch("b-1", "2026-06-03T23:59:59+00:00")
    row = add_batch_columns(df, "test_source", batch.batch_id, batch.ingested_at).first()
    assert row._source_system == "test_source"
    assert row._batch_id == "b-1"
    assert row._ingestion_timestamp == "2026-06-03T23:59:59+00:00"
    assert row._ingestion_date == dt.date(2026, 6, 3)


def test_fresh_batches_differ():
    assert Batch().batch_id != Batch().batch_id
    assert Batch().ingested_at.endswith("+00:00")


def test_column_names_are_stripped(spark):
    df = spark.createDataFrame([(1, 2)], "` a ` int, `b  ` int")
    assert clean_column_names(df).columns == ["a", "b"]


# dedup


def test_latest_per_key_keeps_newest(spark):
    df = spark.createDataFrame(
        [
            ("ORD-001", "shopify", "2026-06-01", 100.0),
            ("ORD-001", "shopify", "2026-06-02", 100.0),
            ("ORD-002", "shopify", "2026-06-01", 50.0),
        ],
        "order_id string, channel string, order_date string, revenue double",
    )
    out = latest_per_key(df, ["order_id", "channel"], "order_date").collect()
    assert sorted((r.order_id, r.order_date) for r in out) == [("ORD-001", "2026-06-02"), ("ORD-002", "2026-06-01")]


def test_latest_per_key_settles_ties_and_nulls(spark):
    rows = [("a", None, 9.0), ("a", day(1), 1.0), ("a", day(1), None), ("a", day(1), 3.0)]
    ddl = "k string, d date, v double"
    for shuffled in (rows, rows[::-1], rows[2:] + rows[:2]):
        df = spark.createDataFrame(shuffled, ddl).repartition(3)
        assert [tuple(r) for r in latest_per_key(df, ["k"], "d").collect()] == [("a", day(1), 3.0)]


def test_latest_per_key_cuts_hot_keys_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    plan = latest_per_key(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_latest_per_key_with_a_hot_key(spark):
    df = spark.range(30_000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS v")
    out = latest_per_key(df, ["k"], "v")
    assert out.count() == 20_001
    assert out.where("k = 0").first().v == 29_997


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(
        st.tuples(
            st.sampled_from("abc"),
            st.one_of(st.none(), st.integers(1, 3)),
            st.one_of(st.none(), st.integers(-2, 2)),
            st.one_of(st.none(), st.sampled_from("xyz")),
        ),
        min_size=1,
        max_size=25,
    )
)
def test_latest_per_key_equals_brute_force(spark, rows):
    def nulls_first(row):
        return [(value is not None, 0 if value is None else value) for value in row[1:]]

    expected = {max((r for r in rows if r[0] == key), key=nulls_first) for key in {r[0] for r in rows}}
    df = spark.createDataFrame(rows, "k string, d int, v int, s string").repartition(3)
    assert {tuple(r) for r in latest_per_key(df, ["k"], "d").collect()} == expected


def test_first_source_follows_priority_not_row_order(spark):
    first = spark.createDataFrame([("b",), (None,)], "k string")
    second = spark.createDataFrame([("a",), ("b",), ("a",)], "k string")
    out = first_source([("one", first), ("two", second)], "k")
    assert sorted(tuple(r) for r in out.collect()) == [("a", "two"), ("b", "one")]


# skew-safe join


# defects


def test_null_rate_and_repeatability(spark, same_rows):
    df = spark.range(10_000).selectExpr("id AS k", "'x' AS a", "'y' AS b")
    out = inject_nulls(df, ["a"], "k")
    assert out.where("a IS NULL").count() == 300
    assert out.where("b IS NULL").count() == 0
    same_rows(out, inject_nulls(df.repartition(5), ["a"], "k"))


def test_duplicates_are_exact_copies(spark):
    df = spark.range(10_000).selectExpr("id AS k", "id * 2 AS v")
    out = inject_duplicates(df, "k")
    assert out.count() == 10_200
    assert out.distinct().count() == 10_000


def test_at_least_one_row_is_hit(spark):
    df = spark.range(5_000, 5_003).selectExpr("id AS k", "date'2026-06-10' AS d")
    assert inject_duplicates(df, "k", at_least_one=True).count() >= 4
    assert inject_late_arrivals(df, "d", "k", at_least_one=True).where("d < date'2026-06-10'").count() >= 1
    assert inject_schema_drift(df, "k", at_least_one=True).where("promo_code_applied IS NOT NULL").count() >= 1


def test_late_arrivals_move_one_to_three_days(spark):
    df = spark.range(10_000).selectExpr("id AS k", "date'2026-06-10' AS d", "timestamp'2026-06-10 12:00:00' AS t")
    moved = inject_late_arrivals(df, "d", "k").groupBy(F.expr("datediff(date'2026-06-10', d) AS days")).count()
    counts = {r.days: r["count"] for r in moved.collect()}
    assert set(counts) == {0, 1, 2, 3} and counts[0] == 9_800
    times = inject_late_arrivals(df, "t", "k").where("t < timestamp'2026-06-10 12:00:00'")
    assert times.count() == 200


def test_schema_drift_fills_one_percent(spark):
    out = inject_schema_drift(spark.range(10_000).selectExpr("id AS k"), "k")
    filled = out.where("promo_code_applied IS NOT NULL")
    assert filled.count() == 100
    assert filled.where("NOT promo_code_applied RLIKE '^PROMO-[0-9]{4}$'").count() == 0


# integrity


def test_orphans_are_counted_per_key_and_row(spark):
    facts = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    known = spark.createDataFrame([("b",)], "k string")
    assert tuple(orphan_counts(facts, known, "k", "c").first()) == ("c", 1, 2)
    assert tuple(orphan_counts(facts, facts.distinct(), "k", "c").first()) == ("c", 0, 0)


def test_late_arrival_profile(spark):
    df = spark.createDataFrame([(day(3), day(3)), (day(1), day(3)), (day(1), day(3))], "d date, _ingestion_date date")
    out = Counter({r.days_late: r.row_count for r in late_arrival_profile(df, "d").collect()})
    assert out == {0: 1, 2: 2}
