import pytest

from shelfline.operators.expectations import (
    QualityFailure,
    between,
    evaluate,
    exists,
    in_set,
    not_null,
    require_passed,
    table_status,
    unique,
)
from shelfline.plans.quality import gold_gate, SUITES, gold_nonempty


def results(df, *suite, layer="silver"):
    return [
        (r.expectation.removeprefix("expect_column_").removeprefix("values_to_"), r.checked_rows, r.unexpected_rows, r.success)
        for r in evaluate(df, "t", layer, suite).collect()
    ]


@pytest.fixture
def df(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("b", None, None), (None, -5, "z"), (None, 7, "x")]
    return spark.createDataFrame(rows, "k string, n int, s string")


def test_every_check(df):
    out = results(df, not_null("k"), unique("k"), between("n", min_value=1), in_set("s", ["x", "y"]))
    assert out == [
        ("not_be_null", 5, 2, False),
        ("be_unique", 3, 2, False),
        ("be_between", 4, 1, False),
        ("be_in_set", 4, 1, False),
    ]


def test_unique_counts_every_repeated_row_and_ignores_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert results(df, unique("k")) == [("be_unique", 4, 3, False)]
    assert results(df.where("k = 'b' OR k IS NULL"), unique("k")) == [("be_unique", 1, 0, True)]


def test_two_unique_columns(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "k string, n int")
    assert results(df, unique("k"), unique("n")) == [("be_unique", 3, 0, True), ("be_unique", 3, 2, False)]


def test_mostly_is_a_share_of_filled_rows(spark):
    df = spark.range(200).selectExpr("IF(id < 100, NULL, IF(id = 100, -1, 1)) AS n")
    assert results(df, between("n", min_value=0, mostly=0.99)) == [("be_between", 100, 1, True)]
    assert results(df, between("n", min_value=0, mostly=0.995)) == [("be_between", 100, 1, False)]
    assert results(df, between("n", min_value=0, max_value=0)) == [("be_between", 100, 100, False)]


def test_empty_table_passes(df):
    out = results(df.where("false"), not_null("k"), unique("k"), between("n", min_value=1))
    assert [o[-1] for o in out] == [True, True, True]


def test_missing_column(df):
    assert results(df, exists("k"), exists("gone"), not_null("gone"), layer="bronze") == [
        ("to_exist", 1, 0, True),
        ("to_exist", 1, 1, False),
        ("not_be_null", 0, 0, False),
    ]


def test_severity_depends_on_the_layer(df):
    suite = [not_null("k"), unique("k"), in_set("s", ["x"]), between("n", min_value=0), exists("k")]
    for layer, critical in (("bronze", [0, 4]), ("silver", [0, 1, 2])):
        rows = evaluate(df, "t", layer, suite).collect()
        assert [i for i, r in enumerate(rows) if r.severity == "critical"] == critical


def test_status_and_gate(df):
    good = evaluate(df.where("k = 'b'"), "good", "silver", [not_null("k"), between("n", min_value=1)])
    warned = evaluate(df, "warned", "silver", [between("n", min_value=1)])
    bad = evaluate(df, "bad", "silver", [not_null("k"), unique("k")])
    status = {r.table_name: r for r in table_status(good.unionByName(warned).unionByName(bad)).collect()}
    assert (status["good"].status, status["warned"].status, status["bad"].status) == ("PASSED", "PASSED", "FAILED")
    assert status["warned"].warnings == "expect_column_values_to_be_between failed on column 'n'"
    assert status["bad"].critical_count == 2
    assert require_passed(good.unionByName(warned)).count() == 2
    with pytest.raises(QualityFailure, match="bad"):
        require_passed(good.unionByName(bad))


def test_row_checks_move_no_rows_and_keys_travel_alone(spark):
    df = spark.range(10).selectExpr("id % 7 AS order_id", "1 AS revenue", "1 AS quantity", "'amazon' AS channel", "current_date() AS order_date")
    plan = evaluate(df, "t", "silver", SUITES["silver"]["orders"])._jdf.queryExecution().executedPlan().toString()
    keyed = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert len(keyed) == 1 and "order_id" in keyed[0]


def test_gold_nonempty(spark):
    out = {r.mart: r.status for r in gold_nonempty({"a": spark.range(2), "b": spark.range(0)}).collect()}
    assert out == {"a": "PASSED", "b": "FAILED"}


def test_an_empty_mart_stops_the_run_unless_its_source_is_empty(spark):
    marts = {"revenue_mart": spark.range(0), "inventory_turnover_mart": spark.range(2)}
    with pytest.raises(QualityFailure, match="revenue_mart"):
        gold_gate(marts)
    with pytest.raises(QualityFailure, match="revenue_mart"):
        gold_gate(marts, {"orders": spark.range(1), "inventory": spark.range(1)})
    assert gold_gate(marts, {"orders": spark.range(0), "inventory": spark.range(1)}).count() == 2
