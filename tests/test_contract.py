import pytest
from fixtures import day

from shelfline.operators.contract import (
    STOREFRONT_CONTRACT,
    ContractViolation,
    contract_gate,
    contract_report,
    drift_columns,
    enforce,
    load_contract,
)

DDL = (
    "order_id string, customer_id string, product_id string, order_date date, "
    "quantity int, revenue double, order_status string"
)
VALID = ("SHOP-000001", "CUST-00001", "PROD-0001", day(1), 2, 99.99, "placed")


def batch(spark, *rows, ddl=DDL):
    return spark.createDataFrame(rows or (VALID,), ddl)


def changed(**values):
    names = [f.split()[0] for f in DDL.split(", ")]
    return tuple(values.get(n, v) for n, v in zip(names, VALID))


def found(df):
    return {(r.rule, r.field, r.severity): r.n for r in contract_report(df).where("n > 0").collect()}


def test_valid_batch_passes(spark):
    assert enforce(batch(spark)) == {"critical": [], "warnings": []}


def test_unknown_column_warns(spark):
    df = batch(spark).selectExpr("*", "'surprise' AS unexpected_column")
    warnings = enforce(df)["warnings"]
    assert any("schema drift" in w for w in warnings)


def test_missing_required_column_is_critical(spark):
    with pytest.raises(ContractViolation):
        enforce(batch(spark).drop("order_id"))


def test_missing_optional_column_is_ignored(spark):
    assert enforce(batch(spark).drop("order_status")) == {"critical": [], "warnings": []}


def test_negative_revenue_and_zero_quantity(spark):
    with pytest.raises(ContractViolation, match="revenue >= 0"):
        enforce(batch(spark, changed(revenue=-10.0)))
    with pytest.raises(ContractViolation, match="quantity"):
        enforce(batch(spark, changed(quantity=0)))
    assert enforce(batch(spark, changed(revenue=0.0)))["critical"] == []


def test_nulls_break_required_but_not_validation(spark):
    df = batch(spark, VALID, changed(quantity=None), changed(quantity=None, order_status=None))
    assert found(df) == {("null_required", "quantity", "critical"): 2}


def test_nan_counts_as_null(spark):
    assert found(batch(spark, changed(revenue=float("nan")))) == {("null_required", "revenue", "critical"): 1}


def test_value_outside_allowed_set_warns(spark):
    df = batch(spark, VALID, changed(order_status="lost"), changed(order_status=None))
    assert found(df) == {("outside_allowed", "order_status", "warning"): 1}
    assert len(enforce(df)["warnings"]) == 1


def test_text_batch_is_judged_by_declared_types(spark):
    ddl = DDL.replace("date,", "string,").replace("int", "string").replace("double", "string")
    df = batch(
        spark,
        changed(order_date="2026-06-01", quantity="79.0", revenue="1.50"),
        changed(order_date="soon", quantity="many", revenue="1.50"),
        changed(order_date="2026-06-01 00:00:00", quantity="0", revenue="-1"),
        ddl=ddl,
    )
    assert found(df) == {
        ("wrong_type", "order_date", "warning"): 1,
        ("wrong_type", "quantity", "critical"): 1,
        ("validation", "quantity", "critical"): 1,
        ("validation", "revenue", "critical"): 1,
    }


def test_gate_lets_all_or_nothing_through(spark):
    good = batch(spark, VALID, changed(order_status="lost"))
    assert contract_gate(good).count() == 2
    assert contract_gate(good.unionByName(batch(spark, changed(quantity=-1)))).count() == 0
    assert contract_gate(good.drop("customer_id")).count() == 0


def test_report_is_one_pass(spark):
    plan = contract_report(batch(spark).repartition(2))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_drift_columns(spark):
    df = batch(spark, VALID, VALID).selectExpr("*", "IF(monotonically_increasing_id() = 0, 'P', NULL) AS promo")
    assert [(r.column_name, r.row_count) for r in drift_columns(df).collect()] == [("promo", 2)]
    assert drift_columns(batch(spark)).count() == 0


def test_contract_from_yaml(spark, tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "contract.yaml"
    path.write_text(
        """
contract:
  name: demo
  version: 2
  schema:
    - {name: order_id, type: string, required: true}
    - {name: quantity, type: integer, required: true, validation: "quantity BETWEEN 1 AND 5"}
    - {name: note, type: string, required: false}
  evolution_policy:
    unknown_fields: reject
    missing_optional_fields: warn
    missing_required_fields: reject
"""
    )
    contract = load_contract(str(path))
    df = spark.createDataFrame([("a", 6, 1)], "order_id string, quantity int, extra int")
    rows = {(r.rule, r.field, r.severity): r.n for r in contract_report(df, contract).where("n > 0").collect()}
    assert rows == {
        ("missing_optional", "note", "warning"): 1,
        ("unknown_field", "extra", "critical"): 1,
        ("validation", "quantity", "critical"): 1,
    }
    assert STOREFRONT_CONTRACT.unknown_fields == "warn"


def test_validations_judge_the_unrounded_number(spark):
    df = batch(spark, changed(revenue=-0.004))
    assert any(r.rule == "validation" and r.field == "revenue" and r.n > 0 for r in contract_report(df).collect())


def test_all_declared_types_are_known(spark, tmp_path):
    kinds = ("string", "date", "integer", "decimal", "double", "float", "long", "boolean", "timestamp")
    text = "contract:\n  name: n\n  version: 1\n  schema:\n" + "".join(f"    - {{name: c_{k}, type: {k}}}\n" for k in kinds)
    (tmp_path / "c.yaml").write_text(text)
    contract = load_contract(str(tmp_path / "c.yaml"))
    df = spark.createDataFrame([tuple("x" for _ in kinds)], ", ".join(f"c_{k} string" for k in kinds))
    wrong = {r.field: r.n for r in contract_report(df, contract).collect() if r.rule == "wrong_type"}
    assert wrong == {f"c_{k}": 1 for k in kinds if k != "string"}
    (tmp_path / "d.yaml").write_text(text.replace("type: long", "type: longer"))
    with pytest.raises(ValueError, match="longer"):
        load_contract(str(tmp_path / "d.yaml"))
