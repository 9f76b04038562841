"""Data contract of an incoming feed: rules, report and gate.

A contract is checked in one aggregate over the batch, whatever the number of
rules. The report has one row per rule; only that handful of rows is ever
brought to the driver, and only by :func:`enforce`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.columns import as_declared
from shelfline.names import ORDER_STATUSES

CRITICAL = "critical"
WARNING = "warning"

# Contract type names, and what each evolution policy leads to.
SPARK_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "date": T.DateType(),
    "integer": T.IntegerType(),
    "decimal": T.DoubleType(),  # judged as it is, not rounded
    "double": T.DoubleType(),
    "float": T.DoubleType(),
    "long": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}
SEVERITY_OF_POLICY = {"reject": CRITICAL, "warn": WARNING, "ignore": None}


class ContractViolation(Exception):
    """A batch breaks at least one critical rule of its contract."""


@dataclass(frozen=True)
class ContractField:
    name: str
    type: str
    required: bool = False
    validation: str | None = None
    allowed_values: tuple[str, ...] = ()


@dataclass(frozen=True)
class Contract:
    name: str
    version: str
    fields: tuple[ContractField, ...]
    unknown_fields: str = "warn"
    missing_optional_fields: str = "ignore"
    missing_required_fields: str = "reject"


# The contract of the storefront feed.
STOREFRONT_CONTRACT = Contract(
    name="shopify_orders_contract",
    version="1.0",
    fields=(
        ContractField("order_id", "string", required=True),
        ContractField("customer_id", "string", required=True),
        ContractField("product_id", "string", required=True),
        ContractField("order_date", "date", required=True),
        ContractField("quantity", "integer", required=True, validation="quantity > 0"),
        ContractField("revenue", "decimal", required=True, validation="revenue >= 0"),
        ContractField("order_status", "string", allowed_values=ORDER_STATUSES),
    ),
)


def load_contract(path: str) -> Contract:
    """Read a contract from a YAML document (needs PyYAML)."""
    import yaml

    with open(path, encoding="utf-8") as handle:
        document = yaml.safe_load(handle)["contract"]
    fields = tuple(
        ContractField(
            name=f["name"],
            type=f["type"],
            required=bool(f.get("required")),
            validation=f.get("validation"),
            allowed_values=tuple(f.get("allowed_values") or ()),
        )
        for f in document["schema"]
    )
    unread = sorted({f"{f.name}: {f.type}" for f in fields if f.type not in SPARK_TYPES})
    if unread:
        raise ValueError(f"contract {document['name']} has unknown types ({', '.join(unread)}); known are {sorted(SPARK_TYPES)}")
    policy = document.get("evolution_policy") or {}
    return Contract(document["name"], str(document["version"]), fields, **policy)


def _is_missing(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.col(name).isNull() | F.isnan(name)
    return F.col(name).isNull()


def schema_changes(df: DataFrame, contract: Contract) -> list[tuple[str, str, str]]:
    """``(rule, field, severity)`` for columns that are missing or unknown."""
    present = set(df.columns)
    known = {f.name for f in contract.fields}
    found = []
    for f in contract.fields:
        if f.name not in present:
            policy = contract.missing_required_fields if f.required else contract.missing_optional_fields
            found.append(("missing_required" if f.required else "missing_optional", f.name, policy))
    found += [("unknown_field", name, contract.unknown_fields) for name in sorted(present - known)]
    return [(rule, name, SEVERITY_OF_POLICY[p]) for rule, name, p in found if SEVERITY_OF_POLICY[p]]


def contract_report(df: DataFrame, contract: Contract = STOREFRONT_CONTRACT, by: tuple[str, ...] = ()) -> DataFrame:
    """One row ``(rule, field, severity, n, message)`` per rule; n = offending rows.

    ``by`` names columns, such as the file of a row, for whose values the rules are judged apart, in the same
    single pass. They are no part of the contract. For missing and unknown columns n is 1. Validations are SQL predicates over
    the fields read as their declared types, and nulls never offend them.
    """
    judged = df.drop(*by)
    present = [f for f in contract.fields if f.name in judged.columns]
    typed: dict[str, Column] = {}
    flags: dict[str, Column] = {}
    rules: list[tuple[str, str, str, str, Column]] = []
    for f in present:
        kind = SPARK_TYPES[f.type]
        typed[f.name] = F.expr(as_declared(df, f.name, kind))
        flags[f"_missing_{f.name}"] = _is_missing(df, f.name)
        if f.required:
            rules.append((
                "null_required", f.name, CRITICAL,
                f"{f.name} is required, but empty in %d row(s)",
                F.col(f"_missing_{f.name}"),
            ))
        if isinstance(df.schema[f.name].dataType, T.StringType) and not isinstance(kind, T.StringType):
            # A rule cannot be judged on a value of the wrong type, so there it is critical.
            rules.append((
                "wrong_type", f.name, CRITICAL if f.validation else WARNING,
                f"%d value(s) in '{f.name}' are not of type {f.type}",
                ~F.col(f"_missing_{f.name}") & F.col(f.name).isNull(),
            ))
        if f.allowed_values:
            rules.append((
                "outside_allowed", f.name, WARNING,
                f"{f.name}: %d row(s) hold none of {', '.join(f.allowed_values)}",
                ~F.col(f.name).isin(*f.allowed_values),
            ))
        if f.validation:
            rules.append((
                "validation", f.name, CRITICAL,
                f"%d row(s) break '{f.validation}'",
                ~F.expr(f.validation),
            ))

    counts = [F.count_if(offends).alias(f"_n{i}") for i, (*_, offends) in enumerate(rules)]
    checked = df.select(*by, *[c.alias(n) for n, c in {**typed, **flags}.items()])
    totals = checked.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), *counts)

    def row(rule: str, name: str, severity: str, n: Column, message: Column) -> Column:
        return F.struct(
            F.lit(rule).alias("rule"), F.lit(name).alias("field"),
            F.lit(severity).alias("severity"), n.alias("n"), message.alias("message"),
        )

    rows = [
        row(rule, name, severity, F.lit(1).cast("bigint"), F.lit(f"{rule} '{name}' (schema drift)"))
        for rule, name, severity in schema_changes(judged, contract)
    ] + [
        row(rule, name, severity, F.col(f"_n{i}"), F.format_string(text, F.col(f"_n{i}")))
        for i, (rule, name, severity, text, _) in enumerate(rules)
    ]
    return totals.select(*by, F.inline(F.array(*rows)))


def drift_columns(df: DataFrame, contract: Contract = STOREFRONT_CONTRACT) -> DataFrame:
    """Columns the contract does not know, with the number of rows that fill them."""
    known = {f.name for f in contract.fields}
    unknown = sorted(set(df.columns) - known)
    totals = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in unknown])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col("_rows").alias("row_count"), F.col(c).alias("filled_rows"))
        for c in unknown
    ]
    if not rows:
        return totals.select(
            F.lit("").alias("column_name"), F.col("_rows").alias("row_count"), F.col("_rows").alias("filled_rows")
        ).where(F.lit(False))
    return totals.select(F.inline(F.array(*rows)))


def contract_gate(df: DataFrame, contract: Contract = STOREFRONT_CONTRACT) -> DataFrame:
    """``df`` as it is, or no rows at all when a critical rule is broken."""
    broken = contract_report(df, contract).where((F.col("severity") == CRITICAL) & (F.col("n") > 0))
    return df.where(~broken.exists())


def enforce(df: DataFrame, contract: Contract = STOREFRONT_CONTRACT) -> dict[str, list[str]]:
    """Check ``df`` now. Returns the warnings, raises on any critical rule."""
    found = contract_report(df, contract).where("n > 0").collect()
    critical = [r.message for r in found if r.severity == CRITICAL]
    if critical:
        raise ContractViolation(
            f"batch refused by contract {contract.name}: {'; '.join(critical)}"
        )
    return {"critical": critical, "warnings": [r.message for r in found if r.severity == WARNING]}
