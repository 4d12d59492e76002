"""Record contract of a POS transaction, as column expressions.

The audited producer validated one object at a time; here the same
rules run over a whole DataFrame inside one projection.  Rules, in
order: required fields (C1), bounds (C2), literal sets (C3) and the
total cross-check (C4, skipped when quantity or unit price already
failed).  Defaults (C5) are applied first.

Violation labels are ``<field>:<rule>``; ``violations`` joins them with
``,`` in rule order (empty string for a clean row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope import schema as S
from tillscope.functions.rules import expected_total, total_mismatch

REQUIRED_FIELDS = [
    "transaction_id",
    "store_id",
    "terminal_id",
    "cashier_id",
    "product_id",
    "quantity",
    "unit_price",
    "total_amount",
    "payment_method",
    "transaction_ts",
]


def contract_defaults(df: DataFrame) -> DataFrame:
    """is_voided defaults to false, audit_flag to VALID."""
    return df.withColumns(
        {
            "is_voided": F.coalesce(F.col("is_voided"), F.lit(False)),
            "audit_flag": F.coalesce(F.col("audit_flag"), F.lit(S.FLAG_VALID)),
        }
    )


def _quantity_ok() -> Column:
    return F.col("quantity").between(S.QUANTITY_MIN, S.QUANTITY_MAX)


def _price_ok() -> Column:
    """The bounds hold for the price as it came, before any rounding."""
    return F.col("unit_price").cast("double").between(float(S.UNIT_PRICE_MIN), float(S.UNIT_PRICE_MAX))


def violation_checks() -> list[tuple[str, Column]]:
    """Ordered ``(label, violated)`` pairs; a NULL check counts as not violated."""
    checks = [(f"{c}:missing", F.col(c).isNull()) for c in REQUIRED_FIELDS]
    checks += [
        ("quantity:range", F.col("quantity").isNotNull() & ~_quantity_ok()),
        ("unit_price:range", F.col("unit_price").isNotNull() & ~_price_ok()),
        ("payment_method:not_in_set",
         F.col("payment_method").isNotNull() & ~F.col("payment_method").isin(*S.PAYMENT_METHODS)),
        ("audit_flag:not_in_set", ~F.col("audit_flag").isin(*S.AUDIT_FLAGS)),
        ("total_amount:mismatch",
         F.coalesce(_quantity_ok(), F.lit(False)) & F.coalesce(_price_ok(), F.lit(False))
         & total_mismatch(expected=expected_total())),
    ]
    return checks


def contract_violations(df: DataFrame, id_column: str = "transaction_id") -> DataFrame:
    """Per row: id, n_violations (int), violations (comma-joined labels)."""
    d = contract_defaults(df)
    checks = violation_checks()
    labels = [F.when(bad, F.lit(label)) for label, bad in checks]
    count = sum((F.when(bad, F.lit(1)).otherwise(F.lit(0)) for _, bad in checks), F.lit(0))
    return d.select(
        F.col(id_column).alias(id_column),
        count.cast("int").alias("n_violations"),
        F.concat_ws(",", *labels).alias("violations"),
    )
