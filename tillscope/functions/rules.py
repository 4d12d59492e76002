"""Silver business rules as Column expressions.

The rejection cascade is an ordered list of ``(reason, predicate)``
pairs folded into one ``CASE WHEN`` chain, so the first matching rule
wins and a NULL predicate falls through to the next rule (a row with a
NULL amount is judged by the store-format rule, exactly as a ``when``
chain does).  Never combine the predicates with boolean algebra: that
would turn NULL into FALSE early.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillscope import schema as S
from tillscope.functions.money import lost, wide


def expected_total(quantity: Column | str = "quantity",
                   unit_price: Column | str = "unit_price") -> Column:
    """round(quantity * unit_price, 2) on decimals (half up), from the price as it came."""
    q = F.col(quantity) if isinstance(quantity, str) else quantity
    return F.round(q.cast("decimal(10,0)") * wide(unit_price).try_cast("decimal(26,10)"), 2)


def total_mismatch(total: Column | str = "total_amount", expected: Column | str = "expected_total",
                   unit_price: Column | str = "unit_price") -> Column:
    """The total, as it came, is more than one cent off, or total or price cannot be held as money."""
    e = F.col(expected) if isinstance(expected, str) else expected
    off = F.abs(wide(total) - e) > F.lit(S.TOTAL_TOLERANCE).cast("decimal(4,2)")
    t = F.col(total) if isinstance(total, str) else total
    return F.when(lost(total) | (t.isNotNull() & lost(unit_price)), True).otherwise(off)


def rejection_rules() -> list[tuple[str, Column]]:
    """The ordered rejection rules over a frame with ``expected_total`` and the amounts as they came."""
    total = F.col("total_amount")
    return [
        (S.REASON_NULL_TRANSACTION_ID, F.col("transaction_id").isNull()),
        (S.REASON_NULL_STORE_ID, F.col("store_id").isNull()),
        (S.REASON_NEGATIVE_AMOUNT, total < 0),
        (S.REASON_TOTAL_MISMATCH,
         total_mismatch()),
        (S.REASON_INVALID_STORE_FORMAT, ~F.col("store_id").rlike(S.STORE_ID_PATTERN)),
    ]


def first_match(rules: Sequence[tuple[str, Column]]) -> Column:
    """Fold ordered ``(label, predicate)`` rules into one CASE: first TRUE wins, else NULL."""
    if not rules:
        return F.lit(None).cast("string")
    label, pred = rules[0]
    chain = F.when(pred, F.lit(label))
    for label, pred in rules[1:]:
        chain = chain.when(pred, F.lit(label))
    return chain.otherwise(F.lit(None).cast("string"))


def rejection_reason() -> Column:
    return first_match(rejection_rules())


def audit_flag(is_voided: Column | str = "is_voided",
               total_amount: Column | str = "total_amount") -> Column:
    """VOIDED, else EXCEPTION_HIGH_VALUE when total > 5000 (strict), else VALID."""
    v = F.col(is_voided) if isinstance(is_voided, str) else is_voided
    t = F.col(total_amount) if isinstance(total_amount, str) else total_amount
    return (
        F.when(v, F.lit(S.FLAG_VOIDED))
        .when(t > S.HIGH_VALUE_THRESHOLD, F.lit(S.FLAG_HIGH_VALUE))
        .otherwise(F.lit(S.FLAG_VALID))
    )
