"""Declarative expectation suite compiled into ONE aggregate.

A suite is a list of ``Expectation`` specs.  ``run_suite`` turns every
rule into ``count_if`` columns of a single ``agg`` (one scan, partial
aggregates per task, no shuffle beyond the final single-row merge), then
unpivots to one report row per rule with ``stack``.

Column rules ignore NULLs except ``not_null``; ``count_if`` (not
``sum(cast)``) keeps counts at 0 on an empty frame, so an empty table
fails only the row-count rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope import schema as S

TABLE = "(table)"


@dataclass(frozen=True)
class Expectation:
    rule_type: str
    column: str = TABLE
    kwargs: dict = field(default_factory=dict)


def not_null(column: str) -> Expectation:
    return Expectation("expect_column_values_to_not_be_null", column)


def between(column: str, min_value=None, max_value=None) -> Expectation:
    return Expectation("expect_column_values_to_be_between", column,
                       {"min_value": min_value, "max_value": max_value})


def in_set(column: str, values: Sequence[str]) -> Expectation:
    return Expectation("expect_column_values_to_be_in_set", column, {"value_set": list(values)})


def matches_regex(column: str, regex: str) -> Expectation:
    return Expectation("expect_column_values_to_match_regex", column, {"regex": regex})


def row_count_between(min_value=None, max_value=None) -> Expectation:
    return Expectation("expect_table_row_count_to_be_between", TABLE,
                       {"min_value": min_value, "max_value": max_value})


def silver_suite() -> list[Expectation]:
    """The eight Silver rules, in order."""
    return [
        not_null("transaction_id"),
        not_null("store_id"),
        between("total_amount", S.TOTAL_AMOUNT_MIN, S.TOTAL_AMOUNT_MAX),
        between("quantity", S.QUANTITY_MIN, S.QUANTITY_MAX),
        in_set("audit_flag", S.AUDIT_FLAGS),
        in_set("payment_method", S.PAYMENT_METHODS),
        matches_regex("store_id", S.STORE_ID_PATTERN),
        row_count_between(min_value=1),
    ]


def _unexpected(e: Expectation) -> Column | None:
    """Predicate that marks a row unexpected, or None for table rules."""
    c = F.col(e.column) if e.column != TABLE else None
    if e.rule_type == "expect_column_values_to_not_be_null":
        return c.isNull()
    if e.rule_type == "expect_column_values_to_be_between":
        lo, hi = e.kwargs.get("min_value"), e.kwargs.get("max_value")
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (c < F.lit(lo))
        if hi is not None:
            bad = bad | (c > F.lit(hi))
        return c.isNotNull() & bad
    if e.rule_type == "expect_column_values_to_be_in_set":
        return c.isNotNull() & ~c.isin(*e.kwargs["value_set"])
    if e.rule_type == "expect_column_values_to_match_regex":
        return c.isNotNull() & ~c.rlike(e.kwargs["regex"])
    if e.rule_type == "expect_table_row_count_to_be_between":
        return None
    raise ValueError(f"unknown rule type {e.rule_type}")


def run_suite(df: DataFrame, suite: Sequence[Expectation]) -> DataFrame:
    """Report: rule_id, rule_type, column, success, element_count, missing_count, unexpected_count."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, e in enumerate(suite):
        pred = _unexpected(e)
        if pred is not None:
            aggs.append(F.count_if(F.col(e.column).isNull()).alias(f"_m{i}"))
            aggs.append(F.count_if(pred).alias(f"_u{i}"))
    one = df.agg(*aggs)

    rows = []
    for i, e in enumerate(suite):
        if e.rule_type == "expect_table_row_count_to_be_between":
            lo, hi = e.kwargs.get("min_value"), e.kwargs.get("max_value")
            ok = F.lit(True)
            if lo is not None:
                ok = ok & (F.col("_rows") >= F.lit(lo))
            if hi is not None:
                ok = ok & (F.col("_rows") <= F.lit(hi))
            missing, unexpected = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
        else:
            missing, unexpected = F.col(f"_m{i}").cast("bigint"), F.col(f"_u{i}").cast("bigint")
            ok = unexpected == 0
        rows.append(F.struct(
            F.lit(i + 1).alias("rule_id"),
            F.lit(e.rule_type).alias("rule_type"),
            F.lit(e.column).alias("column"),
            ok.alias("success"),
            F.col("_rows").cast("bigint").alias("element_count"),
            missing.alias("missing_count"),
            unexpected.alias("unexpected_count"),
        ))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def suite_success(report: DataFrame) -> DataFrame:
    """One row: overall success (AND of all rules) and the number of failed rules."""
    return report.agg(
        F.coalesce(F.bool_and("success"), F.lit(True)).alias("success"),
        F.count_if(~F.col("success")).cast("bigint").alias("failed_rules"),
    )
