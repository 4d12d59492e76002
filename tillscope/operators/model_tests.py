"""Model tests of the gold layer: unique, not_null, relationships.

Each test is an aggregate returning its failure count; ``model_test_report``
stacks one row per test.  Tests over the same model share one scan:
all not_null checks of a model fold into one ``agg``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once (one row per such value)."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def relationships_failures(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-null child keys without a parent row (anti join; the planner broadcasts the
    parent only when its measured size is under the broadcast threshold)."""
    keys = parent.select(F.col(parent_column).alias("__parent_key")).filter(F.col("__parent_key").isNotNull())
    return (child.select(column).filter(F.col(column).isNotNull())
            .join(keys, F.col(column) == F.col("__parent_key"), "left_anti"))


def relationships_failure_count(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """One row (``_f``): child rows whose non-null key has no parent.

    Child keys are counted first (partial aggregate), so a key holding a
    third of the child rows enters the anti join as one row.
    """
    keys = (child.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("__n")))
    parents = parent.select(F.col(parent_column).alias("__parent_key")).filter(F.col("__parent_key").isNotNull())
    missing = keys.join(parents, F.col(column) == F.col("__parent_key"), "left_anti")
    return missing.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("_f"))


@dataclass(frozen=True)
class ModelTest:
    test: str            # unique | not_null | relationships
    model: str
    column: str
    to_model: str | None = None
    to_column: str | None = None

    @property
    def name(self) -> str:
        if self.test == "relationships":
            return f"relationships_{self.model}_{self.column}__{self.to_column}__{self.to_model}"
        return f"{self.test}_{self.model}_{self.column}"


def gold_tests() -> list[ModelTest]:
    """The eleven tests declared on the gold models."""
    return [
        ModelTest("unique", "stg_sales_transactions", "transaction_id"),
        ModelTest("not_null", "stg_sales_transactions", "transaction_id"),
        ModelTest("not_null", "stg_sales_transactions", "store_id"),
        ModelTest("not_null", "stg_sales_transactions", "total_amount"),
        ModelTest("not_null", "fct_daily_sales", "store_id"),
        ModelTest("relationships", "fct_daily_sales", "store_id", "dim_stores", "store_id"),
        ModelTest("not_null", "fct_daily_sales", "transaction_count"),
        ModelTest("unique", "dim_stores", "store_id"),
        ModelTest("not_null", "dim_stores", "store_id"),
        ModelTest("unique", "dim_products", "product_id"),
        ModelTest("not_null", "dim_products", "product_id"),
    ]


def _row(t: ModelTest, failures) -> F.Column:
    return F.struct(
        F.lit(t.name).alias("test_name"),
        F.lit(t.test).alias("test_type"),
        F.lit(t.model).alias("model"),
        F.lit(t.column).alias("column"),
        failures.cast("bigint").alias("failures"),
        (failures == 0).alias("passed"),
    )


def model_test_report(models: dict[str, DataFrame], tests: Sequence[ModelTest] | None = None) -> DataFrame:
    """One row per test: test_name, test_type, model, column, failures, passed."""
    tests = list(tests) if tests is not None else gold_tests()
    parts: list[DataFrame] = []
    by_model: dict[str, list[tuple[int, ModelTest]]] = {}
    for i, t in enumerate(tests):
        by_model.setdefault(t.model, []).append((i, t))
    order = {t.name: i for i, t in enumerate(tests)}
    for model, items in by_model.items():
        df = models[model]
        nn = [t for _, t in items if t.test == "not_null"]
        if nn:
            one = df.agg(*[F.count_if(F.col(t.column).isNull()).alias(f"_f{j}") for j, t in enumerate(nn)])
            parts.append(one.select(F.explode(F.array(*[_row(t, F.col(f"_f{j}")) for j, t in enumerate(nn)])).alias("r")).select("r.*"))
        for _, t in items:
            if t.test == "unique":
                fails = unique_failures(df, t.column).agg(F.count(F.lit(1)).alias("_f"))
            elif t.test == "relationships":
                fails = relationships_failure_count(df, t.column, models[t.to_model], t.to_column)
            else:
                continue
            parts.append(fails.select(_row(t, F.col("_f")).alias("r")).select("r.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    rank = F.create_map(*[x for name, i in order.items() for x in (F.lit(name), F.lit(i))])
    return out.withColumn("test_id", (rank[F.col("test_name")] + 1).cast("int")).select(
        "test_id", "test_name", "test_type", "model", "column", "failures", "passed")
