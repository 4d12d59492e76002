"""Profile reports and checks over Bronze / Silver, as DataFrames.

Every report is a single aggregate (partial + final, one scan) instead
of a series of driver-side ``count()`` calls.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope import schema as S
from tillscope.functions.money import avg_to_cents, pct_of_total, round_to_cents, total_of, unsummed
from tillscope.functions.rules import expected_total, total_mismatch
from tillscope.session import ensure_checkpoint_dir


def profile_nulls(df: DataFrame, columns: Sequence[str] = ("transaction_id", "store_id", "total_amount")) -> DataFrame:
    """One row: number of NULLs per listed column (0 on an empty frame)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Value frequency with its share of all rows (2 decimals), most frequent first.

    NULL is its own group.  The grand total is a scalar subquery over the
    aggregated counts (its exchange is reused), so the groups are never
    funnelled into one partition and no join is needed.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.select(
        column,
        F.col("count").cast("bigint").alias("count"),
        pct_of_total(F.col("count"), total).alias("percentage"),
    ).orderBy(F.col("count").desc(), F.col(column).asc_nulls_first())


def top_stores_by_revenue(bronze: DataFrame, k: int = 10) -> DataFrame:
    """Top-k stores over VALID rows: transactions, revenue, mean basket (2 decimals).

    Sums are exact; a store with an amount that is no money (NaN, infinite)
    shows the floating-point sum, which is then NaN or infinite too.
    """
    agg = bronze.filter(F.col("audit_flag") == S.FLAG_VALID).groupBy("store_id").agg(
        F.count(F.lit(1)).alias("transactions"),
        total_of("total_amount").alias("_sum"),
        unsummed("total_amount").alias("_unsummed"),
        F.sum(F.col("total_amount").cast("double")).alias("_double"),
        F.count("total_amount").alias("_n"),
    )
    return agg.select(
        "store_id",
        F.col("transactions").cast("bigint").alias("transactions"),
        F.when(F.col("_unsummed") > 0, F.col("_double")).otherwise(round_to_cents(F.col("_sum"))).alias("revenue_eur"),
        F.when(F.col("_unsummed") > 0, F.col("_double") / F.col("_n")).otherwise(
            avg_to_cents(F.col("_sum"), F.col("_n"))).alias("avg_basket_eur"),
    ).orderBy(F.col("revenue_eur").desc_nulls_last(), F.col("store_id").asc_nulls_first()).limit(k)


def check_duplicates(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """rows - distinct keys, NULL counting as one distinct value (one row)."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        (F.count_distinct(key) + F.max(F.col(key).isNull().cast("int"))).alias("distinct_ids"),
    ).select(
        F.col("total_rows").cast("bigint").alias("total_rows"),
        F.coalesce(F.col("distinct_ids"), F.lit(0)).cast("bigint").alias("distinct_ids"),
        (F.col("total_rows") - F.coalesce(F.col("distinct_ids"), F.lit(0))).cast("bigint").alias("duplicates"),
    )


def check_total_mismatch(df: DataFrame) -> DataFrame:
    """Rows whose total is more than one cent off round(quantity * unit_price, 2)."""
    return df.agg(F.count_if(total_mismatch(expected=expected_total())).cast("bigint").alias("total_mismatches"))


def check_negative(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col("total_amount") < 0).cast("bigint").alias("negative_amounts"))


def sample(df: DataFrame, columns: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows by all listed columns (a deterministic sample)."""
    return df.select(*columns).orderBy(*[F.col(c).asc_nulls_first() for c in columns]).limit(n)


BRONZE_SAMPLE_COLUMNS = ["transaction_id", "store_id", "product_id", "quantity", "unit_price",
                         "total_amount", "payment_method", "audit_flag"]
SILVER_SAMPLE_COLUMNS = ["transaction_id", "store_id", "total_amount", "audit_flag", "data_layer"]


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def bronze_profile_report(bronze: DataFrame) -> dict[str, DataFrame]:
    """The Bronze verification report as DataFrames (empty dict for an empty table)."""
    if bronze.isEmpty():
        return {}
    return {
        "row_count": row_count(bronze),
        "null_check": profile_nulls(bronze),
        "audit_flag_distribution": distribution(bronze, "audit_flag"),
        "payment_method_distribution": distribution(bronze, "payment_method"),
        "top_stores_by_revenue": top_stores_by_revenue(bronze),
        "sample": sample(bronze, BRONZE_SAMPLE_COLUMNS),
    }


def silver_check_report(silver: DataFrame) -> dict[str, DataFrame]:
    """The Silver verification report as DataFrames (empty dict for an empty table)."""
    if silver.isEmpty():
        return {}
    return {
        "row_count": row_count(silver),
        "duplicates": check_duplicates(silver),
        "total_mismatches": check_total_mismatch(silver),
        "negative_amounts": check_negative(silver),
        "audit_flag_distribution": distribution(silver, "audit_flag"),
        "sample": sample(silver, SILVER_SAMPLE_COLUMNS),
    }


# ---------------------------------------------------------------- whole reports in one pass
REPORT_SCHEMA = "section string, item string, n bigint, percentage double, revenue_eur double, avg_basket_eur double"
#: numbers of the groups that a report's rows are dealt to
_ALL, _FLAG, _METHOD, _STORE = range(4)


def _grouped(rows: DataFrame, groups: dict[int, Column], *aggregates: Column) -> DataFrame:
    """One aggregate over all ``groups`` (number -> item) at once: which, item, n, ...; written, since several sections read it.

    Each row is counted in every group by one scan; the partial aggregate
    leaves one row per group, item and task before the shuffle.
    """
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("which"), item.cast("string").alias("item")) for k, item in groups.items()]))
    dealt = rows.withColumn("_group", each)
    ensure_checkpoint_dir(rows.sparkSession)
    return dealt.groupBy("_group.which", "_group.item").agg(F.count(F.lit(1)).alias("n"), *aggregates).checkpoint()


def _counts(found: DataFrame, section: str, items: dict[str, str]) -> DataFrame:
    """Rows of a section from columns of the group of all rows: item -> column."""
    each = F.explode(F.array(*[F.struct(F.lit(item).alias("item"), F.col(c).cast("bigint").alias("n")) for item, c in items.items()]))
    return found.where(F.col("which") == _ALL).select(each.alias("_r")).select(F.lit(section).alias("section"), "_r.item", "_r.n")


def _shares(found: DataFrame, which: int, section: str) -> DataFrame:
    """A distribution: rows of each value and their share of all rows."""
    total = found.where(F.col("which") == _ALL).agg(F.max("n")).scalar()
    return found.where(F.col("which") == which).select(F.lit(section).alias("section"), "item", "n", pct_of_total(F.col("n"), total).alias("percentage"))


def _in_report_form(*sections: DataFrame) -> DataFrame:
    columns = [(c.split()[0], c.split()[1]) for c in REPORT_SCHEMA.split(", ")]
    whole = [s.select(*[(F.col(c) if c in s.columns else F.lit(None)).cast(t).alias(c) for c, t in columns]) for s in sections]
    out = whole[0]
    for more in whole[1:]:
        out = out.unionByName(more)
    return out


def bronze_report(bronze: DataFrame, k: int = 10) -> DataFrame:
    """The Bronze verification report, one scan: section, item, n, percentage, revenue_eur, avg_basket_eur.

    Sections: row_count, null_check, audit_flag, payment_method and the
    ``k`` stores of the highest revenue (top_stores, over VALID rows).  An
    empty table has the counts alone, all zero.
    """
    valid = F.col("audit_flag") == S.FLAG_VALID
    amount = F.when(valid, F.col("total_amount"))
    nulls = ("transaction_id", "store_id", "total_amount")
    found = _grouped(
        bronze, {_ALL: F.lit(None), _FLAG: F.col("audit_flag"), _METHOD: F.col("payment_method"), _STORE: F.col("store_id")},
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in nulls], F.count_if(valid).alias("n_valid"), total_of(amount).alias("total"),
        unsummed(amount).alias("unsummed"), F.sum(amount.cast("double")).alias("as_double"), F.count(amount).alias("n_amounts"))
    odd = F.col("unsummed") > 0
    top = found.where((F.col("which") == _STORE) & (F.col("n_valid") > 0)).select(
        F.lit("top_stores").alias("section"), "item", F.col("n_valid").alias("n"),
        F.when(odd, F.col("as_double")).otherwise(round_to_cents(F.col("total"))).alias("revenue_eur"),
        F.when(odd, F.col("as_double") / F.col("n_amounts")).otherwise(avg_to_cents(F.col("total"), F.col("n_amounts"))).alias("avg_basket_eur"),
    ).orderBy(F.col("revenue_eur").desc_nulls_last(), F.col("item").asc_nulls_first()).limit(k)
    whole = found if not found.isEmpty() else _nothing(found)
    return _in_report_form(
        _counts(whole, "row_count", {"total_rows": "n"}), _counts(whole, "null_check", {c: f"null_{c}" for c in nulls}),
        _shares(whole, _FLAG, "audit_flag"), _shares(whole, _METHOD, "payment_method"), top)


def silver_report(silver: DataFrame) -> DataFrame:
    """The Silver verification report, one scan: row_count, duplicates, total_mismatches, negative_amounts, audit_flag, as in ``bronze_report``."""
    key = F.col("transaction_id")
    found = _grouped(
        # the ids of the group of all rows alone: the other groups count a constant
        silver.withColumn("_flag", F.col("audit_flag")), {_ALL: F.lit(None), _FLAG: F.col("_flag")},
        F.count_distinct(F.when(F.col("_group.which") == _ALL, key)).alias("n_ids"), F.max(key.isNull().cast("int")).alias("null_id"),
        F.count_if(total_mismatch(expected=expected_total())).alias("mismatches"), F.count_if(F.col("total_amount") < 0).alias("negatives"))
    whole = (found if not found.isEmpty() else _nothing(found)).withColumn("duplicates", F.col("n") - F.col("n_ids") - F.col("null_id"))
    return _in_report_form(
        _counts(whole, "row_count", {"total_rows": "n"}), _counts(whole, "duplicates", {"duplicates": "duplicates"}),
        _counts(whole, "total_mismatches", {"total_mismatches": "mismatches"}), _counts(whole, "negative_amounts", {"negative_amounts": "negatives"}),
        _shares(whole, _FLAG, "audit_flag"))


def _nothing(found: DataFrame) -> DataFrame:
    """The group of all rows of an empty table: zeros."""
    return found.sparkSession.range(1).select(*[F.lit(0).cast(f.dataType).alias(f.name) for f in found.schema.fields])
