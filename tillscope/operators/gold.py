"""Gold layer: staging model, daily sales fact, store and product dimensions.

Each model is a DataFrame function over its parent.  Money sums
are exact decimals (see ``functions.money``); all marts group with a
partial (map-side) aggregate before the shuffle, so a store or product
that carries a third of all rows still ships one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope import schema as S
from tillscope.functions.money import as_money, avg_to_cents, total_of


def stg_sales(silver: DataFrame) -> DataFrame:
    """Typed projection of Silver (money as DOUBLE), rows with an id only."""
    return silver.filter(F.col("transaction_id").isNotNull()).select(
        "transaction_id",
        "store_id",
        "terminal_id",
        "cashier_id",
        "product_id",
        F.col("quantity").cast("int").alias("quantity"),
        F.col("unit_price").cast("double").alias("unit_price"),
        F.col("total_amount").cast("double").alias("total_amount"),
        "payment_method",
        F.col("transaction_ts").cast("timestamp").alias("transaction_ts"),
        "is_voided",
        "audit_flag",
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        F.col("day").cast("int").alias("day"),
    )


def fct_daily_sales(stg: DataFrame) -> DataFrame:
    """Grain store x day: counts, VALID revenue, voids, rounded mean ticket."""
    amount = as_money("total_amount")
    agg = stg.groupBy("store_id", "year", "month", "day").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        total_of(F.when(F.col("audit_flag") == S.FLAG_VALID, amount).otherwise(F.lit(0))).alias("_valid"),
        F.sum(F.when(F.col("audit_flag") == S.FLAG_VOIDED, F.lit(1)).otherwise(F.lit(0))).alias("_voided"),
        total_of(amount).alias("_sum"),
        F.count("total_amount").alias("_n_amounts"),
    )
    return agg.select(
        "store_id",
        "year",
        "month",
        "day",
        F.col("transaction_count").cast("bigint").alias("transaction_count"),
        F.col("_valid").cast("double").alias("valid_revenue"),
        F.col("_voided").cast("bigint").alias("voided_count"),
        avg_to_cents(F.col("_sum"), F.col("_n_amounts")).alias("avg_transaction_value"),
    )


def dim_stores(stg: DataFrame) -> DataFrame:
    """Distinct stores with country and the 3-character store number."""
    return stg.select(
        "store_id",
        F.lit(S.STORE_COUNTRY).alias("country"),
        F.substring("store_id", 4, 3).alias("store_number"),
    ).distinct()


def dim_products(stg: DataFrame) -> DataFrame:
    """Per product: times sold, rounded mean price, max and min price."""
    agg = stg.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("times_sold"),
        total_of(as_money("unit_price")).alias("_sum"),
        F.count("unit_price").alias("_n"),
        F.max("unit_price").alias("max_price"),
        F.min("unit_price").alias("min_price"),
    )
    return agg.select(
        "product_id",
        F.col("times_sold").cast("bigint").alias("times_sold"),
        avg_to_cents(F.col("_sum"), F.col("_n")).alias("avg_price"),
        F.col("max_price").cast("double").alias("max_price"),
        F.col("min_price").cast("double").alias("min_price"),
    )
