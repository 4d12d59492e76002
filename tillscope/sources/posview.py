"""Deterministic mapping of the TPC-H-style test tables onto POS Bronze rows.

``lineitem ⋈ orders ⋈ part`` becomes one Bronze-shaped frame (the layout
the stream ingest writes), with rule-triggering rows chosen by key
arithmetic so every rejection reason and audit class occurs at every
scale.  No row is generated or dropped: the view has exactly one row
per ``lineitem`` row.  The mapping is fixed in FIXTURES.md §3.

The view carries four source-key columns (``POS_TIEBREAK``) that give
the keep-latest dedup a total order; ``to_silver`` drops them.

``pos_view`` is ``pos_bronze`` over ``pos_rows``: the joined source rows
with their id and times, and the Bronze columns derived from them row by
row.  Keep-latest can move the narrow rows and derive Bronze from what it
keeps (``silver_flagged(pos_rows(...), derive=pos_bronze)``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope import schema as S
from tillscope.functions.rules import audit_flag

POS_TIEBREAK = ["src_partkey", "src_suppkey", "src_orderkey", "src_linenumber"]
# what the Bronze columns are derived from, besides id, times and source keys
SOURCE_VALUES = ["l_quantity", "l_returnflag", "o_orderpriority", "p_retailprice"]

# --- fixed values of the test-data mapping (FIXTURES.md §3) ---------------
NULL_ID_EVERY_ORDERKEY = 997      # transaction_id NULL when l_orderkey % 997 = 0
NULL_STORE_EVERY_PARTKEY = 89     # store_id NULL when l_partkey % 89 = 0
FOREIGN_STORE_EVERY_PARTKEY = 53  # 'DE-' store prefix when l_partkey % 53 = 0
STORE_COUNT = 50
CASHIER_BASE, CASHIER_COUNT = 1000, 9000
NEGATIVE_EVERY_ORDERKEY = 61      # total = -q*p
MISMATCH_EVERY_PARTKEY = 37       # total = q*p + 0.05
CENT_OFF_EVERY_PARTKEY = 41       # total = q*p + 0.01 (boundary, stays valid)
PRIORITY_TO_PAYMENT = [
    ("1-URGENT", "CARD"),
    ("2-HIGH", "CASH"),
    ("3-MEDIUM", "CONTACTLESS"),
    ("5-LOW", "VOUCHER"),
    ("4-NOT SPECIFIED", "GIFT"),
]
VOID_RETURNFLAG, VOID_EVERY_LINENUMBER = "R", 3
# --- end of fixed values ---------------------------------------------------


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pad_no_truncate(n: F.Column, width: int) -> F.Column:
    """Zero-pad to ``width`` digits without cutting longer numbers (``lpad`` alone
    would truncate, so product ids past 99,999 parts would collide)."""
    s = n.cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def _payment_method(priority: F.Column) -> F.Column:
    (p0, m0), *rest = PRIORITY_TO_PAYMENT
    chain = F.when(priority == p0, F.lit(m0))
    for p, m in rest:
        chain = chain.when(priority == p, F.lit(m))
    return chain


def pos_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined source rows, one per ``lineitem`` row: id, times, source keys, and what ``pos_bronze`` derives the rest from."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderpriority")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")

    # the price first: it is narrower to move on than an order's date and priority
    j = li.join(part, li.l_partkey == part.p_partkey).join(
        orders, li.l_orderkey == orders.o_orderkey)
    txn_id = F.when(F.col("l_orderkey") % NULL_ID_EVERY_ORDERKEY == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("T-"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    )
    return j.select(
        txn_id.alias("transaction_id"),
        F.col("o_orderdate").cast("timestamp").alias("transaction_ts"),
        F.col("l_shipdate").cast("timestamp").alias("ingested_at"),
        F.col("l_partkey").alias("src_partkey"),
        F.col("l_suppkey").alias("src_suppkey"),
        F.col("l_orderkey").alias("src_orderkey"),
        F.col("l_linenumber").alias("src_linenumber"),
        *SOURCE_VALUES,
    )


def pos_bronze(rows: DataFrame) -> DataFrame:
    """Bronze-shaped rows (``BRONZE_COLUMNS`` + ``POS_TIEBREAK``) of ``pos_rows``, row by row; columns added to them stay behind."""
    orderkey, partkey, suppkey, linenumber = (F.col(c) for c in ("src_orderkey", "src_partkey", "src_suppkey", "src_linenumber"))
    q = F.col("l_quantity").cast("int")
    price = F.col("p_retailprice").cast("decimal(18,2)")
    line_total = q * price
    total = (
        F.when(orderkey % NEGATIVE_EVERY_ORDERKEY == 0, -line_total)
        .when(partkey % MISMATCH_EVERY_PARTKEY == 0, line_total + F.lit(0.05).cast("decimal(3,2)"))
        .when(partkey % CENT_OFF_EVERY_PARTKEY == 0, line_total + F.lit(0.01).cast("decimal(3,2)"))
        .otherwise(line_total)
    )
    store_no = _pad_no_truncate(F.lit(1) + suppkey % STORE_COUNT, 3)
    store_id = F.when(partkey % NULL_STORE_EVERY_PARTKEY == 0, F.lit(None).cast("string")).otherwise(
        F.concat(
            F.when(partkey % FOREIGN_STORE_EVERY_PARTKEY == 0, F.lit("DE-")).otherwise(F.lit("NL-")),
            store_no,
        )
    )
    is_voided = (F.col("l_returnflag") == VOID_RETURNFLAG) & (linenumber % VOID_EVERY_LINENUMBER == 0)
    ts, shipped = F.col("transaction_ts"), F.col("ingested_at")
    own = {"transaction_id", "transaction_ts", "ingested_at", *POS_TIEBREAK, *SOURCE_VALUES}
    return rows.select(
        "transaction_id",
        store_id.alias("store_id"),
        F.concat(F.lit("POS-"), _pad_no_truncate(linenumber, 2)).alias("terminal_id"),
        F.concat(F.lit("EMP-"), (F.lit(CASHIER_BASE) + suppkey % CASHIER_COUNT).cast("string")).alias("cashier_id"),
        F.concat(F.lit("PROD-"), _pad_no_truncate(partkey, 5)).alias("product_id"),
        q.alias("quantity"),
        price.cast("double").alias("unit_price"),
        total.cast("double").alias("total_amount"),
        _payment_method(F.col("o_orderpriority")).alias("payment_method"),
        "transaction_ts",
        is_voided.alias("is_voided"),
        audit_flag(is_voided, total).alias("audit_flag"),
        shipped.alias("kafka_received_at"),
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        "ingested_at",
        F.lit(S.PIPELINE_NAME).alias("pipeline_name"),
        F.lit(S.SOURCE_SYSTEM).alias("source_system"),
        F.lit(S.LAYER_BRONZE).alias("data_layer"),
        *POS_TIEBREAK,
        *[c for c in rows.columns if c not in own],
    )


def pos_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped POS rows (``BRONZE_COLUMNS`` + ``POS_TIEBREAK``)."""
    return pos_bronze(pos_rows(spark, sf_dir))
