"""Schemas, enumerations and thresholds of the sales-audit data model.

Everything here is a plain value; the operators import it instead of
repeating literals.  Types follow the layer they describe:

* message / Bronze money is DOUBLE (JSON numbers decode losslessly into
  a double; a DECIMAL target would round surplus digits on decode),
* Silver money is DECIMAL(18, 4) so the one-cent rules are exact,
* staging and marts expose money as DOUBLE again, like the SQL models.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

MONEY = DecimalType(18, 4)

# --- fixed values (must equal the audited system's, do not edit) ---------
PAYMENT_METHODS = ["CARD", "CASH", "CONTACTLESS", "VOUCHER"]
AUDIT_FLAGS = ["VALID", "VOIDED", "EXCEPTION_HIGH_VALUE"]
FLAG_VALID = "VALID"
FLAG_VOIDED = "VOIDED"
FLAG_HIGH_VALUE = "EXCEPTION_HIGH_VALUE"
HIGH_VALUE_THRESHOLD = 5000          # strict: total > 5000
TOTAL_TOLERANCE = "0.01"             # abs(total - expected) > 0.01 rejects
STORE_ID_PATTERN = r"^NL-[0-9]{3}$"
REASON_NULL_TRANSACTION_ID = "NULL_TRANSACTION_ID"
REASON_NULL_STORE_ID = "NULL_STORE_ID"
REASON_NEGATIVE_AMOUNT = "NEGATIVE_AMOUNT"
REASON_TOTAL_MISMATCH = "TOTAL_MISMATCH"
REASON_INVALID_STORE_FORMAT = "INVALID_STORE_FORMAT"
QUANTITY_MIN, QUANTITY_MAX = 1, 100
UNIT_PRICE_MIN, UNIT_PRICE_MAX = "0.01", "9999.99"
TOTAL_AMOUNT_MIN, TOTAL_AMOUNT_MAX = 0, 100000
PIPELINE_NAME = "resa-kafka-bronze"
SOURCE_SYSTEM = "POS_KAFKA_STREAM"
LAYER_BRONZE = "BRONZE"
LAYER_SILVER = "SILVER"
STORE_COUNTRY = "Netherlands"
# --- end of fixed values ---------------------------------------------------

# Decoded message value.  The stream schema declares some fields
# non-null, but from_json returns every field nullable, so they are all
# declared nullable here.
MESSAGE_SCHEMA = StructType(
    [
        StructField("transaction_id", StringType()),
        StructField("store_id", StringType()),
        StructField("terminal_id", StringType()),
        StructField("cashier_id", StringType()),
        StructField("product_id", StringType()),
        StructField("quantity", IntegerType()),
        StructField("unit_price", DoubleType()),
        StructField("total_amount", DoubleType()),
        StructField("payment_method", StringType()),
        StructField("transaction_ts", StringType()),
        StructField("is_voided", BooleanType()),
        StructField("audit_flag", StringType()),
    ]
)
MESSAGE_FIELDS = [f.name for f in MESSAGE_SCHEMA.fields]

# Raw keyed-message frame (what a broker source exposes).
RAW_MESSAGE_SCHEMA = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("timestamp", TimestampType()),
    ]
)

BRONZE_SCHEMA = StructType(
    [
        StructField("transaction_id", StringType()),
        StructField("store_id", StringType()),
        StructField("terminal_id", StringType()),
        StructField("cashier_id", StringType()),
        StructField("product_id", StringType()),
        StructField("quantity", IntegerType()),
        StructField("unit_price", DoubleType()),
        StructField("total_amount", DoubleType()),
        StructField("payment_method", StringType()),
        StructField("transaction_ts", TimestampType()),
        StructField("is_voided", BooleanType()),
        StructField("audit_flag", StringType()),
        StructField("kafka_received_at", TimestampType()),
        StructField("year", IntegerType()),
        StructField("month", IntegerType()),
        StructField("day", IntegerType()),
        StructField("ingested_at", TimestampType()),
        StructField("pipeline_name", StringType()),
        StructField("source_system", StringType()),
        StructField("data_layer", StringType()),
    ]
)
BRONZE_COLUMNS = [f.name for f in BRONZE_SCHEMA.fields]
# where a message stood in its topic, kept in Bronze if the source tells it: the later offset is the later arrival
POSITION_SCHEMA = StructType([StructField("kafka_offset", LongType()), StructField("kafka_partition", IntegerType())])
POSITION_COLUMNS = [f.name for f in POSITION_SCHEMA.fields]
# the audited stream sink's layout: event date, then store
BRONZE_PARTITION_COLUMNS = ["year", "month", "day", "store_id"]
# date-only layout (stores clustered inside files): far fewer folders when
# a batch spans many days with few rows per store and day
BRONZE_DATE_PARTITION_COLUMNS = ["year", "month", "day"]

SILVER_SCHEMA = StructType(
    [StructField(f.name, MONEY if f.name in ("unit_price", "total_amount") else f.dataType) for f in BRONZE_SCHEMA.fields]
    + [StructField("silver_processed_at", TimestampType())]
)
SILVER_COLUMNS = [f.name for f in SILVER_SCHEMA.fields]
SILVER_PARTITION_COLUMNS = ["year", "month", "day"]

REJECT_COLUMNS = [
    "transaction_id",
    "store_id",
    "product_id",
    "quantity",
    "unit_price",
    "total_amount",
    "expected_total",
    "rejection_reason",
    "silver_processed_at",
]

REJECTS_SCHEMA = StructType(
    [StructField(c, MONEY if c == "expected_total" else StringType() if c == "rejection_reason" else SILVER_SCHEMA[c].dataType)
     for c in REJECT_COLUMNS]
)
