"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Every statement is built from the same CTE chain: ``pos`` (the POS view
over lineitem ⋈ orders ⋈ part), ``dedup``, ``flagged``, ``silver``,
``stg``.  Money is compared exactly: aggregates run over BIGINT units of
0.0001 and round half away from zero in integers (the test tables' sums
fit them; the Spark side sums wide decimals).
"""

from __future__ import annotations

# --- fixed values shared with the Spark side (see tillscope.schema / posview) ---
_LINEAGE = "'resa-kafka-bronze' AS pipeline_name, 'POS_KAFKA_STREAM' AS source_system, 'BRONZE' AS data_layer"

_POS = """
pos0 AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_returnflag, l.l_shipdate,
         o.o_orderdate, o.o_orderpriority,
         CAST(l.l_quantity AS INTEGER) AS q,
         CAST(p.p_retailprice AS DECIMAL(18,2)) AS price
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
pos1 AS (
  SELECT *,
    CASE WHEN l_orderkey % 61 = 0 THEN -(q * price)
         WHEN l_partkey % 37 = 0 THEN q * price + 0.05
         WHEN l_partkey % 41 = 0 THEN q * price + 0.01
         ELSE q * price END AS total_dec,
    (l_returnflag = 'R' AND l_linenumber % 3 = 0) AS voided
  FROM pos0
),
pos AS (
  SELECT
    CASE WHEN l_orderkey % 997 = 0 THEN NULL
         ELSE 'T-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS transaction_id,
    CASE WHEN l_partkey % 89 = 0 THEN NULL
         ELSE (CASE WHEN l_partkey % 53 = 0 THEN 'DE-' ELSE 'NL-' END)
              || lpad(CAST(1 + l_suppkey % 50 AS VARCHAR), 3, '0') END AS store_id,
    'POS-' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS terminal_id,
    'EMP-' || CAST(1000 + l_suppkey % 9000 AS VARCHAR) AS cashier_id,
    printf('PROD-%05d', l_partkey) AS product_id,
    q AS quantity,
    CAST(price AS DOUBLE) AS unit_price,
    CAST(total_dec AS DOUBLE) AS total_amount,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'CARD' WHEN '2-HIGH' THEN 'CASH'
         WHEN '3-MEDIUM' THEN 'CONTACTLESS' WHEN '5-LOW' THEN 'VOUCHER'
         WHEN '4-NOT SPECIFIED' THEN 'GIFT' END AS payment_method,
    o_orderdate AS transaction_ts,
    voided AS is_voided,
    CASE WHEN voided THEN 'VOIDED' WHEN total_dec > 5000 THEN 'EXCEPTION_HIGH_VALUE' ELSE 'VALID' END AS audit_flag,
    l_shipdate AS kafka_received_at,
    CAST(year(o_orderdate) AS INTEGER) AS year,
    CAST(month(o_orderdate) AS INTEGER) AS month,
    CAST(day(o_orderdate) AS INTEGER) AS day,
    l_shipdate AS ingested_at,
    """ + _LINEAGE + """,
    l_partkey AS src_partkey, l_suppkey AS src_suppkey, l_orderkey AS src_orderkey, l_linenumber AS src_linenumber
  FROM pos1
)"""

_BRONZE_COLS = ("transaction_id, store_id, terminal_id, cashier_id, product_id, quantity, unit_price, "
                "total_amount, payment_method, transaction_ts, is_voided, audit_flag, kafka_received_at, "
                "year, month, day, ingested_at, pipeline_name, source_system, data_layer")
_BRONZE_NO_INGEST = _BRONZE_COLS.replace(" ingested_at,", "")

_SILVER = """
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id
        ORDER BY ingested_at DESC NULLS LAST, src_partkey ASC NULLS LAST, src_suppkey ASC NULLS LAST,
                 src_orderkey ASC NULLS LAST, src_linenumber ASC NULLS LAST) AS rn
    FROM pos) t
  WHERE rn = 1
),
clean AS (
  SELECT * REPLACE (CAST(unit_price AS DECIMAL(18,4)) AS unit_price,
                    CAST(total_amount AS DECIMAL(18,4)) AS total_amount,
                    'SILVER' AS data_layer)
  FROM dedup
),
clean2 AS (SELECT *, round(quantity * unit_price, 2) AS expected_total FROM clean),
flagged AS (
  SELECT * REPLACE (CASE WHEN is_voided THEN 'VOIDED' WHEN total_amount > 5000 THEN 'EXCEPTION_HIGH_VALUE'
                         ELSE 'VALID' END AS audit_flag),
    CASE WHEN transaction_id IS NULL THEN 'NULL_TRANSACTION_ID'
         WHEN store_id IS NULL THEN 'NULL_STORE_ID'
         WHEN total_amount < 0 THEN 'NEGATIVE_AMOUNT'
         WHEN abs(total_amount - expected_total) > 0.01 THEN 'TOTAL_MISMATCH'
         WHEN NOT regexp_matches(store_id, '^NL-[0-9]{3}$') THEN 'INVALID_STORE_FORMAT'
         ELSE NULL END AS rejection_reason
  FROM clean2
),
flagged2 AS (SELECT *, rejection_reason IS NULL AS is_valid FROM flagged),
silver AS (
  SELECT transaction_id, store_id, terminal_id, cashier_id, product_id, quantity, unit_price, total_amount,
         payment_method, transaction_ts, is_voided, audit_flag, kafka_received_at, year, month, day,
         ingested_at, pipeline_name, source_system, data_layer
  FROM flagged2 WHERE is_valid
),
stg AS (
  SELECT transaction_id, store_id, terminal_id, cashier_id, product_id, CAST(quantity AS INTEGER) AS quantity,
         CAST(unit_price AS DOUBLE) AS unit_price, CAST(total_amount AS DOUBLE) AS total_amount,
         payment_method, transaction_ts, is_voided, audit_flag, year, month, day
  FROM silver WHERE transaction_id IS NOT NULL
)"""

_SILVER_OUT = ("transaction_id, store_id, terminal_id, cashier_id, product_id, quantity, "
               "CAST(unit_price AS DOUBLE) AS unit_price, CAST(total_amount AS DOUBLE) AS total_amount, "
               "payment_method, transaction_ts, is_voided, audit_flag, kafka_received_at, year, month, day, "
               "ingested_at, pipeline_name, source_system, data_layer")

_MARTS = """
fct AS (
  SELECT store_id, year, month, day,
         count(*) AS transaction_count,
         sum(CASE WHEN audit_flag = 'VALID' THEN {u_total} ELSE 0 END) AS valid_units,
         sum(CASE WHEN audit_flag = 'VOIDED' THEN 1 ELSE 0 END) AS voided,
         sum({u_total}) AS s_units, count(total_amount) AS n_amounts
  FROM stg GROUP BY store_id, year, month, day
),
fct_daily_sales AS (
  SELECT store_id, year, month, day, CAST(transaction_count AS BIGINT) AS transaction_count,
         CAST(valid_units AS DOUBLE) / 10000 AS valid_revenue,
         CAST(voided AS BIGINT) AS voided_count,
         {avg_total} AS avg_transaction_value
  FROM fct
),
dim_stores AS (
  SELECT DISTINCT store_id, 'Netherlands' AS country, substring(store_id, 4, 3) AS store_number FROM stg
),
dp AS (
  SELECT product_id, count(*) AS times_sold, sum({u_price}) AS s_units, count(unit_price) AS n,
         max(unit_price) AS max_price, min(unit_price) AS min_price
  FROM stg GROUP BY product_id
),
dim_products AS (
  SELECT product_id, CAST(times_sold AS BIGINT) AS times_sold, {avg_price} AS avg_price,
         CAST(max_price AS DOUBLE) AS max_price, CAST(min_price AS DOUBLE) AS min_price
  FROM dp
)"""


def _units(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18,4)) * 10000 AS BIGINT)"


def _avg_cents(s: str, n: str) -> str:
    return (f"CASE WHEN {n} > 0 THEN CAST((CASE WHEN {s} < 0 THEN -1 ELSE 1 END) * "
            f"((2 * abs({s}) + 100 * {n}) // (200 * {n})) AS DOUBLE) / 100 END")


def _round_cents(s: str) -> str:
    return f"CAST((CASE WHEN {s} < 0 THEN -1 ELSE 1 END) * ((abs({s}) + 50) // 100) AS DOUBLE) / 100"


def _pct(c: str, t: str) -> str:
    return f"CAST((20000 * {c} + {t}) // (2 * {t}) AS DOUBLE) / 100"


_MARTS_SQL = _MARTS.format(
    u_total=_units("total_amount"),
    u_price=_units("unit_price"),
    avg_total=_avg_cents("s_units", "n_amounts"),
    avg_price=_avg_cents("s_units", "n"),
)


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


BASE = _with(_POS)
SILVER = _with(_POS, _SILVER)
GOLD = _with(_POS, _SILVER, _MARTS_SQL)

_ISO = "strftime(transaction_ts, '%Y-%m-%dT%H:%M:%S.%f')"

_MESSAGES = f"""
msgs AS (
  SELECT store_id AS message_key, transaction_id, store_id, terminal_id, cashier_id, product_id, quantity,
         unit_price, total_amount, payment_method, {_ISO} AS transaction_ts, is_voided, audit_flag,
         kafka_received_at
  FROM pos
  UNION ALL
  SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, ts FROM events
),
enriched AS (
  SELECT transaction_id, store_id, terminal_id, cashier_id, product_id, quantity, unit_price, total_amount,
         payment_method, CAST(transaction_ts AS TIMESTAMP) AS transaction_ts, is_voided, audit_flag,
         kafka_received_at,
         CAST(year(CAST(transaction_ts AS TIMESTAMP)) AS INTEGER) AS year,
         CAST(month(CAST(transaction_ts AS TIMESTAMP)) AS INTEGER) AS month,
         CAST(day(CAST(transaction_ts AS TIMESTAMP)) AS INTEGER) AS day,
         """ + _LINEAGE + """
  FROM msgs
)"""
MSG = _with(_POS, _MESSAGES)

_DECODED = ("transaction_id, store_id, terminal_id, cashier_id, product_id, quantity, unit_price, total_amount, "
            "payment_method, transaction_ts, is_voided, audit_flag, kafka_received_at")

_ADMITTED = (f"SELECT {_BRONZE_NO_INGEST} FROM enriched "
             "WHERE transaction_id IS NOT NULL AND store_id IS NOT NULL AND total_amount IS NOT NULL")


def _dist(source: str, col: str) -> str:
    return (f"{source}, d AS (SELECT {col}, count(*) AS cnt FROM src GROUP BY {col}), "
            f"t AS (SELECT {col}, cnt, sum(cnt) OVER () AS total FROM d) "
            f"SELECT {col}, CAST(cnt AS BIGINT) AS count, {_pct('cnt', 'total')} AS percentage FROM t")


def _suite_rows(which: set[str] | None, with_id: bool) -> str:
    rules = [
        (1, "expect_column_values_to_not_be_null", "transaction_id",
         "count_if(transaction_id IS NULL)", "count_if(transaction_id IS NULL)"),
        (2, "expect_column_values_to_not_be_null", "store_id",
         "count_if(store_id IS NULL)", "count_if(store_id IS NULL)"),
        (3, "expect_column_values_to_be_between", "total_amount", "count_if(total_amount IS NULL)",
         "count_if(total_amount IS NOT NULL AND (total_amount < 0 OR total_amount > 100000))"),
        (4, "expect_column_values_to_be_between", "quantity", "count_if(quantity IS NULL)",
         "count_if(quantity IS NOT NULL AND (quantity < 1 OR quantity > 100))"),
        (5, "expect_column_values_to_be_in_set", "audit_flag", "count_if(audit_flag IS NULL)",
         "count_if(audit_flag IS NOT NULL AND audit_flag NOT IN ('VALID', 'VOIDED', 'EXCEPTION_HIGH_VALUE'))"),
        (6, "expect_column_values_to_be_in_set", "payment_method", "count_if(payment_method IS NULL)",
         "count_if(payment_method IS NOT NULL AND payment_method NOT IN ('CARD', 'CASH', 'CONTACTLESS', 'VOUCHER'))"),
        (7, "expect_column_values_to_match_regex", "store_id", "count_if(store_id IS NULL)",
         "count_if(store_id IS NOT NULL AND NOT regexp_matches(store_id, '^NL-[0-9]{3}$'))"),
    ]
    parts = []
    for rid, rtype, col, missing, unexpected in rules:
        if which is not None and rtype not in which:
            continue
        idc = f"{rid} AS rule_id, " if with_id else ""
        parts.append(
            f"SELECT {idc}'{rtype}' AS rule_type, '{col}' AS \"column\", ({unexpected}) = 0 AS success, "
            f"count(*) AS element_count, CAST({missing} AS BIGINT) AS missing_count, "
            f"CAST({unexpected} AS BIGINT) AS unexpected_count FROM silver")
    if which is None or "expect_table_row_count_to_be_between" in which:
        idc = "8 AS rule_id, " if with_id else ""
        parts.append(
            f"SELECT {idc}'expect_table_row_count_to_be_between' AS rule_type, '(table)' AS \"column\", "
            f"count(*) >= 1 AS success, count(*) AS element_count, CAST(0 AS BIGINT) AS missing_count, "
            f"CAST(0 AS BIGINT) AS unexpected_count FROM silver")
    return SILVER + " UNION ALL ".join(parts)


_TESTS = [
    # (test_id, name, type, model, column, failures-SQL)
    (1, "unique_stg_sales_transactions_transaction_id", "unique", "stg_sales_transactions", "transaction_id",
     "SELECT count(*) FROM (SELECT transaction_id FROM stg WHERE transaction_id IS NOT NULL "
     "GROUP BY transaction_id HAVING count(*) > 1)"),
    (2, "not_null_stg_sales_transactions_transaction_id", "not_null", "stg_sales_transactions", "transaction_id",
     "SELECT count_if(transaction_id IS NULL) FROM stg"),
    (3, "not_null_stg_sales_transactions_store_id", "not_null", "stg_sales_transactions", "store_id",
     "SELECT count_if(store_id IS NULL) FROM stg"),
    (4, "not_null_stg_sales_transactions_total_amount", "not_null", "stg_sales_transactions", "total_amount",
     "SELECT count_if(total_amount IS NULL) FROM stg"),
    (5, "not_null_fct_daily_sales_store_id", "not_null", "fct_daily_sales", "store_id",
     "SELECT count_if(store_id IS NULL) FROM fct_daily_sales"),
    (6, "relationships_fct_daily_sales_store_id__store_id__dim_stores", "relationships", "fct_daily_sales",
     "store_id",
     "SELECT count(*) FROM fct_daily_sales f WHERE f.store_id IS NOT NULL AND NOT EXISTS "
     "(SELECT 1 FROM dim_stores s WHERE s.store_id = f.store_id)"),
    (7, "not_null_fct_daily_sales_transaction_count", "not_null", "fct_daily_sales", "transaction_count",
     "SELECT count_if(transaction_count IS NULL) FROM fct_daily_sales"),
    (8, "unique_dim_stores_store_id", "unique", "dim_stores", "store_id",
     "SELECT count(*) FROM (SELECT store_id FROM dim_stores WHERE store_id IS NOT NULL "
     "GROUP BY store_id HAVING count(*) > 1)"),
    (9, "not_null_dim_stores_store_id", "not_null", "dim_stores", "store_id",
     "SELECT count_if(store_id IS NULL) FROM dim_stores"),
    (10, "unique_dim_products_product_id", "unique", "dim_products", "product_id",
     "SELECT count(*) FROM (SELECT product_id FROM dim_products WHERE product_id IS NOT NULL "
     "GROUP BY product_id HAVING count(*) > 1)"),
    (11, "not_null_dim_products_product_id", "not_null", "dim_products", "product_id",
     "SELECT count_if(product_id IS NULL) FROM dim_products"),
]


def _tests_sql(test_type: str | None) -> str:
    parts = []
    for tid, name, ttype, model, col, fails in _TESTS:
        if test_type is not None and ttype != test_type:
            continue
        idc = f"{tid} AS test_id, " if test_type is None else ""
        parts.append(f"SELECT {idc}'{name}' AS test_name, '{ttype}' AS test_type, '{model}' AS model, "
                     f"'{col}' AS \"column\", CAST(({fails}) AS BIGINT) AS failures, "
                     f"({fails}) = 0 AS passed")
    return GOLD + " UNION ALL ".join(parts)


_CONTRACT_CHECKS = [
    ("transaction_id:missing", "transaction_id IS NULL"),
    ("store_id:missing", "store_id IS NULL"),
    ("terminal_id:missing", "terminal_id IS NULL"),
    ("cashier_id:missing", "cashier_id IS NULL"),
    ("product_id:missing", "product_id IS NULL"),
    ("quantity:missing", "quantity IS NULL"),
    ("unit_price:missing", "unit_price IS NULL"),
    ("total_amount:missing", "total_amount IS NULL"),
    ("payment_method:missing", "payment_method IS NULL"),
    ("transaction_ts:missing", "transaction_ts IS NULL"),
    ("quantity:range", "quantity IS NOT NULL AND NOT (quantity BETWEEN 1 AND 100)"),
    ("unit_price:range", "unit_price IS NOT NULL AND NOT (CAST(unit_price AS DECIMAL(18,4)) BETWEEN 0.01 AND 9999.99)"),
    ("payment_method:not_in_set",
     "payment_method IS NOT NULL AND payment_method NOT IN ('CARD', 'CASH', 'CONTACTLESS', 'VOUCHER')"),
    ("audit_flag:not_in_set", "coalesce(audit_flag, 'VALID') NOT IN ('VALID', 'VOIDED', 'EXCEPTION_HIGH_VALUE')"),
    ("total_amount:mismatch",
     "coalesce(quantity BETWEEN 1 AND 100, false) AND coalesce(CAST(unit_price AS DECIMAL(18,4)) BETWEEN 0.01 AND 9999.99, false) "
     "AND abs(CAST(total_amount AS DECIMAL(18,4)) - round(quantity * CAST(unit_price AS DECIMAL(18,4)), 2)) > 0.01"),
]


def _contract_sql() -> str:
    labels = ", ".join(f"CASE WHEN {cond} THEN '{label}' END" for label, cond in _CONTRACT_CHECKS)
    count = " + ".join(f"(CASE WHEN {cond} THEN 1 ELSE 0 END)" for _, cond in _CONTRACT_CHECKS)
    return (MSG + f"SELECT transaction_id, CAST({count} AS INTEGER) AS n_violations, "
            f"concat_ws(',', {labels}) AS violations FROM msgs")


_SNAP_EARLY = "coalesce(year <= 1995, true)"


def oracle_sql() -> dict[str, str]:
    silver_cols = _SILVER_OUT
    q: dict[str, str] = {}
    # messages / bronze
    q["encode_messages"] = BASE + (
        f"SELECT store_id AS message_key, transaction_id, store_id, terminal_id, cashier_id, product_id, quantity, "
        f"unit_price, total_amount, payment_method, {_ISO} AS transaction_ts, is_voided, audit_flag, "
        f"kafka_received_at FROM pos")
    q["bronze_decode"] = MSG + f"SELECT {_DECODED} FROM msgs"
    q["bronze_enrich"] = MSG + f"SELECT {_BRONZE_NO_INGEST} FROM enriched"
    q["bronze_admit"] = MSG + _ADMITTED
    q["bronze_stream_roundtrip"] = MSG + _ADMITTED
    q["bronze_partition_scan"] = BASE + f"SELECT {_BRONZE_COLS} FROM pos"
    # silver
    q["silver_dedup_latest"] = SILVER + f"SELECT {_BRONZE_COLS} FROM dedup"
    q["silver_clean"] = SILVER + (
        "SELECT transaction_id, store_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price, "
        "CAST(total_amount AS DOUBLE) AS total_amount, CAST(expected_total AS DOUBLE) AS expected_total, "
        "transaction_ts, data_layer FROM flagged2")
    q["silver_rejection_reason"] = SILVER + (
        "SELECT transaction_id, store_id, CAST(total_amount AS DOUBLE) AS total_amount, "
        "CAST(expected_total AS DOUBLE) AS expected_total, rejection_reason, is_valid FROM flagged2")
    q["silver_audit_flag"] = SILVER + (
        "SELECT transaction_id, is_voided, CAST(total_amount AS DOUBLE) AS total_amount, audit_flag FROM flagged2")
    q["silver_valid"] = SILVER + f"SELECT {silver_cols} FROM silver"
    q["silver_rejects"] = SILVER + (
        "SELECT transaction_id, store_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price, "
        "CAST(total_amount AS DOUBLE) AS total_amount, CAST(expected_total AS DOUBLE) AS expected_total, "
        "rejection_reason FROM flagged2 WHERE NOT is_valid")
    q["silver_run_summary"] = SILVER + (
        "SELECT (SELECT count(*) FROM pos) AS bronze_read, "
        "(SELECT count(*) FROM pos) - (SELECT count(*) FROM flagged2) AS duplicates_removed, "
        "(SELECT count_if(is_valid) FROM flagged2) AS valid, "
        "(SELECT count_if(NOT is_valid) FROM flagged2) AS rejected")
    # profiles
    q["profile_nulls"] = BASE + (
        "SELECT count_if(transaction_id IS NULL) AS transaction_id, count_if(store_id IS NULL) AS store_id, "
        "count_if(total_amount IS NULL) AS total_amount FROM pos")
    q["dist_audit_flag"] = _dist(BASE + ", src AS (SELECT * FROM pos)", "audit_flag")
    q["dist_payment_method"] = _dist(BASE + ", src AS (SELECT * FROM pos)", "payment_method")
    q["dist_silver_audit_flag"] = _dist(SILVER + ", src AS (SELECT * FROM silver)", "audit_flag")
    q["top_stores_revenue"] = BASE + (
        f", s AS (SELECT store_id, count(*) AS transactions, sum({_units('total_amount')}) AS u, "
        f"count(total_amount) AS n FROM pos WHERE audit_flag = 'VALID' GROUP BY store_id), "
        f"r AS (SELECT store_id, CAST(transactions AS BIGINT) AS transactions, {_round_cents('u')} AS revenue_eur, "
        f"{_avg_cents('u', 'n')} AS avg_basket_eur FROM s) "
        f"SELECT * FROM r ORDER BY revenue_eur DESC NULLS LAST, store_id ASC NULLS FIRST LIMIT 10")
    q["check_duplicates"] = SILVER + (
        "SELECT count(*) AS total_rows, "
        "CAST(count(DISTINCT transaction_id) + coalesce(max(CASE WHEN transaction_id IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS distinct_ids, "
        "CAST(count(*) - count(DISTINCT transaction_id) - coalesce(max(CASE WHEN transaction_id IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS duplicates "
        "FROM silver")
    q["check_total_mismatch"] = SILVER + (
        "SELECT count_if(abs(total_amount - round(quantity * unit_price, 2)) > 0.01) AS total_mismatches FROM silver")
    q["check_negative"] = SILVER + "SELECT count_if(total_amount < 0) AS negative_amounts FROM silver"
    q["sample_bronze"] = BASE + (
        "SELECT transaction_id, store_id, product_id, quantity, unit_price, total_amount, payment_method, audit_flag "
        "FROM pos ORDER BY transaction_id ASC NULLS FIRST, store_id ASC NULLS FIRST, product_id ASC NULLS FIRST, "
        "quantity ASC NULLS FIRST, unit_price ASC NULLS FIRST, total_amount ASC NULLS FIRST, "
        "payment_method ASC NULLS FIRST, audit_flag ASC NULLS FIRST LIMIT 5")
    q["sample_silver"] = SILVER + (
        "SELECT transaction_id, store_id, CAST(total_amount AS DOUBLE) AS total_amount, audit_flag, data_layer "
        "FROM silver ORDER BY transaction_id ASC NULLS FIRST, store_id ASC NULLS FIRST, total_amount ASC NULLS FIRST, "
        "audit_flag ASC NULLS FIRST, data_layer ASC NULLS FIRST LIMIT 5")
    # contract
    q["contract_violations"] = _contract_sql()
    q["contract_defaults"] = MSG + (
        "SELECT transaction_id, coalesce(is_voided, false) AS is_voided, coalesce(audit_flag, 'VALID') AS audit_flag "
        "FROM msgs")
    # suite
    q["expect_not_null"] = _suite_rows({"expect_column_values_to_not_be_null"}, False)
    q["expect_between"] = _suite_rows({"expect_column_values_to_be_between"}, False)
    q["expect_in_set"] = _suite_rows({"expect_column_values_to_be_in_set"}, False)
    q["expect_regex"] = _suite_rows({"expect_column_values_to_match_regex"}, False)
    q["expect_row_count"] = _suite_rows({"expect_table_row_count_to_be_between"}, False)
    q["expectation_report"] = _suite_rows(None, True)
    # gold
    q["stg_sales"] = SILVER + "SELECT * FROM stg"
    q["fct_daily_sales"] = GOLD + "SELECT * FROM fct_daily_sales"
    q["dim_stores"] = GOLD + "SELECT * FROM dim_stores"
    q["dim_products"] = GOLD + "SELECT * FROM dim_products"
    q["test_unique"] = _tests_sql("unique")
    q["test_not_null"] = _tests_sql("not_null")
    q["test_relationships"] = _tests_sql("relationships")
    q["model_test_report"] = _tests_sql(None)
    # snapshots and export
    q["row_count_bronze"] = BASE + "SELECT count(*) AS total_rows FROM pos"
    q["row_count_silver"] = SILVER + "SELECT count(*) AS total_rows FROM silver"
    q["suite_success"] = SILVER + ("SELECT coalesce(bool_and(success), true) AS success, "
                                   "CAST(count_if(NOT success) AS BIGINT) AS failed_rules FROM (" + _suite_body() + ") r")
    q["bronze_pruned_scan"] = q["bronze_partition_scan"] + (
        " WHERE year = 1995 AND month <= 3 AND store_id IN ('NL-001', 'NL-002', 'NL-003', 'NL-004', 'NL-005', 'NL-006', "
        "'NL-007', 'NL-008', 'NL-009')")
    q["snapshot_write_append"] = SILVER + f"SELECT {silver_cols} FROM silver"
    q["snapshot_read_latest"] = SILVER + f"SELECT {silver_cols} FROM silver"
    q["snapshot_read_version"] = SILVER + f"SELECT {silver_cols} FROM silver WHERE {_SNAP_EARLY}"
    q["snapshot_history"] = SILVER + (
        f"SELECT 0 AS version, 'WRITE' AS operation, 'Overwrite' AS mode, "
        f"(SELECT count(*) FROM silver WHERE {_SNAP_EARLY}) AS n_rows, 0 AS base_version "
        f"UNION ALL SELECT 1, 'WRITE', 'Append', (SELECT count(*) FROM silver WHERE NOT {_SNAP_EARLY}), 0 "
        f"UNION ALL SELECT 2, 'WRITE', 'Overwrite', (SELECT count(*) FROM silver), 2")
    q["snapshot_version_counts"] = SILVER + (
        f"SELECT 0 AS version, (SELECT count(*) FROM silver WHERE {_SNAP_EARLY}) AS n_rows_as_of "
        f"UNION ALL SELECT 1, (SELECT count(*) FROM silver) "
        f"UNION ALL SELECT 2, (SELECT count(*) FROM silver)")
    early = _with(_POS.replace("pos AS (", "pos_all AS (", 1), f"pos AS (SELECT * FROM pos_all WHERE {_SNAP_EARLY})", _SILVER)
    q["silver_as_of"] = early + f"SELECT {silver_cols} FROM silver"
    q["silver_history"] = (
        f"SELECT 0 AS version, 'WRITE' AS operation, 'Overwrite' AS mode, (SELECT count(*) FROM ({early} SELECT 1 FROM silver) e) AS n_rows "
        f"UNION ALL SELECT 1, 'WRITE', 'Overwrite', (SELECT count(*) FROM ({SILVER} SELECT 1 FROM silver) w)")
    q["gold_by_name"] = GOLD + "SELECT * FROM fct_daily_sales"
    q["bronze_admission_counts"] = MSG + (
        f"SELECT (SELECT count(*) FROM msgs) AS n_read, (SELECT count(*) FROM ({_ADMITTED}) a) AS n_admitted, "
        f"(SELECT count(*) FROM msgs) - (SELECT count(*) FROM ({_ADMITTED}) b) AS n_dropped")
    q["bronze_report"] = _bronze_report_sql(q["top_stores_revenue"])
    q["silver_report"] = SILVER + " UNION ALL ".join([
        _report_row("row_count", "total_rows", "count(*)", "silver"),
        _report_row("duplicates", "duplicates", "count(*) - count(DISTINCT transaction_id) - coalesce(max(CASE WHEN transaction_id IS NULL THEN 1 ELSE 0 END), 0)", "silver"),
        _report_row("total_mismatches", "total_mismatches", "count_if(abs(total_amount - round(quantity * unit_price, 2)) > 0.01)", "silver"),
        _report_row("negative_amounts", "negative_amounts", "count_if(total_amount < 0)", "silver"),
        _report_shares("audit_flag", "silver")])
    q["csv_export_roundtrip"] = SILVER + f"SELECT {silver_cols} FROM silver"
    q["audit_chain_summary"] = GOLD + (
        "SELECT (SELECT count(*) FROM pos) AS bronze_read, "
        "(SELECT count(*) FROM pos) - (SELECT count(*) FROM flagged2) AS duplicates_removed, "
        "(SELECT count(*) FROM silver) AS silver_valid, "
        "(SELECT count_if(NOT is_valid) FROM flagged2) AS rejected, "
        "(SELECT CAST(count(*) AS BIGINT) FROM (" + _suite_body() + ") r WHERE NOT r.success) AS expectations_failed, "
        "(SELECT count(*) FROM fct_daily_sales) AS fct_rows, "
        "(SELECT count(*) FROM dim_stores) AS dim_store_rows, "
        "(SELECT count(*) FROM dim_products) AS dim_product_rows, "
        "(SELECT CAST(count(*) AS BIGINT) FROM (" + _tests_body() + ") t WHERE NOT t.passed) AS model_tests_failed")
    return q


def _suite_body() -> str:
    return _suite_rows(None, True)[len(SILVER):]


def _tests_body() -> str:
    return _tests_sql(None)[len(GOLD):]


def _report_row(section: str, item: str, n: str, source: str) -> str:
    return (f"SELECT '{section}' AS section, '{item}' AS item, CAST({n} AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS percentage, "
            f"CAST(NULL AS DOUBLE) AS revenue_eur, CAST(NULL AS DOUBLE) AS avg_basket_eur FROM {source}")


def _report_shares(column: str, source: str) -> str:
    return (f"SELECT '{column}' AS section, item, n, {_pct('n', 'total')} AS percentage, CAST(NULL AS DOUBLE) AS revenue_eur, "
            f"CAST(NULL AS DOUBLE) AS avg_basket_eur FROM (SELECT {column} AS item, count(*) AS n, sum(count(*)) OVER () AS total FROM {source} GROUP BY {column}) d")


def _bronze_report_sql(top_stores: str) -> str:
    return BASE + " UNION ALL ".join([
        _report_row("row_count", "total_rows", "count(*)", "pos"),
        *[_report_row("null_check", c, f"count_if({c} IS NULL)", "pos") for c in ("transaction_id", "store_id", "total_amount")],
        _report_shares("audit_flag", "pos"), _report_shares("payment_method", "pos"),
        "SELECT 'top_stores' AS section, store_id AS item, transactions AS n, CAST(NULL AS DOUBLE) AS percentage, revenue_eur, avg_basket_eur "
        f"FROM ({top_stores}) t"])
