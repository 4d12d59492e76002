"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator key.

All queries read the driver's tables (through the POS view) and run over
them whole.  Processing-time columns (``silver_processed_at``, and the
ingest clock where the message path assigns it) are left out of the
outputs because they differ per run; money leaves as DOUBLE.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, TimestampType

from tillscope import schema as S
from tillscope.functions.contract import contract_defaults, contract_violations
from tillscope.operators import gold, model_tests, profile, quality
from tillscope.operators.dedup import dedup_latest
from tillscope.operators.silver import read_silver, run_silver, silver_flagged, silver_history, silver_rejects, silver_run_summary, silver_valid
from tillscope.plans.pipeline import declared_source, publish_views, run_pipeline
from tillscope.session import scratch_path
from tillscope.sources.bronze import read_bronze, write_bronze_batch
from tillscope.sources.csv_export import export_csv, read_csv_export
from tillscope.sources.messages import decode_messages, encode_messages
from tillscope.sources.posview import POS_TIEBREAK, pos_bronze, pos_rows, pos_view, read_table
from tillscope.sources.versions import read_version, version_counts, version_history, write_version
from tillscope.streaming.ingest import admission_counts, drain, enrich, file_message_source, ingest, start_ingest

Query = Callable[[SparkSession, str], DataFrame]

# year split of the snapshot scenario: version 0 loads the history, version 1 appends the rest
SNAPSHOT_SPLIT_YEAR = 1995
# snapshot versions are partitioned by year: the test data spread over ~2,400 days
# would make three day-partitioned versions write ~7,000 folders of a few rows each
SNAPSHOT_PARTITIONS = ["year"]
# arguments of the pruned scan
PRUNED_FROM, PRUNED_TO = _dt.date(1995, 1, 1), _dt.date(1995, 3, 31)
PRUNED_STORES = [f"NL-00{i}" for i in range(1, 10)]


# ---------------------------------------------------------------- helpers
def _doubles(df: DataFrame) -> DataFrame:
    """Decimal columns as DOUBLE (the comparable output type)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def comparable(df: DataFrame) -> DataFrame:
    """Final projection of a registered query: money as DOUBLE, instants as wall-clock
    TIMESTAMP_NTZ (the session zone converts in and out, so values match a naive
    TIMESTAMP in any session zone and under any collection path)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _registered(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(fn(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def _bronze(spark: SparkSession, d: str) -> DataFrame:
    return pos_view(spark, d)


def _flagged(spark: SparkSession, d: str) -> DataFrame:
    return silver_flagged(pos_rows(spark, d), tiebreak=POS_TIEBREAK, derive=pos_bronze)


def _silver(spark: SparkSession, d: str) -> DataFrame:
    return silver_valid(_flagged(spark, d))


def _stg(spark: SparkSession, d: str) -> DataFrame:
    return gold.stg_sales(_silver(spark, d))


def _models(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The four gold models over one materialised staging table.

    Staging is written once as Parquet under scratch, so the model tests'
    branches each read the columns they need of it instead of re-deriving
    scan -> joins -> dedup, as the pipeline does with its written tables.
    """
    stg = _written(_stg(spark, d), "staging")
    return {
        "stg_sales_transactions": stg,
        "fct_daily_sales": gold.fct_daily_sales(stg),
        "dim_stores": gold.dim_stores(stg),
        "dim_products": gold.dim_products(stg),
    }


def _no_clock(df: DataFrame) -> DataFrame:
    return df.drop("silver_processed_at")


def _messages(spark: SparkSession, d: str) -> DataFrame:
    """POS rows encoded as keyed messages, plus the event stream's JSON as foreign messages."""
    pos = encode_messages(_bronze(spark, d))
    events = read_table(spark, d, "events").select(
        F.lit(None).cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    return pos.unionByName(events)


# ---------------------------------------------------------------- Bronze / messages
def q_encode_messages(spark, d):
    """decode(encode(x)) = x, with the message key as text."""
    return decode_messages(encode_messages(_bronze(spark, d)), with_key=True)


def q_bronze_decode(spark, d):
    return decode_messages(_messages(spark, d))


def q_bronze_enrich(spark, d):
    return enrich(decode_messages(_messages(spark, d))).drop("ingested_at")


def q_bronze_admit(spark, d):
    return ingest(_messages(spark, d)).drop("ingested_at")


def q_bronze_stream_roundtrip(spark, d):
    root = scratch_path(spark, "stream-roundtrip")
    _messages(spark, d).write.parquet(f"{root}/topic")
    src = file_message_source(spark, f"{root}/topic")
    # two tasks a folder: the test rows spread over ~2,400 days of a few dozen rows each
    q = start_ingest(src, f"{root}/bronze", f"{root}/_checkpoint", trigger={"availableNow": True},
                     partition_by=S.BRONZE_DATE_PARTITION_COLUMNS, cluster_by_partition=2)
    q.awaitTermination()
    return read_bronze(spark, f"{root}/bronze").drop("ingested_at")


def q_bronze_admission_counts(spark, d):
    """Messages read, admitted and dropped, as observed in the micro-batches of a stream."""
    root = scratch_path(spark, "stream-counts")
    _messages(spark, d).write.parquet(f"{root}/topic")
    q = drain(file_message_source(spark, f"{root}/topic"), f"{root}/bronze", f"{root}/_checkpoint", partition_by=["year"], cluster_by_partition=2)
    rows = [(c["n_read"], c["n_admitted"], c["n_dropped"]) for c in admission_counts(q)]
    return spark.createDataFrame(rows, "n_read bigint, n_admitted bigint, n_dropped bigint").groupBy().sum().toDF("n_read", "n_admitted", "n_dropped")


def q_bronze_partition_scan(spark, d):
    root = scratch_path(spark, "bronze-scan")
    write_bronze_batch(_bronze(spark, d).select(*S.BRONZE_COLUMNS), f"{root}/bronze",
                       partition_by=S.BRONZE_DATE_PARTITION_COLUMNS)
    return read_bronze(spark, f"{root}/bronze")


def q_bronze_pruned_scan(spark, d):
    """One year's first quarter of the stores 1 to 9 from the audited layout (date and store arguments are the feature)."""
    root = scratch_path(spark, "bronze-pruned")
    write_bronze_batch(_bronze(spark, d).select(*S.BRONZE_COLUMNS), f"{root}/bronze", partition_by=["year", "month", "day"])
    return read_bronze(spark, f"{root}/bronze", date_from=PRUNED_FROM, date_to=PRUNED_TO, stores=PRUNED_STORES)


# ---------------------------------------------------------------- Silver
def q_silver_dedup_latest(spark, d):
    return dedup_latest(_bronze(spark, d), ["transaction_id"], ["ingested_at"], POS_TIEBREAK) \
        .select(*S.BRONZE_COLUMNS)


def q_silver_clean(spark, d):
    return _doubles(_flagged(spark, d).select(
        "transaction_id", "store_id", "quantity", "unit_price", "total_amount", "expected_total",
        "transaction_ts", "data_layer"))


def q_silver_rejection_reason(spark, d):
    return _doubles(_flagged(spark, d).select(
        "transaction_id", "store_id", "total_amount", "expected_total", "rejection_reason", "is_valid"))


def q_silver_audit_flag(spark, d):
    return _doubles(_flagged(spark, d).select("transaction_id", "is_voided", "total_amount", "audit_flag"))


def q_silver_valid(spark, d):
    return _doubles(_no_clock(_silver(spark, d)))


def q_silver_rejects(spark, d):
    return _doubles(_no_clock(silver_rejects(_flagged(spark, d))))


def q_silver_run_summary(spark, d):
    return silver_run_summary(pos_rows(spark, d), tiebreak=POS_TIEBREAK, derive=pos_bronze)


# ---------------------------------------------------------------- profiles and checks
def q_profile_nulls(spark, d):
    return profile.profile_nulls(_bronze(spark, d))


def q_dist_audit_flag(spark, d):
    return profile.distribution(_bronze(spark, d), "audit_flag")


def q_dist_payment_method(spark, d):
    return profile.distribution(_bronze(spark, d), "payment_method")


def q_dist_silver_audit_flag(spark, d):
    return profile.distribution(_silver(spark, d), "audit_flag")


def q_top_stores_revenue(spark, d):
    return profile.top_stores_by_revenue(_bronze(spark, d))


def q_check_duplicates(spark, d):
    return profile.check_duplicates(_silver(spark, d))


def q_check_total_mismatch(spark, d):
    return profile.check_total_mismatch(_silver(spark, d))


def q_check_negative(spark, d):
    return profile.check_negative(_silver(spark, d))


def q_row_count_bronze(spark, d):
    return profile.row_count(_bronze(spark, d))


def q_row_count_silver(spark, d):
    return profile.row_count(_silver(spark, d))


def q_bronze_report(spark, d):
    return profile.bronze_report(_bronze(spark, d))


def q_silver_report(spark, d):
    return profile.silver_report(_silver(spark, d))


def q_sample_bronze(spark, d):
    return profile.sample(_bronze(spark, d), profile.BRONZE_SAMPLE_COLUMNS)


def q_sample_silver(spark, d):
    return _doubles(profile.sample(_silver(spark, d), profile.SILVER_SAMPLE_COLUMNS))


# ---------------------------------------------------------------- contract
def q_contract_violations(spark, d):
    return contract_violations(decode_messages(_messages(spark, d)))


def q_contract_defaults(spark, d):
    return contract_defaults(decode_messages(_messages(spark, d))).select(
        "transaction_id", "is_voided", "audit_flag")


# ---------------------------------------------------------------- expectation suite
def _suite_of(rule_type: str) -> Query:
    def run(spark, d):
        rules = [e for e in quality.silver_suite() if e.rule_type == rule_type]
        return quality.run_suite(_silver(spark, d), rules).drop("rule_id")
    return run


def q_expectation_report(spark, d):
    return quality.run_suite(_silver(spark, d), quality.silver_suite())


def q_suite_success(spark, d):
    return quality.suite_success(q_expectation_report(spark, d))


# ---------------------------------------------------------------- gold
def q_stg_sales(spark, d):
    return _stg(spark, d)


def q_fct_daily_sales(spark, d):
    return gold.fct_daily_sales(_stg(spark, d))


def q_dim_stores(spark, d):
    return gold.dim_stores(_stg(spark, d))


def q_dim_products(spark, d):
    return gold.dim_products(_stg(spark, d))


def _tests_of(test_type: str | None) -> Query:
    def run(spark, d):
        tests = [t for t in model_tests.gold_tests() if test_type is None or t.test == test_type]
        rep = model_tests.model_test_report(_models(spark, d), tests)
        return rep if test_type is None else rep.drop("test_id")
    return run


# ---------------------------------------------------------------- snapshots and export
def _versions(spark, d, upto: int) -> tuple[str, DataFrame]:
    """v0 overwrite (years up to the split), v1 append (the rest), v2 overwrite (all rows again); Silver is computed and clustered once."""
    path = scratch_path(spark, "versions")
    silver = _written(_silver(spark, d).hint("rebalance", *SNAPSHOT_PARTITIONS), "silver")
    early = F.coalesce(F.col("year") <= SNAPSHOT_SPLIT_YEAR, F.lit(True))
    for rows, mode in [(silver.filter(early), "overwrite"), (silver.filter(~early), "append"), (silver, "overwrite")][:upto + 1]:
        write_version(rows, path, mode=mode, partition_by=SNAPSHOT_PARTITIONS, clustered=True)
    return path, silver


def _as_of(spark, d, written: int, version: int | None) -> DataFrame:
    path, silver = _versions(spark, d, written)
    return _doubles(_no_clock(read_version(spark, path, silver.schema, version)))


def q_snapshot_write_append(spark, d):
    return _as_of(spark, d, 1, None)


def q_snapshot_read_version(spark, d):
    return _as_of(spark, d, 2, 0)


def q_snapshot_read_latest(spark, d):
    return _as_of(spark, d, 2, None)


def q_snapshot_history(spark, d):
    return version_history(spark, _versions(spark, d, 2)[0]).drop("written_at")


def q_snapshot_version_counts(spark, d):
    return version_counts(spark, _versions(spark, d, 2)[0])


def _silver_runs(spark, d) -> str:
    """Two published runs of the Silver job: Bronze up to the split year, then all of it."""
    root = scratch_path(spark, "silver-runs")
    bronze = pos_rows(spark, d)
    for rows in (bronze.filter(F.coalesce(F.year("transaction_ts") <= SNAPSHOT_SPLIT_YEAR, F.lit(True))), bronze):
        run_silver(spark, rows, f"{root}/silver", f"{root}/rejects", clock=_dt.datetime.now(_dt.timezone.utc), tiebreak=POS_TIEBREAK, derive=pos_bronze)
    return f"{root}/silver"


def q_silver_as_of(spark, d):
    """Silver as of its first run, read after the second."""
    return _doubles(_no_clock(read_silver(spark, _silver_runs(spark, d), version=0)))


def q_silver_history(spark, d):
    return silver_history(spark, _silver_runs(spark, d)).drop("run", "written_at")


def q_gold_by_name(spark, d):
    """The daily fact by its catalog name, of the newest published run of the chain; its stores checked against the Silver view's."""
    root, prefix = scratch_path(spark, "named"), f"t{uuid.uuid4().hex[:8]}_"
    run_pipeline(spark, pos_rows(spark, d), root, clock=_dt.datetime.now(_dt.timezone.utc), tiebreak=POS_TIEBREAK, derive=pos_bronze)
    publish_views(spark, root, prefix)
    stores = declared_source(spark, f"{prefix}silver").select("store_id").distinct()
    return spark.table(f"{prefix}fct_daily_sales").join(stores, "store_id", "left_semi")


def q_csv_export_roundtrip(spark, d):
    path = scratch_path(spark, "csv-export")
    silver = _silver(spark, d)
    export_csv(silver, path, compression="gzip")  # as plain text the table outgrows all shuffles before it
    return _doubles(_no_clock(read_csv_export(spark, path, silver.schema)))


def q_audit_chain_summary(spark, d):
    return run_pipeline(spark, pos_rows(spark, d), scratch_path(spark, "pipeline"),
                        clock=_dt.datetime.now(_dt.timezone.utc), tiebreak=POS_TIEBREAK, derive=pos_bronze)


_QUERIES: dict[str, Query] = {
    # sources, messages, ingest
    "encode_messages": q_encode_messages,
    "bronze_decode": q_bronze_decode,
    "bronze_enrich": q_bronze_enrich,
    "bronze_admit": q_bronze_admit,
    "bronze_stream_roundtrip": q_bronze_stream_roundtrip,
    "bronze_admission_counts": q_bronze_admission_counts,
    "bronze_partition_scan": q_bronze_partition_scan,
    "bronze_pruned_scan": q_bronze_pruned_scan,
    # silver
    "silver_dedup_latest": q_silver_dedup_latest,
    "silver_clean": q_silver_clean,
    "silver_rejection_reason": q_silver_rejection_reason,
    "silver_audit_flag": q_silver_audit_flag,
    "silver_valid": q_silver_valid,
    "silver_rejects": q_silver_rejects,
    "silver_run_summary": q_silver_run_summary,
    # profiles and checks
    "profile_nulls": q_profile_nulls,
    "dist_audit_flag": q_dist_audit_flag,
    "dist_payment_method": q_dist_payment_method,
    "dist_silver_audit_flag": q_dist_silver_audit_flag,
    "top_stores_revenue": q_top_stores_revenue,
    "check_duplicates": q_check_duplicates,
    "check_total_mismatch": q_check_total_mismatch,
    "check_negative": q_check_negative,
    "sample_bronze": q_sample_bronze,
    "sample_silver": q_sample_silver,
    "bronze_report": q_bronze_report,
    "silver_report": q_silver_report,
    "row_count_bronze": q_row_count_bronze,
    "row_count_silver": q_row_count_silver,
    # contract
    "contract_violations": q_contract_violations,
    "contract_defaults": q_contract_defaults,
    # expectation suite
    "expect_not_null": _suite_of("expect_column_values_to_not_be_null"),
    "expect_between": _suite_of("expect_column_values_to_be_between"),
    "expect_in_set": _suite_of("expect_column_values_to_be_in_set"),
    "expect_regex": _suite_of("expect_column_values_to_match_regex"),
    "expect_row_count": _suite_of("expect_table_row_count_to_be_between"),
    "expectation_report": q_expectation_report,
    "suite_success": q_suite_success,
    # gold and model tests
    "stg_sales": q_stg_sales,
    "fct_daily_sales": q_fct_daily_sales,
    "dim_stores": q_dim_stores,
    "dim_products": q_dim_products,
    "test_unique": _tests_of("unique"),
    "test_not_null": _tests_of("not_null"),
    "test_relationships": _tests_of("relationships"),
    "model_test_report": _tests_of(None),
    # versioned table and export
    "snapshot_write_append": q_snapshot_write_append,
    "snapshot_read_latest": q_snapshot_read_latest,
    "snapshot_read_version": q_snapshot_read_version,
    "snapshot_history": q_snapshot_history,
    "snapshot_version_counts": q_snapshot_version_counts,
    "silver_as_of": q_silver_as_of,
    "silver_history": q_silver_history,
    "gold_by_name": q_gold_by_name,
    "csv_export_roundtrip": q_csv_export_roundtrip,
    # whole chain
    "audit_chain_summary": q_audit_chain_summary,
}

QUERIES: dict[str, Query] = {k: _registered(v) for k, v in _QUERIES.items()}
