"""Bronze → Silver: keep latest, validate, classify, route.

``silver_flagged`` is the pure transformation (one frame with the
rejection reason, validity and re-classified audit flag); ``silver_valid``
and ``silver_rejects`` are the two projections of it, and ``run_silver``
does the I/O: it scans Bronze once (the flagged frame is persisted while
its class counts are taken; the input count is the sum of the copies that
the keep-latest aggregate counted), writes both outputs from the cache and
publishes them with one row.  A lost executor's cached blocks are
recomputed from lineage.

Every run is a version of Silver: ``read_silver`` reads the newest one or
the one as of a version, a run or an instant, ``silver_history`` lists them.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope import schema as S
from tillscope.functions.money import as_money
from tillscope.functions.rules import audit_flag, expected_total, rejection_reason
from tillscope.operators.dedup import COPIES, dedup_latest, dedup_latest_counted
from tillscope.sources.runs import find_folder, join_ledger, ledger_of, new_run, publish, run_folder, run_history

SILVER, REJECTS = "silver", "rejects"  # the tables' names in a ledger


def clock_column(clock: _dt.datetime | Column | None) -> Column:
    """Processing-time column: the given instant, or the query's current time."""
    if clock is None:
        return F.current_timestamp()
    if isinstance(clock, Column):
        return clock
    return F.lit(clock).cast("timestamp")


def silver_flagged(bronze: DataFrame, clock: _dt.datetime | Column | None = None,
                   tiebreak: Sequence[str] = (), counted: bool = False, derive: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Dedup + clean + rule cascade + audit flag, before the valid/reject split.

    Columns: ``SILVER_COLUMNS`` + expected_total, rejection_reason, is_valid
    (+ ``copies`` with ``counted``: the Bronze rows that each row stands for).
    Of equal ingest times the later topic position wins, where Bronze has it.
    With ``derive``, ``bronze`` holds narrower rows (with the columns that
    keep-latest orders by) of which ``derive`` makes Bronze, row by row: only
    the narrow rows are moved, only the kept ones are derived from.
    The rules judge the amounts as they came; money is narrowed to
    DECIMAL(18, 4) afterwards, so an amount that does not fit is rejected,
    never nulled and accepted.
    """
    latest_by = ["ingested_at", *[c for c in S.POSITION_COLUMNS if c in bronze.columns]]
    if tiebreak and derive is None:  # columns that neither decide nor go on
        bronze = bronze.drop(*[c for c in bronze.columns if c in ("audit_flag", "data_layer") or c not in S.SILVER_COLUMNS and c not in (*latest_by, *tiebreak)])
    latest = (dedup_latest_counted if counted else dedup_latest)(bronze, ["transaction_id"], latest_by, tiebreak)
    if derive is not None:
        latest = derive(latest)
    ts = F.col("transaction_ts")
    if dict(latest.dtypes).get("transaction_ts") == "string":
        ts = F.try_to_timestamp(ts)
    cleaned = latest.withColumns(
        {
            "transaction_ts": ts,
            "expected_total": expected_total(),
            "silver_processed_at": clock_column(clock),
            "data_layer": F.lit(S.LAYER_SILVER),
        }
    )
    reason = cleaned.withColumn("rejection_reason", rejection_reason())
    return reason.select(
        *[c for c in S.SILVER_COLUMNS if c not in ("audit_flag", "unit_price", "total_amount")],
        as_money("unit_price").alias("unit_price"),
        as_money("total_amount").alias("total_amount"),
        audit_flag().alias("audit_flag"),
        F.col("expected_total").try_cast(S.MONEY).alias("expected_total"),
        "rejection_reason",
        F.col("rejection_reason").isNull().alias("is_valid"),
        *([COPIES] if counted else []),
    ).select(*S.SILVER_COLUMNS, "expected_total", "rejection_reason", "is_valid", *([COPIES] if counted else []))


def silver_valid(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col("is_valid")).select(*S.SILVER_COLUMNS)


def silver_rejects(flagged: DataFrame) -> DataFrame:
    return flagged.filter(~F.col("is_valid")).select(*S.REJECT_COLUMNS)


def _class_counts(flagged: DataFrame) -> DataFrame:
    """bronze_read, duplicates_removed, valid, rejected of a counted frame."""
    read = F.coalesce(F.sum(COPIES), F.lit(0))
    return flagged.agg(
        read.alias("bronze_read"),
        (read - F.count(F.lit(1))).alias("duplicates_removed"),
        F.count_if(F.col("is_valid")).alias("valid"),
        F.count_if(~F.col("is_valid")).alias("rejected"),
    )


def silver_run_summary(bronze: DataFrame, tiebreak: Sequence[str] = (), derive: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row: bronze_read, duplicates_removed, valid, rejected, from one Bronze scan and one shuffle of its rows."""
    return _class_counts(silver_flagged(bronze, tiebreak=tiebreak, counted=True, derive=derive))


def read_silver(spark: SparkSession, silver_path: str, version: int | None = None, run: str | None = None,
                at: _dt.datetime | None = None) -> DataFrame:
    """The newest published Silver, or as of a version, a run or an instant, with its declared schema: empty if the run held no valid row."""
    path = find_folder(spark, silver_path, SILVER, version, run, at)
    if path is None:
        return spark.createDataFrame([], S.SILVER_SCHEMA)
    return spark.read.schema(S.SILVER_SCHEMA).parquet(path).select(*S.SILVER_COLUMNS)


def read_rejects(spark: SparkSession, rejects_path: str, version: int | None = None, run: str | None = None,
                 at: _dt.datetime | None = None) -> DataFrame:
    path = find_folder(spark, rejects_path, REJECTS, version, run, at)
    return spark.read.schema(S.REJECTS_SCHEMA).parquet(path) if path else spark.createDataFrame([], S.REJECTS_SCHEMA)


def silver_history(spark: SparkSession, silver_path: str) -> DataFrame:
    """version, run, operation, mode, n_rows, written_at of the published Silver; newest first."""
    return run_history(spark, silver_path, SILVER)


def write_silver(bronze: DataFrame, silver_folder: str, rejects_folder: str, clock: _dt.datetime | None = None,
                 tiebreak: Sequence[str] = (), storage: StorageLevel = StorageLevel.MEMORY_AND_DISK,
                 derive: Callable[[DataFrame], DataFrame] | None = None) -> dict:
    """Write Silver (partitioned by date) and Rejects into new folders from one Bronze scan; nothing for empty input.

    Returns the run summary (bronze_read, duplicates_removed, valid, rejected).
    """
    clock = clock or _dt.datetime.now(_dt.timezone.utc)
    flagged = silver_flagged(bronze, clock=clock, tiebreak=tiebreak, counted=True, derive=derive).persist(storage)
    try:
        # the one Bronze scan: materialise the flagged frame and count its classes
        counts = {k: int(v) for k, v in _class_counts(flagged).first().asDict().items()}
        if counts["bronze_read"]:
            # new folders: the dynamic partition mode of a session has nothing to keep
            silver_valid(flagged).hint("rebalance", *S.SILVER_PARTITION_COLUMNS).write.mode("errorifexists") \
                .partitionBy(*S.SILVER_PARTITION_COLUMNS).parquet(silver_folder)
            silver_rejects(flagged).write.mode("errorifexists").parquet(rejects_folder)
    finally:
        flagged.unpersist()
    return counts


def run_silver(spark: SparkSession, bronze: DataFrame, silver_path: str, rejects_path: str,
               clock: _dt.datetime | None = None, tiebreak: Sequence[str] = (),
               storage: StorageLevel = StorageLevel.MEMORY_AND_DISK, derive: Callable[[DataFrame], DataFrame] | None = None) -> dict:
    """Write Silver and Rejects from one Bronze scan and publish both with one row.

    Returns the run summary (bronze_read, duplicates_removed, valid,
    rejected).  Empty input writes nothing, like the audited job.  A run
    that fails, also between the two writes, leaves both tables as they were.
    """
    run = new_run()
    counts = write_silver(bronze, run_folder(silver_path, run), run_folder(rejects_path, run), clock, tiebreak, storage, derive)
    if counts["bronze_read"]:
        ledger = ledger_of(spark, silver_path)
        join_ledger(spark, ledger, [silver_path, rejects_path])
        publish(spark, ledger, run, {SILVER: counts["valid"], REJECTS: counts["rejected"]})
    return counts
