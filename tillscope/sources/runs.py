"""Outputs of repeated runs: a run writes new folders, and one row publishes all of its tables at once.

Every table has a root; a run's rows of it lie under ``<root>/runs/run=<id>``.
A ledger (``<ledger>/published``) has one row per published run: its
number, its id, the rows of each of its tables, and the instant.  Tables
that are written together share one ledger: a root other than the ledger's
holds a pointer to it (``<root>/ledger``).  So a run that fails anywhere
before its row is appended leaves the readers of all its tables on the run
before, and no reader meets tables of different runs.

Readers take the newest published run that holds their table, or the one
as of a version, a run id or an instant.  A run replaces what its tables
held before, so its version is an overwrite in the table's history.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

PUBLISHED = "version int, run string, n_rows map<string,bigint>, published_at timestamp"


def _read_if_there(spark: SparkSession, schema: str, path: str) -> DataFrame:
    """The table, empty before its first row."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def new_run() -> str:
    return f"{_dt.datetime.now(_dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def run_folder(root: str, run: str) -> str:
    return f"{root.rstrip('/')}/runs/run={run}"


def ledger_of(spark: SparkSession, root: str) -> str:
    """The ledger that publishes the table at ``root``: the one it points to, else its own."""
    pointer = _read_if_there(spark, "ledger string", f"{root.rstrip('/')}/ledger").first()
    return pointer["ledger"] if pointer else root.rstrip("/")


def join_ledger(spark: SparkSession, ledger: str, roots: Sequence[str]) -> None:
    """Let ``ledger`` publish the tables at ``roots``; a table stays with its first ledger."""
    for root in {r.rstrip("/") for r in roots} - {ledger.rstrip("/")}:
        now = ledger_of(spark, root)
        if now == ledger.rstrip("/"):
            continue
        if now != root or not published_runs(spark, root).isEmpty():
            raise ValueError(f"{root} is published by {now}")
        spark.range(1).select(F.lit(ledger.rstrip("/")).alias("ledger")).write.mode("ignore").parquet(f"{root}/ledger")


def published_runs(spark: SparkSession, ledger: str) -> DataFrame:
    """version, run, n_rows (of each table), published_at."""
    return _read_if_there(spark, PUBLISHED, f"{ledger.rstrip('/')}/published")


def publish(spark: SparkSession, ledger: str, run: str, n_rows: Mapping[str, int]) -> int:
    """Publish all tables of a run (name -> rows) with one row; returns the run's version."""
    newest = published_runs(spark, ledger).orderBy(F.col("version").desc()).first()
    version = newest["version"] + 1 if newest else 0
    # instants never run backwards, so reading as of an instant and as of a version agree
    at = F.greatest(F.current_timestamp(), F.lit(newest["published_at"] if newest else None).cast("timestamp"))
    tables = F.create_map(*[F.lit(x).cast("bigint") if isinstance(x, int) else F.lit(x) for item in n_rows.items() for x in item])
    spark.range(1).select(F.lit(version).alias("version"), F.lit(run).alias("run"), tables.alias("n_rows"), at.alias("published_at")
                          ).write.mode("append").parquet(f"{ledger.rstrip('/')}/published")
    return version


def _of_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    return published_runs(spark, ledger_of(spark, root)).where(F.map_contains_key("n_rows", F.lit(table)))


def find_run(spark: SparkSession, root: str, table: str, version: int | None = None, run: str | None = None,
             at: _dt.datetime | None = None) -> Row | None:
    """The newest published run that holds ``table``, up to a version or an instant, or exactly the run named; None without one."""
    rows = _of_table(spark, root, table)
    if version is not None:
        rows = rows.where(F.col("version") <= version)
    if at is not None:
        rows = rows.where(F.col("published_at") <= F.lit(at))
    if run is not None:
        rows = rows.where(F.col("run") == run)
    return rows.orderBy(F.col("version").desc()).first()


def find_folder(spark: SparkSession, root: str, table: str, version: int | None = None, run: str | None = None,
                at: _dt.datetime | None = None) -> str | None:
    """Where the table of that run lies.  None before the first run; a version, run or instant without a run is an error."""
    found = find_run(spark, root, table, version, run, at)
    if found is None and not (version is None and run is None and at is None):
        raise FileNotFoundError(f"no run of {table} in {root} as of {version if version is not None else run or at}")
    return run_folder(root, found["run"]) if found else None


def run_history(spark: SparkSession, root: str, table: str) -> DataFrame:
    """version, run, operation, mode, n_rows, written_at of a table; newest first."""
    return _of_table(spark, root, table).select(
        "version", "run", F.lit("WRITE").alias("operation"), F.lit("Overwrite").alias("mode"),
        F.col("n_rows")[table].alias("n_rows"), F.col("published_at").alias("written_at")).orderBy(F.col("version").desc())
