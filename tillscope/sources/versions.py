"""Versions of a table as partitions of one Parquet dataset, visible by publication.

Rows of a write lie under ``base=B/version=N/write=W``: B is the version
whose overwrite the version builds on, so an overwrite is its own base and
an append shares its predecessor's; W names the attempt.  When all files
of a write are in place, one row (version, base, write, operation, rows,
token) is appended to ``<path>_published``.  Readers follow these rows
alone:

* a write that is cut, before or while its files are moved into place,
  has no row and is never read; its retry is a new attempt with new files;
* a caller's ``token`` makes a retry safe after the row was written, too:
  a write whose token is published returns that version and writes nothing.

The table as of N is a filter on partition columns (the writes published
up to N on N's base); the history is the published rows themselves and
opens no data.  A row count is read once, from the footers of the new
files, when a write is published.

All versions of a table are partitioned alike.  A version holds rows:
appending nothing adds no version, and overwriting with nothing is
refused.  Single writer; a schema is the caller's to keep.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

PLACE = [StructField("base", IntegerType()), StructField("version", IntegerType()), StructField("write", StringType())]
PUBLISHED = "version int, base int, write string, mode string, n_rows long, token string, written_at timestamp"
APPEND, OVERWRITE = "append", "overwrite"


def published_versions(spark: SparkSession, path: str) -> DataFrame:
    """version, base, write, mode, n_rows, token, written_at: one row per published version."""
    try:
        return spark.read.schema(PUBLISHED).parquet(f"{path.rstrip('/')}_published")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PUBLISHED)


def _newest(spark: SparkSession, path: str, upto: int | None = None, at: _dt.datetime | None = None) -> Row | None:
    """The publication of the newest version up to number ``upto`` or instant ``at``."""
    rows = published_versions(spark, path)
    if upto is not None:
        rows = rows.where(F.col("version") <= upto)
    if at is not None:
        rows = rows.where(F.col("written_at") <= F.lit(at))
    return rows.orderBy(F.col("version").desc()).first()


def write_files(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """The data of one attempt, into a folder that must not exist."""
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)


def write_version(df: DataFrame, path: str, mode: str = APPEND, partition_by: Sequence[str] = (), token: str | None = None,
                  clustered: bool = False) -> int:
    """Write ``df`` as the next version and publish it; returns the newest version's number.

    Appending no rows to a table adds no version.  With ``token``, a write
    that was published under it before is not repeated.  Rows are shuffled
    by ``partition_by``, so that a folder gets few files; with ``clustered``
    they lie together already (as in files that were written so) and are
    written from where they are.
    """
    if mode not in (APPEND, OVERWRITE):
        raise ValueError("mode must be 'append' or 'overwrite'")
    spark, path = df.sparkSession, path.rstrip("/")
    if token is not None:
        done = published_versions(spark, path).where(F.col("token") == token).first()
        if done is not None:
            return done["version"]
    newest = _newest(spark, path)
    version = newest["version"] + 1 if newest else 0
    base = newest["base"] if newest and mode == APPEND else version
    write = uuid.uuid4().hex
    files = f"{path}/base={base}/version={version}/write={write}"
    write_files(df.hint("rebalance", *partition_by) if partition_by and not clustered else df, files, partition_by)
    n_rows = spark.read.schema(df.schema).parquet(files).count()
    if n_rows == 0:
        if mode == OVERWRITE or newest is None:
            raise ValueError("a version holds rows")
        return newest["version"]
    # the instant of publication never runs backwards, so reading as of an instant and as of a number agree
    written_at = F.greatest(F.current_timestamp(), F.lit(newest["written_at"] if newest else None).cast("timestamp"))
    spark.range(1).select(F.lit(version).alias("version"), F.lit(base).alias("base"), F.lit(write).alias("write"), F.lit(mode).alias("mode"),
                          F.lit(n_rows).cast("long").alias("n_rows"), F.lit(token).cast("string").alias("token"), written_at.alias("written_at")
                          ).write.mode("append").parquet(f"{path}_published")
    return version


def read_version(spark: SparkSession, path: str, schema: StructType, version: int | None = None, at: _dt.datetime | None = None) -> DataFrame:
    """The table as of ``version`` or as of the instant ``at`` (None: the newest)."""
    path = path.rstrip("/")
    newest = _newest(spark, path, version, at)
    if newest is None:
        raise FileNotFoundError(f"no version of {path}" + (f" published by {at}" if at else ""))
    writes = published_versions(spark, path).where((F.col("base") == newest["base"]) & (F.col("version") <= newest["version"])).select("write")
    names = [r["write"] for r in writes.collect()]
    rows = spark.read.schema(StructType([*schema.fields, *PLACE])).parquet(path)
    return rows.where((F.col("base") == newest["base"]) & (F.col("version") <= newest["version"]) & F.col("write").isin(names)).select(*schema.fieldNames())


def version_history(spark: SparkSession, path: str) -> DataFrame:
    """version, operation, mode, n_rows, base_version, written_at; newest first."""
    return published_versions(spark, path).select(
        "version", F.lit("WRITE").alias("operation"), F.initcap("mode").alias("mode"), "n_rows",
        F.col("base").alias("base_version"), "written_at").orderBy(F.col("version").desc())


def version_counts(spark: SparkSession, path: str) -> DataFrame:
    """version, n_rows_as_of: rows of the table as of each version, from the publications alone."""
    rows = published_versions(spark, path)
    before = rows.select(F.col("base").alias("b"), F.col("version").alias("v"), F.col("n_rows").alias("n"))
    return rows.join(before, (F.col("base") == F.col("b")) & (F.col("v") <= F.col("version"))).groupBy("version").agg(F.sum("n").alias("n_rows_as_of"))
