"""Bronze batch scan with partition discovery and pruning.

The scan declares the full Bronze schema (partition columns included),
so partition values are typed as declared instead of inferred, and the
result always comes back in ``BRONZE_COLUMNS`` order (partition columns
otherwise move to the end).  Date and store arguments become filters on
partition columns only, which Spark evaluates against the directory
listing: folders outside the range are never opened.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillscope import schema as S


def _day_key(d: _dt.date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


def read_bronze(spark: SparkSession, path: str, date_from: _dt.date | None = None,
                date_to: _dt.date | None = None, stores: Sequence[str] | None = None, with_position: bool = False) -> DataFrame:
    """Bronze of a range of dates and stores; ``with_position`` adds where its messages stood in their topic (NULL where that was not kept)."""
    extra = S.POSITION_COLUMNS if with_position else []
    df = spark.read.schema(StructType([*S.BRONZE_SCHEMA.fields, *(S.POSITION_SCHEMA.fields if with_position else [])])).parquet(path)
    day_key = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    if date_from is not None:
        df = df.filter(day_key >= _day_key(date_from))
    if date_to is not None:
        df = df.filter(day_key <= _day_key(date_to))
    if stores is not None:
        df = df.filter(F.col("store_id").isin(*stores))
    return df.select(*S.BRONZE_COLUMNS, *extra)


def write_bronze_batch(bronze: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                       mode: str = "append") -> None:
    """Batch writer for Bronze (backfills, tests).

    ``rebalance`` on the partition columns lets AQE give each folder few
    files while splitting a hot date (or store) across several tasks, so
    no single task writes a third of the table.  Rows are clustered by
    store inside each file, so a store filter prunes row groups even under
    the date-only layout.
    """
    partition_by = list(partition_by or S.BRONZE_PARTITION_COLUMNS)
    out = bronze.select(*S.BRONZE_COLUMNS).hint("rebalance", *partition_by)
    if "store_id" not in partition_by:
        # partition columns first: the writer's own required ordering is then met, no re-sort
        out = out.sortWithinPartitions(*partition_by, "store_id")
    out.write.mode(mode).partitionBy(*partition_by).parquet(path)
