"""Message stream → Bronze.

``ingest`` is one stateless projection + filter, so the same function
serves a batch frame and a streaming frame (and is tested as both):
decode → parse event time (NULL on bad text) → date partition columns →
lineage columns → admission filter.  ``start_ingest`` attaches it to an
append-only, checkpointed, partitioned Parquet sink.

The source is a parameter: ``kafka_source`` builds the broker stream
with the audited options as parameters (latest on first start, checkpoint
wins on restart); lost data fails the query unless it is to be tolerated,
and a trigger takes all there is unless a limit is given.
``file_message_source`` reads a directory of message files with the same
``key, value, timestamp`` columns.

A broker also tells partition and offset of each message.  Bronze keeps
them (``POSITION_COLUMNS``, behind the audited columns), and keep-latest
uses them for messages of one ingest time.

How many messages a micro-batch read, admitted and dropped is observed
while it runs; ``admission_counts`` reads it from the query's progress.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillscope import schema as S
from tillscope.sources.messages import decode_messages, has_position

CLUSTER_BUCKETS = 8
TRIGGER_INTERVAL = "30 seconds"
#: folders a task writes side by side; only beyond them are its rows sorted by folder first
OPEN_FOLDERS = 4
ADMISSION = "admission"  # name of the observed metrics


def kafka_source(spark: SparkSession, bootstrap_servers: str, topic: str,
                 starting_offsets: str = "latest",
                 max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool = True) -> DataFrame:
    """Broker topic as a streaming frame (needs the Kafka connector on the classpath)."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def file_message_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                        fmt: str = "parquet") -> DataFrame:
    """Directory of message files (key, value, timestamp) as a streaming frame."""
    reader = spark.readStream.format(fmt).schema(S.RAW_MESSAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def _clock(clock: _dt.datetime | Column | None) -> Column:
    if clock is None:
        return F.current_timestamp()
    if isinstance(clock, Column):
        return clock
    return F.lit(clock).cast("timestamp")


#: the date partitions, of a parsed event time
EVENT_DATE = {"year": F.year, "month": F.month, "day": F.dayofmonth}


def _event_time(decoded: DataFrame) -> DataFrame:
    return decoded.withColumn("transaction_ts", F.try_to_timestamp(F.col("transaction_ts")))


def _lineage(rows: DataFrame, clock: _dt.datetime | Column | None) -> DataFrame:
    return rows.withColumns(
        {
            **{name: part("transaction_ts") for name, part in EVENT_DATE.items()},
            "ingested_at": _clock(clock),
            "pipeline_name": F.lit(S.PIPELINE_NAME),
            "source_system": F.lit(S.SOURCE_SYSTEM),
            "data_layer": F.lit(S.LAYER_BRONZE),
        }
    )


def enrich(decoded: DataFrame, clock: _dt.datetime | Column | None = None) -> DataFrame:
    """Event time parsed (NULL on bad text), date partitions and lineage columns."""
    return _lineage(_event_time(decoded), clock)


def is_admitted() -> Column:
    return F.col("transaction_id").isNotNull() & F.col("store_id").isNotNull() & F.col("total_amount").isNotNull()


def admit(df: DataFrame) -> DataFrame:
    """Bronze admission: id, store and total all present (malformed messages drop here)."""
    return df.filter(is_admitted())


def ingest(raw: DataFrame, clock: _dt.datetime | Column | None = None, observed: str | None = None,
           deal: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Raw messages → admitted Bronze rows in ``BRONZE_COLUMNS`` order (batch or stream), then the topic position if there is one.

    With ``observed``, messages read and admitted are observed under that name.
    ``deal`` moves the admitted rows before the columns that follow from
    them, or are the same in all rows, join them.
    """
    rows = _event_time(decode_messages(raw))
    if observed:
        rows = rows.observe(observed, F.count(F.lit(1)).alias("n_read"), F.count_if(is_admitted()).alias("n_admitted"))
    rows = deal(admit(rows)) if deal else admit(rows)
    return _lineage(rows, clock).select(*S.BRONZE_COLUMNS, *(S.POSITION_COLUMNS if has_position(raw) else []))


def admission_counts(query: StreamingQuery) -> list[dict[str, int]]:
    """batch, n_read, n_admitted, n_dropped of the query's recent micro-batches that read something (Spark keeps the last 100).

    A task that runs again after a lost executor may be counted again; the
    admitted rows themselves are in Bronze once.
    """
    out = []
    for progress in query.recentProgress:
        seen = (progress.observedMetrics or {}).get(ADMISSION)
        if seen is not None and seen["n_read"]:
            out.append({"batch": progress.batchId, "n_read": seen["n_read"], "n_admitted": seen["n_admitted"], "n_dropped": seen["n_read"] - seen["n_admitted"]})
    return out


def start_ingest(raw_stream: DataFrame, bronze_path: str, checkpoint_path: str,
                 trigger: dict | None = None,
                 partition_by: list[str] | None = None,
                 cluster_by_partition: int = CLUSTER_BUCKETS,
                 query_name: str | None = None) -> StreamingQuery:
    """Start the append-only Bronze sink.

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (default: every
    30 seconds; ``{"availableNow": True}`` drains and stops).  With
    ``cluster_by_partition=k`` each micro-batch is hash-partitioned on the
    partition columns plus a salt of ``k`` buckets, so a Bronze folder gets
    at most ``k`` files per batch instead of one per task, and a hot store
    or day is still spread over ``k`` tasks.  The salt hashes the row's own
    id and receive time, so a retried task sends each row to the same place.
    Raise ``k`` for a backfill whose hottest folder holds more than ``k``
    tasks should write; 0 writes from every task into every folder it meets.
    """
    partition_by = partition_by or S.BRONZE_PARTITION_COLUMNS

    def deal(rows: DataFrame) -> DataFrame:
        salt = F.pmod(F.xxhash64("transaction_id", "kafka_received_at"), F.lit(int(cluster_by_partition)))
        places = [EVENT_DATE[c]("transaction_ts") if c in EVENT_DATE else F.col(c) for c in partition_by if c in EVENT_DATE or c in rows.columns]
        return rows.repartition(*places, salt)

    bronze = ingest(raw_stream, observed=ADMISSION, deal=deal if cluster_by_partition else None)
    writer = (bronze.writeStream.format("parquet").outputMode("append")
              .option("path", bronze_path)
              .option("checkpointLocation", checkpoint_path)
              .partitionBy(*partition_by)
              .trigger(**(trigger or {"processingTime": TRIGGER_INTERVAL})))
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()


def drain(raw_stream: DataFrame, bronze_path: str, checkpoint_path: str, partition_by: list[str], **options) -> StreamingQuery:
    """``start_ingest`` over all there is, until it is written, into few folders.

    A task's share of few folders is large, and to sort it by folder spills.
    So tasks write up to ``OPEN_FOLDERS`` folders side by side (Spark sorts
    what is beyond them); the session's own setting comes back afterwards.
    """
    conf, setting = raw_stream.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(setting, None)
    conf.set(setting, OPEN_FOLDERS)
    try:
        query = start_ingest(raw_stream, bronze_path, checkpoint_path, trigger={"availableNow": True}, partition_by=partition_by, **options)
        query.awaitTermination()
        return query
    finally:
        if before is None:
            conf.unset(setting)
        else:
            conf.set(setting, before)
