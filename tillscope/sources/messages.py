"""Keyed JSON messages: encode rows for a topic, decode a topic's frame.

Decode is PERMISSIVE ``from_json`` with the fixed message schema: a
malformed value gives an all-NULL struct, a single bad field gives NULL
in that field only, missing keys are NULL and extra keys are ignored.
Encode keys each message by store (per-store ordering on the topic) and
writes ``transaction_ts`` as ISO text with microseconds, so nothing is
lost in the round trip (``to_json`` alone would cut to milliseconds).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope import schema as S

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def encode_messages(df: DataFrame, received_at: str | None = "kafka_received_at") -> DataFrame:
    """Rows → (key, value, timestamp): key = store_id bytes, value = JSON bytes."""
    fields = []
    for name in S.MESSAGE_FIELDS:
        c = F.col(name)
        if name == "transaction_ts" and dict(df.dtypes).get(name) != "string":
            c = F.date_format(c, ISO_MICROS)
        elif name in ("unit_price", "total_amount"):
            c = c.cast("double")
        fields.append(c.alias(name))
    ts = F.col(received_at) if received_at and received_at in df.columns else F.current_timestamp()
    return df.select(
        F.col("store_id").cast("binary").alias("key"),
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
        ts.cast("timestamp").alias("timestamp"),
    )


def has_position(raw: DataFrame) -> bool:
    """Whether the source tells where a message stood in its topic (columns ``partition`` and ``offset``)."""
    return {"partition", "offset"} <= set(raw.columns)


def decode_messages(raw: DataFrame, with_key: bool = False) -> DataFrame:
    """(key, value, timestamp) → the 12 message fields + kafka_received_at (+ the topic position, if the source tells it).

    The value is parsed once.  The parsed struct is expanded through a
    generator (``inline`` of a one-element array) rather than a projection:
    a later filter on the fields (Bronze admission) cannot be pushed beneath
    a generator, whereas beneath a projection it would re-parse the text
    once per tested field.  A NULL or malformed value still yields one row
    of NULLs.  ``with_key`` also returns the key as text (``message_key``).
    """
    data = F.from_json(F.col("value").cast("string"), S.MESSAGE_SCHEMA)
    key = [F.col("key").cast("string").alias("message_key")] if with_key else []
    position = [F.col("offset").cast("bigint").alias("kafka_offset"), F.col("partition").cast("int").alias("kafka_partition")] if has_position(raw) else []
    expanded = raw.select(*key, *position, F.col("timestamp").alias("kafka_received_at"), F.inline(F.array(data)))
    return expanded.select(*(["message_key"] if with_key else []), *S.MESSAGE_FIELDS, "kafka_received_at", *(S.POSITION_COLUMNS if position else []))


def publish_messages(df: DataFrame, fmt: str = "kafka", topic: str | None = None,
                     bootstrap_servers: str | None = None, path: str | None = None,
                     mode: str = "append") -> None:
    """Write encoded messages: to a broker topic (``fmt="kafka"``, connector needed) or as files.

    Per-store ordering comes from the key: the broker routes one key to one
    partition.  No driver-side send loop; every executor writes its part.
    """
    msgs = encode_messages(df).select("key", "value")
    if fmt == "kafka":
        (msgs.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
         .option("topic", topic).save())
    else:
        encode_messages(df).write.mode(mode).format(fmt).save(path)
