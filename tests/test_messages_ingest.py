"""Decode outcomes (FIXTURES.md §4.1), encode round trip, stream = batch, restart adds nothing."""

import datetime as dt

from pyspark.sql import functions as F

from tillscope import schema as S
from tillscope.sources.bronze import read_bronze
from tillscope.sources.messages import decode_messages, encode_messages
from tillscope.streaming.ingest import file_message_source, ingest, start_ingest

FULL = ('{"transaction_id":"t1","store_id":"NL-001","terminal_id":"POS-01","cashier_id":"EMP-1",'
        '"product_id":"PROD-00001","quantity":2,"unit_price":1.5,"total_amount":3.0,'
        '"payment_method":"CARD","transaction_ts":"2026-06-19T14:30:00.123456","is_voided":false,'
        '"audit_flag":"VALID","extra":1}')
TS = dt.datetime(2026, 6, 19, 15, 0)


def _raw(spark, values):
    return spark.createDataFrame([(None, v.encode() if v is not None else None, TS) for v in values],
                                 S.RAW_MESSAGE_SCHEMA)


def test_decode_outcomes(spark):
    bad_field = FULL.replace('"quantity":2', '"quantity":"x"')
    num_id = FULL.replace('"transaction_id":"t1"', '"transaction_id":7')
    bad_ts = FULL.replace('2026-06-19T14:30:00.123456', 'x')
    rows = decode_messages(_raw(spark, [FULL, "garbage", "[1]", None, bad_field, num_id, bad_ts])).collect()
    assert rows[0].transaction_id == "t1" and rows[0].quantity == 2 and rows[0].kafka_received_at == TS
    for r in rows[1:4]:
        assert all(r[c] is None for c in S.MESSAGE_FIELDS)
    assert rows[4].quantity is None and rows[4].transaction_id == "t1"
    assert rows[5].transaction_id == "7"
    bronze = ingest(_raw(spark, [FULL, "garbage", bad_ts]), clock=TS).collect()
    assert len(bronze) == 2
    by_ts = {r.transaction_ts is None: r for r in bronze}
    assert by_ts[True].year is None and by_ts[False].year == 2026
    assert by_ts[False].transaction_ts == dt.datetime(2026, 6, 19, 14, 30, 0, 123456)


def test_encode_roundtrip_keeps_microseconds_and_nulls(spark):
    ts = dt.datetime(2026, 6, 19, 14, 30, 0, 123456)
    df = spark.createDataFrame(
        [("t1", "NL-001", "", "EMP-1", "P", 1, 1.0, 1.0, "CARD", ts, False, None, TS)],
        "transaction_id string, store_id string, terminal_id string, cashier_id string, product_id string, "
        "quantity int, unit_price double, total_amount double, payment_method string, transaction_ts timestamp, "
        "is_voided boolean, audit_flag string, kafka_received_at timestamp")
    enc = encode_messages(df)
    (key,) = enc.select(F.col("key").cast("string")).first()
    assert key == "NL-001"
    (row,) = ingest(enc, clock=TS).collect()
    assert row.transaction_ts == ts and row.audit_flag is None and row.terminal_id == ""


def test_stream_equals_batch_and_restart_adds_nothing(spark, scratch):
    msgs = [FULL.replace('"t1"', f'"t{i}"').replace("NL-001", f"NL-00{i % 3}") for i in range(20)]
    raw = _raw(spark, msgs + ["garbage"])
    raw.repartition(4).write.parquet(f"{scratch}/topic")
    src = file_message_source(spark, f"{scratch}/topic", max_files_per_trigger=1)
    q = start_ingest(src, f"{scratch}/bronze", f"{scratch}/ckpt", trigger={"availableNow": True})
    q.awaitTermination()
    streamed = read_bronze(spark, f"{scratch}/bronze").drop("ingested_at")
    batch = ingest(raw).drop("ingested_at")
    assert sorted(streamed.collect()) == sorted(batch.collect())
    assert streamed.count() == 20
    # the audited layout: event date, then store
    assert any(p.startswith("store_id=") for p in _listdirs(spark, f"{scratch}/bronze/year=2026/month=6/day=19"))
    # restart: nothing new
    q2 = start_ingest(file_message_source(spark, f"{scratch}/topic", max_files_per_trigger=1),
                      f"{scratch}/bronze", f"{scratch}/ckpt", trigger={"availableNow": True})
    q2.awaitTermination()
    assert read_bronze(spark, f"{scratch}/bronze").count() == 20
    # a new file adds only its rows
    _raw(spark, [FULL.replace('"t1"', '"new"')]).write.mode("append").parquet(f"{scratch}/topic")
    q3 = start_ingest(file_message_source(spark, f"{scratch}/topic"), f"{scratch}/bronze", f"{scratch}/ckpt",
                      trigger={"availableNow": True})
    q3.awaitTermination()
    assert read_bronze(spark, f"{scratch}/bronze").count() == 21


def test_pruned_bronze_scan(spark, scratch):
    msgs = [FULL.replace('"t1"', f'"t{i}"').replace("NL-001", f"NL-00{i % 3}") for i in range(6)]
    ingest(_raw(spark, msgs), clock=TS).write.partitionBy(*S.BRONZE_PARTITION_COLUMNS).parquet(scratch)
    df = read_bronze(spark, scratch, date_from=dt.date(2026, 6, 19), date_to=dt.date(2026, 6, 19),
                     stores=["NL-001"])
    assert df.columns == S.BRONZE_COLUMNS and df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "store_id" in plan


def _listdirs(spark, path):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p)]


def test_bronze_batch_audited_layout_null_partitions(spark, scratch):
    from tests.conftest import SF_SMALL
    from tillscope.sources.bronze import write_bronze_batch
    from tillscope.sources.posview import pos_view

    pos = pos_view(spark, SF_SMALL).select(*S.BRONZE_COLUMNS)
    write_bronze_batch(pos, scratch)          # year/month/day/store_id, as the stream sink
    back = read_bronze(spark, scratch)
    assert back.columns == S.BRONZE_COLUMNS
    assert back.count() == 6000
    assert back.filter(F.col("store_id").isNull()).count() == pos.filter(F.col("store_id").isNull()).count() > 0
    assert sorted(back.collect(), key=repr) == sorted(pos.collect(), key=repr)


def test_decode_type_mismatch_fields_are_null_and_row_dropped(spark):
    odd = FULL.replace('"quantity":2', '"quantity":1.5').replace('"total_amount":3.0', '"total_amount":"2.5"')
    (row,) = decode_messages(_raw(spark, [odd])).collect()
    assert row.quantity is None and row.total_amount is None and row.transaction_id == "t1"
    assert ingest(_raw(spark, [odd]), clock=TS).count() == 0
