"""What the chain moves: narrow rows through keep-latest, rows clustered once for several versions, no constants through the stream's shuffle."""

import datetime as dt
import json
from pathlib import Path

from pyspark.sql import functions as F

from tests.test_quality_gold import ODD_TEXT
from tests.test_rules import T0, _bronze
from tillscope import schema as S
from tillscope.operators.dedup import dedup_latest, dedup_latest_counted
from tillscope.operators.silver import read_silver, run_silver, silver_flagged, silver_run_summary
from tillscope.sources import csv_export, versions
from tillscope.sources.bronze import read_bronze
from tillscope.sources.posview import POS_TIEBREAK, pos_bronze, pos_rows, pos_view
from tillscope.sources.versions import read_version, write_version
from tillscope.streaming import ingest as stream
from tillscope.streaming.ingest import OPEN_FOLDERS, admission_counts, drain, file_message_source, ingest

LINE = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_shipdate timestamp_ntz"


def _source(spark, path):
    """Source tables with repeated keys, null keys and null values."""
    day = dt.datetime(1995, 6, 17)
    lines = [(o, p, (p or 0) % 7, n, float(q) if q else None, flag, day + dt.timedelta(days=(o or 0) % 5) if o != 2 else None)
             for o in (1, 2, 3, 61, 997, None) for p in (1, 37, 41, 53, 89, None) for n, q, flag in ((1, 3, "R"), (3, 5, "R"), (3, None, "N"))]
    spark.createDataFrame(lines + lines[:9], LINE).write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(o, day if o % 2 else None, pr) for o, pr in ((1, "1-URGENT"), (2, None), (3, "5-LOW"), (3, "2-HIGH"), (61, "9"), (997, "1-URGENT"))],
                          "o_orderkey long, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame([(p, 900.0 + p if p != 41 else None) for p in (1, 37, 41, 53, 89)], "p_partkey long, p_retailprice double").write.parquet(f"{path}/part.parquet")
    return path


def _message(tid, total):
    return json.dumps({"transaction_id": tid, "store_id": "NL-001", "quantity": 1, "unit_price": total, "total_amount": total,
                       "transaction_ts": f"199{len(tid or '')}-05-06T01:02:03.000004"}).encode()


def _rows(df):
    return sorted(map(str, df.drop("silver_processed_at").collect()))


def test_derived_after_keep_latest_equals_derived_before(spark, scratch):
    d = _source(spark, f"{scratch}/sf")
    bronze = pos_view(spark, d)
    assert bronze.columns == [*S.BRONZE_COLUMNS, *POS_TIEBREAK] and bronze.count() > 50
    for counted in (False, True):
        late = silver_flagged(pos_rows(spark, d), clock=T0, tiebreak=POS_TIEBREAK, counted=counted, derive=pos_bronze)
        early = silver_flagged(bronze, clock=T0, tiebreak=POS_TIEBREAK, counted=counted)
        assert late.dtypes == early.dtypes
        # rows alike in every deciding column may differ in their quantity: both keep one of each id
        assert sorted(map(str, late.select("transaction_id").collect())) == sorted(map(str, early.select("transaction_id").collect()))
    summary = silver_run_summary(pos_rows(spark, d), tiebreak=POS_TIEBREAK, derive=pos_bronze).first()
    assert summary == silver_run_summary(bronze, tiebreak=POS_TIEBREAK).first() and summary.bronze_read == bronze.count()
    counts = run_silver(spark, pos_rows(spark, d), f"{scratch}/silver", f"{scratch}/rejects", clock=T0, tiebreak=POS_TIEBREAK, derive=pos_bronze)
    assert counts == summary.asDict() and read_silver(spark, f"{scratch}/silver").count() == counts["valid"]
    # without rows that are alike in all that decides, all values agree
    rows = pos_rows(spark, d).dropDuplicates(["transaction_id", "ingested_at", *POS_TIEBREAK]).localCheckpoint()
    want = _rows(silver_flagged(pos_bronze(rows), clock=T0, tiebreak=POS_TIEBREAK))
    assert want == _rows(silver_flagged(rows, clock=T0, tiebreak=POS_TIEBREAK, derive=pos_bronze))
    assert want == _rows(silver_flagged(rows, clock=T0, tiebreak=POS_TIEBREAK, counted=True, derive=pos_bronze).drop("copies"))


def test_queries_move_narrow_rows_through_keep_latest(spark, scratch):
    from tillscope.plans import catalog

    d = _source(spark, f"{scratch}/sf")
    for query in (catalog.q_silver_valid, catalog.q_silver_run_summary):
        plan = query(spark, d)._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.index("Exchange hashpartitioning(transaction_id"):]
        assert "T-" in below and "PROD-" not in below and "EMP-" not in below


def test_counted_keep_latest_holds_deciding_columns_once_and_takes_maps(spark):
    rows = _bronze(spark, [(f"t{i % 5}" if i % 7 else None, "NL-001", i % 4, 1.0, float(i % 6), None if i % 3 else True) for i in range(60)])
    rows = rows.withColumn("ingested_at", F.when(F.col("quantity") == 3, None).otherwise(F.timestamp_seconds(F.lit(5) + F.col("quantity") % 2)))
    got = dedup_latest_counted(rows.repartition(4), ["transaction_id"], ["ingested_at"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "min_by" not in plan
    assert sorted(map(str, got.drop("copies").collect())) == sorted(map(str, dedup_latest(rows, ["transaction_id"], ["ingested_at"]).collect()))
    mapped = rows.withColumn("props", F.create_map(F.lit("q"), F.col("quantity")))
    got = dedup_latest_counted(mapped, ["transaction_id"], ["ingested_at"])
    assert got.columns == [*mapped.columns, "copies"] and got.agg(F.sum("copies")).first()[0] == 60
    assert sorted(map(str, got.drop("copies").collect())) == sorted(map(str, dedup_latest(mapped, ["transaction_id"], ["ingested_at"]).collect()))


def test_clustered_versions_are_written_without_a_shuffle(spark, scratch, monkeypatch):
    seen, whole = [], versions.write_files

    def watched(df, path, partition_by=()):
        seen.append("RebalancePartitions" in df._jdf.queryExecution().optimizedPlan().toString())
        whole(df, path, partition_by)

    monkeypatch.setattr(versions, "write_files", watched)
    spark.range(60).select("id", (F.col("id") % 3).alias("year")).union(spark.createDataFrame([(99, None)], "id long, year long")).write.parquet(f"{scratch}/rows")
    rows = spark.read.parquet(f"{scratch}/rows")
    for clustered in (True, False):
        path = f"{scratch}/versions-{clustered}"
        assert write_version(rows.where("id < 30"), path, mode="overwrite", partition_by=["year"], clustered=clustered) == 0
        assert write_version(rows.where("id >= 30"), path, partition_by=["year"], clustered=clustered) == 1
        assert sorted(r.id for r in read_version(spark, path, rows.schema).collect()) == [*range(60), 99]
        assert sorted(r.id for r in read_version(spark, path, rows.schema, 0).collect()) == [*range(30)]
    assert seen == [False, False, True, True]


def test_snapshots_cluster_silver_once(spark, scratch, monkeypatch):
    from tillscope.plans import catalog

    plans, whole = [], versions.write_files

    def watched(df, path, partition_by=()):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        whole(df, path, partition_by)

    monkeypatch.setattr(versions, "write_files", watched)
    d = _source(spark, f"{scratch}/sf")
    # Silver with rows before and after the split year
    silver = spark.range(9).select(*[(1994 + F.col("id") % 3 if f.name == "year" else F.lit(None)).cast(f.dataType).alias(f.name) for f in S.SILVER_SCHEMA.fields])
    monkeypatch.setattr(catalog, "_silver", lambda spark, d: silver)
    assert catalog.q_snapshot_read_latest(spark, d).count() == 9 and catalog.q_snapshot_read_version(spark, d).count() == 6
    assert len(plans) == 6 and not any("RebalancePartitions" in p for p in plans)


def test_stream_moves_no_lineage_and_few_folders_are_not_sorted(spark, scratch, monkeypatch):
    values = [_message(f"t{i}" if i % 5 else None, 1.0) for i in range(40)] + [b"garbage"]
    raw = spark.createDataFrame([("k".encode(), v, T0 + dt.timedelta(days=400 * (i % 3))) for i, v in enumerate(values)], S.RAW_MESSAGE_SCHEMA)
    raw.repartition(3).write.parquet(f"{scratch}/topic")
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before, during, start = spark.conf.get(setting, None), [], stream.start_ingest

    def watched(*args, **options):
        during.append(spark.conf.get(setting, None))
        return start(*args, **options)

    monkeypatch.setattr(stream, "start_ingest", watched)
    q = drain(file_message_source(spark, f"{scratch}/topic"), f"{scratch}/bronze", f"{scratch}/ckpt", partition_by=["year"], cluster_by_partition=2)
    assert spark.conf.get(setting, None) == before
    (counts,) = admission_counts(q)
    assert (counts["n_read"], counts["n_admitted"], counts["n_dropped"]) == (41, 32, 9)
    rows = read_bronze(spark, f"{scratch}/bronze")
    assert rows.count() == 32 and rows.where("data_layer = 'BRONZE' and pipeline_name is not null and ingested_at is not null").count() == 32
    want = ingest(spark.read.parquet(f"{scratch}/topic")).drop("ingested_at")
    assert sorted(map(str, rows.drop("ingested_at").collect())) == sorted(map(str, want.collect()))
    plan = q._jsq.explainInternal(False)
    above, dealt = plan.split("Initial Plan")[0].split("Exchange hashpartitioning(")
    assert S.PIPELINE_NAME in above and S.PIPELINE_NAME not in dealt and during == [str(OPEN_FOLDERS)]


def test_orders_join_last_so_that_copies_of_an_id_meet_before_the_shuffle(spark, scratch):
    plan = pos_rows(spark, _source(spark, f"{scratch}/sf"))._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join Inner" in x]
    assert len(joins) == 2 and "l_orderkey" in joins[0] and "l_partkey" in joins[1]


def _parts(path):
    """Names and bytes of the part files in a folder."""
    return {f.name: f.stat().st_size for f in Path(path.removeprefix("file:")).iterdir() if f.name.startswith("part-")}


def test_csv_export_query_takes_a_fraction_of_the_text(spark, scratch, monkeypatch):
    from tillscope.plans import catalog

    value = {"string": F.concat(F.lit("a\\n\n "), F.col("id") % 17), "timestamp": F.timestamp_micros(F.col("id") * 86_399_000_001), "boolean": F.col("id") % 2 == 0}
    silver = spark.range(500).select(*[F.when(F.col("id") % 19 != i, value.get(f.dataType.simpleString(), F.col("id") % 997)).cast(f.dataType).alias(f.name)
                                       for i, f in enumerate(S.SILVER_SCHEMA.fields)])
    monkeypatch.setattr(catalog, "_silver", lambda spark, d: silver)
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name: f"{scratch}/{name}")
    back = catalog.q_csv_export_roundtrip(spark, scratch)
    assert _rows(back) == _rows(catalog._doubles(silver)) and back.count() == 500
    csv_export.export_csv(silver, f"{scratch}/text")
    packed, text = _parts(f"{scratch}/csv-export"), _parts(f"{scratch}/text")
    assert all(name.endswith(".csv.gz") for name in packed) and all(name.endswith(".csv") for name in text)
    assert 3 * sum(packed.values()) < sum(text.values())


def test_compressed_csv_comes_back_exactly_from_files_of_bounded_rows(spark, scratch, monkeypatch):
    monkeypatch.setattr(csv_export, "COMPRESSED_ROWS", 5)
    kind = "id int, terminal_id string, audit_flag string, ts timestamp, amount double"
    rows = [(i, t, None if i % 2 else t, T0 + dt.timedelta(microseconds=i) if i % 3 else None, 1.25 * i) for i, t in enumerate(ODD_TEXT * 2)]
    for name, part in (("rows", rows), ("none", [])):
        df = spark.createDataFrame(part, kind).coalesce(1)
        csv_export.export_csv(df, f"{scratch}/{name}", compression="gzip")
        assert sorted(csv_export.read_csv_export(spark, f"{scratch}/{name}", df.schema).collect()) == sorted(df.collect())
    assert len(_parts(f"{scratch}/rows")) == -(-len(rows) // 5)
