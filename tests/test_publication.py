"""Publication of versions and runs: cut writes, retries, failures between two tables, reading as of a version, run or instant, names."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.test_rules import T0, _bronze
from tillscope import schema as S
from tillscope.operators import profile, silver
from tillscope.operators.dedup import dedup_latest, dedup_latest_counted
from tillscope.operators.silver import read_rejects, read_silver, run_silver, silver_flagged, silver_history, silver_run_summary
from tillscope.plans import pipeline
from tillscope.plans.pipeline import declared_source, publish_views, read_mart, run_pipeline
from tillscope.sources import versions
from tillscope.sources.bronze import read_bronze
from tillscope.sources.posview import POS_TIEBREAK, pos_view
from tillscope.sources.versions import read_version, version_counts, version_history, write_version
from tillscope.streaming.ingest import admission_counts, file_message_source, ingest, start_ingest

FOUR = [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def _ids(df):
    return sorted(r[0] for r in df.collect())


def test_cut_write_is_invisible_and_its_retry_is_not_doubled(spark, scratch, monkeypatch):
    rows = spark.createDataFrame(FOUR, "id int, v string")
    assert write_version(rows.where("id <= 2"), scratch, mode="overwrite", partition_by=["v"]) == 0
    whole = versions.write_files

    def cut(df, path, partition_by=()):
        whole(df.where("id = 3"), path, partition_by)  # one folder is in place when the write ends
        raise RuntimeError("lost")

    monkeypatch.setattr(versions, "write_files", cut)
    with pytest.raises(RuntimeError):
        write_version(rows.where("id > 2"), scratch, partition_by=["v"], token="batch 7")
    assert _ids(read_version(spark, scratch, rows.schema)) == [1, 2]
    monkeypatch.setattr(versions, "write_files", whole)
    assert write_version(rows.where("id > 2"), scratch, partition_by=["v"], token="batch 7") == 1
    assert _ids(read_version(spark, scratch, rows.schema)) == [1, 2, 3, 4]
    # a retry after the publication, with its caller's token, adds nothing
    assert write_version(rows.where("id > 2"), scratch, partition_by=["v"], token="batch 7") == 1
    assert _ids(read_version(spark, scratch, rows.schema)) == [1, 2, 3, 4]
    assert [(r.version, r.n_rows) for r in version_history(spark, scratch).collect()] == [(1, 2), (0, 2)]
    assert sorted(tuple(r) for r in version_counts(spark, scratch).collect()) == [(0, 2), (1, 4)]
    first = version_history(spark, scratch).where("version = 0").first().written_at
    assert _ids(read_version(spark, scratch, rows.schema, at=first)) == [1, 2]
    with pytest.raises(FileNotFoundError):
        read_version(spark, scratch, rows.schema, at=first - dt.timedelta(days=1))


def test_run_that_fails_between_its_two_writes_changes_neither_table(spark, scratch, monkeypatch):
    s, r = f"{scratch}/silver", f"{scratch}/rejects"
    one = _bronze(spark, [("x", "NL-001", 1, 1.0, 1.0, False), ("bad", "NL-001", 1, 1.0, -1.0, False)])
    two = _bronze(spark, [("y", "NL-002", 1, 1.0, 1.0, False), ("worse", "NL-001", 1, 1.0, -1.0, False)])
    run_silver(spark, one, s, r, clock=T0)
    rejects = silver.silver_rejects

    def fails(flagged):
        raise RuntimeError("lost between the writes")

    monkeypatch.setattr(silver, "silver_rejects", fails)
    with pytest.raises(RuntimeError):
        run_silver(spark, two, s, r, clock=T0)
    assert _ids(read_silver(spark, s)) == ["x"] and _ids(read_rejects(spark, r)) == ["bad"]
    monkeypatch.setattr(silver, "silver_rejects", rejects)
    run_silver(spark, two, s, r, clock=T0)
    assert _ids(read_silver(spark, s)) == ["y"] and _ids(read_rejects(spark, r)) == ["worse"]
    history = silver_history(spark, s).collect()
    assert [(h.version, h.n_rows, h["mode"]) for h in history] == [(1, 1, "Overwrite"), (0, 1, "Overwrite")]
    first = history[1]
    for as_of in ({"version": 0}, {"run": first.run}, {"at": first.written_at}):
        assert _ids(read_silver(spark, s, **as_of)) == ["x"] and _ids(read_rejects(spark, r, **as_of)) == ["bad"]
    with pytest.raises(FileNotFoundError):
        read_silver(spark, s, run="none")


def test_chain_publishes_all_tables_at_once_and_names_move_after_it(spark, scratch, monkeypatch):
    good = _bronze(spark, [("x", "NL-001", 1, 1.0, 1.0, False)])
    more = _bronze(spark, [("x", "NL-002", 1, 1.0, 1.0, False), ("n", "NL-002", 1, 1.0, -1.0, False)])
    run_pipeline(spark, good, scratch, clock=T0)
    publish_views(spark, scratch, "pub_")
    real = pipeline.model_test_report

    def fails(models):
        raise RuntimeError("lost before the last table")

    monkeypatch.setattr(pipeline, "model_test_report", fails)
    with pytest.raises(RuntimeError):
        run_pipeline(spark, more, scratch, clock=T0)
    monkeypatch.setattr(pipeline, "model_test_report", real)
    publish_views(spark, scratch, "pub_")

    def stores():
        return [declared_source(spark, "pub_silver").first().store_id, spark.table("pub_fct_daily_sales").first().store_id,
                spark.table("pub_dim_stores").first().store_id, read_mart(spark, f"{scratch}/gold", "dim_stores").first().store_id,
                read_silver(spark, f"{scratch}/silver").first().store_id]

    assert stores() == ["NL-001"] * 5 and spark.table("pub_rejects").count() == 0 and read_rejects(spark, f"{scratch}/rejects").count() == 0
    run_pipeline(spark, more, scratch, clock=T0)
    assert spark.table("pub_dim_stores").first().store_id == "NL-001"  # published, not yet under its name
    publish_views(spark, scratch, "pub_")
    assert stores() == ["NL-002"] * 5 and spark.table("pub_rejects").count() == 1
    assert read_mart(spark, f"{scratch}/gold", "dim_stores", version=0).first().store_id == "NL-001"
    with pytest.raises(ValueError, match="unit_price"):
        declared_source(spark, "pub_dim_products", S.SILVER_SCHEMA)
    # Silver of the chain stays with the chain's ledger when its job runs alone
    run_silver(spark, good, f"{scratch}/silver", f"{scratch}/rejects", clock=T0)
    assert read_silver(spark, f"{scratch}/silver").first().store_id == "NL-001" and stores()[3] == "NL-002"


def test_counted_dedup_equals_the_window(spark):
    rows = [(f"t{i % 9}" if i % 10 else None, "NL-001", i % 4, 1.0, float(i % 6), False) for i in range(300)]
    bronze = _bronze(spark, rows).withColumn("ingested_at", F.when(F.col("quantity") == 3, None).otherwise(F.timestamp_seconds(F.lit(5) + F.col("quantity") % 2)))
    for tiebreak in ([], ["total_amount", "quantity"]):
        if tiebreak:
            bronze = bronze.dropDuplicates(["transaction_id", "ingested_at", *tiebreak])
        got = dedup_latest_counted(bronze.repartition(5), ["transaction_id"], ["ingested_at"], tiebreak)
        want = dedup_latest(bronze, ["transaction_id"], ["ingested_at"], tiebreak)
        assert sorted(map(str, got.drop("copies").collect())) == sorted(map(str, want.collect()))
        assert got.agg(F.sum("copies")).first()[0] == bronze.count()
    with pytest.raises(TypeError):
        dedup_latest_counted(bronze, ["transaction_id"], ["store_id"])
    plan = silver_run_summary(_bronze(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "CollectMetrics" not in plan and plan.count("Exchange hashpartitioning") == 1


def _message(tid, total):
    return json.dumps({"transaction_id": tid, "store_id": "NL-001", "quantity": 1, "unit_price": total, "total_amount": total}).encode()


def test_later_topic_position_wins_at_one_ingest_time(spark, scratch):
    raw = spark.createDataFrame([(None, _message("a", 1.0), T0, 0, 41), (None, _message("a", 2.0), T0, 0, 42), (None, _message("a", 3.0), T0, 0, 7)],
                                "key binary, value binary, timestamp timestamp, partition int, offset long")
    bronze = ingest(raw, clock=T0)
    assert bronze.columns == [*S.BRONZE_COLUMNS, *S.POSITION_COLUMNS]
    for counted in (False, True):
        assert [r.total_amount for r in silver_flagged(bronze, clock=T0, counted=counted).collect()] == [2]
        # without positions the content decides, as before
        assert [r.total_amount for r in silver_flagged(bronze.drop(*S.POSITION_COLUMNS), clock=T0, counted=counted).collect()] == [1]
    bronze.write.partitionBy("year").parquet(f"{scratch}/bronze")
    assert [r.total_amount for r in silver_flagged(read_bronze(spark, f"{scratch}/bronze", with_position=True), clock=T0).collect()] == [2]
    assert read_bronze(spark, f"{scratch}/bronze").columns == S.BRONZE_COLUMNS


def test_admitted_and_dropped_add_up_per_micro_batch(spark, scratch):
    values = [_message(f"t{i}", 1.0) for i in range(12)] + [b"garbage", b"[1]", _message(None, 1.0)]
    spark.createDataFrame([(None, v, T0) for v in values], S.RAW_MESSAGE_SCHEMA).repartition(3).write.parquet(f"{scratch}/topic")
    q = start_ingest(file_message_source(spark, f"{scratch}/topic", max_files_per_trigger=1), f"{scratch}/bronze", f"{scratch}/ckpt", trigger={"availableNow": True})
    q.awaitTermination()
    counts = admission_counts(q)
    assert len(counts) == 3 and all(c["n_read"] == c["n_admitted"] + c["n_dropped"] for c in counts)
    assert sum(c["n_read"] for c in counts) == 15 and sum(c["n_admitted"] for c in counts) == 12 == read_bronze(spark, f"{scratch}/bronze").count()
    # a source without positions: Bronze has none, and reads as NULL
    assert read_bronze(spark, f"{scratch}/bronze", with_position=True).where("kafka_offset IS NULL").count() == 12


def test_reports_agree_with_the_single_checks_and_scan_once(spark, scratch):
    pos_view(spark, SF_SMALL).select(*S.BRONZE_COLUMNS).write.parquet(f"{scratch}/bronze")
    bronze = spark.read.parquet(f"{scratch}/bronze")
    seen = []

    def watched(rows, groups, *aggregates):
        plan = rows.withColumn("_group", F.lit(1))._jdf.queryExecution().executedPlan().toString()
        seen.append(plan.count("FileScan"))
        return grouped(rows, groups, *aggregates)

    grouped, profile._grouped = profile._grouped, watched
    try:
        report = profile.bronze_report(bronze)
        found = {}
        for r in report.collect():
            found.setdefault(r.section, []).append((r.item, r.n, r.percentage, r.revenue_eur, r.avg_basket_eur))
    finally:
        profile._grouped = grouped
    assert seen == [1] and "FileScan" not in report._jdf.queryExecution().executedPlan().toString()
    assert found["row_count"] == [("total_rows", 6000, None, None, None)]
    assert {i: n for i, n, *_ in found["null_check"]} == profile.profile_nulls(bronze).first().asDict()
    for column in ("audit_flag", "payment_method"):
        want = {(r[column], r["count"], r.percentage) for r in profile.distribution(bronze, column).collect()}
        assert {x[:3] for x in found[column]} == want
    assert {(i, n, rev, avg) for i, n, _, rev, avg in found["top_stores"]} == {tuple(r) for r in profile.top_stores_by_revenue(bronze).collect()}


def test_reports_of_empty_tables_and_odd_ids(spark):
    empty = spark.createDataFrame([], S.BRONZE_SCHEMA)
    assert {(r.section, r.item, r.n) for r in profile.bronze_report(empty).collect()} == {
        ("row_count", "total_rows", 0), ("null_check", "transaction_id", 0), ("null_check", "store_id", 0), ("null_check", "total_amount", 0)}
    assert sum(r.n for r in profile.silver_report(empty).collect()) == 0
    rows = _bronze(spark, [(None, "NL-001", 1, 1.0, 1.0, False), (None, "NL-001", 1, 1.0, 2.0, False), ("a", "NL-001", 1, 1.0, -1.0, False)])
    got = {r.section: r.n for r in profile.silver_report(rows).collect()}
    assert got == {"row_count": 3, "duplicates": 1, "total_mismatches": 2, "negative_amounts": 1, "audit_flag": 3}
    assert profile.check_duplicates(rows).first().duplicates == 1


def test_counts_of_the_small_bronze(spark):
    assert tuple(silver_run_summary(pos_view(spark, SF_SMALL), tiebreak=POS_TIEBREAK).first()) == (6000, 1406, 4280, 314)
