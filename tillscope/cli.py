"""Command line: each stage of the audit chain as one Spark application.

    python -m tillscope.cli <command> [options]
    spark-submit tillscope/cli.py <command> [options]

Commands: ingest, silver, validate, gold, pipeline, profile, history, export-csv.
Settings that the audited scripts read from the environment are options
here.  The session comes from the launcher (master, resources, checkpoint
folder); nothing is hard-wired.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _session(app: str) -> SparkSession:
    spark = SparkSession.builder.appName(f"tillscope-{app}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")  # naive timestamp text is UTC, wherever the launcher runs
    return spark


def _print_df(df) -> None:
    for row in df.toLocalIterator():
        print(json.dumps(row.asDict(), default=str))


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tillscope")
    sub = p.add_subparsers(dest="cmd", required=True)

    ing = sub.add_parser("ingest", help="message stream -> Bronze (runs until stopped, or drains with --available-now)")
    ing.add_argument("--bronze", required=True)
    ing.add_argument("--checkpoint", required=True)
    ing.add_argument("--kafka-servers")
    ing.add_argument("--topic")
    ing.add_argument("--message-dir", help="directory of message files (key, value, timestamp) instead of a topic")
    ing.add_argument("--available-now", action="store_true")
    ing.add_argument("--starting-offsets", default="latest", help="where a first start begins (a checkpoint wins)")
    ing.add_argument("--max-per-trigger", type=int, help="records (topic) or files (directory) of a trigger; default: all there is")
    ing.add_argument("--trigger-interval", help="for example '30 seconds'")
    ing.add_argument("--tolerate-data-loss", action="store_true", help="go on where the topic has lost messages")
    ing.add_argument("--buckets", type=int, help="tasks that write one folder of a batch")
    ing.add_argument("--date-only", action="store_true", help="partition by date only (stores clustered in files)")

    sil = sub.add_parser("silver", help="Bronze -> Silver + Rejects (one Bronze scan)")
    sil.add_argument("--bronze", required=True)
    sil.add_argument("--silver", required=True)
    sil.add_argument("--rejects", required=True)
    sil.add_argument("--tiebreak", default="", help="comma-separated columns ordering equal ingest times")

    val = sub.add_parser("validate", help="expectation suite over Silver")
    val.add_argument("--silver", required=True)
    val.add_argument("--strict", action="store_true", help="exit 1 when a rule fails")

    gld = sub.add_parser("gold", help="staging view, marts and model tests from Silver")
    gld.add_argument("--silver", required=True)
    gld.add_argument("--out", required=True)
    gld.add_argument("--strict", action="store_true")

    pip = sub.add_parser("pipeline", help="silver -> validate -> gold in one application")
    pip.add_argument("--bronze", required=True)
    pip.add_argument("--out", required=True)
    pip.add_argument("--strict", action="store_true")

    his = sub.add_parser("history", help="published versions of Silver")
    his.add_argument("--silver", required=True)

    exp = sub.add_parser("export-csv", help="Silver as CSV (distributed write)")
    exp.add_argument("--silver", required=True)
    exp.add_argument("--out", required=True)

    pro = sub.add_parser("profile", help="verification report of a Bronze or Silver table")
    one = pro.add_mutually_exclusive_group(required=True)
    one.add_argument("--bronze")
    one.add_argument("--silver")

    a = p.parse_args(argv)
    spark = _session(a.cmd)

    if a.cmd == "ingest":
        from tillscope import schema as S
        from tillscope.streaming.ingest import CLUSTER_BUCKETS, file_message_source, kafka_source, start_ingest

        if a.message_dir:
            src = file_message_source(spark, a.message_dir, a.max_per_trigger)
        else:
            src = kafka_source(spark, a.kafka_servers, a.topic, a.starting_offsets, a.max_per_trigger, not a.tolerate_data_loss)
        every = {"processingTime": a.trigger_interval} if a.trigger_interval else None
        q = start_ingest(src, a.bronze, a.checkpoint,
                         trigger={"availableNow": True} if a.available_now else every,
                         cluster_by_partition=CLUSTER_BUCKETS if a.buckets is None else a.buckets,
                         partition_by=S.BRONZE_DATE_PARTITION_COLUMNS if a.date_only else None)
        q.awaitTermination()
        return 0
    if a.cmd == "silver":
        from tillscope.operators.silver import run_silver
        from tillscope.sources.bronze import read_bronze

        tiebreak = [c for c in a.tiebreak.split(",") if c]
        print(json.dumps(run_silver(spark, read_bronze(spark, a.bronze, with_position=True), a.silver, a.rejects, tiebreak=tiebreak)))
        return 0
    if a.cmd == "validate":
        from tillscope.plans.pipeline import validate_silver

        from tillscope.operators.quality import suite_success

        rows = validate_silver(spark, a.silver).collect()  # one row per rule
        report = spark.createDataFrame(rows)
        _print_df(report)
        _print_df(suite_success(report))
        return 1 if a.strict and not all(r["success"] for r in rows) else 0
    if a.cmd == "gold":
        from tillscope.operators.silver import read_silver
        from tillscope.plans.pipeline import run_gold

        res = run_gold(spark, read_silver(spark, a.silver), a.out, strict=a.strict)
        print(json.dumps(res))
        return 1 if (a.strict and res["model_tests_failed"]) else 0
    if a.cmd == "pipeline":
        from tillscope.plans.pipeline import PipelineCheckFailed, run_pipeline
        from tillscope.sources.bronze import read_bronze

        try:
            _print_df(run_pipeline(spark, read_bronze(spark, a.bronze, with_position=True), a.out, strict=a.strict))
        except PipelineCheckFailed as exc:
            print(str(exc), file=sys.stderr)
            return 1
        return 0
    if a.cmd == "history":
        from tillscope.operators.silver import silver_history

        _print_df(silver_history(spark, a.silver))
        return 0
    if a.cmd == "export-csv":
        from tillscope.operators.silver import read_silver
        from tillscope.sources.csv_export import export_csv

        export_csv(read_silver(spark, a.silver), a.out)
        return 0
    if a.cmd == "profile":
        from tillscope.operators import profile
        from tillscope.operators.silver import read_silver
        from tillscope.sources.bronze import read_bronze

        rows = read_bronze(spark, a.bronze) if a.bronze else read_silver(spark, a.silver)
        _print_df(profile.bronze_report(rows) if a.bronze else profile.silver_report(rows))
        _print_df(profile.sample(rows, profile.BRONZE_SAMPLE_COLUMNS if a.bronze else profile.SILVER_SAMPLE_COLUMNS))
        return 0
    return 2


if __name__ == "__main__":
    raise SystemExit(main())
