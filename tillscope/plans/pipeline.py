"""The daily chain: Bronze → Silver (+ Rejects) → expectation suite → gold marts → model tests.

One Spark application, no export hop: Silver is written once, the suite
runs as one aggregate over it, staging is a view over Silver, the marts
are written as tables and the model tests read the written tables.
Row counts of the marts are read from their files' footers.

All tables of a run (Silver, Rejects, suite report, marts, test report)
are published by one row when the last is written, so a run that fails on
the way leaves every reader on the run before.  ``strict=True`` raises
when the suite or a model test fails, and publishes nothing (the audited
chain only reported).  ``publish_views`` moves named views to the newest
published run, one statement a view.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillscope import schema as S
from tillscope.operators.gold import dim_products, dim_stores, fct_daily_sales, stg_sales
from tillscope.operators.model_tests import model_test_report
from tillscope.operators.quality import run_suite, silver_suite
from tillscope.operators.silver import REJECTS, SILVER, read_silver, write_silver
from tillscope.sources.runs import find_folder, join_ledger, ledger_of, new_run, publish, run_folder

MARTS = ("fct_daily_sales", "dim_stores", "dim_products")
MODEL_TESTS, REPORT = "model_tests", "quality_report"

SUMMARY_SCHEMA = ("bronze_read bigint, duplicates_removed bigint, silver_valid bigint, rejected bigint, "
                  "expectations_failed bigint, fct_rows bigint, dim_store_rows bigint, "
                  "dim_product_rows bigint, model_tests_failed bigint")


class PipelineCheckFailed(RuntimeError):
    pass


def validate_silver(spark: SparkSession, silver_path: str) -> DataFrame:
    """The eight-rule suite over a written Silver table (one aggregate job)."""
    return run_suite(read_silver(spark, silver_path), silver_suite())


def _write_counted(df: DataFrame, path: str) -> int:
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


def read_mart(spark: SparkSession, gold_path: str, name: str, version: int | None = None, run: str | None = None,
              at: _dt.datetime | None = None) -> DataFrame:
    """A mart (or ``model_tests``) of the newest published run, or as of a version, a run or an instant."""
    path = find_folder(spark, gold_path, name, version, run, at)
    if path is None:
        raise FileNotFoundError(f"no published run in {gold_path}")
    return spark.read.parquet(f"{path}/{name}")


def write_gold(spark: SparkSession, silver: DataFrame, out: str) -> tuple[dict[str, int], int]:
    """Staging view, the three marts as tables, the model tests over the written tables: (rows of each table, failed tests)."""
    stg = stg_sales(silver)
    stg.createOrReplaceTempView("stg_sales_transactions")
    n_rows = {"fct_daily_sales": _write_counted(fct_daily_sales(stg), f"{out}/fct_daily_sales")}
    fct = spark.read.parquet(f"{out}/fct_daily_sales")
    n_rows["dim_stores"] = _write_counted(dim_stores(fct), f"{out}/dim_stores")  # the fact has every store of staging
    n_rows["dim_products"] = _write_counted(dim_products(stg), f"{out}/dim_products")
    models = {"stg_sales_transactions": stg, **{name: spark.read.parquet(f"{out}/{name}") for name in MARTS}}
    n_rows[MODEL_TESTS] = _write_counted(model_test_report(models), f"{out}/{MODEL_TESTS}")
    return n_rows, spark.read.parquet(f"{out}/{MODEL_TESTS}").filter(~F.col("passed")).count()


def _gold_summary(n_rows: dict[str, int], failed: int) -> dict:
    return {"fct_rows": n_rows["fct_daily_sales"], "dim_store_rows": n_rows["dim_stores"], "dim_product_rows": n_rows["dim_products"],
            "model_tests_failed": failed}


def run_gold(spark: SparkSession, silver: DataFrame, gold_path: str, strict: bool = False) -> dict:
    """The gold tables as a run of their own.

    With ``strict`` a failed model test leaves the marts unpublished: readers stay on the run before.
    """
    run = new_run()
    n_rows, failed = write_gold(spark, silver, run_folder(gold_path, run))
    if not (strict and failed):
        publish(spark, ledger_of(spark, gold_path), run, n_rows)
    return _gold_summary(n_rows, failed)


def run_pipeline(spark: SparkSession, bronze: DataFrame, out_dir: str,
                 clock: _dt.datetime | None = None, tiebreak: Sequence[str] = (),
                 strict: bool = False, derive: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Run the chain into ``out_dir`` (silver, rejects, quality_report, gold), published together; returns the one-row run summary."""
    out, run = out_dir.rstrip("/"), new_run()
    folder = {name: run_folder(f"{out}/{name}", run) for name in ("silver", "rejects", REPORT, "gold")}
    counts = write_silver(bronze, folder["silver"], folder["rejects"], clock, tiebreak, derive=derive)
    if counts["bronze_read"] == 0:
        return spark.createDataFrame([(0,) * 9], SUMMARY_SCHEMA)

    silver = spark.read.schema(S.SILVER_SCHEMA).parquet(folder["silver"]).select(*S.SILVER_COLUMNS)
    n_rules = _write_counted(run_suite(silver, silver_suite()), folder[REPORT])
    failed_rules = spark.read.parquet(folder[REPORT]).filter(~F.col("success")).count()
    if strict and failed_rules:
        raise PipelineCheckFailed(f"{failed_rules} expectation(s) failed")
    n_rows, failed_tests = write_gold(spark, silver, folder["gold"])
    if strict and failed_tests:
        raise PipelineCheckFailed(f"{failed_tests} model test(s) failed")
    join_ledger(spark, out, [f"{out}/{name}" for name in folder])
    publish(spark, out, run, {SILVER: counts["valid"], REJECTS: counts["rejected"], REPORT: n_rules, **n_rows})
    gold = _gold_summary(n_rows, failed_tests)
    row = (counts["bronze_read"], counts["duplicates_removed"], counts["valid"], counts["rejected"], failed_rules,
           gold["fct_rows"], gold["dim_store_rows"], gold["dim_product_rows"], failed_tests)
    return spark.createDataFrame([row], SUMMARY_SCHEMA)


def declared_source(spark: SparkSession, name: str, schema: StructType = S.SILVER_SCHEMA) -> DataFrame:
    """A catalog table or view as a declared source: the declared columns, with the declared types; a missing column is an error."""
    rows = spark.table(name)
    missing = [f.name for f in schema.fields if f.name not in rows.columns]
    if missing:
        raise ValueError(f"{name} lacks the declared columns {', '.join(missing)}")
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def publish_views(spark: SparkSession, out_dir: str, prefix: str = "") -> dict[str, str]:
    """Views ``<prefix>silver``, ``<prefix>rejects`` and one per mart over the newest published run of a chain: name -> folder.

    A view moves with one statement, so a reader by name sees the run
    before or the new one, and a run that is not published is never seen.
    """
    out = out_dir.rstrip("/")
    schemas = {SILVER: S.SILVER_SCHEMA, REJECTS: S.REJECTS_SCHEMA}
    moved = {}
    for name in (SILVER, REJECTS, *MARTS):
        root = f"{out}/{name}" if name in schemas else f"{out}/gold"
        path = find_folder(spark, root, name)
        if path is None:
            raise FileNotFoundError(f"no published run in {out}")
        path = path if name in schemas else f"{path}/{name}"
        # an empty table's folder has no schema of its own: the declared columns are cast to, and read as nothing
        empty = name in schemas and spark.read.schema(schemas[name]).parquet(path).isEmpty()
        columns = ", ".join(f"CAST({'NULL' if empty else f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schemas[name].fields) if name in schemas else "*"
        spark.sql(f"CREATE OR REPLACE VIEW {prefix}{name} AS SELECT {columns} FROM " + ("range(0)" if empty else f"parquet.`{path}`"))
        moved[f"{prefix}{name}"] = path
    return moved
