"""Expectation suite, contract, model tests and versioned-table behaviour (FIXTURES.md §4.4, §4.5)."""

import datetime as dt

import pytest

from tillscope import schema as S
from tillscope.functions.contract import contract_violations
from tillscope.operators import model_tests, quality
from tillscope.sources.csv_export import export_csv, read_csv_export
from tillscope.sources.versions import read_version, version_history, write_version


def test_suite_null_passes_except_not_null(spark):
    df = spark.createDataFrame(
        [("T-1", "NL-001", 10.0, 1, "VALID", "CARD"),
         ("T-2", "XX", -1.0, 0, "BAD", "BITCOIN"),
         (None, None, None, None, None, None)],
        "transaction_id string, store_id string, total_amount double, quantity int, "
        "audit_flag string, payment_method string")
    rep = {r.rule_id: r for r in quality.run_suite(df, quality.silver_suite()).collect()}
    assert [rep[i].unexpected_count for i in range(1, 8)] == [1, 1, 1, 1, 1, 1, 1]
    assert rep[1].missing_count == 1 and rep[8].success and rep[8].element_count == 3
    assert not any(rep[i].success for i in range(1, 8))


def test_suite_empty_table_fails_row_count_only(spark):
    empty = spark.createDataFrame([], "transaction_id string, store_id string, total_amount double, "
                                      "quantity int, audit_flag string, payment_method string")
    rep = {r.rule_id: r.success for r in quality.run_suite(empty, quality.silver_suite()).collect()}
    assert rep[8] is False and all(rep[i] for i in range(1, 8))
    assert quality.suite_success(quality.run_suite(empty, quality.silver_suite())).first().failed_rules == 1


def test_contract_labels_in_rule_order(spark):
    df = spark.createDataFrame(
        [("t", "NL-001", "POS-1", "E", "P", 0, 1.0, 9.0, "GIFT", "x", None, None),
         ("u", "NL-001", "POS-1", "E", "P", 2, 1.5, 3.05, "CARD", "x", False, "VALID"),
         ("v", "NL-001", "POS-1", "E", "P", 2, 1.5, 3.0, "CARD", "x", False, "VALID")],
        "transaction_id string, store_id string, terminal_id string, cashier_id string, product_id string, "
        "quantity int, unit_price double, total_amount double, payment_method string, transaction_ts string, "
        "is_voided boolean, audit_flag string")
    got = {r.transaction_id: (r.n_violations, r.violations) for r in contract_violations(df).collect()}
    assert got["t"] == (2, "quantity:range,payment_method:not_in_set")   # mismatch skipped: quantity failed
    assert got["u"] == (1, "total_amount:mismatch")
    assert got["v"] == (0, "")


def test_model_tests_ignore_nulls(spark):
    child = spark.createDataFrame([("a",), ("b",), (None,), ("z",)], "store_id string")
    parent = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "store_id string")
    assert model_tests.relationships_failures(child, "store_id", parent, "store_id").count() == 1
    assert model_tests.unique_failures(parent, "store_id").count() == 1
    tests = [model_tests.ModelTest("unique", "p", "store_id"), model_tests.ModelTest("not_null", "p", "store_id"),
             model_tests.ModelTest("relationships", "c", "store_id", "p", "store_id")]
    rep = {r.test_type: r.failures for r in model_tests.model_test_report({"p": parent, "c": child}, tests).collect()}
    assert rep == {"unique": 1, "not_null": 1, "relationships": 1}


def test_versions_isolate(spark, scratch):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    b = spark.createDataFrame([(3, "z")], "id int, v string")
    assert write_version(a, scratch, mode="overwrite") == 0
    assert write_version(b, scratch) == 1
    assert write_version(b.limit(0), scratch) == 1  # nothing to append: no new version
    with pytest.raises(ValueError):
        write_version(b.limit(0), scratch, mode="overwrite")
    assert read_version(spark, scratch, a.schema, 0).count() == 2
    assert read_version(spark, scratch, a.schema).count() == 3
    assert write_version(a.filter("id = 1"), scratch, mode="overwrite") == 2
    assert sorted(r.id for r in read_version(spark, scratch, a.schema, 1).collect()) == [1, 2, 3]
    assert [r.id for r in read_version(spark, scratch, a.schema).collect()] == [1]
    plan = read_version(spark, scratch, a.schema, 0)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(base" in plan
    hist = [(r.version, r.mode, r.n_rows, r.base_version) for r in version_history(spark, scratch).collect()]
    assert hist == [(2, "Overwrite", 1, 2), (1, "Append", 1, 0), (0, "Overwrite", 2, 0)]
    with pytest.raises(FileNotFoundError):
        read_version(spark, f"{scratch}-none", a.schema)


ODD_TEXT = ["", " lead", "trail ", "  ", "\\N", "\\", "a\\nb", 'quo"te,comma', "line\nbreak", "cr\rlf\r\n", "tab\t", "nul\0x\\0", "\\\\N", None, "NL-001\n", '"', "#c"]


def test_csv_roundtrip_exact(spark, scratch):
    ts = dt.datetime(2026, 6, 19, 14, 30, 0, 123456)
    df = spark.createDataFrame([(i, t, None if i % 2 else t, ts if i % 3 else None, 1.25 * i) for i, t in enumerate(ODD_TEXT)],
                               "id int, terminal_id string, audit_flag string, ts timestamp, amount double")
    export_csv(df, scratch)
    back = sorted(read_csv_export(spark, scratch, df.schema).collect())
    assert back == sorted(df.collect())


def test_reports_and_publish(spark, scratch):
    from tillscope.operators.profile import bronze_profile_report, silver_check_report
    from tillscope.sources.messages import publish_messages
    from tillscope.sources.posview import pos_view
    from tests.conftest import SF_SMALL

    bronze = pos_view(spark, SF_SMALL)
    rep = bronze_profile_report(bronze)
    assert rep["row_count"].first()[0] == 6000
    assert set(rep) == {"row_count", "null_check", "audit_flag_distribution", "payment_method_distribution",
                        "top_stores_by_revenue", "sample"}
    assert rep["top_stores_by_revenue"].count() == 10 and rep["sample"].count() == 5
    assert silver_check_report(bronze.limit(0)) == {}
    publish_messages(bronze.select(*S.MESSAGE_FIELDS, "kafka_received_at"), fmt="parquet", path=scratch)
    assert spark.read.parquet(scratch).count() == 6000
