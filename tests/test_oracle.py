"""Registered queries against the DuckDB oracle (the driver's correctness gate, locally)."""

import os

import pytest

from tests.oracle_compare import compare, duck
from tillscope.plans.oracle import oracle_sql as core_sql

SF = os.environ.get("TILLSCOPE_ORACLE_SF", "/root/testdata/sf0.01")
SMALL = "/root/testdata/sf0.001"
# keys that write a folder for each of ~2,400 days read the smallest tables here; the driver's gate reads sf0.01
WRITING = {"bronze_stream_roundtrip", "bronze_partition_scan", "bronze_pruned_scan", "audit_chain_summary", "silver_as_of", "silver_history", "gold_by_name"}
KEYS = sorted(core_sql())


@pytest.fixture(scope="module")
def con():
    return {sf: duck(sf) for sf in (SF, SMALL)}


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    sf = SMALL if key in WRITING else SF
    r = compare(spark, key, sf, con[sf])
    assert r["status"] == "ok", r


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(core_sql()) <= set(E.oracle_sql()) <= set(E.queries())
