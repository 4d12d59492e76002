
import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillscope import schema as S
from tillscope.operators import gold
from tillscope.operators.dedup import dedup_latest
from tillscope.operators.silver import silver_flagged, silver_rejects, silver_valid
from tillscope.plans.pipeline import PipelineCheckFailed, run_pipeline
from tillscope.sources.messages import decode_messages, encode_messages
from tillscope.sources.posview import POS_TIEBREAK, pos_view

CLOCK = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def flagged(spark):
    return silver_flagged(pos_view(spark, SF_SMALL), clock=CLOCK, tiebreak=POS_TIEBREAK).cache()


def test_valid_plus_rejects_is_dedup(flagged):
    assert silver_valid(flagged).count() + silver_rejects(flagged).count() == flagged.count() == 4594


def test_dedup_idempotent(spark):
    once = dedup_latest(pos_view(spark, SF_SMALL), ["transaction_id"], ["ingested_at"], POS_TIEBREAK)
    twice = dedup_latest(once, ["transaction_id"], ["ingested_at"], POS_TIEBREAK)
    assert sorted(once.collect(), key=repr) == sorted(twice.collect(), key=repr)


def test_gold_properties(flagged):
    stg = gold.stg_sales(silver_valid(flagged))
    fct = gold.fct_daily_sales(stg)
    assert fct.agg(F.sum("transaction_count")).first()[0] == stg.count()
    orphans = fct.join(gold.dim_stores(stg), "store_id", "left_anti").filter(F.col("store_id").isNotNull())
    assert orphans.count() == 0


def test_decode_encode_roundtrip_on_pos(spark):
    pos = pos_view(spark, SF_SMALL).select(*S.MESSAGE_FIELDS, "kafka_received_at")
    back = decode_messages(encode_messages(pos)).withColumn("transaction_ts", F.try_to_timestamp("transaction_ts"))
    assert sorted(back.collect(), key=repr) == sorted(pos.collect(), key=repr)


_text = st.one_of(st.none(), st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=12))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(_text, _text, st.one_of(st.none(), st.integers(-5, 200)),
                          st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False)),
                          st.one_of(st.none(), st.booleans())), min_size=1, max_size=8))
def test_encode_decode_property(spark, rows):
    df = spark.createDataFrame(
        [(a, b, "T", "C", "P", q, p, p, "CARD", "2026-01-01T00:00:00.000000", v, None, dt.datetime(2026, 1, 1))
         for a, b, q, p, v in rows],
        "transaction_id string, store_id string, terminal_id string, cashier_id string, product_id string, "
        "quantity int, unit_price double, total_amount double, payment_method string, transaction_ts string, "
        "is_voided boolean, audit_flag string, kafka_received_at timestamp")
    assert sorted(decode_messages(encode_messages(df)).collect(), key=repr) == sorted(df.collect(), key=repr)


def test_pipeline_strict_gate(spark, scratch):
    bronze = pos_view(spark, SF_SMALL)
    summary = run_pipeline(spark, bronze, f"{scratch}/lenient", clock=CLOCK, tiebreak=POS_TIEBREAK).first()
    assert summary.silver_valid == 4280 and summary.expectations_failed == 1  # GIFT payments fail the set rule
    with pytest.raises(PipelineCheckFailed):
        run_pipeline(spark, bronze, f"{scratch}/strict", clock=CLOCK, tiebreak=POS_TIEBREAK, strict=True)


def test_cli_silver_validate_gold(spark, scratch):
    from tillscope.cli import main
    from tillscope.sources.bronze import write_bronze_batch

    write_bronze_batch(pos_view(spark, SF_SMALL).select(*S.BRONZE_COLUMNS), f"{scratch}/bronze",
                       partition_by=S.BRONZE_DATE_PARTITION_COLUMNS)
    assert main(["silver", "--bronze", f"{scratch}/bronze", "--silver", f"{scratch}/silver",
                 "--rejects", f"{scratch}/rejects"]) == 0
    from tillscope.operators.silver import read_rejects
    from tillscope.plans.pipeline import read_mart

    assert read_rejects(spark, f"{scratch}/rejects").count() == 314
    assert main(["profile", "--silver", f"{scratch}/silver"]) == 0 and main(["profile", "--bronze", f"{scratch}/bronze"]) == 0
    assert main(["validate", "--silver", f"{scratch}/silver"]) == 0
    assert main(["validate", "--silver", f"{scratch}/silver", "--strict"]) == 1   # GIFT payments
    assert main(["gold", "--silver", f"{scratch}/silver", "--out", f"{scratch}/gold", "--strict"]) == 0
    assert read_mart(spark, f"{scratch}/gold", "fct_daily_sales").count() == 3502
