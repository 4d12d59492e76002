"""The pipeline's stages on their own inputs, and the registered queries."""

from __future__ import annotations

import corpus_pipeline
from tests.llm import cases
from tillscope.llm.common import table
from tillscope.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_names():
    assert sorted(QUERIES, key=lambda k: int(k[2:].split("_")[0])) and {int(k[2:].split("_")[0]) for k in QUERIES} == set(range(1, 14))
    assert ORACLE_SQL.keys() <= QUERIES.keys()


def test_run(spark):
    docs = table(spark, SF, "documents")
    kept = corpus_pipeline.quality(spark, docs, SF)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    out = corpus_pipeline.run(spark, SF).toPandas()
    assert out["doc_id"].nunique() < docs.count() and out["length"].max() <= 2048
    used = out.groupby("sequence_id")["length"].sum()
    assert (used <= 2048).all() and len(used) <= -(-used.sum() // 2048) * 1.1 + 1


def test_stages_keep_columns_and_take_awkward_rows(spark):
    rows = cases.table(spark).selectExpr("*", "doc_id AS n_chars")
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, rows, SF)
        assert out.columns == rows.columns
        assert stage(spark, rows.limit(0), SF).count() == 0
    ids = [r.doc_id for r in corpus_pipeline.near_copies(spark, rows, SF).collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(i for i in ids if i is not None)) and 1 in ids and 2 not in ids and 3 not in ids
    texts = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, rows, SF).collect()}
    assert texts[1] and 4 not in texts and texts[5] is None and texts[6] == ""
    assert corpus_pipeline.packing(spark, rows, SF).select("doc_id").distinct().count() == 22
