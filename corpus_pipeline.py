"""Corpus pipeline: quality classifier, line dedup, near-dedup, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the
next one's ``docs``.  All but the last return the columns of documents.
Empty tables go through as empty tables; null and empty texts stay unless
a stage says otherwise.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.llm.common import saved, table
from tillscope.llm.line_dedup import BROADCAST_ROWS, dedup_lines
from tillscope.llm.minhash import near_rows
from tillscope.llm.packing import pack
from tillscope.llm.quality_fm import keep_quality, train
from tillscope.llm.queries import LINE_BOUND


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores at 0.5 or more; fitted on the labelled rows outside the held-out fold."""
    return keep_quality(docs, train(docs, table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line repeats; a document that keeps no line with text goes."""
    done = dedup_lines(docs, **LINE_BOUND)
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("text")).otherwise(F.col("row.text")),
           "n_chars": F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("row.n_chars"))}
    return done.where(~changed | (F.trim("text") != "")).select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id; rows that repeat an id with other text are documents of their own."""
    row = F.struct(F.col("doc_id").cast("long").isNull().alias("no_id"), F.col("doc_id").cast("long").alias("doc_id"),
                   F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    placed = docs.select(F.struct(*docs.columns).alias("whole"), row.alias("row"))
    gone = saved(near_rows(docs).where("not first").select("row").distinct(), "near-copies")
    kept = placed.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, "row", "left_anti")
    repeated = saved(placed.groupBy("row").agg(F.count("*").alias("n")).where("n > 1").select("row"), "repeated-rows")
    if repeated.isEmpty():
        return kept.select("whole.*")
    # rows that repeat id and text: one of them, the first by its other columns
    once = kept.join(repeated, "row", "left_semi").groupBy("row").agg(F.min_by("whole", F.to_json("whole")).alias("whole"))
    return kept.join(repeated, "row", "left_anti").select("whole.*").unionByName(once.select("whole.*"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, closing_id=0)


STAGES = [("quality classifier", quality), ("line dedup", lines), ("MinHash near-dedup", near_copies), ("best-fit packing", packing)]

#: SQL can't express the classifier
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
