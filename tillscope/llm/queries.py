"""Registered queries of the subpackage: one ``opN_<name>`` per operator, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.llm import license_scan, url_filter, warc
from tillscope.llm.common import table
from tillscope.llm.line_dedup import dedup_lines
from tillscope.llm.minhash import near_duplicates
from tillscope.llm.multi_index import nearest
from tillscope.llm.packing import pack
from tillscope.llm.quality_fm import score_documents, train
from tillscope.llm.spotsigs import edited_fingerprints
from tillscope.llm.token_count import token_counts
from tillscope.llm.vector_codes import vector_codes
from tillscope.llm.whitening import whiten
from tillscope.llm.word_bpe import encode_decode

Query = Callable[[SparkSession, str], DataFrame]


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


#: lines from four words on; one word in five may differ, four at most
LINE_BOUND = {"min_words": 4, "max_edits": 4, "words_per_edit": 5}


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"), **LINE_BOUND).drop("row")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, closing_id=0)


def op5_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op6_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, train(docs, table(spark, sf_dir, "labels")))


#: (verdict, host, path)
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.filter_urls(pages, URL_RULES, url_filter.label_by_words(pages))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op9_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), components=32)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"), least_bytes=0)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6, scale=4096)


QUERIES: dict[str, Query] = {
    "op1_spotsigs": op1_spotsigs,
    "op2_line_dedup": op2_line_dedup,
    "op3_license_scan": op3_license_scan,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_multi_index": op5_multi_index,
    "op6_quality_fm": op6_quality_fm,
    "op7_url_filter": op7_url_filter,
    "op8_token_counts": op8_token_counts,
    "op9_word_bpe": op9_word_bpe,
    "op10_minhash": op10_minhash,
    "op11_whitening": op11_whitening,
    "op12_warc": op12_warc,
    "op13_vector_codes": op13_vector_codes,
}

#: DuckDB SQL where it can express a query
ORACLE_SQL: dict[str, str] = {
    "op3_license_scan": license_scan.oracle_sql(),
    "op12_warc": warc.oracle_sql(),
}
