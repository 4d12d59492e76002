"""Shared helpers: table reads, written intermediate tables, text batches for Arrow tasks."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.session import scratch_path

#: texts per step inside a Python task: bounds the token lists held at once
TEXTS_PER_STEP = 256
BYTES_PER_STEP = 2_000_000


_shipped: set[str] = set()  # applications that have the package on their executors


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` whose tasks can import this package, also where it is not installed on the executors."""
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        path = os.path.join(tempfile.mkdtemp(), f"{package.name}.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(path)
        _shipped.add(sc.applicationId)
    return df.mapInArrow(fn, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back (cuts lineage, survives lost executors)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(col: str) -> Column:
    """The text, a null as the empty text."""
    return F.coalesce(F.col(col), F.lit(""))


def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut (id..., text) batches into steps of bounded size; the text is the last column.

    Only one step's texts are Python strings at a time, whatever a batch holds.
    """
    for batch in batches:
        column = batch.column(batch.num_columns - 1)
        sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
        lo, size = 0, 0
        for i, n in enumerate(sizes):
            size += n
            if i + 1 - lo >= TEXTS_PER_STEP or size >= BYTES_PER_STEP or i + 1 == len(sizes):
                yield batch.slice(lo, i + 1 - lo), [t or "" for t in column.slice(lo, i + 1 - lo).to_pylist()]
                lo, size = i + 1, 0


def map_texts(docs: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Run an Arrow task over (id, text) alone; other columns never reach Python."""
    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), fn, schema)
