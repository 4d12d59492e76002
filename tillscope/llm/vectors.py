"""Vectors of a table as Arrow batches of rows of one dimension, and a join with groups that may be hot."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: groups broadcast at most, whatever the number of rows (about 200 bytes each)
HOT_GROUPS = 100_000


def usable_vectors(df: DataFrame, id_col: str, vector_col: str, *others: Column, below: float = float("inf")) -> tuple[DataFrame, int]:
    """(vec_id, others, v) of the rows whose vector holds neither null nor non-finite entries nor any from ``below`` on, and the dimension.

    Vectors of another length than the most common one (ties: the longest)
    and empty vectors take no part.  Without any vector the dimension is 0.
    """
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= F.lit(below)))
    rows = df.where(v.isNotNull() & (F.size(v) > 0) & ~bad)
    found = rows.groupBy(F.size(vector_col).alias("d")).agg(F.count("*").alias("n")).agg(F.max(F.struct("n", "d")).alias("m")).first()["m"]
    dim = found["d"] if found else 0
    return rows.where(F.size(vector_col) == dim).select(F.col(id_col).alias("vec_id"), *others, F.col(vector_col).alias("v")), dim


def as_matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column as rows of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def with_groups(rows: DataFrame, groups: DataFrame, key: str, spread: Column) -> DataFrame:
    """``rows`` with the columns of their group (null without one); ``groups``: key, n (its number of rows), more.

    Groups of many rows are broadcast: at most ``HOT_GROUPS`` of them can
    hold more than the n-th part of all rows.  The others are broadcast if
    their counted number allows it, else joined by a shuffle, where rows of
    hot groups are dealt out by ``spread``.
    """
    size = groups.agg(F.count("*").alias("c"), F.sum("n").alias("n")).first()
    packed = groups.select(key, "n", F.struct(*[c for c in groups.columns if c != key]).alias("_group"))
    if size["c"] <= HOT_GROUPS:
        joined = rows.join(F.broadcast(packed.drop("n")), key, "left")
    else:
        least = size["n"] // HOT_GROUPS + 1
        hot = packed.where(F.col("n") >= least).select(key, F.col("_group").alias("_hot"))
        cold = packed.where(F.col("n") < least).select(F.col(key).alias("_key"), F.col("_group").alias("_cold")).withColumn("_key", F.col("_key").cast("string"))
        placed = rows.join(F.broadcast(hot), key, "left").withColumn(
            "_key", F.when(F.col("_hot").isNull(), F.col(key).cast("string")).otherwise(F.concat(F.lit("hot "), spread.cast("string"))))
        joined = placed.join(cold, "_key", "left").withColumn("_group", F.coalesce("_hot", "_cold")).drop("_key", "_hot", "_cold")
    return joined.select(*rows.columns, *[F.col(f"_group.{c}").alias(c) for c in groups.columns if c != key])
