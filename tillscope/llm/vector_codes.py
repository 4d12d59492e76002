"""Vector codes: one codebook entry per part of a vector, found exactly in integers.

Components become integers, floor(scale * x); a vector is cut into equal
consecutive parts, and each part is coded by the nearest entry of its
position's codebook (squared Euclidean distance, ties to the lower index).

1. Transform.  Parts and entries are padded with zeros to a power of two P
   and pass an unnormalised Walsh-Hadamard transform: additions only, and
   every squared distance becomes exactly P times what it was.
2. Search.  Coefficients are taken in sequency order (by their number of
   sign changes), where smooth data have most of their energy first.  The
   entry that the first coefficient favours gives a bound, its whole
   distance.  The others add up squared differences and leave as soon as
   they exceed the bound; an entry that stays level with it stays.
3. Rounds.  A task adds up its parts by (position, entry); Spark adds the
   tasks' sums; the driver gets one row per position, entry and component,
   whatever the number of vectors, and divides with floor.

All arithmetic is exact: 64-bit integers where a bound on the magnitudes
shows that nothing overflows, else Python's integers.

Rows whose vector is null or empty, holds a null or non-finite component
or one of 2**80 or more, or has another than the most common length give
no row.  Repeated rows and ids are coded row by row; a null id is kept
and sorts last among the first codebook's.  A dimension that the parts do
not divide is padded with zeros at the end.  With fewer vectors than
entries the codebooks are that much smaller.  Errors beyond a 64-bit
integer are null.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import map_arrow, saved
from tillscope.llm.vectors import as_matrix, usable_vectors, with_groups

LARGEST = 2.0**80
#: vectors per step inside a task
ROWS_PER_STEP = 4096


def quantised(v: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * v), exactly: 64-bit where that holds it, else Python's integers."""
    if np.abs(v).max(initial=0) * scale < 2**52:
        return np.floor(v * float(scale)).astype(np.int64)
    whole = [int(x) * scale if abs(x) >= 2**52 else int(np.floor(x * scale)) for x in v.ravel()]
    return np.array(whole, dtype=object).reshape(v.shape)


@cache
def sequency_order(size: int) -> np.ndarray:
    """Rows of the natural-order transform by their number of sign changes."""
    h = np.ones((1, 1), np.int8)
    while len(h) < size:
        h = np.block([[h, h], [h, -h]])
    return np.argsort((h[:, 1:] != h[:, :-1]).sum(1))


def walsh(x: np.ndarray) -> np.ndarray:
    """Unnormalised Walsh-Hadamard transform of the last axis, zero-padded to a power of two, in sequency order."""
    size = 1 << (x.shape[-1] - 1).bit_length()
    t = np.zeros((*x.shape[:-1], size), x.dtype)
    t[..., :x.shape[-1]] = x
    half = 1
    while half < size:
        pairs = t.reshape(*x.shape[:-1], -1, 2, half)
        t = np.stack([pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]], axis=-2).reshape(*x.shape[:-1], size)
        half *= 2
    return t[..., sequency_order(size)]


def nearest_entries(t: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, scaled squared distance) of each row's nearest entry, both transformed; ties to the lower index."""
    first = (t[:, None, 0] - entries[None, :, 0]) ** 2
    bound = ((t - entries[first.argmin(1)]) ** 2).sum(1)
    row, entry = np.nonzero(first <= bound[:, None])
    total = first[row, entry]
    for k in range(1, t.shape[1]):
        total = total + (t[row, k] - entries[entry, k]) ** 2
        stay = total <= bound[row]
        row, entry, total = row[stay], entry[stay], total[stay]
    starts = np.searchsorted(row, np.arange(len(t)))
    best = np.minimum.reduceat(total, starts)
    tied = np.nonzero(total == best[row])[0]
    return entry[tied[np.searchsorted(row[tied], np.arange(len(t)))]], best


class Coder:
    """Codebooks (positions, entries, components), integers."""

    def __init__(self, books: np.ndarray, scale: int) -> None:
        self.books, self.scale = books, scale
        self.positions, _, self.width = books.shape
        self.padded = 1 << (self.width - 1).bit_length()
        self.magnitude = int(np.abs(books).max(initial=0))

    def parts(self, v: np.ndarray) -> np.ndarray:
        """(vectors, positions, components), quantised and padded with zeros to whole parts."""
        x = quantised(v, self.scale)
        out = np.zeros((len(x), self.positions * self.width), x.dtype)
        out[:, :x.shape[1]] = x
        return out.reshape(len(x), self.positions, self.width)

    def assign(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vectors, positions): indexes, and exact squared distances."""
        largest = max(self.magnitude, int(np.abs(parts).max(initial=0)))
        kind = np.int64 if 4 * self.padded**3 * largest**2 < 2**62 else object
        t, books = walsh(parts.astype(kind)), walsh(self.books.astype(kind))
        found = [nearest_entries(t[:, p], books[p]) for p in range(self.positions)]
        return np.stack([i for i, _ in found], 1), np.stack([d for _, d in found], 1) // self.padded


def _blocks(column: pa.Array, dim: int) -> Iterator[tuple[int, np.ndarray]]:
    for at in range(0, len(column), ROWS_PER_STEP):
        yield at, as_matrix(column.slice(at, ROWS_PER_STEP), dim)


def _round(vectors: DataFrame, dim: int, coder: Coder) -> np.ndarray:
    """The codebooks after one round."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(coder.books.shape, object)
        counts = np.zeros(coder.books.shape[:2], np.int64)
        for batch in batches:
            for _, v in _blocks(batch.column(0), dim):
                parts = coder.parts(v)
                codes, _ = coder.assign(parts)
                for p in range(coder.positions):
                    for e in np.unique(codes[:, p]):
                        chosen = parts[codes[:, p] == e, p]
                        sums[p, e] += chosen.sum(0).astype(object)
                        counts[p, e] += len(chosen)
        p, e, c = (x.ravel() for x in np.indices(sums.shape))
        used = counts[p, e] > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[used], pa.int32()) for x in (p, e, c)] + [pa.array([str(s) for s in sums.ravel()[used]], pa.string()),
                                                                 pa.array(counts[p, e][used])], ["p", "e", "c", "s", "n"])

    books = coder.books.copy()
    partial = map_arrow(vectors.select("v"), task, "p int, e int, c int, s string, n long")
    for r in partial.groupBy("p", "e", "c").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect():
        books[r["p"], r["e"], r["c"]] = int(r["s"]) // r["n"]
    return books


def train_codebooks(vectors: DataFrame, dim: int, parts: int, entries: int, rounds: int, scale: int) -> Coder:
    """Codebooks that start as the parts of the vectors with the smallest ids; ``vectors``: vec_id, v."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    width = -(-dim // parts)
    empty = Coder(np.zeros((parts, 0, width), object), scale)
    coder = Coder(empty.parts(np.array([r["v"] for r in first], np.float64)).astype(object).transpose(1, 0, 2), scale)
    for _ in range(rounds):
        coder = Coder(_round(vectors, dim, coder), scale)
    return coder


def codebook_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(x) for x in books.ravel()).encode()).hexdigest()


def vector_codes(df: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, id_col: str = "vec_id",
                 vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error (error over equal labels, nulls together), codebooks_sha256."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    vectors, dim = usable_vectors(df, id_col, vector_col, F.to_json(F.struct(F.col(label_col).alias("label"))).alias("label"), below=LARGEST)
    kind = df.schema[id_col].dataType.simpleString()
    if not dim:
        return df.sparkSession.createDataFrame([], f"vec_id {kind}, code string, error long, label_error long, codebooks_sha256 string")
    coder = train_codebooks(vectors, dim, parts, entries, rounds, scale)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, v in _blocks(batch.column(2), dim):
                codes, errors = coder.assign(coder.parts(v))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(v)), batch.column(1).slice(at, len(v)), pa.array([c.tobytes().hex() for c in codes.astype(np.uint8)]),
                     pa.array([str(e) for e in errors.astype(object).sum(1)])], ["vec_id", "label", "code", "error"])

    coded = saved(map_arrow(vectors.select("vec_id", "label", "v"), task, f"vec_id {kind}, label string, code string, error string").select(
        "vec_id", "label", "code", F.col("error").cast("decimal(38,0)").alias("error")), "vector-codes")
    totals = saved(coded.groupBy("label").agg(F.sum("error").alias("total"), F.count("*").alias("n")), "label-errors")
    return with_groups(coded, totals, "label", F.xxhash64("code")).select(
        "vec_id", "code", F.col("error").try_cast("long").alias("error"), F.col("total").try_cast("long").alias("label_error"),
        F.lit(codebook_digest(coder.books)).alias("codebooks_sha256"))
