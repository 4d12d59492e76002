"""Embedding whitening through a bidiagonal qd solver.

1. Integers.  Every entry c becomes x = floor(scale * c) + shift, so sums
   and deviations are exact.
2. QR by blocks.  A task holds one triangle R: centred rows are stacked
   under it block by block and reduced again.  The tasks' triangles are
   reduced in groups until one is left, with R'R = n * covariance; the
   covariance itself, which would square the rounding, is never formed.
3. Bidiagonal.  Householder reflections from both sides bring R to an upper
   bidiagonal B; the right ones are kept.
4. dqds.  Differential quotient-difference steps with shifts find the
   squared singular values of B to high relative accuracy, small ones too.
5. Twisted factorisations.  For each value the factorisations of B'B from
   the top and from the bottom meet at the place of the smallest pivot and
   give the vector by multiplications alone.  Vectors of values that lie
   close together are made orthogonal, those of (nearly) equal ones found
   by inverse iteration against the ones before.  The right reflections
   carry them back.

A triangle is as large as the dimension squared, whatever the number of
rows; nothing else reaches the driver but sums over the rows.

Rows whose vector is null or empty, holds a null or non-finite entry, one
of 2**55 or more, or has another than the most common length give no row.
Repeated rows and ids count row by row; a null id is kept.  Directions
without variance (rounding aside) have no component, so equal vectors or a
single one give no rows, and fewer than ``components`` directions give
fewer.  A deviation beyond a 64-bit integer is null.  An empty table gives
an empty result; columns other than the id and the vector are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import map_arrow, saved
from tillscope.llm.vectors import as_matrix, usable_vectors

LARGEST = 2.0**55
ROWS_PER_STEP = 2048
#: triangles that one task reduces to one
FAN = 8
#: smallest squared singular value told from zero inside the solver, relative to the largest
TINY = 1e-60
EPS = np.finfo(np.float64).eps
#: values closer than this, relative to themselves, get their vectors made orthogonal
CLOSE = 1e-3


def integers(v: np.ndarray, scale: int, shift: int) -> np.ndarray:
    """floor(scale * v) + shift as 64-bit integers."""
    return np.floor(v * float(scale)).astype(np.int64) + shift


class Fit(NamedTuple):
    """Sums of the integers over all rows."""

    n: int
    sums: list[int]
    scale: int
    shift: int

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exactly; 64-bit where that holds it, else Python's integers."""
        small = self.n * int(np.abs(x).max(initial=0)) < 2**61 and max(map(abs, self.sums)) < 2**61
        kind = np.int64 if small else object
        return x.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def squares(self, deviations: np.ndarray) -> pa.Array:
        """Sums of the squared deviations, exactly; null beyond 64 bits."""
        largest = int(np.abs(deviations).max(initial=0))
        if largest**2 * deviations.shape[1] < 2**63:
            return pa.array((deviations.astype(np.int64) ** 2).sum(1))
        return pa.array([s if s < 2**63 else None for s in (deviations.astype(object) ** 2).sum(1)], pa.int64())

    def centred(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations / self.n).astype(np.float64)


def fit_sums(vectors: DataFrame, dim: int, scale: int, shift: int) -> Fit:
    """Number of rows and exact sums per dimension; a task gives one row per dimension."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(dim, object)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_STEP):
                x = integers(as_matrix(batch.column(0).slice(at, ROWS_PER_STEP), dim), scale, shift)
                n, sums = n + len(x), sums + x.astype(object).sum(0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim), pa.int32()), pa.array([str(s) for s in sums]), pa.array([n] * dim, pa.int64())], ["i", "s", "n"])

    found = map_arrow(vectors.select("v"), task, "i int, s string, n long").groupBy("i").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).orderBy("i").collect()
    return Fit(found[0]["n"], [int(r["s"]) for r in found], scale, shift)


def _triangle(rows: np.ndarray) -> np.ndarray:
    """R of a QR of ``rows``, square."""
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((rows.shape[1] - len(r), rows.shape[1]))]) if len(r) < rows.shape[1] else r


def centred_triangle(vectors: DataFrame, dim: int, fit: Fit) -> np.ndarray:
    """R with R'R = the sum of the outer products of all centred rows."""
    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_STEP):
                x = fit.centred(fit.deviations(integers(as_matrix(batch.column(0).slice(at, ROWS_PER_STEP), dim), fit.scale, fit.shift)))
                r = _triangle(x if r is None else np.vstack([r, x]))
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([r.ravel()], pa.list_(pa.float64()))], ["r"])

    def reduce_triangles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            for i in range(batch.num_rows):
                x = as_matrix(batch.column(0).slice(i, 1), dim * dim).reshape(dim, dim)
                r = x if r is None else _triangle(np.vstack([r, x]))
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([r.ravel()], pa.list_(pa.float64()))], ["r"])

    triangles = saved(map_arrow(vectors.select("v"), reduce_rows, "r array<double>"), "triangles")
    while (left := triangles.count()) > 1:
        triangles = saved(map_arrow(triangles.repartition(-(-left // FAN)), reduce_triangles, "r array<double>"), "triangles")
    return np.array(triangles.first()["r"]).reshape(dim, dim)


# ------------------------------------------------------------------ bidiagonal form
def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """(u, a): the reflection along the unit vector u maps x to (a, 0, ...); a zero u reflects nothing."""
    size = np.linalg.norm(x)
    a = -np.copysign(size, x[0])
    u = x.copy()
    u[0] -= a
    length = np.linalg.norm(u)
    return (u / length, a) if length > 0 else (np.zeros_like(x), x[0])


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, superdiagonal, right reflectors) of an upper bidiagonal form of ``r``."""
    m, d = r.copy(), len(r)
    diagonal, above, right = np.zeros(d), np.zeros(max(d - 1, 0)), []
    for k in range(d):
        u, diagonal[k] = _reflector(m[k:, k])
        m[k:, k + 1:] -= 2 * np.outer(u, u @ m[k:, k + 1:])
        if k + 1 < d:
            w, above[k] = _reflector(m[k, k + 1:])
            m[k + 1:, k + 1:] -= 2 * np.outer(m[k + 1:, k + 1:] @ w, w)
            right.append(w)
    return diagonal, above, right


def _reflect_back(z: np.ndarray, right: list[np.ndarray]) -> np.ndarray:
    v = z.copy()
    for k in range(len(right) - 1, -1, -1):
        v[k + 1:] -= 2 * right[k] * (right[k] @ v[k + 1:])
    return v


# ------------------------------------------------------------------ singular values
def _dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One differential qd step with a shift: (q, e, smallest d); None if the shift was too large."""
    d, least, q2, e2 = q[0] - shift, q[0] - shift, [], []
    for k in range(len(e)):
        if d < 0:
            return None
        p = d + e[k]
        if p <= 0:
            p = TINY * TINY
        t = q[k + 1] / p
        q2.append(p)
        e2.append(e[k] * t)
        d = d * t - shift
        least = min(least, d)
    if d < 0:
        return None
    q2.append(d)
    return q2, e2, least


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Falling squared singular values of an unreduced upper bidiagonal matrix, by dqds with deflation at the end."""
    q, e, found, total = [float(x) for x in diagonal**2], [float(x) for x in above**2], [], 0.0
    while q:
        if len(q) == 1:
            found.append(q[0] + total)
            break
        if e[-1] <= EPS * EPS * (q[-1] + total) or e[-1] <= TINY * TINY:
            found.append(q.pop() + total)
            e.pop()
            continue
        # the smaller eigenvalue of the last two rows is an upper bound of the smallest: just below it once the tail has settled
        a, b, c = q[-2], e[-1], q[-1]
        half = (a + b + c) / 2
        tail = a * c / (half + np.sqrt(max(half * half - a * c, 0.0))) if half > 0 else 0.0
        for shift in (tail * (1 - 4 * EPS) - b if b < c / 16 else 0.0, tail * 0.75 if b < c else 0.0, 0.0):
            if shift < 0 or (shift == 0 and total + q[-1] < 0):
                continue
            step = _dqds_step(q, e, shift)
            if step is not None:
                q, e, _ = step
                total += shift
                break
    return np.sort(np.array(found))[::-1]


# ------------------------------------------------------------------ vectors
def _top_down(pivots: np.ndarray, lower: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(s, d, l): stationary qd transform of LDL' - value."""
    n = len(pivots)
    s, d, low = np.zeros(n), np.zeros(n), np.zeros(n - 1)
    s[0] = -value
    for k in range(n - 1):
        d[k] = pivots[k] + s[k]
        if abs(d[k]) < TINY:
            d[k] = -TINY
        low[k] = pivots[k] * lower[k] / d[k]
        s[k + 1] = low[k] * lower[k] * s[k] - value
    d[-1] = pivots[-1] + s[-1]
    return s, d, low


def _bottom_up(pivots: np.ndarray, lower: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(p, d, u): progressive qd transform of LDL' - value; d[k + 1] stands below row k."""
    n = len(pivots)
    p, below, up = np.zeros(n), np.zeros(n), np.zeros(n - 1)
    p[-1] = pivots[-1] - value
    for k in range(n - 2, -1, -1):
        d = pivots[k] * lower[k] ** 2 + p[k + 1]
        if abs(d) < TINY:
            d = -TINY
        below[k + 1] = d
        up[k] = pivots[k] * lower[k] / d
        p[k] = p[k + 1] * pivots[k] / d - value
    return p, below, up


def _twisted(pivots: np.ndarray, lower: np.ndarray, value: float) -> tuple[np.ndarray, float]:
    """(z, correction): the vector where the factorisations meet at the smallest pivot, and its Rayleigh correction of the value."""
    s, _, low = _top_down(pivots, lower, value)
    p, _, up = _bottom_up(pivots, lower, value)
    gamma = s + p + value
    r = int(np.argmin(np.abs(gamma)))
    z = np.zeros(len(pivots))
    z[r] = 1.0
    for k in range(r - 1, -1, -1):
        z[k] = -low[k] * z[k + 1]
    for k in range(r, len(pivots) - 1):
        z[k + 1] = -up[k] * z[k]
    square = float(z @ z)
    return z / np.sqrt(square), float(gamma[r]) / square


def _inverse_iteration(pivots: np.ndarray, lower: np.ndarray, value: float, before: list[np.ndarray], seed: int) -> np.ndarray:
    """A vector of ``value`` orthogonal to ``before``, from a fixed pseudo-random start, by solving with the twisted factorisation."""
    value *= 1 + 64 * EPS  # beside the cluster: no single direction of it may drown the others
    s, above, low = _top_down(pivots, lower, value)
    p, below, up = _bottom_up(pivots, lower, value)
    gamma = s + p + value
    r = int(np.argmin(np.abs(gamma)))
    middle = np.concatenate([above[:r], [np.copysign(max(abs(gamma[r]), EPS * EPS * value), gamma[r])], below[r + 1:]])
    z = np.random.default_rng(seed).normal(size=len(pivots))

    def apart(z: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for other in before:
                z = z - other * (other @ z)
            z = z / np.linalg.norm(z)
        return z

    for _ in range(4):
        z = apart(z)
        for k in range(r):
            z[k + 1] -= low[k] * z[k]
        for k in range(len(up) - 1, r - 1, -1):
            z[k] -= up[k] * z[k + 1]
        z = z / middle
        for k in range(r - 1, -1, -1):
            z[k] -= low[k] * z[k + 1]
        for k in range(r, len(up)):
            z[k + 1] -= up[k] * z[k]
        z = z / np.abs(z).max()
    return apart(z)


def _block_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> list[np.ndarray]:
    """Right singular vectors of an unreduced bidiagonal block for its falling ``values``."""
    if len(diagonal) == 1:
        return [np.ones(1)]
    pivots = np.maximum(diagonal**2, TINY)
    lower = above / np.where(diagonal**2 < TINY, np.sqrt(TINY), diagonal)[:-1]
    out: list[np.ndarray] = []
    cluster = 0  # where the values close to the present one begin
    for i, value in enumerate(values):
        if i and values[i - 1] - value > CLOSE * value:
            cluster = i
        z, correction = _twisted(pivots, lower, value)
        if abs(correction) < 1e-8 * value:
            z, _ = _twisted(pivots, lower, value + correction)
        rest = z
        for other in out[cluster:i]:
            rest = rest - other * (other @ rest)
        if np.linalg.norm(rest) < 0.5:
            rest = _inverse_iteration(pivots, lower, value, out[cluster:i], i)
        elif i > cluster:
            for other in out[cluster:i]:
                rest = rest - other * (other @ rest)
        out.append(rest / np.linalg.norm(rest))
    return out


def principal_directions(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(falling eigenvalues of R'R, unit eigenvectors as columns)."""
    largest = np.abs(r).max(initial=0)
    if largest == 0:
        return np.zeros(len(r)), np.eye(len(r))
    diagonal, above, right = bidiagonal(r / largest)
    top = np.abs(np.concatenate([diagonal, above])).max()
    cuts = [0, *(np.nonzero(np.abs(above) <= EPS * EPS * top)[0] + 1), len(r)]
    values, vectors = [], []
    for lo, hi in zip(cuts, cuts[1:]):
        d, b = diagonal[lo:hi], above[lo:hi - 1]
        found = squared_singular_values(np.where(np.abs(d) < np.sqrt(TINY), np.sqrt(TINY), d), b)
        for value, z in zip(found, _block_vectors(d, b, found)):
            whole = np.zeros(len(r))
            whole[lo:hi] = z
            values.append(value)
            vectors.append(_reflect_back(whole, right))
    order = np.argsort(-np.array(values), kind="stable")
    found = np.array(vectors).T[:, order]
    return np.array(values)[order] * largest**2, found / np.linalg.norm(found, axis=0)


class Whitening(NamedTuple):
    """What projects integers to whitened components."""

    fit: Fit
    directions: np.ndarray  # dimension x components
    variances: np.ndarray
    explained: np.ndarray

    def project(self, deviations: np.ndarray) -> np.ndarray:
        return self.fit.centred(deviations) @ self.directions / np.sqrt(self.variances)


def train_whitening(vectors: DataFrame, dim: int, components: int, scale: int, shift: int) -> Whitening:
    fit = fit_sums(vectors, dim, scale, shift)
    values, directions = principal_directions(centred_triangle(vectors, dim, fit))
    told = np.sqrt(np.maximum(values, 0)) > max(fit.n, dim) * EPS * np.sqrt(max(values[0], 0)) if values[0] > 0 else np.zeros(dim, bool)
    k = min(components, int(told.sum()))
    return Whitening(fit, directions[:, :k], values[:k] / fit.n, values[:k] / values.sum() if k else values[:0])


def identity_error(vectors: DataFrame, dim: int, w: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, over all rows."""
    k = len(w.variances)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, sums, n = np.zeros((k, k)), np.zeros(k), 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_STEP):
                y = w.project(w.fit.deviations(integers(as_matrix(batch.column(0).slice(at, ROWS_PER_STEP), dim), w.fit.scale, w.fit.shift)))
                products, sums, n = products + y.T @ y, sums + y.sum(0), n + len(y)
        if n:
            every = np.r_[products.ravel(), sums]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(every)), pa.int32()), pa.array(every)], ["i", "s"])

    found = map_arrow(vectors.select("v"), task, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).orderBy("i").collect()
    every = np.array([r["s"] for r in found]) / w.fit.n
    means = every[k * k:]
    return float(np.abs(every[:k * k].reshape(k, k) - np.outer(means, means) - np.eye(k)).max())


def whiten(df: DataFrame, components: int = 32, scale: int = 64, shift: int = 1_000_000, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: one row per usable vector and component."""
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double"
    vectors, dim = usable_vectors(df, id_col, vector_col, below=LARGEST)
    w = train_whitening(vectors, dim, components, scale, shift) if dim else None
    if w is None or not len(w.variances):
        return df.sparkSession.createDataFrame([], f"{schema}, identity_error double")
    k = len(w.variances)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_STEP):
                deviations = w.fit.deviations(integers(as_matrix(batch.column(1).slice(at, ROWS_PER_STEP), dim), w.fit.scale, w.fit.shift))
                m = len(deviations)
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, m).take(each), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, w.fit.n)),
                     w.fit.squares(deviations).take(each), pa.array(w.project(deviations).ravel()), pa.array(np.tile(w.explained, m))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained"])

    return map_arrow(vectors, task, schema).withColumn("identity_error", F.lit(identity_error(vectors, dim, w)))
