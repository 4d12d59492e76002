"""Vector codes (13) and whitening (11) against plain Python and dense linear algebra."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import cases  # noqa: F401
from tillscope.llm import vector_codes as V
from tillscope.llm import whitening as W
from tillscope.llm.vectors import with_groups

SCHEMA = "vec_id long, embedding array<double>, label int, v string, code string, total long"


def rows_with_awkward(seed=1, n=120, dim=16, spread=0.2):
    r = random.Random(seed)
    rows = [(i, [r.gauss(0, spread) for _ in range(dim)], r.choice([None, 1, 2])) for i in range(n)]
    rows += [(n + i, rows[3][1], 1) for i in range(40)]  # one common vector
    rows += [(3, rows[3][1], 2), (None, rows[5][1], 5), (900, None, 1), (901, [1.0] * (dim - 1) + [None], 1), (902, [float("nan")] * dim, 1),
             (903, [1.0, 2.0], 1), (904, [], 1), (905, [float("inf")] + [0.0] * (dim - 1), 1), (906, [0.0] * dim, 3)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", "y", 7) for i, v, lab in rows], SCHEMA).repartition(3)


def kept(rows, dim):
    return [(i, v, lab) for i, v, lab in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]


def codes_by_hand(rows, dim, parts=8, entries=16, rounds=6, scale=4096):
    rows = kept(rows, dim)
    width = -(-dim // parts)
    whole = [[math.floor(x * scale) if abs(x) < 2**40 else int(x) * scale for x in v] + [0] * (parts * width - dim) for _, v, _ in rows]
    first = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, rows[k][1]))[:entries]
    cut = lambda x, p: x[p * width:(p + 1) * width]
    books = [[cut(whole[k], p) for k in first] for p in range(parts)]

    def best(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            at = [best(cut(x, p), books[p])[1] for x in whole]
            books[p] = [[sum(c) // len(c) for c in zip(*[cut(x, p) for x, k in zip(whole, at) if k == e])] if e in at else entry
                        for e, entry in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    found = [[best(cut(x, p), books[p]) for p in range(parts)] for x in whole]
    errors = [sum(d for d, _ in f) for f in found]
    out = []
    for (i, _, lab), f, e in zip(rows, found, errors):
        total = sum(x for x, (_, _, other) in zip(errors, rows) if other == lab)
        out.append((i, "".join(f"{k:02x}" for _, k in f), e if e < 2**63 else None, total if total < 2**63 else None, digest))
    return sorted(out, key=str)


@pytest.mark.parametrize("dim,spread", [(16, 0.2), (24, 1.0), (13, 0.2), (16, 1e9)])
def test_codes(spark, dim, spread):
    rows = rows_with_awkward(dim=dim, spread=spread)
    got = sorted((tuple(r) for r in V.vector_codes(frame(spark, rows)).collect()), key=str)
    assert got == codes_by_hand(rows, dim)


def test_codes_of_few_and_of_none(spark):
    rows = [(5, [0.5] * 8, 1), (2, [0.25] * 8, None), (2, [0.25] * 8, None)]
    assert sorted((tuple(r) for r in V.vector_codes(frame(spark, rows)).collect()), key=str) == codes_by_hand(rows, 8)
    assert V.vector_codes(frame(spark, [])).count() == 0
    assert V.vector_codes(frame(spark, [(1, None, 1), (2, [], 2)])).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


@pytest.mark.parametrize("width", [1, 3, 8, 13])
@pytest.mark.parametrize("kind", [np.int64, object])
def test_transform_keeps_distances_and_search_is_exact(width, kind):
    r = np.random.default_rng(width)
    x, c = r.integers(-40, 40, (200, width)).astype(kind), r.integers(-40, 40, (16, width)).astype(kind)
    c[9], x[0] = c[4], c[4]
    tx, tc = V.walsh(x), V.walsh(c)
    exact = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (((tx[:, None] - tc[None]) ** 2).sum(2) == exact * tx.shape[1]).all()
    at, d = V.nearest_entries(tx, tc)
    assert (at == exact.astype(np.int64).argmin(1)).all() and (d == exact.min(1) * tx.shape[1]).all()


def test_sequency_order():
    t = V.walsh(np.eye(16, dtype=np.int64))  # row k: the k-th column of the transform, so columns are its functions
    assert [int((f[1:] != f[:-1]).sum()) for f in t.T] == list(range(16))


def test_hot_and_cold_groups(spark, monkeypatch):
    monkeypatch.setattr("tillscope.llm.vectors.HOT_GROUPS", 3)
    rows = spark.range(200).selectExpr("id", "CASE WHEN id < 100 THEN 'hot' ELSE concat('k', id % 20) END AS key")
    groups = rows.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("top")).where("key != 'k3'")
    got = with_groups(rows, groups, "key", F.col("id")).collect()
    assert len(got) == 200 and {(r.key, r.n, r.top) for r in got if r.key in ("hot", "k3", "k4")} == {("hot", 100, 99), ("k3", None, None), ("k4", 5, 184)}


# ------------------------------------------------------------------ whitening
def spectrum_cases():
    r = np.random.default_rng(0)
    q = np.linalg.qr(r.normal(size=(200, 30)))[0]
    turn = np.linalg.qr(r.normal(size=(30, 30)))[0]
    constant = np.zeros((10, 6))
    constant[:, 2] = r.normal(size=10)
    return {"gauss": r.normal(size=(500, 64)), "graded": r.normal(size=(500, 40)) * 10.0 ** (-np.arange(40) / 2), "orthonormal": q,
            "equal values": q * np.repeat([3.0, 2, 1], 10) @ turn, "rank 3": r.normal(size=(100, 3)) @ r.normal(size=(3, 20)),
            "few rows": r.normal(size=(5, 20)), "one": r.normal(size=(5, 1)), "constant": constant,
            "twins": np.diag(np.abs(np.arange(-10, 11)) + 11.0) + np.diag(np.ones(20), 1), "diagonal": np.diag([1.0, 2, 3, 3, 0, 0]), "zero": np.zeros((3, 4))}


@pytest.mark.parametrize("name", spectrum_cases())
def test_solver(name):
    a = spectrum_cases()[name]
    r = W._triangle(a)
    values, v = W.principal_directions(r)
    want = np.linalg.svd(r, compute_uv=False) ** 2
    scale = max(want[0], 1e-300)
    assert np.abs(values - want).max() <= 1e-13 * scale and (np.diff(values) <= 0).all()
    if name == "graded":  # small values to high relative accuracy
        assert (np.abs(values - want) <= 1e-10 * want)[want > 1e-24 * want[0]].all()
    assert np.abs(v.T @ v - np.eye(len(v))).max() < 1e-11
    assert np.abs(r.T @ (r @ v) - v * values).max() <= 1e-13 * scale


def test_whitening_against_dense_algebra(spark):
    dim = 16
    rows = rows_with_awkward(dim=dim)
    x = np.floor(np.array([v for _, v, _ in kept(rows, dim)]) * 64).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    c = (n * x - sums) / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    got = W.whiten(frame(spark, rows), components=10).toPandas()
    assert len(got) == n * 10 and (got["n"] == n).all() and set(got["component"]) == set(range(1, 11))
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-10
    by_id = {i: k for k, (i, _, _) in enumerate(kept(rows, dim))}
    for j in range(10):
        part = got[got["component"] == j + 1]
        at = [by_id[None if i != i else int(i)] for i in part["vec_id"]]
        want = (c @ v[:, j] / math.sqrt(e[j]))[at]
        sign = np.sign((want * part["whitened"]).sum())
        assert np.allclose(part["whitened"] * sign, want, atol=1e-8) and np.allclose(part["explained"], e[j] / e.sum(), rtol=1e-10)
        assert (part["deviation"] == ((n * x - sums) ** 2).sum(1)[at]).all()


def test_whitening_of_few_directions_and_of_none(spark):
    two = [(i, [float(i), 1.0, -float(i), float(i % 2)], 1) for i in range(9)]
    got = W.whiten(frame(spark, two)).toPandas()
    assert set(got["component"]) == {1, 2} and got["identity_error"][0] < 1e-10 and abs(got.drop_duplicates("component")["explained"].sum() - 1) < 1e-12
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None, 1)], [(1, [1.0, 2.0], 1)], [(i, [1.0, 2.0], 1) for i in range(5)]):
        none = W.whiten(frame(spark, rows))
        assert none.columns == columns and none.count() == 0
    far = W.whiten(frame(spark, [(1, [2.0**54, 0.0], 1), (2, [0.0, 1.0], 1), (3, [-(2.0**54), 5.0], 1)])).collect()
    assert all(r.deviation is None for r in far if r.vec_id != 2) and len(far) == 3 or len(far) == 6
