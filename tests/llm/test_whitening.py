"""Whitening: the contour integration against a dense solver, sums and distances against whole numbers."""

import numpy as np
import pytest
from pyspark.sql import types as T

from intake.llm import queries as Q
from intake.llm import whitening as W

from .conftest import CLASHES, SF


def matrix(values, seed=1):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    m = (q * values) @ q.T
    return (m + m.T) / 2


SPECTRA = {
    "spread": np.arange(1, 41.0), "close": 1 + 1e-6 * np.arange(30), "steep": 10.0 ** -np.arange(12),
    "tied": np.array([5.0] * 7 + [3.0] * 20 + [1.0] * 13), "tie at the cut": np.array([9, 8, 7] + [2.0] * 30),
    "rank 5": np.array([4, 3, 2, 1, 0.5] + [0.0] * 20), "all equal": np.ones(20), "one": np.array([3.0]),
    "two": np.array([1.0, 2.0]), "near pair": np.array([1, 1 + 1e-10, 0.5, 0.3] + [0.1] * 10), "far": np.array([1e6, 1e3, 1, 1e-3]),
}


@pytest.mark.parametrize("name", sorted(SPECTRA))
def test_leading_eigenpairs(name):
    values = SPECTRA[name]
    m = matrix(values)
    e, u = W.leading(m, 16)
    want = np.sort(values)[::-1]
    want = want[want > 0][:16]
    assert len(e) == len(want)
    size = values.max()
    assert np.abs(e - want).max() <= 1e-13 * size * len(values)
    assert np.abs(m @ u - u * e).max() <= 1e-13 * size * len(values)
    assert np.abs(u.T @ u - np.eye(len(e))).max() < 1e-13


def test_random_spectra():
    rng = np.random.default_rng(7)
    for k in range(40):
        dims = int(rng.integers(1, 60))
        x = rng.standard_normal((int(rng.integers(1, 80)), dims)) * 10.0 ** rng.uniform(-2, 2, dims)
        m = np.cov(x.T, bias=True).reshape(dims, dims) if len(x) > 1 else np.zeros((dims, dims))
        e, u = W.leading(m, 16)
        want = np.linalg.eigvalsh(m)[::-1]
        rank = int((want > 1e-12 * max(want[0], 1e-300)).sum())
        assert min(16, rank) <= len(e) <= 16 and np.abs(e - want[:len(e)]).max(initial=0) <= 1e-12 * want[0]
        assert np.abs(m @ u - u * e).max(initial=0) <= 1e-12 * max(want[0], 1e-300)


def test_inertia_and_projector():
    values = np.array([0.0, 1, 1, 2, 5, 9])
    m = matrix(values)
    tri = W.tridiagonal(m)
    for at in (-1, 0.5, 1.5, 3, 7, 10):
        assert W.inertia(tri, at) == (values > at).sum()
    p = W.project(m, 0.5, 2.5, np.eye(6), nodes=32)
    assert np.abs(p @ p - p).max() < 1e-6 and round(np.trace(p)) == 3
    assert W.leading(np.zeros((4, 4)), 16)[0].size == 0


def brute(vectors, components=16):
    """vec_id -> (n, deviation, whitened up to sign) by whole numbers and a dense solver."""
    good = [(i, [int(np.floor(64 * float(c))) + 1000000 for c in v]) for i, v in vectors
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fit])
    cov = centred.T @ centred / n
    e, u = np.linalg.eigh(cov)
    order = [k for k in np.argsort(-e) if e[k] > 1e-12 * e.max()][:components]
    out = [(i, sum((n * a - s) ** 2 for a, s in zip(x, sums)),
            np.array([(n * a - s) / n for a, s in zip(x, sums)]) @ u[:, order] / np.sqrt(e[order])) for i, x in good]
    return n, e[order] / np.trace(cov), out


def test_query_against_dense_solver(spark):
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    n, share, want = brute(vectors)
    got = {}
    for r in Q.op11_whitening(spark, SF).collect():
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert abs(r["explained"] / share[r["component"] - 1] - 1) < 1e-9
        got.setdefault(r["vec_id"], {})[r["component"]] = (r["whitened"], r["deviation"])
    assert len(got) == len(want)
    a = np.array([[got[i][k][0] for k in range(1, 17)] for i, _, _ in want])
    b = np.array([w for _, _, w in want])
    sign = np.sign((a * b).sum(axis=0))
    assert np.abs(a * sign - b).max() < 1e-6
    assert all({d for _, d in got[i].values()} == {dev} for i, dev, _ in want)


def frame(spark, rows):
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))]
                          + [T.StructField(c, T.StringType()) for c in [*CLASHES, "x", "dims", "w", "share", "component"]])
    return spark.createDataFrame([(*r, *["?"] * (len(CLASHES) + 5)) for r in rows], schema).repartition(3)


def test_edges(spark):
    rng = np.random.default_rng(2)
    nan, inf = float("nan"), float("inf")
    rows = [(i, rng.standard_normal(5).tolist()) for i in range(40)]
    rows += [(40, None), (41, [nan] * 5), (42, [1.0, inf, 0.0, 0.0, 0.0]), (43, [None] * 5), (44, []), (45, [1.0, 2.0]),
             (0, rows[0][1]), (None, rows[1][1]), (46, rows[2][1])]        # repeated id, no id, repeated vector
    out = W.whiten(frame(spark, rows)).collect()
    n, _, want = brute([r for r in rows if r[1] and len(r[1]) == 5])
    assert n == 40 and {r["n"] for r in out} == {40}
    ids = sorted((r["vec_id"] is not None, r["vec_id"] or 0) for r in out if r["component"] == 1)
    assert ids == sorted((i is not None, i or 0) for i, _, _ in want)      # 40..45 give no rows, repeated ones all theirs
    assert {r["component"] for r in out} == {1, 2, 3, 4, 5}
    assert {(r["vec_id"], r["deviation"]) for r in out} == {(i, d) for i, d, _ in want}
    assert W.whiten(frame(spark, [])).count() == 0
    assert W.whiten(frame(spark, rows[40:45])).count() == 0
    assert W.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0   # one distinct vector: no spread


def test_large_ids_beside_missing_ones(spark):
    ids = [2 ** 62 + 1, None, -2 ** 63, 3]
    out = W.whiten(frame(spark, [(i, [float(k), float(k * k)]) for k, i in enumerate(ids)]).coalesce(1))
    assert sorted((r["vec_id"] for r in out.where("component = 1").collect()), key=str) == sorted(ids, key=str)


def test_lengths_and_ranks(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((30, 2))
    flat = [(i, [a, b, a, 7.0]) for i, (a, b) in enumerate(base.tolist())]           # rank 2 of 4
    short = [(100 + i, [float(i), float(i * i)]) for i in range(10)]
    out = W.whiten(frame(spark, flat + short)).collect()
    comps = {}
    for r in out:
        comps.setdefault(r["vec_id"], set()).add(r["component"])
        assert r["n"] == (30 if r["vec_id"] < 100 else 10) and r["identity_error"] < 1e-9
    assert all(c == {1, 2} for c in comps.values()) and len(comps) == 40


def test_huge_entries(spark):
    out = W.whiten(frame(spark, [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 5.0]), (4, [2.0 ** 31, 1.0])])).collect()
    assert {r["vec_id"] for r in out} == {1, 2, 3, 4}
    assert all(r["deviation"] is None for r in out if r["vec_id"] in (1, 2))
    _, _, want = brute([(1, [2.0 ** 20, 0.0]), (2, [0.0, 1.0]), (3, [0.5, 5.0])])
    out = W.whiten(frame(spark, [(1, [2.0 ** 20, 0.0]), (2, [0.0, 1.0]), (3, [0.5, 5.0])])).collect()
    assert {(r["vec_id"], r["deviation"]) for r in out} == {(i, d) for i, d, _ in want}
