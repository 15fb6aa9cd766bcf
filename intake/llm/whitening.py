"""Embedding whitening by contour integration (FEAST).

Vectors become whole numbers, ``floor(scale * c) + shift``; each distinct one
counts once in the fit.  Sums and the covariance are added up in the tasks and
by Spark, on numbers centred at the whole part of the mean, so that sums stay
exact in doubles as long as they are below 2**53, in any order; only a matrix of
dims x dims reaches the driver, whatever the number of rows.

There its leading eigenvectors are found interval by interval.  Inertia counts
(signs of the pivots of the shifted matrix, in tridiagonal form) cut the part of
the spectrum that is asked for into intervals of few eigenvalues with edges in
gaps.  For each, a quadrature of (zI - V)^-1 over a circle through its edges
projects a random block onto its eigenvectors, Rayleigh-Ritz extracts them, and
both are repeated until the residuals are at rounding.  An interval is done only
if it gave as many eigenvalues as the inertia counts say.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intake.llm.common import frozen

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
EDGE = 2.0 ** 61                 # scaled entries beyond are taken as this
NODES, ROUNDS, FEW = 8, 30, 6    # quadrature nodes on a half circle, iterations, eigenvalues an interval may hold
SEED = 5
EPS = np.finfo(float).eps


# ---- eigenvalues of a symmetric matrix in intervals --------------------------------------------

def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the same eigenvalues (Householder)."""
    a = v.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        alpha = -np.copysign(np.linalg.norm(x), x[0])
        x[0] -= alpha
        size = x @ x
        if size == 0:
            continue
        rest = a[k + 1:, k + 1:]
        p = 2 / size * (rest @ x)
        w = p - (x @ p / size) * x
        rest -= np.outer(x, w) + np.outer(w, x)
        a[k + 1, k] = a[k, k + 1] = alpha
        a[k + 2:, k] = a[k, k + 2:] = 0
    return np.diag(a).copy(), np.diag(a, 1).copy()


def inertia(tri: tuple[np.ndarray, np.ndarray], at: float) -> int:
    """Number of eigenvalues above ``at``: positive pivots of the shifted matrix."""
    diagonal, off = tri
    tiny = EPS * EPS * max(np.abs(diagonal).max(), np.abs(off).max() if len(off) else 0, np.finfo(float).tiny / EPS / EPS)
    above, q = 0, 1.0
    for k, d in enumerate(diagonal):
        q = d - at - (off[k - 1] ** 2 / q if k else 0)
        if abs(q) < tiny:
            q = -tiny
        above += q > 0
    return above


def intervals(tri: tuple, low: float, high: float, tol: float) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues in it) of pieces that hold few eigenvalues and end in gaps; empty ones are left out."""
    out, todo = [], [(low, high, inertia(tri, low) - inertia(tri, high))]
    while todo:
        lo, hi, n = todo.pop()
        if n == 0:
            continue
        if n > FEW:
            width = hi - lo
            for part in (0.5, 0.4, 0.6, 0.3, 0.7, 0.2, 0.8, 0.1, 0.9, 0.05, 0.02, 0.01):
                mid, gap = lo + part * width, max(width * 1e-3, tol)
                if gap * 4 < width and inertia(tri, mid - gap) == inertia(tri, mid + gap):
                    above = inertia(tri, mid) - inertia(tri, hi)
                    todo += [(lo, mid, n - above), (mid, hi, above)]
                    break
            else:
                out.append((lo, hi, n))     # a cluster: no gap to cut in
            continue
        out.append((lo, hi, n))
    return out


def project(v: np.ndarray, lo: float, hi: float, block: np.ndarray, nodes: int = NODES) -> np.ndarray:
    """A block of vectors on the eigenvectors of [lo, hi]: Gauss-Legendre quadrature over a half circle."""
    t, w = np.polynomial.legendre.leggauss(nodes)
    centre, radius = (lo + hi) / 2, (hi - lo) / 2
    out = np.zeros_like(block)
    for turn, weight in zip(np.exp(1j * np.pi * (t + 1) / 2), w):
        solved = np.linalg.solve((centre + radius * turn) * np.eye(len(v)) - v, block.astype(complex))
        out += weight / 2 * (radius * turn * solved).real
    return out


def ritz(v: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ritz values and vectors of a block's span."""
    q, r, _ = np.linalg.svd(block, full_matrices=False)
    q = q[:, r > r.max(initial=0) * EPS * len(v)]
    q = np.linalg.qr(q)[0]
    small = q.T @ v @ q
    e, u = np.linalg.eigh((small + small.T) / 2)
    return e, q @ u


def feast(v: np.ndarray, lo: float, hi: float, count: int, tol: float) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues in [lo, hi] and their vectors."""
    dims, size = len(v), min(len(v), 2 * count + 4)
    rng = np.random.default_rng(SEED)
    block = rng.standard_normal((dims, size))
    while True:
        for _ in range(ROUNDS):
            e, u = ritz(v, project(v, lo, hi, block))
            inside = (e >= lo) & (e <= hi)
            if inside.sum() == count and np.abs(v @ u[:, inside] - u[:, inside] * e[inside]).max() <= tol:
                return e[inside], u[:, inside]
            block = np.hstack([u, rng.standard_normal((dims, size - u.shape[1]))])
        if size == dims:
            raise ArithmeticError(f"{count} eigenvalues in [{lo}, {hi}] by inertia, {inside.sum()} found")
        size = min(dims, 2 * size)
        block = np.hstack([u, rng.standard_normal((dims, size - u.shape[1]))])


def leading(v: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns; those at rounding of zero are none."""
    size = np.abs(v).sum(axis=1).max(initial=0)
    if size == 0:
        return np.empty(0), np.empty((len(v), 0))
    v, dims = v / size, len(v)               # eigenvalues at most 1
    tri, tol = tridiagonal(v), 8 * EPS * dims
    want = min(components, inertia(tri, tol))
    if not want:
        return np.empty(0), np.empty((dims, 0))
    # the highest edge with enough eigenvalues above it, in a gap (ties stay together)
    lo, hi = tol, 1 + 1e-3
    for _ in range(60):
        mid = (lo + hi) / 2
        if inertia(tri, mid) >= want:
            lo = mid
        else:
            hi = mid
        if hi - lo <= max(tol, 1e-6 * lo):
            break
    low = lo
    for k in range(1, 40):                   # step down into a clear gap
        step = max(tol, low * 1e-4) * k
        if low - step <= 2 * tol:
            low = tol
            break
        if inertia(tri, low - step * 1.5) == inertia(tri, low - step / 2):
            low -= step
            break
    found = [feast(v, a, b, n, 4 * tol) for a, b, n in intervals(tri, low, 1 + 1e-3, tol)]
    vectors = np.hstack([u for _, u in found])
    e, u = ritz(v, vectors)                  # orthogonal over all intervals
    if len(e) != inertia(tri, low):
        raise ArithmeticError("eigenvectors of two intervals coincide")
    e, u = e[::-1][:want], u[:, ::-1][:, :want]
    return e * size, u


# ---- vectors ------------------------------------------------------------------------------------

@dataclass
class Fit:
    """Whitening of vectors of one length."""

    n: int
    sums: list[int]              # per dimension, over the fit list
    vectors: np.ndarray          # components as columns
    values: np.ndarray           # their eigenvalues, falling
    trace: float
    error: float | None = None   # of the whitened covariance, see ``fit``

    @property
    def base(self) -> np.ndarray:
        """Whole part of the mean."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """Sums of what is left above it."""
        return np.array([s % self.n for s in self.sums], np.int64)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.base).astype(float) - self.rest / self.n) @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - S)^2 over dimensions, exact; None where it is beyond a long."""
        y = x - self.base
        if len(self.sums) * (self.n * (float(np.abs(y).max(initial=0)) + 1)) ** 2 < 2.0 ** 62:
            return ((self.n * y - self.rest) ** 2).sum(axis=1).tolist()
        rest = [int(r) for r in self.rest]
        sums = [sum((self.n * int(a) - r) ** 2 for a, r in zip(row, rest)) for row in y.tolist()]
        return [s if s < 2 ** 63 else None for s in sums]


def whole_numbers(v: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """Entries as long: floor(scale * c) + shift, taken as +-2**61 where scale * c is beyond."""
    return F.transform(v.cast("array<double>"), lambda c: F.floor(F.greatest(F.least(scale * c, F.lit(EDGE)), F.lit(-EDGE))) + shift)


def usable(v: Column) -> Column:
    return v.isNotNull() & F.forall(v.cast("array<double>"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))


def _by_length(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for pdf in batches:
        for dims, part in pdf.groupby(pdf["x"].map(len), sort=True):
            if dims:
                yield part, np.stack(part["x"].to_numpy()).astype(np.int64)


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from decimal import Decimal

    total: dict[int, list[int]] = {}
    for _, x in _by_length(batches):
        high, low = (x >> 31).sum(axis=0).tolist(), (x & (2 ** 31 - 1)).sum(axis=0).tolist()  # no overflow
        own = [len(x)] + [(a << 31) + b for a, b in zip(high, low)]
        total[x.shape[1]] = [a + b for a, b in zip(total.get(x.shape[1], [0] * len(own)), own)]
    for dims, own in total.items():
        yield pd.DataFrame({"dims": dims, "i": range(len(own)), "s": [Decimal(s) for s in own]})


def _products(fits: dict[int, Fit], whitened: bool):
    """Tasks' sums of y_i * y_j (and of y_i as j = -1), y the centred or the whitened vectors of the fit list."""
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for _, x in _by_length(batches):
            fit = fits[x.shape[1]]
            y = fit.whiten(x) if whitened else (x - fit.base).astype(float)
            y = np.hstack([np.ones((len(y), 1)), y])
            total[x.shape[1]] = total.get(x.shape[1], 0) + y.T @ y
        for dims, own in total.items():
            i, j = np.triu_indices(len(own))
            yield pd.DataFrame({"dims": dims, "i": i - 1, "j": j - 1, "s": own[i, j]})
    return add


def _covariance(x: DataFrame, fits: dict[int, Fit], whitened: bool) -> dict[int, np.ndarray]:
    """Per length, the covariance over the fit list (divisor n)."""
    rows = (x.mapInPandas(_products(fits, whitened), "dims int, i int, j int, s double")
            .groupBy("dims", "i", "j").agg(F.sum("s").alias("s")).toPandas())
    out = {}
    for dims, part in rows.groupby("dims"):
        size = int(part["j"].max()) + 2
        m = np.zeros((size, size))
        m[part["i"] + 1, part["j"] + 1] = part["s"]
        m = np.triu(m) + np.triu(m, 1).T
        n = m[0, 0]
        out[int(dims)] = (m[1:, 1:] - np.outer(m[0, 1:], m[0, 1:]) / n) / n
    return out


def fit(x: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """Whitening per length of the vectors ``x`` (array of long), each distinct vector once.

    Brought to the driver, per length: the sums and the upper half of a matrix
    of dims x dims.  Components whose eigenvalue is at rounding of zero are none,
    so a fit may have fewer than asked for."""
    once = frozen(x.select("x").distinct(), "whole-vectors")
    sums = once.mapInPandas(_sums, "dims int, i int, s decimal(38,0)").groupBy("dims", "i").agg(F.sum("s").alias("s")).collect()
    got: dict[int, dict[int, int]] = {}
    for r in sums:
        got.setdefault(r["dims"], {})[r["i"]] = int(r["s"])
    fits = {d: Fit(s[0], [s[i] for i in range(1, d + 1)], np.empty((d, 0)), np.empty(0), 0.0) for d, s in got.items()}
    if not fits:
        return fits
    for d, v in _covariance(once, fits, whitened=False).items():
        fits[d].values, fits[d].vectors = leading(v, components)
        fits[d].trace = float(np.trace(v))
    for d, c in _covariance(once, fits, whitened=True).items():
        if len(c):
            fits[d].error = float(np.abs(c - np.eye(len(c))).max())
    return fits


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT,
           id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), one row per row and component.

    Rows whose vector is null or holds null or non-finite entries give none.
    Vectors of each length have a fit of their own; empty vectors, and a length
    with one distinct vector only, have no component and give no rows.  n is the
    number of distinct vectors of the fit, deviation the squared distance of
    n * x from their sum (null beyond a long).  Repeated rows come out as often as
    they are there.  Other columns are not read."""
    good = vectors.where(usable(F.col(vec_col))).select(
        F.col(id_col).cast("string").alias("vec_id"), whole_numbers(F.col(vec_col), scale, shift).alias("x"))
    fits = fit(good, components)

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, x in _by_length(batches):
            f = fits[x.shape[1]]
            if len(f.values):
                yield pd.DataFrame({
                    "vec_id": part["vec_id"].to_numpy(), "dims": x.shape[1],
                    "deviation": pd.array(f.deviation(x), "Int64"), "w": list(f.whiten(x))})

    shared = vectors.sparkSession.createDataFrame(
        [(d, int(f.n), [float(e / f.trace) for e in f.values], f.error) for d, f in fits.items() if len(f.values)],
        "dims int, n long, share array<double>, identity_error double")
    # ids travel as texts: pandas would make floats of numbers with nulls among them; one row a length is broadcast
    out = good.mapInPandas(apply, "vec_id string, dims int, deviation long, w array<double>").join(F.broadcast(shared), "dims")
    return out.select(F.col("vec_id").cast(vectors.schema[id_col].dataType), F.posexplode(F.arrays_zip("w", "share")).alias("k", "c"), "n", "deviation", "identity_error").select(
        "vec_id", (F.col("k") + 1).alias("component"), "n", "deviation", F.col("c.w").alias("whitened"),
        F.col("c.share").alias("explained"), "identity_error")
