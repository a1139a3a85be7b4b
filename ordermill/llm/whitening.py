"""Whitened principal components by pivoted Cholesky and one-sided Jacobi.

The fit runs over the distinct integer vectors.  One pass gives their number
and sums; a second one the scatter around the integer point next to the mean,
exact integers per task that Spark adds up.  What is left of the mean (under
half a unit a component) is corrected in whole numbers, so the covariance is
exact before it becomes doubles, whatever the order and partitioning.

The covariance is factored by Cholesky with diagonal pivoting.  One-sided
Jacobi turns the columns of that triangular factor pairwise until they are
orthogonal: their squared norms are the eigenvalues, the columns over their
norms the components.  The matrix itself is never iterated on, which keeps
small eigenvalues accurate.  Only dimension x dimension numbers reach the
driver.  A last pass over the distinct vectors measures the covariance of the
whitened vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import staged
from ordermill.llm.vectors import LONGS, integer_vectors, matrix, slices

SCALE, COMPONENTS = 256, 4
SWEEPS = 60
EPS = np.finfo(float).eps


def cholesky(a: np.ndarray) -> np.ndarray:
    """Factor g with g @ g.T = a for a positive semidefinite matrix, columns in
    pivot order (triangular once its rows are taken in that order); as many
    columns as the rank."""
    n = len(a)
    g = np.zeros((n, n))
    left = a.diagonal().astype(float).copy()
    floor = n * EPS * left.max(initial=0.0)
    rest = np.ones(n, bool)
    for k in range(n):
        pivot = int(np.argmax(np.where(rest, left, -np.inf)))
        if left[pivot] <= floor:
            return g[:, :k]
        root = math.sqrt(left[pivot])
        rest[pivot] = False
        g[pivot, k] = root
        g[rest, k] = (a[rest, pivot] - g[rest, :k] @ g[pivot, :k]) / root
        left[rest] -= g[rest, k] ** 2
    return g


def jacobi(g: np.ndarray) -> np.ndarray:
    """The columns of g turned until they are orthogonal: g @ g.T stays as it is.
    Disjoint pairs turn together, every pair once a sweep."""
    g = g.copy()
    n = g.shape[1]
    ring = list(range(n + n % 2))
    for _ in range(SWEEPS):
        turned = False
        for _ in range(len(ring) - 1):
            half = len(ring) // 2
            pairs = [(a, b) for a, b in zip(ring[:half], ring[:half - 1:-1]) if a < n and b < n]
            ring = [ring[0], ring[-1], *ring[1:-1]]
            if not pairs:
                continue
            p, q = map(list, zip(*pairs))
            gp, gq = g[:, p], g[:, q]
            a, b, c = (gp * gp).sum(axis=0), (gq * gq).sum(axis=0), (gp * gq).sum(axis=0)
            turn = np.abs(c) > EPS * np.sqrt(a * b)
            if not turn.any():
                continue
            turned = True
            with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                zeta = (b - a) / (2 * c)
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            t = np.where(turn, t, 0.0)
            cos = 1 / np.hypot(1.0, t)
            sin = cos * t
            g[:, p], g[:, q] = cos * gp - sin * gq, sin * gp + cos * gq
        if not turned:
            break
    return g


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positive eigenvalues, falling, and their unit eigenvectors as columns
    (the entry of largest size is positive)."""
    g = jacobi(cholesky(a))
    values = (g * g).sum(axis=0)
    order = [int(i) for i in np.argsort(-values, kind="stable") if values[i] > 0]
    vectors = g[:, order] / np.sqrt(values[order])
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), range(len(order))]) if len(order) else 1
    return values[order], vectors * signs


def _sums(dims):
    def run(batches):
        n, total = 0, [0] * dims
        for b in slices(batches):
            x = matrix(b.column("x"), dims)
            n += len(x)
            total = [t + int(s) for t, s in zip(total, _exact_sum(x))]
        yield pa.record_batch([pa.array([-1, *range(dims)], pa.int32()),
                               pa.array([n, *total], pa.decimal128(38, 0))], names=["at", "s"])
    return run


def _exact_sum(x):
    most = int(max(x.max(initial=0), -int(x.min(initial=0))))
    return x.sum(axis=0) if most * max(len(x), 1) < LONGS else x.astype(object).sum(axis=0)


def _scatter(dims, centre, bound):
    low = [(i, j) for i in range(dims) for j in range(i + 1)]
    whole = object if bound >= LONGS // 4 else np.int64

    def run(batches):
        total = np.zeros((dims, dims), object)
        for b in slices(batches):
            y = matrix(b.column("x"), dims).astype(whole) - np.array(centre, whole)
            most = max(int(y.max()), -int(y.min())) if y.size else 0
            if most * most * max(len(y), 1) < 1 << 53:       # every product and sum is a whole double
                y = y.astype(np.float64)
                total = total + (y.T @ y).astype(np.int64).astype(object)
            else:
                y = y.astype(object)
                total = total + y.T @ y
        yield pa.record_batch([pa.array([i for i, _ in low], pa.int32()), pa.array([j for _, j in low], pa.int32()),
                               pa.array([int(total[i, j]) for i, j in low], pa.decimal128(38, 0))], names=["i", "j", "s"])
    return run


def _offsets(x, n, sums):
    """n * x - sums, exact: 64-bit integers where they and their squares' sum fit, else Python's."""
    most = (int(max(x.max(initial=0), -int(x.min(initial=0)))) * n + max(map(abs, sums), default=0))
    if most * most * max(x.shape[1], 1) < LONGS:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _project(off, n, vectors, values):
    """Whitened coordinates, one by one (a row's do not depend on the rows beside it)."""
    y = (off / n).astype(np.float64)
    return [(y * vectors[:, c]).sum(axis=1) / math.sqrt(values[c]) for c in range(len(values))]


def _check(dims, n, sums, vectors, values):
    k = len(values)

    def run(batches):
        z_sum, zz_sum = np.zeros(k), np.zeros((k, k))
        for b in slices(batches):
            z = np.array(_project(_offsets(matrix(b.column("x"), dims), n, sums), n, vectors, values))
            z_sum, zz_sum = z_sum + z.sum(axis=1), zz_sum + z @ z.T
        yield pa.record_batch([pa.array(np.arange(k + k * k, dtype=np.int32)), pa.array(np.r_[z_sum, zz_sum.reshape(-1)])],
                              names=["at", "s"])
    return run


def _rows(dims, n, sums, vectors, values, explained):
    k = len(values)

    def run(batches):
        for b in slices(batches):
            off = _offsets(matrix(b.column("x"), dims), n, sums)
            deviation = pa.array([int(d) for d in (off * off).sum(axis=1)], pa.decimal128(38, 0))
            whitened = _project(off, n, vectors, values)
            for c in range(k):
                yield pa.record_batch(
                    [b.column("vec_id"), pa.array(np.full(len(off), c + 1, np.int32)), deviation, pa.array(whitened[c]),
                     pa.array(np.full(len(off), explained[c]))],
                    names=["vec_id", "component", "deviation", "whitened", "explained"])
    return run


def whiten(vectors: DataFrame, id_col="vec_id", vec_col="embedding", scale=SCALE, components=COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation (exact), whitened, explained,
    identity_error: one row for each sound vector and component.

    Vectors that are null or hold null, NaN or infinite components are left
    out; shorter ones count as padded with zeros.  Repeated rows give a row
    each and count once in the fit; null ids stay null.  There are as many
    components as the covariance has rank, at most ``components``: an empty
    table, one distinct vector or vectors without components give no rows."""
    spark = vectors.sparkSession
    rows, dims, bound = integer_vectors(vectors, scale, id_col, vec_col)
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("x"))
    fit = staged(rows.select(F.concat("x", zeros).alias("x")).distinct(), "whiten-fit")
    out = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, "
           "identity_error double")
    got = dict(fit.mapInArrow(_sums(dims), "at int, s decimal(38,0)").groupBy("at").agg(F.sum("s")).collect())
    n, sums = int(got.get(-1, 0)), [int(got.get(j, 0)) for j in range(dims)]
    if n < 2 or not dims:
        return spark.createDataFrame([], out)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    scatter = fit.mapInArrow(_scatter(dims, centre, bound), "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(
        F.sum("s").alias("s")).collect()                     # half a dimension x dimension matrix
    rest = [s - n * c for s, c in zip(sums, centre)]
    cov, trace = np.zeros((dims, dims)), 0
    for i, j, s in scatter:
        whole = n * int(s) - rest[i] * rest[j]               # n * n times the covariance
        cov[i, j] = cov[j, i] = whole / (n * n)
        trace += whole if i == j else 0
    values, units = eigen(cov)
    values, units = values[:components], units[:, :components]
    k = len(values)
    if not k:
        return spark.createDataFrame([], out)
    explained = (values / (trace / (n * n))).tolist()
    seen = dict(fit.mapInArrow(_check(dims, n, sums, units, values), "at int, s double")
                .groupBy("at").agg(F.sum("s")).collect())
    mean = np.array([seen[c] / n for c in range(k)])         # next to nothing: the vectors are centred
    second = np.array([seen[k + c] / n for c in range(k * k)]).reshape(k, k)
    error = float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())
    return rows.mapInArrow(_rows(dims, n, sums, units, values, explained),
                           "vec_id long, component int, deviation decimal(38,0), whitened double, explained double"
                           ).select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                                    "explained", F.lit(error).alias("identity_error"))
