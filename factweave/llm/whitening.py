"""Whitening of embeddings: exact distributed covariance, eigenvectors refined from float32 to double precision.

Entries become whole numbers x = floor(scale * c) + shift, so sums need no rounding: one pass sums every
dimension, a second one centres by the rounded mean and multiplies, in blocks so small that every float64
product sum is a whole number below 2^53. Spark adds the tasks' sums as decimals; the covariance is the same
whatever the partitions are. A task emits dim^2 numbers, the driver receives dim^2 numbers: both are
bounded by the dimension, not by the rows.

The eigenvectors start in float32 and are corrected by the iteration of Ogita and Aishima, in long double:
with R = I - X'X and S = X'AX, the eigenvalues are s_ii / (1 - r_ii) and X gains X E, where
e_ij = (s_ij + l_j r_ij) / (l_j - l_i) for eigenvalues further apart than the error bound, r_ij / 2 else.
Each step is a few matrix products and squares the error. Eigenvalues closer than the bound form a
cluster: its block X_J'(A - mu I)X_J, whose entries are as small as the cluster is narrow, is solved apart
and turns the cluster's vectors; the iteration then goes on, with bounds that have become smaller. Equal
eigenvalues stay a cluster, and any orthonormal basis of theirs is right.

Defined results: rows whose vector is null or empty, or holds null or non-finite entries, and rows whose
vector has another length than most (ties: the longer) take no part. Scaled entries saturate at +-2^50.
Repeated rows count as often as they occur; a null id stays null; an empty table gives an empty result.
A component without variance has ``whitened`` null and does not count for ``identity_error``; where no
variance is left at all, ``explained`` is null and ``identity_error`` 0. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factweave.llm.common import map_text
from factweave.llm.vectors import matrix, usable

LARGEST = 1 << 50
LIMB = 20            # bits of a limb: products of two limbs of 2^12 rows stay below 2^53
BLOCK_ROWS = 1 << 12


@dataclass(frozen=True)
class Whitener:
    """The fitted transform: ``center`` (whole numbers near the mean), ``sums`` of x - center, ``vectors`` (dim, k), eigenvalues."""
    n: int
    center: np.ndarray
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    peak: int            # largest |x - center|
    scale: float
    shift: int

    def project(self, y: np.ndarray) -> np.ndarray:
        """Whitened coordinates of rows x - center; columns without variance hold 0."""
        rate = np.where(self.values > 0, 1.0 / np.sqrt(np.where(self.values > 0, self.values, 1.0)), 0.0)
        centred, axes = (y - (self.sums.astype(float) / self.n)).T, self.vectors * rate
        out = np.zeros((centred.shape[1], axes.shape[1]))
        for values, axis in zip(np.ascontiguousarray(centred), axes):  # dimension by dimension: a matrix product's order of addition depends on the batch
            out += values[:, None] * axis
        return out


def integers(column: pa.Array, dim: int, scale: float, shift: int) -> np.ndarray:
    """floor(scale * c) + shift of a list column, as int64."""
    x = np.floor(matrix(column, dim).astype(np.float64) * scale)
    return np.clip(x, -LARGEST, LARGEST).astype(np.int64) + shift


def _vectors(df: DataFrame, id_col: str, vector: str, dim: int | None = None) -> DataFrame:
    out = df.filter(usable(vector))
    if dim is not None:
        out = out.filter(F.size(vector) == dim)
    return out.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))


def gram(y: np.ndarray, peak: int) -> np.ndarray:
    """y'y of int64 rows, exactly, as an array of Python integers."""
    d = y.shape[1]
    total = np.zeros((d, d), object)
    limbs = max(1, -(-(int(peak).bit_length() + 1) // LIMB))
    parts = []
    for t in range(limbs):  # floor division: all limbs but the last lie in [0, 2^LIMB)
        parts.append((y if t == limbs - 1 else y & ((1 << LIMB) - 1)).astype(np.float64))
        y = y >> LIMB
    for i in range(0, len(parts[0]), BLOCK_ROWS):
        for t in range(limbs):
            for u in range(limbs):
                exact = parts[t][i:i + BLOCK_ROWS].T @ parts[u][i:i + BLOCK_ROWS]
                total += exact.astype(np.int64).astype(object) << LIMB * (t + u)
    return total


def _norm(m: np.ndarray):
    return np.sqrt((m * m).sum())


def refined_eigh(a: np.ndarray, steps: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, eigenvectors) of a symmetric long double matrix, from a float32 start."""
    d = len(a)
    size = np.abs(a).max()
    if not size:
        return np.zeros(d, a.dtype), np.eye(d, dtype=a.dtype)
    a = a / size
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(a.dtype)
    eye, whole = np.eye(d, dtype=a.dtype), _norm(a)
    tiny, before = np.finfo(a.dtype).eps * d, np.inf
    for _ in range(steps):
        r = eye - x.T @ x
        s = x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2  # symmetric to the last bit: small gaps would enlarge the difference
        values = np.diag(s) / (1 - np.diag(r))
        bound = 2 * (_norm(s - np.diag(values)) + whole * _norm(r))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > bound
        e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ e
        order = np.argsort(-values)
        x, values = x[:, order], values[order]
        cut = np.flatnonzero(values[:-1] - values[1:] > bound) + 1
        for cluster in np.split(np.arange(d), cut):
            if len(cluster) < 2:
                continue
            xj, mu = x[:, cluster], values[cluster].mean()
            block = xj.T @ (a @ xj - mu * xj)
            block = (block + block.T) / 2
            width = np.abs(block).max()
            if width > tiny:  # a narrower cluster is one eigenvalue for this precision
                q = np.linalg.eigh((block / width).astype(np.float64))[1].astype(a.dtype)[:, ::-1]
                x[:, cluster] = xj @ q
        if bound <= tiny or (bound < 1e-15 and bound > before / 2):  # as exact as this precision gets
            break
        before = bound
    x = x + x @ ((eye - x.T @ x) / 2)  # a cluster's turn in double precision leaves the last digits
    values = np.einsum("ij,ij->j", x, a @ x) * size
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def fit(vectors: DataFrame, components: int, scale: float, shift: int, dim: int) -> Whitener | None:
    """The transform of all ``vectors`` (vec_id, v), each of ``dim`` entries; None without rows."""
    def totals(batches):
        n, total, low, high = 0, np.zeros(dim, object), None, None
        for batch in batches:
            x = integers(batch.column(0), dim, scale, shift)
            if not len(x):
                continue
            n += len(x)
            total += (x >> 31).sum(axis=0).astype(object) * (1 << 31) + (x & ((1 << 31) - 1)).sum(axis=0).astype(object)
            low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
            high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
        if n:
            yield list(range(dim)), [n] * dim, [str(t) for t in total], low, high

    rows = map_text(vectors.select("v"), lambda b: totals(b), "i int, n long, total string, low long, high long") \
        .groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.min("low").alias("low"), F.max("high").alias("high")) \
        .orderBy("i").collect()
    if not rows:
        return None
    n = rows[0].n
    total = np.array([int(r.total) for r in rows], object)
    center = (2 * total + n) // (2 * n)
    sums = total - n * center
    peak = max(max(abs(r.high - c), abs(r.low - c)) for r, c in zip(rows, center.tolist()))
    middle = center.astype(np.int64)

    def products(batches):
        acc, seen = np.zeros((dim, dim), object), False
        for batch in batches:
            y = integers(batch.column(0), dim, scale, shift) - middle
            if len(y):
                acc, seen = acc + gram(y, peak), True
        if seen:
            i, j = np.triu_indices(dim)
            yield i, j, [str(v) for v in acc[i, j]]

    cells = map_text(vectors.select("v"), lambda b: products(b), "i int, j int, value string") \
        .groupBy("i", "j").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    exact = np.zeros((dim, dim), object)
    for c in cells:
        exact[c.i, c.j] = exact[c.j, c.i] = n * int(c.value) - int(sums[c.i]) * int(sums[c.j])
    cov = np.array([[np.longdouble(str(v)) for v in row] for row in exact]) / (np.longdouble(n) * np.longdouble(n))
    values, x = refined_eigh(cov)
    k = min(components, dim)
    x, values, trace = x[:, :k], values[:k], np.trace(cov)
    x = x * np.where(x[np.abs(x).argmax(axis=0), np.arange(k)] < 0, -1, 1)
    values = np.where(values > np.abs(values).max(initial=0) * np.finfo(np.float64).eps * dim, values, 0)
    return Whitener(n, middle, sums, x.astype(np.float64), values.astype(np.float64), float(trace), int(peak), scale, shift)


def identity_error(vectors: DataFrame, w: Whitener) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured over all rows."""
    dim, k = len(w.center), len(w.values)

    def moments(batches):
        n, first, second = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            z = w.project(integers(batch.column(0), dim, w.scale, w.shift) - w.center)
            n, first, second = n + len(z), first + z.sum(axis=0), second + z.T @ z
        if n:
            i, j = np.indices((k, k + 1)).reshape(2, -1)
            yield i, j, np.hstack([second, first[:, None]]).ravel()

    cells = map_text(vectors.select("v"), lambda b: moments(b), "i int, j int, value double") \
        .groupBy("i", "j").agg(F.sum(F.col("value").cast("decimal(38,18)")).alias("value")).collect()
    m = np.zeros((k, k + 1))
    for c in cells:
        m[c.i, c.j] = float(c.value) / w.n
    off = np.abs(m[:, :k] - np.outer(m[:, k], m[:, k]) - np.eye(k))[np.ix_(w.values > 0, w.values > 0)]
    return float(off.max(initial=0.0))


def whiten(df: DataFrame, components: int = 8, id_col: str = "vec_id", vector: str = "embedding", scale: float = 1024.0, shift: int = 100_000) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error, eigenvalue): one row per vector and component.

    ``deviation`` is the exact sum over dimensions of (n x - S)^2, S the sums over the fitted rows, as a decimal.
    """
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double, eigenvalue double"
    sizes = df.filter(usable(vector)).groupBy(F.size(vector).alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    if not sizes:
        return df.sparkSession.createDataFrame([], schema)
    dim = sizes[0].dim
    vectors = _vectors(df, id_col, vector, dim)
    w = fit(vectors, components, scale, shift, dim)
    error, k = identity_error(vectors, w), min(components, dim)
    biggest = (w.n * w.peak + max(abs(int(s)) for s in w.sums)) ** 2 * dim
    explained = w.values / w.trace if w.trace > 0 else [None] * k

    def rows(batches):
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            y = integers(batch.column(1), dim, w.scale, w.shift) - w.center
            far = w.n * (y if biggest < 1 << 63 else y.astype(object)) - (w.sums.astype(np.int64) if biggest < 1 << 63 else w.sums)
            far = (far * far).sum(axis=1)
            deviation = pa.array(far) if biggest < 1 << 63 else pa.array([pa.scalar(int(v), pa.decimal128(38, 0)).as_py() for v in far], pa.decimal128(38, 0))
            z = pa.array(w.project(y).ravel(), mask=np.tile(w.values <= 0, m))
            each = pa.array(np.repeat(np.arange(m), k))
            yield (batch.column(0).take(each), np.tile(np.arange(1, k + 1), m), [w.n] * (m * k), deviation.cast(pa.decimal128(38, 0)).take(each), z,
                   list(explained) * m, [error] * (m * k), np.tile(w.values, m))

    return map_text(vectors, rows, schema)
