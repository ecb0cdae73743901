"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided
Jacobi on the triangular factor.

1. Every component c becomes the whole number x = floor(64 c) + 1000000. One pass sums x,
   a second one the products of x less the rounded means: both in whole numbers, so the
   centred scatter n * sum((x - mean)(x - mean)') is exact whatever the order of the
   rows, and the covariance V is its entry-wise nearest double. A task sends one number for each pair of
   dimensions, however many rows it has; the driver holds the d x d sums, nothing of the rows.
2. V = L L' by Cholesky with the largest remaining diagonal entry as pivot; it stops where
   nothing above rounding is left, so constant or dependent dimensions only shorten L.
3. The columns of L are rotated in pairs until all are orthogonal (a round-robin of disjoint pairs,
   each round as whole arrays). Their squared norms are V's eigenvalues e, the
   columns divided by their norms its unit eigenvectors: L's columns span V's range and
   no second factor is needed. The largest entry of a component is positive.
4. whitened = (x - S/n) . component / sqrt(e). A third pass over the
   whitened vectors measures the largest entry of their covariance minus the identity.

Defined cases: rows with a null or empty vector or a null or non-finite component are dropped; of
vectors of several lengths the most frequent length counts (of equals the greatest), the others are
dropped; a null vec_id stays null; repeated rows each count and each return; fewer independent dimensions than
components asked for give fewer components (no rows at all where all vectors are equal);
an empty table gives an empty result; other columns are ignored. floor(64 c) must fit 31 bits, else an error is raised.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
EXACT = 2.0**53


@dataclass
class Fit:
    """n vectors with per-dimension sums (of x), components as columns, eigenvalues falling."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray


def _usable(embeddings: DataFrame) -> DataFrame:
    e = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return e.where((F.size("embedding") > 0) & F.forall("embedding", finite))


def _whole(m: np.ndarray) -> np.ndarray:
    x = np.floor(m * SCALE)
    if np.abs(x).max(initial=0) >= 2.0**31:
        raise ValueError("components are too large for whole numbers of 31 bits")
    return x.astype(np.int64) + SHIFT


def _batches(batches):
    """(rows, whole numbers) of a few thousand vectors at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, 4096):
            part = batch.slice(i, 4096)
            flat = part.column("embedding").flatten().to_numpy(zero_copy_only=False)
            yield part, _whole(flat.reshape(part.num_rows, -1))  # all of one length


def _sums(vectors: DataFrame, dim: int) -> list[int]:
    def add(batches):
        total = [0] * dim
        for _, x in _batches(batches):
            total = [t + int(s) for t, s in zip(total, x.sum(axis=0), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(total, pa.decimal128(38, 0))], names=["i", "s"])

    rows = vectors.select("embedding").mapInArrow(add, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
    out = [0] * dim
    for r in rows:
        out[r["i"]] = int(r["s"])
    return out


def _products(vectors: DataFrame, centre: np.ndarray) -> np.ndarray:
    """Sums of the products of all pairs of dimensions of x - centre, as Python integers."""
    dim = len(centre)
    i, j = np.triu_indices(dim)

    def add(batches):
        total = np.zeros(len(i), object)
        for _, x in _batches(batches):
            y = x - centre
            if float(np.abs(y).max()) ** 2 * len(y) < EXACT:
                f = y.astype(np.float64)
                p = (f.T @ f).astype(np.int64)  # whole numbers below 2^53: exact
            else:
                p = y.astype(object).T @ y.astype(object)
            total = total + p[i, j].astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.tolist(), pa.decimal128(38, 0))],
                                         names=["i", "j", "s"])

    rows = vectors.select("embedding").mapInArrow(add, "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    out = np.zeros((dim, dim), object)
    for r in rows:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = int(r["s"])
    return out


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L with a = L L' (rows in a's order, columns by falling pivot), as many columns as a has rank."""
    rest, d = np.array(np.diag(a)), len(a)
    limit = d * np.finfo(float).eps * rest.max(initial=0)
    columns = np.zeros((d, d))
    for k in range(d):
        p = int(np.argmax(rest))
        if rest[p] <= limit:
            return columns[:, :k]
        column = (a[:, p] - columns[:, :k] @ columns[p, :k]) / np.sqrt(rest[p])
        column[rest == -np.inf] = 0  # pivots of earlier columns
        column[p] = np.sqrt(rest[p])
        columns[:, k] = column
        rest = rest - column**2
        rest[p] = -np.inf
    return columns


def jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of factor @ factor.T,
    by rotating pairs of the factor's columns until all are orthogonal."""
    a = np.array(factor, float)
    r = a.shape[1]
    size = r + r % 2  # an odd number of columns: one sits out each round
    order = np.arange(size)
    tolerance = 4 * np.finfo(float).eps
    for _ in range(sweeps):
        rotated = False
        for _ in range(size - 1):
            p, q = order[:size // 2], order[size // 2:][::-1]
            inside = (p < r) & (q < r)
            p, q = p[inside], q[inside]
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            turn = np.abs(xy) > tolerance * np.sqrt(xx * yy)
            if turn.any():
                rotated = True
                p, q, x, y, xx, yy, xy = p[turn], q[turn], x[:, turn], y[:, turn], xx[turn], yy[turn], xy[turn]
                zeta = (yy - xx) / (2 * xy)
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                c = 1 / np.hypot(1.0, t)
                a[:, p], a[:, q] = c * x - c * t * y, c * t * x + c * y
            order = np.concatenate([order[:1], np.roll(order[1:], 1)])
        if not rotated:
            break
    norms = np.sqrt((a * a).sum(axis=0))
    down = np.argsort(-norms, kind="stable")
    u = a[:, down] / norms[down]
    u *= np.where(u[np.abs(u).argmax(axis=0), np.arange(u.shape[1])] < 0, -1.0, 1.0)
    return norms[down] ** 2, u


def fit(vectors: DataFrame, n: int, dim: int, components: int) -> Fit:
    sums = _sums(vectors, dim)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    products = _products(vectors, np.array(centre, np.int64))
    left = [s - n * m for s, m in zip(sums, centre, strict=True)]
    v = np.array([[(n * int(products[i, j]) - left[i] * left[j]) / (n * n) for j in range(dim)] for i in range(dim)])
    values, columns = jacobi(pivoted_cholesky(v))
    return Fit(n, sums, columns[:, :components], values[:components], values[:components] / np.trace(v) if len(values) else values)


def _whitened(x: np.ndarray, f: Fit) -> np.ndarray:
    centre = np.array([s // f.n for s in f.sums], np.int64)
    rest = np.array([s % f.n / f.n for s in f.sums])
    return ((x - centre) - rest) @ f.components / np.sqrt(f.eigenvalues)


def _identity_error(vectors: DataFrame, f: Fit) -> float:
    k = len(f.eigenvalues)

    def add(batches):
        first, second = np.zeros(k), np.zeros((k, k))
        for _, x in _batches(batches):
            w = _whitened(x, f)
            first += w.sum(axis=0)
            second += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(k + 1), k), pa.int32()), pa.array(np.tile(np.arange(k), k + 1), pa.int32()),
                                          pa.array(np.concatenate([second.ravel(), first]))], names=["i", "j", "s"])

    # as decimals the sums do not depend on the order of the tasks
    rows = (vectors.select("embedding").mapInArrow(add, "i int, j int, s double")
            .groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,15)")).alias("s")).collect())
    total = np.zeros((k + 1, k))
    for r in rows:
        total[r["i"], r["j"]] = float(r["s"])
    mean = total[k] / f.n  # the vectors are centred, so this is rounding
    return float(np.abs(total[:k] / f.n - np.outer(mean, mean) - np.eye(k)).max())


def _deviation(x: np.ndarray, f: Fit) -> pa.Array:
    """sum over dimensions of (n x - S)^2, exact."""
    centre = np.array([s // f.n for s in f.sums], np.int64)
    rest = [s % f.n for s in f.sums]
    far = float(np.abs(x - centre).max(initial=0) + 1) * f.n
    if far**2 * x.shape[1] < 2.0**62:
        y = (x - centre) * f.n - np.array(rest, np.int64)
        return pa.array((y * y).sum(axis=1)).cast(pa.decimal128(38, 0))
    y = (x - centre).astype(object) * f.n - np.array(rest, object)
    return pa.array([int(s) for s in (y * y).sum(axis=1)], pa.decimal128(38, 0))


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component (from 1): vec_id, component, n, deviation
    (decimal), whitened, explained, identity_error."""
    usable = _usable(embeddings)
    kind = usable.schema["vec_id"].dataType.simpleString()
    lengths = usable.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    empty = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    none = embeddings.sparkSession.createDataFrame([], f"vec_id {kind}, {empty}")
    if not lengths:
        return none
    dim, n = lengths[0]["dim"], lengths[0]["n"]
    vectors = usable.where(F.size("embedding") == dim)
    f = fit(vectors, n, dim, components)
    if not len(f.eigenvalues):
        return none
    error = _identity_error(vectors, f)

    def project(batches):
        for part, x in _batches(batches):
            w = _whitened(x, f)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, w.shape[1]), pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), _deviation(x, f), lists], names=["vec_id", "deviation", "whitened"])

    rows = vectors.mapInArrow(project, f"vec_id {kind}, deviation decimal(38,0), whitened array<double>")
    explained = F.array(*[F.lit(float(e)) for e in f.explained])
    return (rows.select("vec_id", "deviation", F.posexplode("whitened").alias("pos", "whitened"))
            .select("vec_id", (F.col("pos") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                    F.element_at(explained, F.col("pos") + 1).alias("explained"), F.lit(error).alias("identity_error")))
