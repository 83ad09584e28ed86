"""Embedding whitening (12): pivoted Cholesky, then one-sided Jacobi on its factor.

Entries are integers, so counts, sums and the scatter are exact: vectors are centred
by the rounded mean before anything is multiplied, and the rest of the mean (half a
unit at most) is taken off as an exact fraction.  Every task adds up its rows and
returns one triangle of products; Spark adds the triangles entry by entry.  The
d x d scatter, whatever the number of vectors, is factored on the driver: Cholesky
with diagonal pivoting gives P L with L L' = P' V P, and plane rotations make the
columns of P L orthogonal.  Their squared norms are the eigenvalues, the normalised
columns the components.  Scatter is never diagonalised itself, so small eigenvalues
keep their digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.common import bound_batches, cut, read_table
from tickforge.llm.vectors import by_length, floor_scaled

_BIG = pa.decimal128(38, 0)
_LONG = 1 << 63


# ---- linear algebra on the d x d scatter ---------------------------------------

def pivoted_cholesky(a: np.ndarray, tolerance: float = 1e-13) -> np.ndarray:
    """G = P L (d x rank) with G G' = a, the largest remaining diagonal entry first;
    ends where none exceeds ``tolerance`` times the largest entry of the diagonal."""
    a, d = np.array(a, float), len(a)
    g, left = np.zeros((d, d)), np.diag(a).copy()
    least = tolerance * max(left.max(initial=0.0), 0.0)
    used = np.zeros(d, bool)
    for k in range(d):
        p = int(np.argmax(np.where(used, -np.inf, left)))
        if left[p] <= least:
            return g[:, :k]
        column = (a[:, p] - g[:, :k] @ g[p, :k]) / np.sqrt(left[p])
        column[used] = 0.0  # rows already eliminated
        column[p] = np.sqrt(left[p])
        g[:, k], used[p] = column, True
        left = left - column ** 2
    return g


def one_sided_jacobi(g: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit components (columns) of g g': columns are rotated
    in pairs until all are orthogonal to double precision."""
    g = np.array(g, float, order="F")
    n = g.shape[1]
    for _ in range(sweeps):
        turned = False
        for i in range(n - 1):
            for j in range(i + 1, n):
                x, y = g[:, i], g[:, j]
                a, b, c = x @ x, y @ y, x @ y
                if abs(c) <= 1e-15 * np.sqrt(a * b):
                    continue
                turned = True
                z = (b - a) / (2 * c)
                t = (1.0 if z >= 0 else -1.0) / (abs(z) + np.hypot(1.0, z))
                cos = 1 / np.hypot(1.0, t)
                g[:, i], g[:, j] = cos * (x - t * y), cos * (t * x + y)
        if not turned:
            break
    norms = np.sqrt((g * g).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    return norms[order] ** 2, g[:, order] / norms[order]


# ---- sums over the vectors -------------------------------------------------------

def gram(y: np.ndarray) -> np.ndarray:
    """Exact y'y: by doubles or longs while these hold every sum, else by Python integers."""
    top = int(np.abs(y).max(initial=0)) ** 2 * len(y)
    if top < 1 << 53:
        f = y.astype(float)
        return (f.T @ f).astype(np.int64).astype(object)
    if top < _LONG:
        return (y.T @ y).astype(object)
    o = y.astype(object)
    return o.T @ o


def total(y: np.ndarray) -> np.ndarray:
    """Exact column sums."""
    if int(np.abs(y).max(initial=0)) * len(y) < _LONG:
        return y.sum(axis=0).astype(object)
    return y.astype(object).sum(axis=0)


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], _BIG)


def _one_list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _added(parts: DataFrame, by: str | None = None) -> DataFrame:
    """Arrays of decimals added entry by entry: ``(by,) pos, value``."""
    keys = [by] if by else []
    each = parts.select(*keys, F.posexplode("sums").alias("pos", "value"))
    return each.groupBy(*keys, "pos").agg(F.sum("value").cast("decimal(38,0)").alias("value"))


@dataclass
class Whitening:
    """Fit over n integer vectors of one length: sums, eigenvalues and components."""

    dim: int
    n: int
    sums: list[int]
    centre: np.ndarray
    trace: float
    values: np.ndarray
    components: np.ndarray
    scale: float
    shift: int

    def rest(self) -> np.ndarray:
        """Mean of the vectors less the rounded mean."""
        return np.array([float(Fraction(s, self.n) - int(c)) for s, c in zip(self.sums, self.centre)])

    def project(self, y: np.ndarray) -> np.ndarray:
        """Whitened rows of vectors already less the rounded mean."""
        return (y - self.rest()) @ (self.components / np.sqrt(self.values))

    def deviations(self, y: np.ndarray) -> list[int | None]:
        """sum over dimensions of (n x - S)^2, exact; null where no long holds it."""
        left = [s - self.n * int(c) for s, c in zip(self.sums, self.centre)]
        top = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, left), default=0)
        if top * top * self.dim < _LONG:
            d = self.n * y - np.array(left, np.int64)
            return (d * d).sum(axis=1).tolist()
        d = self.n * y.astype(object) - np.array(left, object)
        return [v if v < _LONG else None for v in (d * d).sum(axis=1).tolist()]


def _centred(batches: Iterator[pa.RecordBatch], fit: Whitening) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        rows, x = by_length(batch.column(1)).get(fit.dim, (None, None))
        if rows is not None and len(rows):
            yield batch.column(0).take(pa.array(rows)), floor_scaled(x, fit.scale) + fit.shift - fit.centre


def _moments(scale: float, shift: int):
    """Count and sums of every length of vector, one row a task and length."""
    def run(batches):
        found: dict[int, list] = {}
        for batch in batches:
            for dim, (rows, x) in by_length(batch.column(1)).items():
                if len(rows) and dim:
                    y = floor_scaled(x, scale) + shift
                    was = found.setdefault(dim, [0, np.zeros(dim, object)])
                    was[0] += len(y)
                    was[1] = was[1] + total(y)
        for dim, (n, sums) in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), _one_list(_decimals([n, *sums]))], names=["dim", "sums"])
    return run


def _scatter(fit: Whitening):
    """The triangle of y'y of the centred rows, one row a task."""
    upper = np.triu_indices(fit.dim)

    def run(batches):
        sums = np.zeros(len(upper[0]), object)
        for _, y in _centred(batches, fit):
            sums = sums + gram(y)[upper]
        yield pa.RecordBatch.from_arrays([_one_list(_decimals(sums))], names=["sums"])
    return run


def _spread(fit: Whitening, most: int):
    """Sums and triangle of products of the whitened rows, one row a task."""
    upper = np.triu_indices(most)

    def run(batches):
        one, two = np.zeros(most), np.zeros(len(upper[0]))
        for _, y in _centred(batches, fit):
            z = fit.project(y)[:, :most]
            one, two = one + z.sum(axis=0), two + (z.T @ z)[upper]
        yield pa.RecordBatch.from_arrays([_one_list(pa.array(np.concatenate([one, two])))], names=["sums"])
    return run


def _columns(df: DataFrame, vector: str, id: str) -> DataFrame:
    bound_batches(df.sparkSession)
    return df.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("v"))


def fit(df: DataFrame, scale: float = 64.0, shift: int = 1_000_000, vector: str = "embedding", id: str = "vec_id") -> Whitening | None:
    """Fit on all vectors of ``df``; entries become integers floor(scale * entry) + shift.

    Vectors that are null or hold a null, NaN or infinite entry are left out.  A
    covariance needs one length: where lengths differ, that of most vectors counts
    (ties: the longer) and the others are left out too; empty vectors always are.
    Other columns are not read.  None if no vector is left.  Two passes over the input.
    """
    rows = _columns(df, vector, id)
    found = cut(_added(rows.mapInArrow(_moments(scale, shift), "dim int, sums array<decimal(38,0)>"), "dim"), "whiten-sums")
    most = found.filter("pos = 0").orderBy(F.desc("value"), F.desc("dim")).limit(1).collect()
    if not most:
        return None
    dim, n = most[0]["dim"], int(most[0]["value"])
    sums = [int(r["value"]) for r in found.filter(F.col("dim") == dim).filter("pos > 0").orderBy("pos").collect()]
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    out = Whitening(dim, n, sums, centre, 0.0, np.zeros(0), np.zeros((dim, 0)), scale, shift)
    cells = {r["pos"]: int(r["value"]) for r in _added(rows.mapInArrow(_scatter(out), "sums array<decimal(38,0)>")).collect()}
    left = [s - n * int(c) for s, c in zip(sums, centre)]
    v = np.zeros((dim, dim))
    trace = Fraction(0)
    for k, (i, j) in enumerate(zip(*np.triu_indices(dim))):
        # n * sum(y y') - sum(y) sum(y)' over n^2, exact up to the last division
        exact = Fraction(n * cells[k] - left[i] * left[j], n * n)
        v[i, j] = v[j, i] = float(exact)
        trace += exact if i == j else 0
    out.trace = float(trace)
    out.values, out.components = one_sided_jacobi(pivoted_cholesky(v))
    return out


def identity_error(df: DataFrame, fitted: Whitening, components: int, vector: str = "embedding", id: str = "vec_id") -> float:
    """Largest absolute entry of the covariance of the whitened rows, measured on them, less the identity."""
    m = min(components, len(fitted.values))
    if not m:
        return 0.0
    parts = _columns(df, vector, id).mapInArrow(_spread(fitted, m), "sums array<double>")
    each = parts.select(F.posexplode("sums").alias("pos", "value")).groupBy("pos").agg(F.sum("value").alias("value"))
    s = np.zeros(m + m * (m + 1) // 2)
    for r in each.collect():
        s[r["pos"]] = r["value"] / fitted.n
    upper = np.triu_indices(m)
    c = s[m:] - s[:m][upper[0]] * s[:m][upper[1]]
    return float(np.abs(c - (upper[0] == upper[1])).max())


def whiten(df: DataFrame, fitted: Whitening, components: int, vector: str = "embedding", id: str = "vec_id") -> DataFrame:
    """``id, deviation, whitened`` (array, by falling eigenvalue) of every vector of the
    fitted length; at most ``components``, and none whose eigenvalue is zero.  Rows that
    repeat an id or have none are vectors of their own."""
    m = min(components, len(fitted.values))

    def run(batches):
        for ids, y in _centred(batches, fitted):
            z = np.ascontiguousarray(fitted.project(y)[:, :m]).reshape(-1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * m), pa.array(z))
            yield pa.RecordBatch.from_arrays([ids, pa.array(fitted.deviations(y), pa.int64()), lists], names=["id", "deviation", "whitened"])
    return _columns(df, vector, id).mapInArrow(run, "id long, deviation long, whitened array<double>")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query 12 over ``embeddings``: up to 32 components of the vectors floor(64 * c) + 1000000."""
    df = read_table(spark, sf_dir, "embeddings")
    fitted = fit(df)
    if fitted is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    error = identity_error(df, fitted, 32)
    share = F.array(*[F.lit(float(e / fitted.trace)) for e in fitted.values[:32]])
    rows = whiten(df, fitted, 32).select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(F.col("id").alias("vec_id"), (F.col("at") + 1).cast("int").alias("component"), F.lit(fitted.n).cast("long").alias("n"),
                       "deviation", "whitened", F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
