"""Centroid clustering (11): exact integer k-means by Shallot search.

A vector carries its nearest centroid, its second-nearest one, an upper bound on
the distance to the first and a lower bound on the distance to all others.  After
the centroids have moved, the bounds move with them (triangle inequality); where
they still tell the two apart, the vector stays without a distance being computed.
Otherwise the distances to both remembered centroids are computed, the closer one
starts the scan, and the other centroids follow in the order of their distance from
it, which was sorted once a round.  The scan of a vector ends where no centroid
further out can be among its two nearest; this ball shrinks with every better one.
Whoever survives the bounds is compared by exact integer squared distances, ties to
the smaller number, so the result is that of a full search.

Bounds are doubles widened by ``SLACK`` at every step, far above their rounding, and
are strict: a vector whose bounds meet is always searched.  A pass is one
``mapInArrow`` without a shuffle; the rows it writes are the vectors with their
state and, from every task, the sums of its clusters.  Only the k x d sums of a
round come to the driver, and k x d integers go back with the next pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.common import bound_batches, cut_to, drop_folder, read_table
from tickforge.llm.vectors import by_length, floor_scaled, list_column, matrix_of
from tickforge.session import scratch_path

SLACK = 1e-12
# Components whose squared distances, summed over a vector, fit a long.
LARGEST = 1 << 58

STATE = "id long, x array<long>, near int, second int, upper double, lower double, distance long, cluster int, n long, sums array<long>, inertia decimal(38,0)"
_SCHEMA = pa.schema([
    ("id", pa.int64()), ("x", pa.list_(pa.int64())), ("near", pa.int32()), ("second", pa.int32()), ("upper", pa.float64()),
    ("lower", pa.float64()), ("distance", pa.int64()), ("cluster", pa.int32()), ("n", pa.int64()),
    ("sums", pa.list_(pa.int64())), ("inertia", pa.decimal128(38, 0)),
])


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of paired integer rows."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


@dataclass
class Round:
    """What a pass needs of the centroids: their integers, their order by distance
    from each of them, and how far each has moved since the pass before."""

    centroids: np.ndarray
    moved: np.ndarray | None = None

    def __post_init__(self):
        c = self.centroids
        k = len(c)
        gap = np.array([np.sqrt(squared(c, c[i:i + 1]).astype(float)) for i in range(k)]).reshape(k, k)
        self.order = np.argsort(gap, axis=1, kind="stable")
        # a centroid is the first of its own order, also beside an equal one
        for i in range(k):
            self.order[i] = np.concatenate(([i], self.order[i][self.order[i] != i]))
        self.gap = np.take_along_axis(gap, self.order, axis=1) * (1 - SLACK)
        self.half = (self.gap[:, 1] if k > 1 else np.full(k, np.inf)) / 2
        if self.moved is not None:
            # the furthest move among the other centroids
            top = np.argsort(-self.moved)[:2]
            self.other = np.full(k, self.moved[top[0]])
            self.other[top[0]] = self.moved[top[1]] if k > 1 else 0.0


def search(x: np.ndarray, start: np.ndarray, other: np.ndarray, r: Round) -> tuple[np.ndarray, ...]:
    """Nearest and second-nearest centroid of every row of ``x`` and their squared
    distances, found from two centroids of each row (``other`` -1 if there is but one)."""
    c, k = r.centroids, len(r.centroids)
    best, d1 = start.copy(), squared(x, c[start])
    if k == 1:
        return best, np.full(len(x), -1), d1, np.full(len(x), -1)
    second, d2 = other.copy(), squared(x, c[other])
    swap = (d2 < d1) | (d2 == d1) & (second < best)
    best[swap], second[swap], d1[swap], d2[swap] = second[swap], best[swap], d2[swap], d1[swap]
    centre, known = best.copy(), second.copy()
    inner = np.sqrt(d1.astype(float)) * (1 + SLACK)
    active = np.arange(len(x))
    for step in range(1, k):
        # the ball of a row shrinks with its second-best distance
        ball = inner[active] + np.sqrt(d2[active].astype(float)) * (1 + SLACK)
        active = active[r.gap[centre[active], step] <= ball]
        if not len(active):
            break
        at = r.order[centre[active], step]
        new = at != known[active]
        rows, at = active[new], at[new]
        d = squared(x[rows], c[at])
        first = (d < d1[rows]) | (d == d1[rows]) & (at < best[rows])
        then = ~first & ((d < d2[rows]) | (d == d2[rows]) & (at < second[rows]))
        won = rows[first]
        second[won], d2[won], best[won], d1[won] = best[won], d1[won], at[first], d[first]
        second[rows[then]], d2[rows[then]] = at[then], d[then]
    return best, second, d1, d2


def assign(x: np.ndarray, near: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray, r: Round) -> tuple[np.ndarray, ...]:
    """State of every row after the centroids have moved; also how many rows were searched."""
    near, second = near.copy(), second.copy()
    upper = (upper + r.moved[near]) * (1 + SLACK)
    lower = lower - r.other[near] - SLACK * (lower + r.other[near])
    open_ = np.flatnonzero(upper >= np.maximum(lower, r.half[near]))
    if len(open_):
        exact = np.sqrt(squared(x[open_], r.centroids[near[open_]]).astype(float)) * (1 + SLACK)
        upper[open_] = exact
        open_ = open_[exact >= np.maximum(lower[open_], r.half[near[open_]])]
    if len(open_):
        a, b, d1, d2 = search(x[open_], near[open_], second[open_], r)
        near[open_], second[open_] = a, b
        upper[open_], lower[open_] = bounds(d1, d2)
    return near, second, upper, lower, len(open_)


def bounds(d1: np.ndarray, d2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lower = np.where(d2 < 0, 1e300, np.sqrt(np.maximum(d2, 0).astype(float)) * (1 - SLACK))
    return np.sqrt(d1.astype(float)) * (1 + SLACK), lower


def _pass(r: Round, first: bool, last: bool, dim: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One pass over the vectors: their new state and, last of a task, its sums by cluster."""
    k = len(r.centroids)

    def run(batches):
        sums, n, inertia = np.zeros((k, dim), np.int64), np.zeros(k, np.int64), [0] * k
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix_of(batch.column("x"), dim)
            if first:
                start = np.zeros(len(x), np.int64)
                near, second, d1, d2 = search(x, start, start + (1 if k > 1 else -1), r)
                upper, lower = bounds(d1, d2)
            else:
                state = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("near", "second", "upper", "lower")]
                near, second, upper, lower, _ = assign(x, state[0].astype(np.int64), state[1].astype(np.int64), *state[2:], r)
            by = np.argsort(near, kind="stable")
            here, at = np.unique(near[by], return_index=True)
            sums[here] += np.add.reduceat(x[by], at, axis=0)
            n += np.bincount(near, minlength=k)
            distance = None
            if last:
                distance = squared(x, r.centroids[near])
                for c, part in zip(here.tolist(), np.split(distance[by], at[1:])):
                    inertia[c] += _total(part)
            none = [pa.nulls(len(x), f.type) for f in list(_SCHEMA)[7:]]
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("x"), pa.array(near, pa.int32()), pa.array(second, pa.int32()), pa.array(upper),
                pa.array(lower), pa.nulls(len(x), pa.int64()) if distance is None else pa.array(distance), *none], schema=_SCHEMA)
        mine = np.flatnonzero(n)
        if len(mine):
            yield pa.RecordBatch.from_arrays([
                *[pa.nulls(len(mine), f.type) for f in list(_SCHEMA)[:7]], pa.array(mine, pa.int32()), pa.array(n[mine]),
                list_column(sums[mine]), pa.array([_decimal(inertia[c]) for c in mine], pa.decimal128(38, 0))], schema=_SCHEMA)
    return run


def _total(values: np.ndarray) -> int:
    """Exact sum of non-negative longs."""
    return int((values >> 32).sum()) * (1 << 32) + int((values & 0xFFFFFFFF).sum())


def _decimal(value: int):
    from decimal import Decimal
    return Decimal(value)


def whole_vectors(df: DataFrame, dim: int, scale: float, vector: str = "embedding", id: str = "vec_id") -> DataFrame:
    """``id, x``: the vectors of ``dim`` finite entries as integers floor(scale * entry)."""
    def run(batches):
        for batch in batches:
            rows, x = by_length(batch.column(1)).get(dim, (None, None))
            if rows is not None and len(rows):
                y = floor_scaled(x, scale)
                if dim * float(np.abs(y).max()) ** 2 * 4 > LARGEST:
                    raise ValueError("a vector entry is too large for squared distances in 64 bits")
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), list_column(y)], names=["id", "x"])
    bound_batches(df.sparkSession)
    return df.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("v")).mapInArrow(run, "id long, x array<long>")


@dataclass
class Clustering:
    """``vectors`` (id, x, near, distance) and ``centroids`` with their rows' count and inertia."""

    vectors: DataFrame
    centroids: list[list[int]]
    counts: list[int]
    inertia: list[int]


def cluster(df: DataFrame, k: int, rounds: int, dim: int, scale: float, salt: str = "2:", vector: str = "embedding", id: str = "vec_id") -> Clustering:
    """Cluster the whole vectors of ``df`` (``id``, ``vector``) around ``k`` centroids.

    Vectors that are null, of another length than ``dim``, or hold a null, NaN or
    infinite entry are left out.  Centroids start as the vectors whose id has the
    smallest SHA-256 (after ``salt``; a null id counts as no text; equal hashes, so
    repeated ids, in the order of their components).  Fewer vectors than ``k`` give
    fewer centroids, none give none.  Each of ``rounds`` rounds assigns every vector and then moves every
    centroid that has vectors to the floor of their mean; then all are assigned once
    more.  Rows that repeat an id or have none are vectors of their own; other
    columns are not read.  Entries too large for exact 64-bit distances fail the job.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "cluster-vectors")
    rows = cut_to(whole_vectors(df, dim, scale, vector, id), path)
    first = rows.select(F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256).alias("h"), "x")
    # the k smallest of every task are kept before they meet
    start = first.orderBy("h", "x").limit(k).collect()
    c = np.array([r["x"] for r in start], np.int64).reshape(-1, dim)
    if not len(c):
        return Clustering(rows.selectExpr("id", "x", "cast(null as int) near", "cast(null as bigint) distance"), [], [], [])
    r = Round(c)
    for step in range(rounds + 1):
        to = scratch_path(spark, "cluster-state")
        bound_batches(spark)
        state = cut_to(rows.mapInArrow(_pass(r, step == 0, step == rounds, dim), STATE), to)
        drop_folder(spark, path)  # the state before has been read by all
        path, rows = to, state.filter("cluster IS NULL").select(*STATE_COLUMNS)
        found = _sums(state, dim)
        if step == rounds:
            return Clustering(rows.select("id", "x", "near", "distance"), c.tolist(),
                              [found[i][0] if i in found else 0 for i in range(len(c))],
                              [found[i][2] if i in found else 0 for i in range(len(c))])
        moved = np.array([[s // found[i][0] for s in found[i][1]] if i in found else c[i] for i in range(len(c))], np.int64)
        r = Round(moved, np.sqrt(squared(moved, c).astype(float)) * (1 + SLACK))
        c = moved


STATE_COLUMNS = ["id", "x", "near", "second", "upper", "lower", "distance"]


def _sums(state: DataFrame, dim: int) -> dict[int, tuple[int, list[int], int]]:
    """Count, component sums and inertia of each cluster, over the sums of the tasks."""
    parts = state.filter("cluster IS NOT NULL").select("cluster", "n", "sums", "inertia")
    total = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.sum("inertia").cast("decimal(38,0)").alias("inertia"),
        F.array(*[F.sum(F.get("sums", F.lit(i)).cast("decimal(28,0)")) for i in range(dim)]).alias("sums"))
    return {r["cluster"]: (r["n"], [int(s) for s in r["sums"]], int(r["inertia"])) for r in total.collect()}


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query 11 over ``embeddings``: 40 centroids, 5 rounds, components floor(256 * x)."""
    out = cluster(read_table(spark, sf_dir, "embeddings"), k=40, rounds=5, dim=64, scale=256.0)
    about = [(i, out.inertia[i], sum(out.inertia), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
             for i, c in enumerate(out.centroids)]
    table = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # one row per centroid: a bounded side
    return out.vectors.join(F.broadcast(table), F.col("near") == F.col("cluster")).select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(k: int = 40, rounds: int = 5, dim: int = 64) -> str:
    """The same by full search, one pair of queries a round; ``best`` holds distance and number in one integer."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT vec_id, min(distance * {k} + k) AS best FROM (
    SELECT e.vec_id, c.k, sum((e.x - c.x) * (e.x - c.x)) AS distance FROM entry e JOIN c{i} c ON e.d = c.d GROUP BY e.vec_id, c.k
  ) GROUP BY vec_id)""")
        if i < rounds:
            steps.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT c.k, c.d, CASE WHEN s.n IS NULL THEN c.x ELSE (s.total - ((s.total % s.n) + s.n) % s.n) // s.n END AS x
  FROM c{i} c LEFT JOIN (
    SELECT a.best % {k} AS k, e.d, count(*) AS n, sum(e.x) AS total FROM a{i} a JOIN entry e ON a.vec_id = e.vec_id GROUP BY a.best % {k}, e.d
  ) s ON s.k = c.k AND s.d = c.d)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}
), entry AS MATERIALIZED (
  SELECT vec_id, unnest(v) AS x, unnest(range({dim})) AS d FROM kept
), first AS (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR))) - 1 AS k FROM kept
), c0 AS MATERIALIZED (
  SELECT f.k, e.d, e.x FROM first f JOIN entry e ON f.vec_id = e.vec_id WHERE f.k < {k}
),{",".join(steps)},
far AS (
  SELECT vec_id, best % {k} AS k, best // {k} AS distance FROM a{rounds}
), total AS (
  SELECT k, sum(distance) AS cluster_inertia FROM far GROUP BY k
), named AS (
  SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY k
)
SELECT far.vec_id, CAST(far.k AS INTEGER) AS cluster, CAST(far.distance AS BIGINT) AS distance,
       CAST(total.cluster_inertia AS BIGINT) AS cluster_inertia,
       CAST((SELECT sum(distance) FROM far) AS BIGINT) AS inertia, named.centroid_sha256
FROM far JOIN total ON far.k = total.k JOIN named ON far.k = named.k
"""


OP11_SQL = _sql()
