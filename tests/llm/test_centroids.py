from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from tickforge.llm import centroids as C
from tickforge.llm.common import read_table

SF = "/root/testdata/sf0.001"


def brute(rows, k, rounds, dim, scale, salt="2:"):
    """Full search in Python integers: (id, cluster, distance) per kept row and the centroids."""
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    h = sorted((hashlib.sha256(f"{salt}{'' if i is None else i}".encode()).hexdigest(), x) for i, x in kept)
    cs = [x for _, x in h[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(cs))
    for _ in range(rounds):
        at = [nearest(x)[1] for _, x in kept]
        for n in range(len(cs)):
            mine = [x for (_, x), a in zip(kept, at) if a == n]
            if mine:
                cs[n] = [sum(col) // len(mine) for col in zip(*mine)]
    return [(i, nearest(x)[1], nearest(x)[0]) for i, x in kept] if cs else [], cs


def key(r):
    return (r[0] is None, r[0] or 0, r[1:])


def run(spark, rows, **how):
    df = spark.createDataFrame([(i, v, "x", "x", 1) for i, v in rows], "vec_id long, embedding array<double>, x string, near string, cluster int")
    out = C.cluster(df, **how)
    return sorted(((r["id"], r["near"], r["distance"]) for r in out.vectors.collect()), key=key), out


@pytest.mark.parametrize("seed, dim, k, spread", [(1, 2, 7, 4.0), (2, 3, 12, 1.5), (3, 8, 5, 3.0), (4, 1, 9, 6.0)])
def test_equals_full_search_with_many_ties(spark, seed, dim, k, spread):
    """Few different integer vectors: equal distances, equal centroids, empty clusters."""
    rnd = random.Random(seed)
    rows = [(i, [rnd.uniform(-spread, spread) for _ in range(dim)]) for i in range(400)]
    rows += [(1_000 + i, rows[0][1]) for i in range(150)]
    how = {"k": k, "rounds": 5, "dim": dim, "scale": 1.0}
    got, out = run(spark, rows, **how)
    want, cs = brute(rows, **how)
    assert got == sorted(want, key=key) and out.centroids == cs
    assert sum(out.inertia) == sum(d for _, _, d in want) and out.counts == [sum(c == n for _, c, _ in want) for n in range(len(cs))]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0]),
            (7, [0.5, 2.0]), (None, [3.0, 4.0]), (None, [3.0, 5.0]), (8, [1.0, 2.0, 3.0]), (9, [-0.001, 0.0])]
    for k in (1, 3, 40):
        how = {"k": k, "rounds": 2, "dim": 2, "scale": 256.0}
        got, out = run(spark, rows, **how)
        want, cs = brute(rows, **how)
        assert got == sorted(want, key=key) and out.centroids == cs
    got, out = run(spark, rows[:6], k=3, rounds=2, dim=2, scale=1.0)
    assert got == [] and out.centroids == []


def test_too_large_entries_fail(spark):
    with pytest.raises(Exception, match="too large"):
        run(spark, [(1, [1e30, 0.0])], k=1, rounds=1, dim=2, scale=1.0)


def test_the_bounds_save_searches():
    """After a small move most vectors of clear clusters are not searched again, and
    those that are get the result of a full search."""
    rnd = np.random.default_rng(5)
    c = rnd.integers(-4_000, 4_000, (30, 16))
    x = c[rnd.integers(0, 30, 5_000)] + rnd.integers(-300, 300, (5_000, 16))
    r = C.Round(c)
    near, second, d1, d2 = C.search(x, np.zeros(len(x), int), np.ones(len(x), int), r)
    full = ((x[:, None, :] - c[None]) ** 2).sum(2)
    assert (near == full.argmin(1)).all() and (d2 == np.sort(full, 1)[:, 1]).all()
    moved = c + rnd.integers(-20, 21, c.shape)
    r2 = C.Round(moved, np.sqrt(C.squared(moved, c).astype(float)))
    near2, _, upper, lower, searched = C.assign(x, near, second, *C.bounds(d1, d2), r2)
    full = ((x[:, None, :] - moved[None]) ** 2).sum(2)
    assert (near2 == full.argmin(1)).all() and searched < 500
    two = np.sort(np.sqrt(full), 1)
    assert (upper >= two[:, 0]).all() and (lower <= two[:, 1]).all()


def test_query_equals_full_search(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in read_table(spark, SF, "embeddings").collect()]
    want, cs = brute(rows, 40, 5, 64, 256.0)
    out = C.op11_centroid_clustering(spark, SF).collect()
    assert sorted((r["vec_id"], r["cluster"], r["distance"]) for r in out) == sorted(want)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    by = [sum(d for _, c, d in want if c == n) for n in range(len(cs))]
    assert all((r["centroid_sha256"], r["cluster_inertia"], r["inertia"]) == (sha[r["cluster"]], by[r["cluster"]], sum(by)) for r in out)
