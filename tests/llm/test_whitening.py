from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from tickforge.llm import whitening as W
from tickforge.llm.common import read_table

SF = "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, "x") for i, v in rows], "vec_id long, embedding array<double>, id string, sums int, v string")


def exact(vectors, scale=64.0, shift=1_000_000):
    """Integer vectors, their sums and the exact covariance as fractions."""
    x = [[math.floor(scale * float(c)) + shift for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    cov = np.array([[float(Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x), n ** 3)) for j in range(d)] for i in range(d)])
    return x, s, cov


def test_factor_and_rotations_are_the_eigen_decomposition():
    rnd = np.random.default_rng(1)
    for d, rank in ((1, 1), (5, 5), (12, 7), (40, 40)):
        a = rnd.normal(size=(d, rank)) * np.logspace(0, -4, rank)
        v = a @ a.T
        g = W.pivoted_cholesky(v)
        assert g.shape[1] == rank and np.allclose(g @ g.T, v, rtol=0, atol=1e-13 * np.abs(v).max())
        # triangular up to the order of the rows
        assert sorted((np.abs(g) > 0).argmin(1)[(np.abs(g) == 0).any(1)].tolist()) == sorted(range(1, rank))[:int((np.abs(g) == 0).any(1).sum())]
        e, u = W.one_sided_jacobi(g)
        assert np.allclose(e, np.linalg.eigvalsh(v)[::-1][:rank], rtol=1e-6) and (np.diff(e) <= 0).all()
        assert np.allclose(u.T @ u, np.eye(rank), atol=1e-13) and np.allclose(v @ u, u * e, atol=1e-13 * e[0])
    assert W.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)


def test_gram_is_exact_at_every_size():
    rnd = np.random.default_rng(2)
    for top in (9, 1 << 28, 1 << 34):
        y = rnd.integers(-top, top, (50, 3))
        want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(3)] for i in range(3)]
        assert W.gram(y).tolist() == want and W.total(y).tolist() == [sum(map(int, y[:, i])) for i in range(3)]


@pytest.mark.parametrize("spread", [1.0, 1e-2, 1e3])
def test_equals_plain_eigenvectors(spark, spread):
    rnd = np.random.default_rng(3)
    data = (rnd.normal(size=(300, 6)) * np.logspace(0, -1, 6) * spread + 5).tolist()
    rows = list(enumerate(data)) + [(7, data[0])] * 40 + [(None, data[1])]
    df = frame(spark, rows)
    x, s, cov = exact([v for _, v in rows])
    f = W.fit(df)
    n = len(rows)
    assert (f.n, f.sums, f.dim) == (n, s, 6) and math.isclose(f.trace, np.trace(cov), rel_tol=1e-12)
    e, u = np.linalg.eigh(cov)
    assert np.allclose(f.values, e[::-1][:len(f.values)], rtol=1e-9)
    out = W.whiten(df, f, 4).collect()
    assert sorted(r["deviation"] for r in out) == sorted(sum((n * a - b) ** 2 for a, b in zip(r, s)) for r in x)
    z = np.array([r["whitened"] for r in out])
    assert np.abs(np.cov(z.T, bias=True) - np.eye(z.shape[1])).max() < 1e-9
    assert W.identity_error(df, f, 4) < 1e-9
    centred = (np.array(x, float) - np.array(s) / n) @ u[:, ::-1][:, :4] / np.sqrt(e[::-1][:4])
    assert np.allclose(np.sort(np.abs(centred), axis=0), np.sort(np.abs(z), axis=0), atol=1e-6)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    fine = [(1, [1.0, 2.0]), (1, [2.0, 1.0]), (None, [4.0, -1.0]), (2, [4.0, -1.0])]
    odd = [(3, None), (4, []), (5, [1.0, None]), (6, [nan, 1.0]), (7, [1.0, -inf]), (8, [1.0]), (9, [1.0, 2.0, 3.0])]
    f = W.fit(frame(spark, fine + odd))
    assert f.dim == 2 and f.n == 4
    assert sorted(str(r["id"]) for r in W.whiten(frame(spark, fine + odd), f, 32).collect()) == ["1", "1", "2", "None"]
    assert W.fit(frame(spark, odd[:5])) is None and W.fit(frame(spark, [])) is None
    # one vector, or copies of one: no component has a variance
    one = frame(spark, fine[:1] * 3)
    f = W.fit(one)
    assert len(f.values) == 0 and [list(r["whitened"]) for r in W.whiten(one, f, 32).collect()] == [[], [], []] and W.identity_error(one, f, 32) == 0.0
    # a dimension without variance has no component
    assert len(W.fit(frame(spark, [(i, [float(i), 3.0]) for i in range(5)])).values) == 1


def test_query(spark):
    rows = read_table(spark, SF, "embeddings").collect()
    x, s, cov = exact([r["embedding"] for r in rows])
    e = np.linalg.eigvalsh(cov)[::-1]
    out = W.op12_whitening(spark, SF).collect()
    m = min(32, int((e > 1e-9 * e[0]).sum()))
    assert len(out) == len(rows) * m and {r["n"] for r in out} == {len(rows)}
    by = {(r["vec_id"], r["component"]): r for r in out}
    n = len(rows)
    for r, xs in zip(rows, x):
        assert by[r["vec_id"], 1]["deviation"] == sum((n * a - b) ** 2 for a, b in zip(xs, s))
    for c in range(1, m + 1):
        assert math.isclose(by[rows[0]["vec_id"], c]["explained"], e[c - 1] / e.sum(), rel_tol=1e-6)
    assert len({r["identity_error"] for r in out}) == 1 and out[0]["identity_error"] < 1e-4
