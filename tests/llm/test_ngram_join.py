from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tests.llm.conftest import ODD
from tickforge.llm import ngram_join as N
from tickforge.llm.linking import components


def shingles(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    size = min(5, len(w))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                group[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None and (find(i) not in low or d < low[find(i)]):
            low[find(i)] = d
    return sorted(((d, len(s), low.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def variants(rnd, n):
    base = [f"w{rnd.randrange(4_000)}" for _ in range(rnd.randrange(5, 90))]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randrange(0, 5)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(10_000)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("bits", [N.COUNTER_BITS, 12])
def test_equals_brute_force(spark, make_docs, some_docs, monkeypatch, bits):
    monkeypatch.setattr(N, "COUNTER_BITS", bits)
    rnd = random.Random(3)
    rows = list(some_docs) + ODD
    line = " ".join(f"common{i}" for i in range(12))
    for k in range(25):
        for i, text in enumerate(variants(rnd, rnd.randrange(1, 14))):
            rows.append((1_000 + 100 * k + i, text.upper() if i % 3 == 0 else f"{text}\n{line}"))
    got = sorted((tuple(r) for r in N.join_ngrams(make_docs(rows)).collect()), key=repr)
    assert got == brute(rows)


def test_no_links_and_empty(spark, make_docs):
    assert N.join_ngrams(make_docs([])).count() == 0
    assert sorted(map(tuple, N.join_ngrams(make_docs([(2, "a b c"), (1, "d e f")])).collect())) == [(1, 1, 1), (2, 1, 2)]


def test_a_large_family_makes_few_pairs(spark, make_docs, monkeypatch):
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(400):
        w = list(base)
        for _ in range(5):
            w[rnd.randrange(200)] = f"x{rnd.randrange(9_999)}"
        rows.append((i, " ".join(w)))
    made = []
    whole = N.overlap_check

    def counted(sets):
        check = whole(sets)

        def run(pairs):
            made.append(pairs.count())
            return check(pairs)
        return run
    monkeypatch.setattr(N, "overlap_check", counted)
    rows.append((900, " ".join(base)))
    got = N.join_ngrams(make_docs(rows)).collect()
    assert {r["component_id"] for r in got} == {0}
    assert sum(made) < 10 * len(rows)


def test_components_of_chains(spark):
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (103, 101), (7, 7)]
    got = {r["id"]: r["comp"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 103: 100}


def test_the_map_bound_is_never_below_the_overlap():
    rnd = np.random.default_rng(5)
    for n, m in [(1, 1), (3, 4), (40, 30), (300, 290), (5_000, 700)]:
        for part in (0.0, 0.5, 0.9, 1.0):
            both = rnd.integers(0, 1 << 32, int(part * min(n, m)), dtype=np.uint32)
            x, y = (np.unique(np.concatenate([both, rnd.integers(0, 1 << 32, k - len(both), dtype=np.uint32)])) for k in (n, m))
            shared = len(np.intersect1d(x, y))
            assert shared <= N.most_shared(len(x), len(y), N.bit_map(x), N.bit_map(y)) <= min(len(x), len(y))


def test_columns_that_agree_in_32_bits_are_two():
    cols = np.array([5 << 32 | 1, 5 << 32 | 2, 5 << 32 | 3, 9 << 32], dtype="<u8")
    assert N.exact_shared(4, 3, cols.tobytes(), cols[1:].tobytes()) == 3
    assert N.most_shared(4, 3, N.bit_map(cols), N.bit_map(cols[1:])) >= 3
    _, n, cols = N.shingle_set(" ".join(f"w{i}" for i in range(300_000)))
    assert n == len(cols) == 299_996  # about ten of these pairs agree in 32 bits
    assert len(np.unique(cols >> np.uint64(32))) < n


def test_columns_in_a_worker_are_bounded(spark, make_docs):
    """Counters take a byte each and stop at 255; batches are of few bytes."""
    total = np.zeros(1 << N.COUNTER_BITS, dtype="u1")
    cols = np.sort(np.arange(40, dtype="<u8") | np.uint64(5 << (64 - N.COUNTER_BITS))).tobytes()
    seen = []
    for _ in range(9):
        N.count_columns(total, cols)
        seen.append(int(total[5]))
    assert seen == [40, 80, 120, 160, 200, 240, 255, 255, 255] and total.sum() == 255
    N.join_ngrams(make_docs([(1, "a b c")])).collect()
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 1 << 20
