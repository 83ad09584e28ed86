from __future__ import annotations

import hashlib
import random

import pytest

from tests.llm.conftest import ODD
from tickforge.llm import suffix_dedup as S


def brute(rows):
    """Rows in order; every byte of a 100-byte string seen before goes."""
    seen, out = set(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        mask = bytearray(len(data))
        for i in range(len(data) - 99):
            s = data[i:i + 100]
            if s in seen:
                mask[i:i + 100] = b"\1" * 100
            seen.add(s)
        kept = bytes(b for b, m in zip(data, mask) if not m)
        spans = sum(1 for i, m in enumerate(mask) if m and not (i and mask[i - 1]))
        out.append((doc_id, len(data), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(docs):
    return sorted((tuple(r) for r in S.dedup_substrings(docs).collect()), key=repr)


@pytest.mark.parametrize("chunk", [2 << 20, 700])
def test_equals_brute_force(spark, make_docs, some_docs, monkeypatch, chunk):
    monkeypatch.setattr(S, "CHUNK_BYTES", chunk)
    rnd = random.Random(chunk)
    def word():
        return "".join(rnd.choices("abcdé ", k=rnd.randrange(1, 9)))
    pool = ["".join(word() for _ in range(60)) for _ in range(6)]
    rows = [(d, t) for d, t in some_docs[:60]]
    for i in range(120):
        parts = []
        for _ in range(rnd.randrange(1, 5)):
            p = rnd.choice(pool)
            a, b = sorted(rnd.randrange(len(p)) for _ in range(2))
            parts.append(rnd.choice([p, p[a:b], word() * 3, "a" * rnd.randrange(150), "ab" * rnd.randrange(120)]))
        rows.append((10_000 + i, "".join(parts)))
    rows += [(20_000 + i, t) for i, (_, t) in enumerate(ODD)]
    assert run(make_docs(rows)) == brute(rows)


def test_repeated_and_null_ids(spark, make_docs):
    text = "".join(random.Random(1).choices("abcdefgh", k=300))
    out = run(make_docs([(1, text), (1, text), (None, text), (None, None)]))
    # the null id comes first; of the two rows of id 1 both have it before them
    assert [(r[0], r[2]) for r in out] == [(1, 300), (1, 300), (None, 0), (None, 0)]
    assert run(make_docs([])) == []
