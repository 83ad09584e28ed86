from __future__ import annotations

import hashlib
import random
import re

from tests.llm.conftest import ODD
from tickforge.llm import secrets as S

A = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    out = [(m.start(), 0, m.end(), "assign") for m in A.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def added(text):
    weak = [(m.start(), 3 + i, m.end(), k) for i, (k, p) in enumerate(
        (("weak_id", S.WEAK_ID), ("weak_secret", S.WEAK_SECRET), ("endpoint", S.ENDPOINT)))
        for m in re.finditer(p, text, re.A)]
    every = base(text) + weak
    def near(x, role):
        return any(S.ROLE[y[3]] == role and abs(y[0] - x[0]) <= S.SCOPE for y in every)
    rule = {"weak_id": ("secret",), "weak_secret": ("id",), "endpoint": ("id", "secret")}
    return [x for x in weak if all(near(x, r) for r in rule[x[3]])]


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))


def test_equals_brute_force(spark, make_docs, some_docs):
    rnd = random.Random(2)
    parts = ["token = ", "password:'", "abc", "AKIA", "ABCDEFGHIJKLMNOP1234", "0123456789abcdef01234567", "é😀", "\n",
             "client_id=bob ", "pwd: hunter22 ", "https://x.example/p ", " " * 140, "api_key=", "secret: token=abcdefgh",
             "token: a ", "Passwd=\"", "x.y/z+q", "access_key: zzzzzzzz ", "user=ann@x "]
    rows = some_docs + ODD + [(1_000 + i, "".join(rnd.choices(parts, k=rnd.randrange(1, 30)))) for i in range(300)]
    out = sorted(S.scan(make_docs(rows)).collect(), key=repr)
    want = []
    for d, t in rows:
        b = base(t or "")
        n = [sum(x[3] == k for x in b) for k in ("assign", "access", "hex")]
        want.append((d, *n, hashlib.sha256(joined(b).encode()).hexdigest(), joined(b + added(t or ""))))
    got = [tuple(r) for r in out]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert any("weak" in r[5] for r in got)


def test_empty_table(make_docs):
    assert S.scan(make_docs([])).count() == 0
