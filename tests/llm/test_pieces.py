from __future__ import annotations

import random

import pytest
import sentencepiece

from tests.llm.conftest import ODD
from tickforge.llm import pieces as P


@pytest.fixture(scope="module")
def model():
    return P.Pieces(P.default_model())


def _all_paths(model, word):
    into = model.edges(word)
    paths = {0: [(0.0, ())]}
    for end in range(1, len(word) + 1):
        paths[end] = [(s + g, ids + step) for start, step, g in into[end] for s, ids in paths[start]]
    return sorted(paths[len(word)], key=lambda x: -x[0])


def test_n_best_equals_brute_force(model):
    rnd = random.Random(3)
    for _ in range(150):
        text = " ".join("".join(rnd.choices("abetnd▁é.\n", k=rnd.randrange(0, 6))) for _ in range(rnd.randrange(1, 4)))
        combos = [(0.0, ())]
        for word in model.words(text):
            combos = [(s + a, ids + b) for s, ids in combos for a, b in _all_paths(model, word)]
        best = sorted((s for s, _ in combos), reverse=True)
        ids, score, scores, changed = model.encode(text, 5)
        assert scores == pytest.approx(best[:5]) and score == pytest.approx(best[0])
        valid = {ids: s for s, ids in combos}
        found = [tuple(model.segmentation(text, c)) for c in changed]
        assert len(set(found)) == len(found)
        assert [valid[f] for f in found] == pytest.approx(scores)
        assert all(model.decode(list(f)) == text for f in found)


def test_together_as_one_by_one(model):
    rnd = random.Random(11)
    texts = ["", " ", "▁", "▁▁ a▁b", "a" * 3_000, "x" * 70 + " y", "日本語 テキスト\n\t x", "😀é" * 50] + [
        "".join(rnd.choices("ab ▁é日\n1.e", k=rnd.randrange(0, 120))) for _ in range(300)]
    for text, found in zip(texts, model.encode_all(texts, 4)):
        ids, score, scores, changes = model.encode(text, 4)
        assert found.ids.tolist() == ids.tolist() and found.exact
        assert (found.score, found.scores, found.changes) == (score, scores, changes)
        # each part by itself, character by character
        alone = [model.best(w) for w in model.words(text)]
        assert [i for a in alone for i in a[0]] == ids.tolist()
        assert score == pytest.approx(sum(a[1] for a in alone))


def test_alternatives_come_back(spark, make_docs, some_docs, model):
    rows = some_docs[:40] + ODD
    encoded = P.encode(make_docs(rows), n=5)
    every = P.segmentations(encoded).collect()
    scores = {i: s for i, s in model.table.values()}
    assert len(every) > 3 * len(some_docs[:40])
    odd = {d for d, _ in ODD}  # some repeat an id
    texts = {d: t for d, t in some_docs[:40] if d not in odd}
    assert len(texts) > 20
    for r in every:
        if r["doc_id"] in texts and all(i in scores for i in r["ids"]):
            assert model.decode(r["ids"]) == texts[r["doc_id"]]
            assert r["score"] == pytest.approx(sum(scores[i] for i in r["ids"]))
    for doc_id in texts:
        mine = [tuple(r["ids"]) for r in every if r["doc_id"] == doc_id]
        assert len(set(mine)) == len(mine)


def test_long_ties_end(model):
    ids, score, scores, _ = model.encode("a" * 5_000, 4)
    assert len(scores) == 4 and scores == sorted(scores, reverse=True)


def test_table(spark, make_docs, some_docs):
    rows = some_docs + ODD
    out = P.encode(make_docs(rows)).collect()
    assert len(out) == len(rows) and all(r["exact"] for r in out)
    library = sentencepiece.SentencePieceProcessor(model_file=P.default_model())
    texts = dict(some_docs)
    for r in out[:50]:
        assert library.decode(r["ids"]) == texts[r["doc_id"]]
    back = P.decode(P.encode(make_docs(rows))).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == sorted((str(d), t or "") for d, t in rows)
    assert P.encode(make_docs([])).count() == 0
