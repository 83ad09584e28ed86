from __future__ import annotations

import random

from tests.llm.conftest import ODD
from tickforge.llm import decontaminate as D


def test_wand_equals_scoring_all(spark):
    rnd = random.Random(9)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randrange(1, 12)))) for i in range(60)]
    df = {w: sum(w in t.split() for _, t in items) for w in vocabulary}
    index = D.Index(items, df, 60, 6.0)
    for _ in range(300):
        query = sorted({index.terms[w] for w in rnd.choices(vocabulary, k=rnd.randrange(1, 25)) if w in index.terms})
        for threshold in (0.3, 0.6, 0.9):
            scores = {}
            for t in query:
                for k, g in (x for part in index.postings[t].values() for x in part):
                    scores[k] = scores.get(k, 0) + g
            want = {k: s for k, s in scores.items() if s >= threshold}
            got = dict(index.wand(query, threshold))
            assert all(abs(want.get(k, threshold) - got.get(k, threshold)) < 1e-6 for k in want.keys() | got.keys())


def _plant(rnd, item):
    filler = " ".join("".join(rnd.choices("qzxvk", k=6)) for _ in range(rnd.randrange(0, 400)))
    return f"{filler} {item.replace(' ', '  ')}\n{filler[::-1]}"


def test_planted_items_are_found(spark, make_docs, monkeypatch):
    rnd = random.Random(2)
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    texts = [(r["item_id"], r["text"]) for r in items.collect()]
    rows = ODD + [(100 + i, _plant(rnd, t)) for i, t in texts] + [(900, texts[0][1] + " " + texts[1][1])]
    for group in (2_000, 15):
        monkeypatch.setattr(D, "GROUP", group)
        got = {(r["doc_id"], r["item_id"]) for r in D.leaks(make_docs(rows), items).collect()}
        assert got == {(100 + i, i) for i, _ in texts} | {(900, texts[0][0]), (900, texts[1][0])}
    kept = D.drop_leaks(make_docs(rows), items)
    assert kept.count() == len(ODD) and kept.columns == make_docs([]).columns


def test_odd_items(spark, make_docs):
    items = spark.createDataFrame([(1, None), (2, ""), (None, "a b c d e f g h"), (3, "word")], "item_id long, text string")
    got = sorted((str(r["doc_id"]), str(r["item_id"])) for r in D.leaks(make_docs(ODD), items).collect())
    assert got == [("5", "3"), ("5", "3"), ("9", "None")]
    assert D.leaks(make_docs([]), items).count() == 0
    assert D.leaks(make_docs(ODD), items.limit(0)).count() == 0


def _contained(text, item):
    w, q = D.words(text), D.words(item)
    return any(w[i:i + len(q)] == q for i in range(len(w) - len(q) + 1))


def test_every_whole_copy_in_the_table_is_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    want = {(r["doc_id"], i) for r in docs.collect() for i, t in items if _contained(r["text"], t)}
    got = {(r["doc_id"], r["item_id"]) for r in D.op6_decontaminate(spark, "/root/testdata/sf0.01").collect()}
    assert want and want <= got and len(got - want) <= 0.05 * len(want)
