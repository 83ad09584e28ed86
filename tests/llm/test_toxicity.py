from __future__ import annotations

import random

from tests.llm.conftest import ODD
from tickforge.llm import toxicity as T


def _rows(n=400):
    rnd = random.Random(1)
    plain = ["the", "sun", "rose", "over", "hills", "and", "we", "walked", "home", "again"]
    out = []
    for _ in range(n):
        y = rnd.random() < 0.3
        sentences = [" ".join(rnd.choices(plain, k=8)) for _ in range(rnd.randrange(2, 30))]
        if y:
            sentences.insert(rnd.randrange(len(sentences)), f"you {rnd.choice(['vile', 'rotten'])} thing")
        out.append((". ".join(sentences) + ".", int(y)))
    return out


def test_learns_from_document_labels_and_locates():
    rows = _rows()
    model = T.fit(rows[:300])
    for text, y in rows[300:]:
        found = model.sentences(text)
        assert (model.score(found) >= 0.5) == bool(y)
        assert all("you" in text[a:b] for a, b, p in found if p >= 0.5)


def test_one_label_gives_the_leak():
    model = T.fit([("a b", 0), ("c d", 0)])
    assert abs(model.score(model.sentences("a b")) - model.leak) < 1e-9 and model.leak < 0.5


def test_odd_rows(spark, make_docs):
    model = T.fit(_rows())
    rows = ODD + [(50, "İ stanbul. you vile thing. ok")]
    out = T.score(make_docs(rows), model).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    hit = next(r for r in out if r["doc_id"] == 50)
    text = rows[-1][1]
    assert hit["predicted"] == 1 and "vile" in text[hit["offending"][0]["start"]:hit["offending"][0]["end"]]
    kept = T.drop_toxic(make_docs(rows), model)
    assert kept.columns == make_docs([]).columns and kept.count() == len(rows) - 1
    assert T.score(make_docs([]), model).count() == 0


def test_held_out_accuracy(spark):
    df = T.op5_toxicity(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    rows = df.filter("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").collect()
    yes = [r["score"] for r in rows if r["toxic"] == 1]
    no = [r["score"] for r in rows if r["toxic"] == 0]
    auc = sum((a > b) + 0.5 * (a == b) for a in yes for b in no) / (len(yes) * len(no))
    right = sum(r["predicted"] == r["toxic"] for r in rows) / len(rows)
    assert right >= 0.94 and auc >= 0.75
    assert sum(r["predicted"] for r in rows if r["toxic"] == 0) <= 0.01 * len(no)


def test_sentences_equal_a_plain_search_and_take_linear_steps():
    import random

    from tickforge.llm.toxicity import Model
    model, rnd = Model({"bad": 2.0, "evil": 1.0, "é": 0.5}, -1.0, 0.01), random.Random(1)
    for _ in range(2_000):
        text = "".join(rnd.choices(["bad", "evil", " ", ".", "!", "\n", "x", "é", "?", "İ", " "], k=rnd.randrange(0, 30)))
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
        want = set()
        for word in ("bad", "evil", "é"):
            for at in range(len(low)):
                whole = low.startswith(word, at) and not (at and low[at - 1].isalnum()) and not low[at + len(word):at + len(word) + 1].isalnum()
                if whole:
                    start = max(low.rfind(c, 0, at) for c in ".!?\n") + 1
                    end = min([x for c in ".!?\n" if (x := low.find(c, at)) >= 0], default=len(low))
                    want.add((start, min(end + 1, len(low))))
        assert [s[:2] for s in model.sentences(text)] == sorted(want)
    # one mark in the whole text, and no mark but line breaks: every place is looked at once
    assert len(model.sentences("this is bad\n" * 200_000)) == 200_000
