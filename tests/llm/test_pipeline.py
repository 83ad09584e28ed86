from __future__ import annotations

import hashlib

import pytest

import corpus_pipeline
from tests.llm import test_decontaminate, test_line_dedup, test_ngram_join
from tickforge.llm import pieces, toxicity
from tickforge.llm.common import cut, read_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage."""
    docs, out = read_table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = cut(stage(spark, docs, SF), name)
        out.append((name, docs, after))
        docs = after
    return out


def pairs(df):
    return sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def test_stage_order_and_columns(spark, stages):
    assert [s[0] for s in stages] == ["toxicity", "line_dedup", "ngram_join", "decontaminate", "sentencepiece"]
    columns = read_table(spark, SF, "documents").columns
    assert all(after.columns == columns for _, _, after in stages[:-1])
    assert all(r["n_chars"] == len(r["text"]) for r in stages[1][2].collect())


def test_each_stage_on_its_own_input(spark, stages):
    by = {name: (before, after) for name, before, after in stages}
    before, after = by["toxicity"]
    model = toxicity.train(before, read_table(spark, SF, "labels"))
    assert pairs(after) == [(d, t) for d, t in pairs(before) if model.score(model.sentences(t)) < 0.5]
    before, after = by["line_dedup"]
    rows = pairs(before)
    small = [(d, t) for d, t in rows if len(t) < 3_000][:120]
    got = corpus_pipeline.dedup_lines(spark, spark.createDataFrame(small, "doc_id long, text string"), SF)
    assert [t for _, t in pairs(got)] == test_line_dedup.brute(spark, small)
    assert len(pairs(after)) == len(rows)
    before, after = by["ngram_join"]
    keep = {d for d, n, low in test_ngram_join.brute(pairs(before)) if not n or d == low}
    assert pairs(after) == [(d, t) for d, t in pairs(before) if d in keep]
    before, after = by["decontaminate"]
    items = [r["text"] for r in read_table(spark, SF, "benchmark").collect()]
    left = {d for d, _ in pairs(after)}
    assert not any(test_decontaminate._contained(t, x) for d, t in pairs(after) for x in items)
    assert sum(d not in left for d, _ in pairs(before)) <= 1 + sum(
        any(test_decontaminate._contained(t, x) for x in items) for _, t in pairs(before))
    before, after = by["sentencepiece"]
    texts = dict(pairs(before))
    back = pieces.decode(after).collect()
    assert {r["doc_id"]: r["text"] for r in back} == texts


def test_run_is_the_stages(spark, stages):
    def key(df):
        return sorted((r["doc_id"], r["ids_crc32"], hashlib.sha256(repr(r["nbest_scores"]).encode()).hexdigest()) for r in df.collect())
    assert key(corpus_pipeline.run(spark, SF)) == key(stages[-1][2])
