from __future__ import annotations

from tests.llm.conftest import ODD
from tickforge.llm.exact_dedup import DigestIndex, dedup
from tickforge.session import scratch_path


def test_repeated_and_null_rows(spark, make_docs):
    index = DigestIndex(spark, scratch_path(spark, "ix"), 4)
    out = dedup(make_docs(ODD + [(20, ""), (21, "word")]), index).collect()
    assert len(out) == len(ODD) + 2
    by_digest = {}
    for r in out:
        by_digest.setdefault(r["text_sha256"], []).append(r)
    for rows in by_digest.values():
        assert sum(r["kept"] for r in rows) == 1
        assert {r["group_size"] for r in rows} == {len(rows)}
        best = max((r["doc_id"] for r in rows if r["doc_id"] is not None), default=None)
        assert {r["keep_id"] for r in rows} == {best}


def test_new_data_is_joined_with_the_index(spark, make_docs):
    index = DigestIndex(spark, scratch_path(spark, "ix"), 4)
    dedup(make_docs([(1, "a"), (2, "b")]), index).collect()
    out = dedup(make_docs([(3, "a"), (4, "c"), (5, "c")]), index)
    assert {r["doc_id"]: (r["keep_id"], r["kept"]) for r in out.collect()} == {3: (1, False), 4: (5, False), 5: (5, True)}
    assert index.rows().count() == 3
    plan = index.new_only(index.rows().select("digest"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan.replace("AdaptiveSparkPlan", "")
    assert dedup(make_docs([]), index).count() == 0


def test_a_second_batch_keeps_no_row_of_a_known_text(spark, make_docs):
    """Row keys start anew with every batch: null and repeated ids, the same row again."""
    index = DigestIndex(spark, scratch_path(spark, "ix"), 4)
    assert [r["kept"] for r in dedup(make_docs([(0, "a")]), index).collect()] == [True]
    out = dedup(make_docs([(None, "a"), (0, "a"), (0, "b"), (0, "b"), (None, "b"), (None, None), (3, "")]), index).collect()
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["keep_id"], r["group_size"], r["kept"]) for r in out)
    assert [g for g in got if g[2] == 0 and g[3] == 1] == [(False, 0, 0, 1, False), (True, 0, 0, 1, False)]  # text a
    assert sum(r["kept"] for r in out) == 2
    assert sorted((r["doc_id"], r["group_size"]) for r in out if r["kept"]) == [(0, 3), (3, 2)]
    assert not any(r["kept"] for r in dedup(make_docs([(0, "a"), (7, "b")]), index).collect())
