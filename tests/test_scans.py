"""Size-checked joins, ordered scans over large groups, key ranges from counts."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tickforge.operators import derive
from tickforge.operators.derive import pair_windows
from tickforge.plans import scans
from tickforge.plans.joins import join_small, measured


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_measured_counts_texts_and_nested_values(spark):
    df = spark.createDataFrame([(1, "x" * 1_000, ["y" * 500] * 4, {"k": "z" * 300}), (None, None, None, None)],
                               "a long, s string, l array<string>, m map<string,string>")
    rows, size = measured(df)
    assert rows == 2 and 3_300 < size < 3_700
    assert measured(df.limit(0)) == (0, 0)


@pytest.mark.parametrize("how, hint", [({}, True), ({"max_rows": 9}, False), ({"max_bytes": 5_000}, False)])
def test_join_small_is_bounded_in_rows_and_bytes(spark, how, hint):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(100).withColumnRenamed("id", "k")
        small = spark.range(10).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1_000).alias("v"))
        out = join_small(big, small, ["k"], **how)
        assert ("BroadcastHashJoin" in plan_of(out)) == hint and out.count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


@pytest.mark.parametrize("per_range", [7, 50, 10_000])
def test_numbered_equals_row_number(spark, per_range):
    """One group holds most rows, one is NULL; rows of the order's ties are alike."""
    df = spark.range(600).select(F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 10 == 8, F.concat(F.lit("g"), F.col("id") % 3)).alias("g"),
                                 (F.col("id") * 7919 % 601).alias("o"), "id")
    out = scans.numbered(df, ["g"], ["o"], rows_per_range=per_range)
    assert out.columns == ["g", "o", "id", "_row"]
    by = defaultdict(list)
    for r in out.collect():
        by[r["g"]].append((r["o"], r["_row"]))
    assert sum(map(len, by.values())) == 600
    assert all([n for _, n in sorted(v)] == list(range(1, len(v) + 1)) for v in by.values())
    assert scans.numbered(df.limit(0), ["g"], ["o"]).count() == 0


@pytest.mark.parametrize("few", [0, 20_000])
def test_places_from_counts(spark, monkeypatch, few):
    """Contiguous, balanced key ranges with no sampling: one exchange by place, rows as
    by hash; a pair of half of all rows spans places, NULL keys and times have one."""
    monkeypatch.setattr(derive, "LEAST_ROWS", 50)
    monkeypatch.setattr(derive, "FEW_CHUNKS", few)
    bars = spark.range(3_000).select(
        F.when(F.col("id") % 2 == 0, "HOT").when(F.col("id") % 31 > 0, F.concat(F.lit("F"), F.col("id") % 17)).alias("fsym"),
        F.when(F.col("id") % 3 > 0, "USD").otherwise("BTC").alias("tsym"),
        F.when(F.col("id") % 29 > 0, F.timestamp_seconds(F.col("id") * 60)).alias("ts"),
        (F.col("id") % 101).cast("double").alias("high"), (F.col("id") % 97).cast("double").alias("close"))
    cols = ["fsym", "tsym", "ts", "high", "close", "close_lag1", "all_time_high"]

    def rows(**how):
        return pair_windows(bars, "ts", with_ath=True, chunk_seconds=3_600, **how)
    out = rows(partitioning="counts")
    assert Counter(tuple(r) for r in out.select(*cols).collect()) == Counter(tuple(r) for r in rows().select(*cols).collect())
    plan = plan_of(out)
    assert plan.count("shufflepartitionidpassthrough") == 1 and "rangepartitioning" not in plan
    got = out.select("fsym_char1", "tsym", "fsym", "ts", F.spark_partition_id().alias("p")).collect()
    sizes = Counter(r["p"] for r in got)
    assert 6 <= len(sizes) <= 9 and max(sizes.values()) < 2 * 3_000 / len(sizes)
    key = {}
    for r in got:  # places are contiguous in the key order
        k = tuple((x is not None, x or "") for x in (r["fsym_char1"], r["tsym"], r["fsym"]))
        key.setdefault(r["p"], []).append((*k, (r["ts"] is not None, int(r["ts"].timestamp()) // 3_600 if r["ts"] else 0)))
    spans = [(min(v), max(v)) for _, v in sorted(key.items())]
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_places_fall_back_to_sampling(spark, monkeypatch):
    monkeypatch.setattr(derive, "BROADCAST_BYTES", 1)
    df = spark.range(100).select(F.lit("A").alias("fsym"), F.lit("B").alias("tsym"), F.timestamp_seconds("id").alias("ts"),
                                 F.lit(1.0).alias("high"), F.lit(1.0).alias("close"))
    out = pair_windows(df, "ts", with_ath=False, chunk_seconds=10, partitioning="counts")
    assert "rangepartitioning" in plan_of(out) and out.count() == 100
