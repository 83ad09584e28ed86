"""Derive bars: edge frames for W1/W2/N1-N3 and the chunked window's equivalence."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_CHECK, rows
from tickforge import fixtures as fx
from tickforge.operators.derive import DAY, HOUR, MINUTE, Grain, derive_bars, output_columns, pair_windows

DAY_S = 86_400


def landed(spark, data):
    """(fsym, tsym, time, high, close) rows -> landed text bars."""
    df = spark.createDataFrame(data, "fsym string, tsym string, time long, high string, close string")
    return df.select(
        F.col("time").cast("string").alias("time"),
        F.lit("1").alias("open"),
        "high",
        F.lit("1").alias("low"),
        "close",
        F.lit("1").alias("volumefrom"),
        F.lit("1").alias("volumeto"),
        "fsym",
        "tsym",
        F.lit("2018-12-23 00:00:00.5").alias("request_timestamp"),
    )


@pytest.mark.parametrize("chunked", [True, False])
def test_zero_guard_and_ath(spark, chunked):
    data = [("BTC", "USD", i * DAY_S, h, c) for i, (h, c) in enumerate([("0", "1"), ("0", "0"), ("5", "2"), ("0", "4")])]
    out = derive_bars(landed(spark, data), DAY, chunked=chunked).orderBy("date")
    got = rows(out, "change", "pct_change", "all_time_high", "pct_from_ath")
    assert got == [
        (None, None, None, None),
        (-1.0, -1.0, None, None),
        (2.0, None, 5.0, 2.0 / 5.0 - 1),  # previous close 0 -> no pct_change
        (2.0, 1.0, 5.0, 4.0 / 5.0 - 1),
    ]


@pytest.mark.parametrize("chunked", [True, False])
def test_equal_times_are_range_peers(spark, chunked):
    data = [("X", "USD", 1, "0", "1"), ("X", "USD", 2, "5", "1"), ("X", "USD", 2, "7", "1"), ("X", "USD", 3, "6", "1")]
    out = derive_bars(landed(spark, data), DAY, chunked=chunked)
    got = sorted(rows(out, "high", "all_time_high"), key=lambda r: (r[0] or 0))
    assert sorted(r[1] or 0 for r in got) == [0, 7.0, 7.0, 7.0]


@pytest.mark.parametrize("chunked", [True, False])
def test_dirty_text_does_not_poison_ath(spark, chunked):
    data = [("X", "USD", 0, "nan", "None"), ("X", "USD", DAY_S, "3", "2"), ("X", "USD", 2 * DAY_S, "", "nan")]
    out = derive_bars(landed(spark, data), DAY, chunked=chunked).orderBy("date")
    assert rows(out, "all_time_high") == [(None,), (3.0,), (3.0,)]
    assert rows(out, "close") == [(None,), (2.0,), (None,)]


def test_pairs_are_independent_and_gaps_not_filled(spark):
    data = [("A", "USD", 0, "1", "1"), ("A", "USD", 10 * DAY_S, "2", "3"), ("B", "USD", DAY_S, "9", "9")]
    out = derive_bars(landed(spark, data), DAY).orderBy("fsym", "date")
    assert rows(out, "fsym", "change") == [("A", None), ("A", 2.0), ("B", None)]


def test_output_columns_per_grain(spark):
    data = [("1ST", "USD", 3600 * 5 + 60 * 7, "1", "1")]
    for g in (DAY, HOUR, MINUTE):
        out = derive_bars(landed(spark, data), g)
        assert out.columns == output_columns(g)
    r = derive_bars(landed(spark, data), MINUTE).first()
    assert (r["hour"], r["minute"], r["fsym_char1"]) == (5, 7, "_")


def test_chunked_equals_plain_across_many_chunks(spark):
    """Tiny chunks (1 hour for minute bars) force many chunk borders."""
    bars = fx.landed_bars(spark, SF_CHECK, "minute")
    small = Grain("minute", 60, 3_600, ("hour", "minute"), True, False)
    cols = output_columns(small) + ["close_lag1"]
    a = derive_bars(bars, small, chunked=True, keep=("close_lag1",)).select(*cols)
    b = derive_bars(bars, small, chunked=False, keep=("close_lag1",)).select(*cols)
    c = derive_bars(bars, small, chunked=True, partitioning="range", keep=("close_lag1",)).select(*cols)
    assert a.count() == b.count() == 9929
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert c.exceptAll(b).count() == 0 and b.exceptAll(c).count() == 0


def test_invariants_over_testdata(spark):
    out = derive_bars(fx.landed_bars(spark, SF_CHECK, "day"), DAY)
    assert out.count() == fx.bars(spark, SF_CHECK, "day").count()
    # ATH never falls within a pair
    from pyspark.sql import Window

    w = Window.partitionBy("fsym", "tsym").orderBy("date")
    falls = out.withColumn("prev", F.lag("all_time_high").over(w)).filter(F.col("all_time_high") < F.col("prev"))
    assert falls.count() == 0
    # a close at or below the high is at or below the ATH
    assert out.filter((F.col("high") >= F.col("close")) & (F.col("pct_from_ath") > 1e-12)).count() == 0
    # change sums to last minus first close (no NULL closes in day bars)
    per_pair = out.groupBy("fsym", "tsym").agg(
        F.sum("change").alias("s"), F.max_by("close", "date").alias("last"), F.min_by("close", "date").alias("first")
    )
    assert per_pair.filter(F.abs(F.col("s") - (F.col("last") - F.col("first"))) > 1e-6).count() == 0


def test_plain_window_function_direct(spark):
    df = spark.createDataFrame([("B", "U", "B", 1, 1.0, 2.0), ("B", "U", "B", 2, 3.0, 0.0)],
                               "fsym_char1 string, tsym string, fsym string, t long, close double, high double")
    df = df.withColumn("ts", F.timestamp_seconds("t"))
    out = pair_windows(df, "ts", with_ath=True, chunk_seconds=1).orderBy("t")
    assert rows(out, "close_lag1", "all_time_high") == [(None, 2.0), (1.0, 2.0)]


def test_dedupe_option(spark):
    data = [("X", "USD", 0, "1", "1"), ("X", "USD", DAY_S, "2", "2"), ("X", "USD", DAY_S, "2", "2")]
    twice = landed(spark, data)
    assert derive_bars(twice, DAY).count() == 3  # nothing dropped by default
    once = derive_bars(twice, DAY, dedupe=True).orderBy("date")
    assert rows(once, "change") == [(None,), (1.0,)]


def test_hot_pair_is_split_across_tasks(spark):
    """One pair with ~90% of the rows: the chunked window spreads it over
    many tasks; the plain per-pair window would keep it in one."""
    hot = spark.range(0, 60 * 24 * 40).select(  # 40 days of minute bars
        F.lit("HOT").alias("fsym"), F.lit("USD").alias("tsym"), (F.col("id") * 60).alias("t"))
    cold = spark.range(0, 6000).select(
        F.concat(F.lit("C"), (F.col("id") % 50).cast("string")).alias("fsym"), F.lit("USD").alias("tsym"),
        (F.col("id") * 60).alias("t"))
    bars = hot.unionByName(cold).select(
        F.col("t").cast("string").alias("time"), F.lit("1").alias("open"), F.lit("2").alias("high"),
        F.lit("1").alias("low"), F.lit("1").alias("close"), F.lit("1").alias("volumefrom"),
        F.lit("1").alias("volumeto"), "fsym", "tsym")

    def largest_share(df):
        # sum(change) keeps the window in the plan (a count alone would prune it)
        sizes = df.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count(F.lit(1)).alias("count"), F.sum("change")).collect()
        return max(r["count"] for r in sizes) / sum(r["count"] for r in sizes)

    chunked = derive_bars(bars, MINUTE)
    plain = derive_bars(bars, MINUTE, chunked=False)
    # AQE would (rightly) merge these few MB into one partition; measure the
    # partitioning itself
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert largest_share(plain) > 0.85
        assert largest_share(chunked) < 0.3
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
