"""Chunks with very many copies of one (pair, time) are split by salt and
still equal the plain per-pair window."""

from __future__ import annotations

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickforge.operators import derive
from tickforge.operators.derive import MINUTE, derive_bars, pair_windows
from tickforge.session import scratch_path

bar = st.tuples(
    st.sampled_from(["AAA", "BBB"]),  # fsym
    st.integers(min_value=0, max_value=300),  # time (seconds)
    st.one_of(st.none(), st.just(0.0), st.floats(min_value=0.5, max_value=9.0)),  # high
    st.one_of(st.none(), st.just(0.0), st.floats(min_value=0.5, max_value=9.0)),  # close
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(bar, min_size=1, max_size=40, unique_by=lambda r: (r[0], r[1])),
       copies=st.lists(st.tuples(st.integers(min_value=0, max_value=39), st.integers(min_value=2, max_value=60)),
                       max_size=3),
       chunk=st.sampled_from([7, 50, 1000]), partitioning=st.sampled_from(["hash", "range", "counts"]))
def test_split_copies_equals_plain(spark, rows, copies, chunk, partitioning):
    data = [(f, "USD", t, h, c) for f, t, h, c in rows]
    for pick, n in copies:  # exact copies of some bars
        data += [data[pick % len(rows)]] * n
    df = spark.createDataFrame(data, "fsym string, tsym string, t long, high double, close double") \
        .withColumn("ts", F.timestamp_seconds("t"))
    cols = ["fsym", "t", "high", "close", "close_lag1", "all_time_high"]
    plain = Counter(tuple(r) for r in pair_windows(df, "ts", with_ath=True, chunk_seconds=None)
                    .select(*cols).collect())
    split = pair_windows(df, "ts", with_ath=True, chunk_seconds=chunk, partitioning=partitioning,
                         split_copies_over=5)
    split = Counter(tuple(r) for r in split.select(*cols).collect())
    assert plain == split


def test_hot_copies_are_split_across_tasks(spark):
    """One (pair, time) holds ~75% of the rows, each with its own volume: with
    the split, no window task holds more than a third of the rows."""
    cold = spark.range(0, 8000).select(
        F.concat(F.lit("C"), (F.col("id") % 40).cast("string")).alias("fsym"), (F.col("id") * 60).alias("t"), "id")
    hot = spark.range(0, 24000).select(F.lit("HOT").alias("fsym"), F.lit(600).cast("bigint").alias("t"), "id")
    bars = cold.unionByName(hot).select(
        F.col("t").cast("string").alias("time"), F.lit("1").alias("open"), F.lit("2").alias("high"),
        F.lit("1").alias("low"), F.lit("1").alias("close"), F.col("id").cast("string").alias("volumefrom"),
        F.lit("1").alias("volumeto"), "fsym", F.lit("USD").alias("tsym"))

    def largest_share(df):
        sizes = df.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count(F.lit(1)).alias("count"), F.sum("change")).collect()
        return max(r["count"] for r in sizes) / sum(r["count"] for r in sizes)

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert largest_share(derive_bars(bars, MINUTE)) > 0.7
        split = derive_bars(bars, MINUTE, split_copies_over=3000)
        assert largest_share(split) < 0.34
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    plain = derive_bars(bars, MINUTE, chunked=False)
    key = ["fsym", "date", "hour", "minute", "close", "change"]
    assert Counter(tuple(r) for r in split.select(*key).collect()) == \
        Counter(tuple(r) for r in plain.select(*key).collect())


def own_requests(spark, hot=24_000):
    """One (pair, time) holds 75% of the rows, every copy from a request of its own."""
    cold = spark.range(0, hot // 3).select(
        F.concat(F.lit("C"), (F.col("id") % 40).cast("string")).alias("fsym"), F.timestamp_seconds(F.col("id") * 60).alias("ts"), "id")
    rows = cold.unionByName(spark.range(0, hot).select(F.lit("HOT").alias("fsym"), F.timestamp_seconds(F.lit(600)).alias("ts"), "id"))
    return rows.select("fsym", F.lit("USD").alias("tsym"), "ts", F.timestamp_seconds(F.col("id") * 7919 % 100_003).alias("request_timestamp"),
                       (F.col("id") % 1_009).cast("double").alias("high"), (F.col("id") % 997).cast("double").alias("close"))


def test_copies_with_own_requests_are_spread(spark):
    """Ranges of equal row count: no window task holds a third of the rows, also not of
    the small windows over the ranges, and every row equals the plain window's."""
    bars = own_requests(spark)
    cols = ["fsym", "ts", "request_timestamp", "high", "close", "close_lag1", "all_time_high"]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        plain = Counter(tuple(r) for r in pair_windows(bars, "ts", with_ath=True, chunk_seconds=None).select(*cols).collect())
        for partitioning in ("hash", "counts"):
            split = pair_windows(bars, "ts", with_ath=True, chunk_seconds=86_400, partitioning=partitioning, split_copies_over=2_000)
            got = split.select(*cols, F.spark_partition_id().alias("p")).collect()
            assert Counter(tuple(r)[:-1] for r in got) == plain
            assert max(Counter(r["p"] for r in got).values()) < len(got) / 3
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hot_rows_are_read_once(spark):
    """The main plan reads the input for the cold rows alone; the hot ones come from the
    ranges that were written."""
    path = f"{scratch_path(spark, 'hot-input')}"
    own_requests(spark, 3_000).write.parquet(path)
    out = pair_windows(spark.read.parquet(path), "ts", with_ath=True, chunk_seconds=86_400, split_copies_over=500)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count(path.rsplit("/", 1)[1][:30]) == 1 and "hot-bars" in plan


def test_split_equals_plain_after_a_shuffle(spark):
    """Bars in any order and layout, different values at one time, NULL times
    and adaptive coalescing: the limit changes no row."""
    bars = spark.range(0, 4000).select(
        F.concat(F.lit("F"), (F.col("id") % 3).cast("string")).alias("fsym"), F.lit("USD").alias("tsym"),
        F.when(F.col("id") % 7 > 0, F.timestamp_seconds(F.col("id") % 40 * 60)).alias("ts"),
        F.timestamp_seconds(F.col("id") % 5).alias("request_timestamp"),
        (F.col("id") % 11).cast("double").alias("high"), (F.col("id") % 23).cast("double").alias("close"))
    bars = bars.unionByName(bars.filter("close > 12"))  # exact copies
    cols = ["fsym", "ts", "request_timestamp", "high", "close", "close_lag1", "all_time_high"]

    def out(df, **kw):
        return Counter(tuple(r) for r in pair_windows(df, "ts", with_ath=True, **kw).select(*cols).collect())

    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        plain = out(bars, chunk_seconds=None)
        for limit in (5, 20, None):
            for partitioning in ("hash", "range", "counts"):
                got = out(bars.repartition(64, "close", "high"), chunk_seconds=600, partitioning=partitioning, split_copies_over=limit)
                assert got == plain
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_ranges_do_not_grow_with_the_rows(spark, monkeypatch):
    """A low limit makes no more ranges than tasks have use for; rows stay the plain window's."""
    made = []
    cut = derive.cut_ranges
    monkeypatch.setattr(derive, "cut_ranges", lambda df, order, ranges, name: made.append(ranges) or cut(df, order, ranges, name))
    bars = own_requests(spark, 3_000)
    cols = ["fsym", "ts", "request_timestamp", "high", "close", "close_lag1", "all_time_high"]
    plain = Counter(tuple(r) for r in pair_windows(bars, "ts", with_ath=True, chunk_seconds=None).select(*cols).collect())
    split = pair_windows(bars, "ts", with_ath=True, chunk_seconds=86_400, split_copies_over=10)
    assert Counter(tuple(r) for r in split.select(*cols).collect()) == plain
    assert made == [16]  # two a shuffle partition
    assert derive._range_count(5_000_000_000, 100, 8) == 5_000 and derive._range_count(900, 100, 8) == 9
