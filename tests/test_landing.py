"""Landing steps: back-fill cut, page flags, cut-off, text, unions, top-n."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tickforge.operators import landing
from tickforge.sources import responses as resp


def page(fsym, page_no, status, volumes):
    data = [{"time": 1000 * page_no + i, "open": 1.0, "high": 1.0, "low": 1.0, "close": 1.0,
             "volumefrom": v, "volumeto": 1.0} for i, v in enumerate(volumes)]
    return (fsym, "USD", page_no, status, json.dumps({"Data": data, "TimeFrom": 1000 * page_no}))


def pages_df(spark, pages):
    return spark.createDataFrame(pages, "fsym string, tsym string, page_no int, status int, body string")


def kept(spark, pages):
    out = landing.backfill_cut(pages_df(spark, pages))
    return sorted(rows(out, "fsym", "page_no"))


def test_stop_at_all_zero_page(spark):
    got = kept(spark, [page("A", 0, 200, [1, 2]), page("A", 1, 200, [0, 0]), page("A", 2, 200, [5])])
    assert got == [("A", 0)]


def test_failed_page_hides_later_good_pages(spark):
    got = kept(spark, [page("A", 0, 200, [1]), page("A", 1, 500, [1]), page("A", 2, 200, [1])])
    assert got == [("A", 0)]


def test_empty_page_stops(spark):
    got = kept(spark, [page("A", 0, 200, [1]), page("A", 1, 200, []), page("A", 2, 200, [1])])
    assert got == [("A", 0)]


def test_null_volume_is_not_zero(spark):
    got = kept(spark, [page("A", 0, 200, [0, None, 0]), page("A", 1, 200, [3])])
    assert got == [("A", 0), ("A", 1)]


def test_pairs_cut_independently(spark):
    got = kept(spark, [page("A", 0, 500, [1]), page("B", 0, 200, [1]), page("B", 1, 200, [2])])
    assert got == [("B", 0), ("B", 1)]


def test_page_all_zero_values(spark):
    df = pages_df(spark, [page("A", 0, 200, []), page("A", 1, 200, [0, None]), page("A", 2, 200, [0, 0]),
                          ("A", "USD", 3, 500, '{"Response":"Error"}')])
    got = sorted(rows(landing.page_flags(df), "page_no", "all_zero", "stop"))
    assert got == [(0, True, True), (1, False, False), (2, True, True), (3, None, True)]


def test_flatten_skips_failed_and_empty(spark):
    df = pages_df(spark, [page("A", 0, 200, [1, 2]), page("A", 1, 500, [1]), page("A", 2, 200, [])])
    out = resp.flatten_bars(df)
    assert out.count() == 2
    assert set(out.columns) >= {"fsym", "tsym", "page_no", "time", "close", "volumefrom"}


def test_cutoff_keeps_equal_time(spark):
    df = spark.createDataFrame([(99,), (100,), (101,)], "time long")
    assert rows(landing.cutoff_filter(df, 100), "time") == [(99,), (100,)]


def test_all_to_string_keeps_nulls(spark):
    df = spark.createDataFrame([(1.5, None, 3)], "a double, b double, c int")
    r = landing.all_to_string(df).first()
    assert (r["a"], r["b"], r["c"]) == ("1.5", None, "3")


def test_concat_pairs_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, 2.0)], "time long, volumeto double")
    b = spark.createDataFrame([(2,)], "time long")
    got = sorted(rows(landing.concat_pairs([a, None, b]), "time", "volumeto"))
    assert got == [(1, 2.0), (2, None)]
    with pytest.raises(ValueError):
        landing.concat_pairs([None])


def test_recent_bars_top_n(spark):
    df = spark.createDataFrame([("A", "USD", t) for t in range(10)] + [("B", "USD", 5)], "fsym string, tsym string, time long")
    out = landing.recent_bars(df, 3)
    assert sorted(rows(out, "fsym", "time", "recent_rank")) == [("A", 7, 3), ("A", 8, 2), ("A", 9, 1), ("B", 5, 1)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_stamp_columns(spark):
    df = spark.createDataFrame([("1INCH", "USD", 1545523200)], "fsym string, tsym string, time long")
    r = landing.stamp_columns(df, "2018-12-24 00:00:00.5").first()
    assert (r["fsym_char1"], r["year"], r["month"], r["day"], r["request_timestamp"]) == (
        "_", 2018, 12, 23, "2018-12-24 00:00:00.5")


def test_sort_landing_orders_each_task(spark):
    df = spark.createDataFrame([(t,) for t in (5, 3, 9, 1)], "time long").coalesce(1)
    assert rows(landing.sort_landing(df), "time") == [(1,), (3,), (5,), (9,)]


def test_flatten_coins_discovers_fields(spark):
    doc = json.dumps({"Data": {"BTC": {"Symbol": "BTC", "Id": "1"}, "ETH": {"Symbol": "ETH", "Algo": "x"}}})
    df = spark.createDataFrame([("d", 200, doc)], "doc_id string, status int, body string")
    out = resp.flatten_coins(df)
    assert out.columns == ["Algo", "Id", "Symbol"]
    assert sorted(rows(out, "Symbol", "Id", "Algo")) == [("BTC", "1", None), ("ETH", None, "x")]


def test_flatten_charts_keeps_name(spark):
    doc = json.dumps({"values": [{"x": 1, "y": 2.5}, {"x": 2, "y": 3.0}]})
    df = spark.createDataFrame([("n-tx", "u", doc)], "chart string, url string, body string")
    assert rows(resp.flatten_charts(df), "chart", "x", "y") == [("n-tx", 1, 2.5), ("n-tx", 2, 3.0)]


def test_json_parse_variant_and_schema(spark):
    df = spark.createDataFrame([('{"a": {"b": 3}}',)], "body string")
    r = df.select(
        F.try_variant_get(resp.json_parse("body"), "$.a.b", "int").alias("v"),
        resp.json_parse("body", "STRUCT<a: STRUCT<b: INT>>").getField("a").getField("b").alias("s"),
    ).first()
    assert (r["v"], r["s"]) == (3, 3)


def test_dedupe_bars_keeps_newest_request(spark):
    df = spark.createDataFrame(
        [("A", "USD", 1, "2018-12-23 00:00:00", 1.0), ("A", "USD", 1, "2018-12-24 00:00:00", 2.0),
         ("A", "USD", 2, "2018-12-23 00:00:00", 3.0), ("B", "USD", 1, None, 4.0)],
        "fsym string, tsym string, time long, request_timestamp string, close double",
    )
    out = landing.dedupe_bars(df)
    assert sorted(rows(out, "fsym", "time", "close")) == [("A", 1, 2.0), ("A", 2, 3.0), ("B", 1, 4.0)]


def test_json_parse_strictness(spark):
    df = spark.createDataFrame([("{bad",)], "body string")
    assert df.select(resp.json_parse("body", strict=False).alias("v")).first()["v"] is None
    with pytest.raises(Exception):
        df.select(resp.json_parse("body")).collect()


def test_dedupe_compares_instants_and_keeps_unreadable_times(spark):
    df = spark.createDataFrame(
        [("A", "USD", t, "2018-12-23 00:00:00", c) for t, c in (("60", 1.0), ("60.0", 2.0), ("120.0", 3.0), ("bad", 4.0), ("bad", 5.0))],
        "fsym string, tsym string, time string, request_timestamp string, close double")
    for parts in (1, 4):
        got = sorted(rows(landing.dedupe_bars(df.repartition(parts)), "time", "close"))
        assert len(got) == 4 and got[-2:] == [("bad", 4.0), ("bad", 5.0)] and ("120.0", 3.0) in got
        assert got == sorted(rows(landing.dedupe_bars(df), "time", "close"))


def test_single_responses_keep_bars_without_volume(spark):
    df = pages_df(spark, [page("A", 0, 200, [0, 0]), page("B", 0, 200, [1])])
    from tickforge.plans import jobs
    single = jobs.landing_rows(df, "2100-01-01 00:00:00", "2018-12-24 00:00:00", paged=False)
    paged = jobs.landing_rows(df, "2100-01-01 00:00:00", "2018-12-24 00:00:00")
    assert sorted(r["fsym"] for r in single.collect()) == ["A", "A", "B"]
    assert [r["fsym"] for r in paged.collect()] == ["B"]


@pytest.mark.parametrize("body", ["{bad", "[]", '{"Message": "x"}', None])
def test_bad_pages_fail_the_job(spark, body):
    good, bad = page("A", 0, 200, [1]), page("A", 1, 200, [1])
    df = pages_df(spark, [good, bad]).withColumn("body", F.when(F.col("page_no") == 1, F.lit(body)).otherwise(F.col("body")))
    with pytest.raises(Exception):
        landing.backfill_cut(df).collect()
    with pytest.raises(Exception):
        resp.flatten_bars(df).collect()
    failed = df.withColumn("status", F.when(F.col("page_no") == 1, F.lit(500)).otherwise(F.col("status")))
    assert landing.backfill_cut(failed).count() == 1
