"""Holiday calendar (J2), pairs (J1, A1, A3, X5) and quality checks (Q1-Q4)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tickforge.operators import holidays, pairs, quality


def flags(spark, days):
    df = spark.createDataFrame([(d,) for d in days], "d date")
    return dict(rows(holidays.is_holiday_usa(df, "d"), "d", "is_holiday_usa"))


def test_holidays_2021_with_observed_days(spark):
    days = [dt.date(2021, 6, 18), dt.date(2021, 6, 19), dt.date(2021, 7, 4), dt.date(2021, 7, 5),
            dt.date(2021, 12, 24), dt.date(2021, 12, 25), dt.date(2021, 12, 31), dt.date(2021, 7, 6)]
    got = flags(spark, days)
    assert [got[d] for d in days] == [True] * 7 + [False]


def test_holiday_calendar_2021_size(spark):
    years = spark.createDataFrame([(2021,), (2022,)], "year int")
    cal = holidays.holiday_calendar(years).filter(F.year("holiday_date") == 2021)
    assert cal.filter(~F.col("observed")).count() == 11
    # Jun 18, Jul 5, Dec 24 and Dec 31 (New Year 2022 falls on a Saturday)
    assert cal.filter(F.col("observed")).count() == 4


def test_rule_start_years(spark):
    got = flags(spark, [dt.date(1985, 1, 21), dt.date(1986, 1, 20), dt.date(1975, 10, 27), dt.date(1975, 11, 11),
                        dt.date(2020, 6, 19), None])
    assert got[dt.date(1985, 1, 21)] is False  # no MLK day before 1986
    assert got[dt.date(1986, 1, 20)] is True
    assert got[dt.date(1975, 10, 27)] is True  # Veterans Day in October, 1971-77
    assert got[dt.date(1975, 11, 11)] is False
    assert got[dt.date(2020, 6, 19)] is False  # Juneteenth from 2021
    assert got[None] is False


def test_holiday_test_is_an_expression(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 1),)], "d date")
    plan = holidays.is_holiday_usa(df, "d")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_holiday_expression_equals_the_calendar(spark):
    years = spark.range(1971, 2060).withColumnRenamed("id", "year")
    days = {r["holiday_date"] for r in holidays.holiday_calendar(years.select(F.col("year").cast("int"))).collect()}
    first = dt.date(1971, 1, 2)
    every = [first + dt.timedelta(i) for i in range(88 * 365)]
    got = dict(rows(holidays.is_holiday_usa(spark.createDataFrame([(d,) for d in every], "d date"), "d"), "d", "is_holiday_usa"))
    assert got == {d: d in days for d in every}
    old = dt.date(1968, 2, 22)
    df = spark.createDataFrame([(old,), (None,)], "d date")
    assert dict(rows(holidays.is_holiday_usa(df, "d"), "d", "is_holiday_usa")) == {old: None, None: False}


def test_pair_product_keeps_duplicates_without_a_join(spark):
    f = spark.createDataFrame([("BTC",), ("BTC",), ("ETH",)], "fsym string")
    out = pairs.pair_product(f, ["USD", "EUR"])
    assert out.count() == 6
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_buckets_and_manifest(spark):
    p = pairs.with_bucket(pairs.pair_product(spark.createDataFrame([("BTC",), ("1ST",), ("BAT",)], "fsym string"), ["USD"]))
    assert rows(pairs.distinct_buckets(p), "fsym_char1") == [("B",), ("_",)]
    assert sorted(rows(pairs.bucket_pairs(p), "fsym_char1", "n_pairs", "n_symbols")) == [("B", 2, 2), ("_", 1, 1)]
    m = pairs.request_manifest(p.filter("fsym = 'BTC'"), "minute", base_url="https://h/data", app_name="app",
                               exchange="EX", as_of="2018-12-24 10:00:00")
    assert m.first()["url"] == "https://h/data/histominute?fsym=BTC&tsym=USD&limit=2000&toTs=1545523200&e=EX&extraParams=app"
    d = pairs.request_manifest(p.filter("fsym = 'BTC'"), "day", base_url="https://h/data", app_name="app", exchange="EX")
    assert d.first()["url"].endswith("&allData=true&e=EX&extraParams=app")
    n = pairs.request_manifest(p.filter("fsym = 'BTC'"), "hour", base_url="https://h/data", app_name="app",
                               exchange="EX", all_data=False, limit=30)
    assert "&limit=30&e=EX" in n.first()["url"]
    with pytest.raises(ValueError):
        pairs.request_manifest(p, "hour", base_url="b", app_name="a", exchange="e")  # paged without as_of


def test_check_request_arguments():
    quality.check_request("day", ["BTC"], ["USD"], 2000, True, "EX", "app")
    with pytest.raises(ValueError, match="grain"):
        quality.check_request("week", ["BTC"], ["USD"], 2000, True, "EX", "app")
    with pytest.raises(ValueError, match="fsyms"):
        quality.check_request("day", ["BTC", 3], ["USD"], 2000, True, "EX", "app")
    with pytest.raises(ValueError, match="limit"):
        quality.check_request("day", ["BTC"], ["USD"], "2000", True, "EX", "app")


def test_dataset_checks(spark):
    s = spark.createDataFrame([("BTC", "x"), ("", "x"), (None, "y"), ("1ST", "y")], "fsym string, slice string")
    assert quality.bad_symbols(s).count() == 2
    assert rows(quality.check_one_bucket(s.filter("fsym <> ''"), ["slice"]), "slice") == []
    mixed = spark.createDataFrame([("BTC", "s"), ("ETH", "s")], "fsym string, slice string")
    assert rows(quality.check_one_bucket(mixed, ["slice"]), "slice", "n_buckets") == [("s", 2)]
    keys = spark.createDataFrame([("HASH_RATE", "https://a/charts/hash-rate"), ("DIFF", "https://a/charts/difficulty")],
                                 "key string, url string")
    assert rows(quality.check_chart_keys(keys), "key") == [("DIFF",)]
    resp = spark.createDataFrame([(200,), (500,), (None,)], "status int")
    assert quality.check_status(resp).count() == 2
    with pytest.raises(ValueError):
        quality.require_empty(quality.check_status(resp), "bad responses")
    quality.require_empty(quality.check_status(resp.filter("status = 200")), "bad responses")


def test_chart_requests_suffix(spark):
    charts = spark.createDataFrame([("n-tx", "https://a/charts/n-tx")], "chart string, url string")
    assert pairs.chart_requests(charts).first()["request_url"] == "https://a/charts/n-tx?timespan=all&format=json"


def test_coin_list_job_fails_on_bad_status(spark):
    from tickforge.plans import jobs
    from tickforge.session import scratch_path

    docs = spark.createDataFrame([("d", 500, '{"Data": {}}')], "doc_id string, status int, body string")
    with pytest.raises(ValueError, match="HTTP 200"):
        jobs.coin_list_job(docs, scratch_path(spark, "t-coins"), "coinlist", "2018-12-23 00:00:00")
