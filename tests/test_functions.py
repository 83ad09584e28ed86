"""Edge rows for the Column -> Column helpers (D1-D11, X1-X4, P1 cell rule)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tickforge.functions import numeric as fn
from tickforge.functions import symbols as fs
from tickforge.functions import temporal as ft


def one_col(spark, values, type_="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {type_}")


def test_clean_double_dirty_text(spark):
    df = one_col(spark, ["None", "nan", "", "1e3", "2.5", None, "NaN"])
    got = [r[0] for r in df.select(fn.clean_double("v")).collect()]
    assert got == [None, None, None, 1000.0, 2.5, None, None]


def test_try_divide_zero_guard(spark):
    df = spark.createDataFrame([(2.0, 0.0), (3.0, 1.5), (1.0, None)], "c double, p double")
    got = [r[0] for r in df.select(fn.pct_change("c", "p")).collect()]
    assert got == [None, 1.0, None]


def test_pct_from_ath(spark):
    df = spark.createDataFrame([(5.0, 10.0), (5.0, None)], "c double, a double")
    assert [r[0] for r in df.select(fn.pct_from_ath("c", "a")).collect()] == [-0.5, None]


def test_unix_to_ts_forms(spark):
    df = one_col(spark, ["1545523200", "1545523200.0", "None", "garbage", "", "99999999999999999", "1e300"])
    got = [r[0] for r in df.select(ft.unix_to_ts("v")).collect()]
    assert got[:2] == [dt.datetime(2018, 12, 23), dt.datetime(2018, 12, 23)]
    assert got[2:] == [None] * 5


def test_parse_timestamp_layouts(spark):
    df = one_col(
        spark,
        [
            "2018-12-23 05:06:07.123456",
            "2018-12-23",
            "12/23/2018 05:06:07",
            "12/23/2018",
            "20181223",
            "2018-12-23_05_06_07_120000",
            "garbage",
        ],
    )
    got = [r[0] for r in df.select(ft.parse_timestamp("v")).collect()]
    assert got == [
        dt.datetime(2018, 12, 23, 5, 6, 7, 123456),
        dt.datetime(2018, 12, 23),
        dt.datetime(2018, 12, 23, 5, 6, 7),
        dt.datetime(2018, 12, 23),
        dt.datetime(2018, 12, 23),
        dt.datetime(2018, 12, 23, 5, 6, 7, 120000),
        None,
    ]
    dates = [r[0] for r in df.select(ft.parse_date("v")).collect()]
    assert dates[0] == dt.date(2018, 12, 23) and dates[-1] is None


def test_quarter_start_edges(spark):
    days = [dt.date(2020, 1, 1), dt.date(2020, 3, 31), dt.date(2020, 4, 1), dt.date(2020, 2, 29), dt.date(2020, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "v date")
    got = [r[0] for r in df.select(ft.quarter_start("v")).collect()]
    assert got == [dt.date(2020, 1, 1), dt.date(2020, 1, 1), dt.date(2020, 4, 1), dt.date(2020, 1, 1), dt.date(2020, 10, 1)]


def test_day_and_month_names_are_full(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2),)], "v date")
    r = df.select(ft.day_name("v"), ft.month_name("v")).first()
    assert tuple(r) == ("Tuesday", "January")


def test_last_utc_close_is_previous_midnight(spark):
    df = spark.createDataFrame([(dt.datetime(2018, 12, 24, 17, 30),), (dt.datetime(2018, 12, 24),)], "v timestamp")
    got = [r[0] for r in df.select(ft.last_utc_close("v")).collect()]
    assert got == [1545523200, 1545523200]  # 2018-12-23 00:00:00 UTC


def test_calendar_parts_follow_utc(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 5, 23, 59),)], "v timestamp")
    r = df.select(ft.hour_of("v"), ft.minute_of("v"), ft.date_of("v"), *ft.date_parts("v").values()).first()
    assert tuple(r) == (23, 59, dt.date(2024, 3, 5), 2024, 3, 5)


def test_run_id_layout(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2018, 12, 23, 0, 0, 0, 120000),), (dt.datetime(2018, 12, 23),)], "v timestamp"
    )
    got = [r[0] for r in df.select(ft.run_id("v")).collect()]
    assert got == ["2018-12-23_00_00_00_120000", "2018-12-23_00_00_00"]


def test_symbol_bucket(spark):
    df = one_col(spark, ["1ST", "btc", "BTC", "", None])
    got = [r[0] for r in df.select(fs.symbol_bucket("v")).collect()]
    assert got == ["_", "b", "B", "", None]


def test_chart_name_and_kebab_key(spark):
    df = spark.createDataFrame([("N_UNIQUE_ADDRESSES", "https://x.org/charts/n-unique-addresses")], "k string, u string")
    r = df.select(fs.kebab_key("k"), fs.chart_name("u")).first()
    assert r[0] == r[1] == "n-unique-addresses"


def test_null_if_zero(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (None,)], "v double")
    assert [r[0] for r in df.select(fn.null_if_zero("v")).collect()] == [None, 5.0, None]


def test_functions_stay_in_the_jvm(spark):
    df = one_col(spark, ["1545523200"]).select(
        ft.unix_to_ts("v"), ft.parse_timestamp("v"), fs.symbol_bucket("v"), fn.clean_double("v"), ft.run_id(F.current_timestamp())
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan
