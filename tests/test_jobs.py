"""Jobs: checks while writing, rerun-safe landing, packed documents, kept fields."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tickforge.operators.quality import Watch, bad_symbol, guard
from tickforge.plans import jobs
from tickforge.session import scratch_path
from tickforge.sinks import writers
from tickforge.sources import landed as src
from tickforge.sources import responses as resp

PAGES = "fsym string, tsym string, page_no int, status int, body string"
BAR = {"open": 1.0, "high": 2.0, "low": 1.0, "close": 1.5, "volumefrom": 3.0, "volumeto": 4.0}


def pages(spark, data):
    return spark.createDataFrame([(f, t, n, s, json.dumps({"Data": [{"time": x, **BAR} for x in times]})) for f, t, n, s, times in data], PAGES)


def land(spark, root, data, run="r1", **how):
    return jobs.landing_job(pages(spark, data), root, run, "1970-02-01 00:00:00", "1970-02-01 00:00:01", **how)


def test_landing_twice_replaces_the_run(spark):
    root = scratch_path(spark, "land")
    with pytest.raises(ValueError, match="not been landed"):
        src.committed_run(spark, root, "r1")
    land(spark, root, [("A", "U", 0, 200, [60, 120]), ("B", "U", 0, 200, [60])])
    again = land(spark, root, [("A", "U", 0, 200, [60, 120])])
    land(spark, root, [("C", "U", 0, 200, [60])], run="r2")
    run = src.committed_run(spark, root, "r1")
    assert run == again
    assert sorted((r["fsym"], r["time"]) for r in src.scan_bars(spark, run).collect()) == [("A", "120"), ("A", "60")]
    assert [r["rows"] for r in src.run_commits(spark, root, "r1").orderBy("version").collect()] == [3, 2]
    jobs.derive_job(spark, run, out := scratch_path(spark, "out"), "minute")
    assert src.scan_derived(spark, out, "minute").count() == 2


@pytest.mark.parametrize("symbol", [None, " "])
def test_a_bad_symbol_is_not_committed(spark, symbol):
    root = scratch_path(spark, "land")
    land(spark, root, good := [("A", "U", 0, 200, [60])])
    kept = src.committed_run(spark, root, "r1")
    with pytest.raises(ValueError, match="blank symbol: 2 rows"):
        land(spark, root, [*good, (symbol, "U", 0, 200, [60, 120])])
    assert src.committed_run(spark, root, "r1") == kept


def test_derive_refuses_a_symbol_in_another_bucket(spark):
    run, out = scratch_path(spark, "run"), scratch_path(spark, "out")
    row = [("60", *["1"] * 6, f, "U", "1970-01-01", "1970-01-01", "A", 1970, 1, 1) for f in ("A", "B")]
    writers.sink_landing(spark.createDataFrame(row, src.LANDED_SCHEMA), run)
    with pytest.raises(Exception, match="symbol outside its bucket"):
        jobs.derive_job(spark, run, out, "minute")


def test_charts_and_coins_check_while_writing(spark):
    docs = [("n-a", "https://x/charts/n-a", '{"values":[{"x":1,"y":2.0}]}'), ("n-b", "https://x/charts/n-c", '{"values":[]}')]
    df = spark.createDataFrame(docs, "chart string, url string, body string")
    jobs.chart_job(df.limit(1), scratch_path(spark, "charts"))
    with pytest.raises(Exception, match="chart and URL differ"):
        jobs.chart_job(df, scratch_path(spark, "charts"))
    coins = spark.createDataFrame([(200, '{"Data":{"A":{"Id":"1"}}}'), (500, "{}")], "status int, body string")
    folder = scratch_path(spark, "coins")
    with pytest.raises(Exception, match="not HTTP 200"):
        jobs.coin_list_job(coins, folder, "c", "t")
    assert src.scan_coins(spark, jobs.coin_list_job(coins.limit(1), folder, "c", "t")).collect()[0].asDict() == {"Id": "1", "request_timestamp": "t"}


def test_request_job_checks_arguments_and_symbols(spark):
    common = dict(base_url="https://h", app_name="a", exchange="E", as_of="2024-01-02 03:00:00")
    path = scratch_path(spark, "manifest")
    jobs.request_job(spark, path, ["A", "B"], ["U"], "day", **common)
    assert sorted(r["url"] for r in spark.read.parquet(path).collect()) == [
        f"https://h/histoday?fsym={f}&tsym=U&allData=true&e=E&extraParams=a" for f in "AB"]
    with pytest.raises(ValueError, match="grain must be"):
        jobs.request_job(spark, scratch_path(spark, "m"), ["A"], ["U"], "week", **common)
    with pytest.raises(Exception, match="blank symbol"):
        jobs.request_job(spark, scratch_path(spark, "m"), ["A", " "], ["U"], "day", **common)


def test_watch_and_guard(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("", 3)], "fsym string, n int")
    watch = Watch(df, {"blank": bad_symbol("fsym"), "large": F.col("n") > 9})
    watch.df.write.format("noop").mode("overwrite").save()
    with pytest.raises(ValueError, match="^blank: 2 rows$"):
        watch.require()
    assert guard(df, {"large": F.col("n") > 9, "unknown": F.lit(None).cast("boolean")}).count() == 3


def test_packed_documents(spark):
    """Many documents a file, odd names and texts, one larger than a pack, copies; by name again."""
    docs = [(f"f{i % 3}", f"d{i}", json.dumps({"i": i, "s": "é😀\n\t" * (i % 5)})) for i in range(200)]
    docs += [("a/b", "x=y", '{ "k" : [1, 2] }'), ("f0", "large", json.dumps("z" * 50_000)), docs[7], docs[7]]
    df = spark.createDataFrame(docs, "folder string, name string, body string")
    path = scratch_path(spark, "packed")
    writers.sink_json_packed(df, path, pack_bytes=4_000)
    index = spark.read.parquet(f"{path}/index").collect()
    assert len(index) == 202 and 5 < len({r["pack"] for r in index}) < 30
    assert spark.read.text(f"{path}/packs").count() == 202
    back = {(r["folder"], r["name"]): json.loads(r["body"]) for r in resp.read_packed(spark, path).collect()}
    assert back == {(f, n): json.loads(b) for f, n, b in docs}
    some = spark.createDataFrame([("f1", "d7"), ("a/b", "x=y"), ("f1", "d7"), ("no", "no")], "folder string, name string")
    assert sorted((r["name"], r["body"]) for r in resp.read_packed(spark, path, some).collect())[1] == ("x=y", '{"k":[1,2]}')
    empty = scratch_path(spark, "packed")
    writers.sink_json_packed(df.limit(0), empty)
    assert resp.read_packed(spark, empty, some).count() == 0


@pytest.mark.parametrize("bad, what", [([("f", "n", "{")], "MALFORMED"), ([("f", "n", "1"), ("f", "n", "2")], "two documents"), ([("f", None, "1")], "without name")])
def test_packed_documents_refuse(spark, bad, what):
    with pytest.raises(Exception, match=what):
        writers.sink_json_packed(spark.createDataFrame(bad, "folder string, name string, body string"), scratch_path(spark, "packed"))


def test_unknown_fields_are_kept(spark):
    body = json.dumps({"Data": [{"time": 1, "close": 2.5, "z": {"q": [1, None]}, "a": "x"}, {"time": 2, "volumefrom": "no number"}, 7]})
    df = spark.createDataFrame([("A", "U", 0, 200, body), ("A", "U", 1, 500, "x"), ("A", "U", 2, 200, '{"Data":[]}')], PAGES)
    rows = resp.flatten_bars(df, rest=True).withColumn("rest", F.to_json("rest")).collect()
    assert [(r["time"], r["close"], r["volumefrom"], r["rest"]) for r in rows] == [
        (1, 2.5, None, '{"a":"x","z":{"q":[1,null]}}'), (2, None, None, None), (None, None, None, None)]
    for rest in (False, True):
        with pytest.raises(Exception, match="without Data"):
            resp.flatten_bars(df.withColumn("body", F.lit("{}")), rest=rest).collect()
        with pytest.raises(Exception, match="without values: c"):
            resp.flatten_charts(spark.createDataFrame([("c", "{}")], "chart string, body string"), rest=rest).collect()


def test_coin_fields_come_from_one_schema(spark):
    docs = [('{"Data":{"A":{"Id":"1","n":2,"odd name`":null},"B":{"x":{"y":1.50}}}}',), ('{"Data":{}}',), ('{"Data":{"C":"no object"}}',)]
    df = spark.createDataFrame(docs, "body string")
    out = resp.flatten_coins(df)
    assert out.columns == ["Id", "n", "odd name`", "x"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([("1", "2", None, None), (None, None, None, '{"y":1.5}'), (None,) * 4], key=str)
    assert resp.flatten_coins(df, fields=("Id",)).columns == ["Id"]
    assert resp.flatten_coins(df.limit(0)).columns == []
    for bad in ("{}", '{"Data":[1]}', "null"):
        with pytest.raises(Exception, match="without Data"):
            resp.flatten_coins(spark.createDataFrame([(bad,)], "body string")).collect()
