"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator key of the inventory.  Each reads the testdata tables through
``tickforge.fixtures`` and runs the operator over the whole input.  Sink
keys write to a fresh folder below the shared checkpoint root and return
what Spark reads back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge import fixtures as fx
from tickforge.functions import numeric as fn
from tickforge.functions import symbols as fs
from tickforge.functions import temporal as ft
from tickforge.operators import frontier, holidays, landing, pairs, quality
from tickforge.operators.derive import (
    DAY,
    HOUR,
    MINUTE,
    derive_bars,
    output_columns,
    rename_volumes,
    replace_column,
    typed_bars,
)
from tickforge.plans import jobs
from tickforge.session import scratch_path
from tickforge.sinks import writers
from tickforge.sources import landed as src
from tickforge.sources import responses as resp

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the test set-up (mirrored in tickforge.oracles).
LANDING_AS_OF = "2024-01-30 12:00:00"
RECENT_N = 24
PREFIX = "C"
UNIT_PAIRS = 100
PACKED_BYTES = 256 << 10
MANIFEST_BASE = "https://min-api.example.com/data"
MANIFEST_APP = "tickforge_test"
MANIFEST_EXCHANGE = "AGG"
CHART_URL_BASE = "https://api.example.org/charts/"

BAR_NUMBERS = ("open", "high", "low", "close", "volumefrom", "volumeto")


def _typed_back(df: DataFrame, numbers=BAR_NUMBERS, whole=("time",)) -> DataFrame:
    """Landed text -> numbers again, for comparing values (texts of doubles
    differ between engines)."""
    cols = {c: fn.clean_double(c) for c in numbers if c in df.columns}
    cols.update({c: F.col(c).try_cast("bigint") for c in whole if c in df.columns})
    return df.withColumns(cols)


# ------------------------------------------------------------ derive (W, N, P)

# window chunks over this many rows (only copies of one (pair, time) make one
# that large) are split by salt; see operators.derive.pair_windows
COPY_LIMIT = 1_000_000
# the same limit where the testdata is to exceed it
COPY_ROWS = 100


def change_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1d + W2 + N1-N3: the derived daily bars (flagship)."""
    return derive_bars(fx.landed_bars(spark, sf_dir, "day"), DAY, split_copies_over=COPY_LIMIT)


def change_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1h: derived hourly bars."""
    return derive_bars(fx.landed_bars(spark, sf_dir, "hour"), HOUR, split_copies_over=COPY_LIMIT)


def change_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1m: derived minute bars."""
    return derive_bars(fx.landed_bars(spark, sf_dir, "minute"), MINUTE, split_copies_over=COPY_LIMIT)


def all_time_high(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running maximum of non-zero highs per pair."""
    return change_daily(spark, sf_dir).select("date", "fsym", "tsym", "high", "all_time_high")


def change_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + W2 where every bar time has many copies, each with its own request: pairs of
    more than ``COPY_ROWS`` rows are cut into ranges of equal row count."""
    bars = derive_bars(fx.requested_bars(spark, sf_dir), DAY, split_copies_over=COPY_ROWS, keep=("request_timestamp",))
    return bars.select("fsym", "tsym", "date", "request_timestamp", "close", "change", "pct_change", "all_time_high")


def change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N1 on hourly bars."""
    bars = derive_bars(
        fx.landed_bars(spark, sf_dir, "hour"), HOUR, split_copies_over=COPY_LIMIT, keep=("close_lag1",)
    )
    return bars.select("fsym", "tsym", "date", "hour", "close", "close_lag1", "change")


def pct_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N2 on minute bars (zero closes give NULL)."""
    bars = derive_bars(
        fx.landed_bars(spark, sf_dir, "minute"), MINUTE, split_copies_over=COPY_LIMIT, keep=("close_lag1",)
    )
    return bars.select("fsym", "tsym", "date", "hour", "minute", "close", "close_lag1", "pct_change")


def pct_from_ath(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N3 on daily bars."""
    return change_daily(spark, sf_dir).select(
        "date", "fsym", "tsym", "close", "all_time_high", "pct_from_ath"
    )


def project_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 (minute output columns)."""
    return derive_bars(fx.landed_bars(spark, sf_dir, "minute"), MINUTE, split_copies_over=COPY_LIMIT)


def typed_bars_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed text -> doubles ('nan' and 'None' -> NULL)."""
    return typed_bars(fx.landed_bars(spark, sf_dir, "day"))


def replace_column_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed ``date`` and ``request_timestamp`` replaced by parsed values."""
    landed = fx.landed_bars(spark, sf_dir, "hour")
    out = replace_column(
        landed,
        {"date": ft.unix_to_ts("time"), "request_timestamp": ft.parse_timestamp("request_timestamp")},
    )
    return out.select("fsym", "tsym", "time", "date", "request_timestamp")


def rename_volumes_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3."""
    out = rename_volumes(typed_bars(fx.landed_bars(spark, sf_dir, "day")))
    return out.select("fsym", "tsym", "time", "volume_fsym", "volume_tsym")


def null_if_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8 on hourly highs."""
    b = fx.bars(spark, sf_dir, "hour")
    return b.select("fsym", "tsym", "time", "high", fn.null_if_zero("high").alias("high_nz"))


# ------------------------------------------------------------ landing steps

def cutoff_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 with D11: hourly bars at or before the last UTC close of the fixture's as-of."""
    b = fx.bars(spark, sf_dir, "hour")
    cut = landing.cutoff_filter(b, ft.last_utc_close(F.lit(fx.FIXTURE_AS_OF)))
    return cut.select("fsym", "tsym", "time", "close")


def last_utc_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D11 for every hourly bar instant taken as an as-of."""
    b = fx.bars(spark, sf_dir, "hour")
    return b.select("fsym", "tsym", "time", ft.last_utc_close("bar_ts").alias("cutoff"))


def recent_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: the 24 newest hourly bars per pair."""
    b = fx.bars(spark, sf_dir, "hour")
    return landing.recent_bars(b, RECENT_N).select("fsym", "tsym", "time", "close", "recent_rank")


def sort_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: minute bars ordered by time inside each task."""
    b = fx.bars(spark, sf_dir, "minute")
    return landing.sort_landing(b).select("fsym", "tsym", "time", "close")


def stamp_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6 (+ D1, D10): flattened page bars stamped with bucket, date parts, request time."""
    bars = resp.flatten_bars(fx.bar_pages(spark, sf_dir))
    out = landing.stamp_columns(bars, fx.FIXTURE_REQUEST_TS)
    return out.select("fsym", "tsym", "time", "fsym_char1", "date", "year", "month", "day", "request_timestamp")


def all_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars to text and back; NULL stays NULL."""
    b = fx.bars(spark, sf_dir, "day").withColumn(
        "low", F.when(F.col("low") >= 1, F.col("low"))
    ).select("fsym", "tsym", "time", *BAR_NUMBERS)
    text = landing.all_to_string(b)
    return _typed_back(text)


def concat_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One frame per quote symbol, the ETH frame without ``volumeto``."""
    b = fx.bars(spark, sf_dir, "day").select("fsym", "tsym", "time", "close", "volumeto")
    frames = [b.filter(F.col("tsym") == q) for q in fx.QUOTES]
    frames[2] = frames[2].drop("volumeto")
    return landing.concat_pairs(frames)


def backfill_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages kept in front of each pair's first stop page."""
    kept = landing.backfill_cut(fx.bar_pages(spark, sf_dir))
    return kept.select("fsym", "tsym", "page_no", "status")


def concat_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bars of the kept pages."""
    kept = landing.backfill_cut(fx.bar_pages(spark, sf_dir))
    return landing.concat_pages(kept).select("fsym", "tsym", "time", "close", "volumefrom")


def page_all_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 per page (NULL for the failed page, which has no data)."""
    return landing.page_flags(fx.bar_pages(spark, sf_dir)).select("fsym", "tsym", "page_no", "all_zero")


# ------------------------------------------------------------ sources

def flatten_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page bodies -> bars; the failed page gives nothing."""
    return resp.flatten_bars(fx.bar_pages(spark, sf_dir))


def json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page bodies parsed without a schema (VARIANT), two fields read."""
    pages = fx.bar_pages(spark, sf_dir)
    v = resp.json_parse("body")
    return pages.select(
        "fsym",
        "tsym",
        "page_no",
        F.try_variant_get(v, "$.TimeFrom", "bigint").alias("time_from"),
        F.array_size(F.try_variant_get(v, "$.Data", "array<variant>")).alias("n_bars"),
    )


def flatten_coins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed coin objects -> one text row per coin, fields found from the data."""
    return resp.flatten_coins(fx.coin_documents(spark, sf_dir))


def map_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values of the keyed object, one row per coin."""
    docs = fx.coin_documents(spark, sf_dir)
    data = resp.json_parse("body", resp.COIN_LIST_SCHEMA).getField("Data")
    coins = resp.explode_rows(docs, resp.map_values(data), []).withColumnRenamed("_item", "coin")
    return coins.select(
        F.col("coin").getItem("Symbol").alias("symbol"), F.size("coin").alias("n_fields")
    )


def flatten_charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chart documents -> points, chart name kept."""
    return resp.flatten_charts(fx.chart_documents(spark, sf_dir))


def flatten_bars_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 with the fields no schema names kept (as JSON text here)."""
    bars = resp.flatten_bars(fx.extended_pages(spark, sf_dir), rest=True)
    return bars.withColumn("rest", F.to_json("rest"))


def flatten_charts_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 with the fields no schema names kept (as JSON text here)."""
    points = resp.flatten_charts(fx.extended_charts(spark, sf_dir), rest=True)
    return points.withColumn("rest", F.to_json("rest"))


def scan_coins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: coin list landed by the coin-list job, read back."""
    folder = scratch_path(spark, "coins")
    path = jobs.coin_list_job(fx.coin_documents(spark, sf_dir), folder, "coinlist", fx.FIXTURE_REQUEST_TS)
    return src.scan_coins(spark, path)


def _landed_run(spark: SparkSession, sf_dir: str, grain: str) -> str:
    """Land the text bars of ``grain`` as one run; return the run folder."""
    run = src.run_path(scratch_path(spark, f"landed-{grain}"), "fixture")
    writers.sink_landing(fx.landed_bars(spark, sf_dir, grain), run)
    return run


def scan_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed run read back with the declared schema."""
    run = _landed_run(spark, sf_dir, "day")
    return _typed_back(src.scan_bars(spark, run))


def scan_bars_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bucket of a landed run (partition pruning)."""
    run = _landed_run(spark, sf_dir, "day")
    return _typed_back(src.scan_bars_prefix(spark, run, PREFIX))


# ------------------------------------------------------------ sinks and layouts

def sink_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 via the landing job: pages -> cut -> bars -> stamped text -> run folder."""
    root = scratch_path(spark, "landing")
    run = jobs.landing_job(fx.bar_pages(spark, sf_dir), root, "fixture", LANDING_AS_OF, fx.FIXTURE_REQUEST_TS)
    return _landed_back(spark, run)


def sink_landing_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: a run landed twice, read by its manifest."""
    root = scratch_path(spark, "landing")
    for _ in range(2):
        jobs.landing_job(fx.bar_pages(spark, sf_dir), root, "fixture", LANDING_AS_OF, fx.FIXTURE_REQUEST_TS)
    return _landed_back(spark, src.committed_run(spark, root, "fixture"))


def sink_landing_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 for single responses: no cut, bars without volume land too."""
    root = scratch_path(spark, "landing")
    run = jobs.landing_job(fx.bar_pages(spark, sf_dir), root, "fixture", LANDING_AS_OF, fx.FIXTURE_REQUEST_TS, all_data=False)
    return _landed_back(spark, run)


def _landed_back(spark: SparkSession, run: str) -> DataFrame:
    back = _typed_back(src.scan_bars(spark, run))
    return back.select(
        "fsym", "tsym", "fsym_char1", "year", "month", "day", "time", "close",
        "volumefrom", "date", "request_timestamp",
    )


def sink_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: numeric daily bars as one flat dataset, read back."""
    b = fx.bars(spark, sf_dir, "day").select("fsym", "tsym", "time", *BAR_NUMBERS)
    path = writers.sink_flat(b, scratch_path(spark, "flat"), "bars")
    return spark.read.parquet(path)


def sink_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: landed hourly run -> derive job -> partitioned output, read back."""
    run = _landed_run(spark, sf_dir, "hour")
    out = scratch_path(spark, "derived")
    jobs.derive_job(spark, run, out, HOUR)
    return src.scan_derived(spark, out, HOUR)


def sink_derived_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 with key ranges from the counts of the chunk summary: no sampling read."""
    run = _landed_run(spark, sf_dir, "hour")
    out = scratch_path(spark, "derived")
    jobs.derive_job(spark, run, out, HOUR, layout="counts")
    return src.scan_derived(spark, out, HOUR)


def sort_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: derived daily bars in the reference output layout."""
    return writers.sort_derived(change_daily(spark, sf_dir))


def cluster_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived hourly bars with each output folder's rows together
    (rebalanced: a hot folder is split over several tasks)."""
    return writers.cluster_output(change_hourly(spark, sf_dir))


def sink_charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: chart points, one folder per chart, read back."""
    path = scratch_path(spark, "charts")
    jobs.chart_job(fx.chart_documents(spark, sf_dir), path)
    return spark.read.parquet(path).select("chart", "x", "y")


def sink_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: chart documents written as JSON files (folder = chart, name =
    block), read back and flattened."""
    docs = fx.chart_documents(spark, sf_dir)
    named = docs.select(
        F.col("chart").alias("folder"),
        F.format_string("block-%d", "block").alias("name"),
        "body",
    )
    path = scratch_path(spark, "json")
    writers.sink_json(named, path)
    back = resp.read_documents(spark, path).withColumnRenamed("folder", "chart")
    return resp.flatten_charts(back)


def sink_json_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 packed: chart documents in packs, read back by name and flattened."""
    docs = fx.chart_documents(spark, sf_dir)
    named = docs.select(F.col("chart").alias("folder"), F.format_string("block-%d", "block").alias("name"), "body")
    path = scratch_path(spark, "packed")
    writers.sink_json_packed(named, path, pack_bytes=PACKED_BYTES)
    wanted = named.filter("folder <> 'n-view'").select("folder", "name")
    return resp.flatten_charts(resp.read_packed(spark, path, wanted).withColumnRenamed("folder", "chart"))


# ------------------------------------------------------------ symbols and pairs

def symbol_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 on part symbols."""
    s = fx.part_symbols(spark, sf_dir)
    return s.select("p_partkey", "fsym", fs.symbol_bucket("fsym").alias("fsym_char1"))


def distinct_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1."""
    return pairs.distinct_buckets(pairs.with_bucket(fx.part_symbols(spark, sf_dir)))


def _symbol_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    symbols = fx.part_symbols(spark, sf_dir).select("fsym").distinct()
    return pairs.with_bucket(pairs.pair_product(symbols, fx.QUOTES))


def bucket_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: pairs and symbols per bucket."""
    return pairs.bucket_pairs(_symbol_pairs(spark, sf_dir))


def work_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: the pairs of each bucket in numbered units."""
    return pairs.work_units(_symbol_pairs(spark, sf_dir), UNIT_PAIRS)


def pair_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands x quote symbols."""
    brands = fx.table(spark, sf_dir, "part").select(F.col("p_brand").alias("fsym")).distinct()
    return pairs.pair_product(brands, fx.QUOTES)


def request_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three URL forms for every brand pair."""
    p = pair_product(spark, sf_dir)
    common = dict(base_url=MANIFEST_BASE, app_name=MANIFEST_APP, exchange=MANIFEST_EXCHANGE)
    frames = [
        pairs.request_manifest(p, "day", **common).withColumn("kind", F.lit("day_all")),
        pairs.request_manifest(p, "hour", as_of=fx.FIXTURE_AS_OF, **common).withColumn("kind", F.lit("hour_all")),
        pairs.request_manifest(p, "minute", all_data=False, limit=1440, **common).withColumn("kind", F.lit("minute_limit")),
    ]
    return landing.concat_pairs(frames)


def chart_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5 for charts: the request URL of every landed chart document's chart."""
    docs = fx.chart_documents(spark, sf_dir).select("chart", "url").distinct()
    return pairs.chart_requests(docs).select("chart", "request_url")


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the landed pages of an interrupted back-fill meet; gaps and overlaps."""
    return frontier.page_links(frontier.page_headers(fx.chained_pages(spark, sf_dir)), MINUTE.bar_seconds)


def next_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5, resumed: the next request of every pair, from the landed pages; pairs of
    brands have no page yet."""
    headers = frontier.page_headers(fx.chained_pages(spark, sf_dir))
    wanted = pair_product(spark, sf_dir).unionByName(fx.pair_events(spark, sf_dir).select("fsym", "tsym"))
    return frontier.next_requests(headers, "minute", as_of=fx.FIXTURE_AS_OF, pairs=wanted,
                                  base_url=MANIFEST_BASE, app_name=MANIFEST_APP, exchange=MANIFEST_EXCHANGE)


def chart_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3 on the chart URLs."""
    docs = fx.chart_documents(spark, sf_dir)
    return docs.select("chart", fs.chart_name("url").alias("name"))


def _chart_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = fx.table(spark, sf_dir, "events")
    key = F.concat(F.lit("N_"), F.upper("event_type"))
    url = F.concat(
        F.lit(CHART_URL_BASE + "n-"),
        F.col("event_type"),
        F.when(F.col("value") > 400, F.lit("-v2")).otherwise(F.lit("")),
    )
    return ev.select("event_id", key.alias("key"), url.alias("url"))


def kebab_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4."""
    k = _chart_keys(spark, sf_dir)
    return k.select("event_id", "key", fs.kebab_key("key").alias("kebab"))


# ------------------------------------------------------------ date and time

def _dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.order_instants(spark, sf_dir).select("o_orderkey", "order_date")


def quarter_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D4."""
    return _dates(spark, sf_dir).withColumn("quarter_start", ft.quarter_start("order_date"))


def day_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D5."""
    return _dates(spark, sf_dir).withColumn("day_name", ft.day_name("order_date"))


def month_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6."""
    return _dates(spark, sf_dir).withColumn("month_name", ft.month_name("order_date"))


def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D10."""
    return _dates(spark, sf_dir).withColumns(ft.date_parts("order_date"))


def is_holiday_usa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates against the generated federal calendar."""
    return holidays.is_holiday_usa(_dates(spark, sf_dir), "order_date")


def run_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2."""
    o = fx.order_instants(spark, sf_dir)
    return o.select("o_orderkey", ft.run_id("instant").alias("run_id"))


def unix_to_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 on unix-second texts (whole, with '.0', garbage)."""
    o = fx.order_instants(spark, sf_dir)
    return o.select("o_orderkey", "text_unix", ft.unix_to_ts("text_unix").alias("ts"))


def parse_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 on texts in three layouts (and garbage)."""
    o = fx.order_instants(spark, sf_dir)
    return o.select("o_orderkey", "text_ts", ft.parse_timestamp("text_ts").alias("ts"))


def parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3."""
    o = fx.order_instants(spark, sf_dir)
    return o.select("o_orderkey", "text_ts", ft.parse_date("text_ts").alias("d"))


def _event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = fx.table(spark, sf_dir, "events")
    return ev.select("event_id", F.col("ts").cast("timestamp").alias("ts"))


def hour_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D7."""
    return _event_times(spark, sf_dir).select("event_id", ft.hour_of("ts").alias("hour"))


def minute_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D8."""
    return _event_times(spark, sf_dir).select("event_id", ft.minute_of("ts").alias("minute"))


def date_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D9."""
    return _event_times(spark, sf_dir).select("event_id", ft.date_of("ts").alias("date"))


# ------------------------------------------------------------ quality checks

def check_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 (data part): blank and NULL symbols."""
    return quality.bad_symbols(fx.part_symbols(spark, sf_dir, seed_bad=True)).select("p_partkey", "fsym")


def check_one_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2: brands (as slices) whose symbols span several buckets."""
    return quality.check_one_bucket(fx.part_symbols(spark, sf_dir), ["p_brand"])


def check_chart_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: keys whose kebab form differs from the URL's chart name."""
    bad = quality.check_chart_keys(_chart_keys(spark, sf_dir))
    return bad.select("event_id", "key_name", "url_name")


def check_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4: non-200 pages."""
    return quality.check_status(fx.bar_pages(spark, sf_dir)).select("fsym", "tsym", "page_no", "status")


def queries() -> dict[str, Query]:
    return {
        # derive: windows, arithmetic, projections
        "change_daily": change_daily,
        "change_hourly": change_hourly,
        "change_minute": change_minute,
        "all_time_high": all_time_high,
        "change_copies": change_copies,
        "change": change,
        "pct_change": pct_change,
        "pct_from_ath": pct_from_ath,
        "project_bars": project_bars,
        "typed_bars": typed_bars_q,
        "replace_column": replace_column_q,
        "rename_volumes": rename_volumes_q,
        "null_if_zero": null_if_zero,
        # landing
        "cutoff_filter": cutoff_filter,
        "last_utc_close": last_utc_close,
        "recent_bars": recent_bars,
        "sort_landing": sort_landing,
        "stamp_columns": stamp_columns,
        "all_to_string": all_to_string,
        "concat_pairs": concat_pairs,
        "backfill_cut": backfill_cut,
        "concat_pages": concat_pages,
        "page_all_zero": page_all_zero,
        # sources
        "flatten_bars": flatten_bars,
        "json_parse": json_parse,
        "flatten_coins": flatten_coins,
        "map_values": map_values,
        "flatten_charts": flatten_charts,
        "flatten_bars_rest": flatten_bars_rest,
        "flatten_charts_rest": flatten_charts_rest,
        "scan_coins": scan_coins,
        "scan_bars": scan_bars,
        "scan_bars_prefix": scan_bars_prefix,
        # sinks and layouts
        "sink_landing": sink_landing,
        "sink_landing_rerun": sink_landing_rerun,
        "sink_landing_whole": sink_landing_whole,
        "sink_flat": sink_flat,
        "sink_derived": sink_derived,
        "sink_derived_counts": sink_derived_counts,
        "sort_derived": sort_derived,
        "cluster_output": cluster_output,
        "sink_charts": sink_charts,
        "sink_json": sink_json,
        "sink_json_packed": sink_json_packed,
        # symbols and pairs
        "symbol_bucket": symbol_bucket,
        "distinct_buckets": distinct_buckets,
        "bucket_pairs": bucket_pairs,
        "work_units": work_units,
        "pair_product": pair_product,
        "request_manifest": request_manifest,
        "chart_requests": chart_requests,
        "page_links": page_links,
        "next_requests": next_requests,
        "chart_name": chart_name,
        "kebab_key": kebab_key,
        # date and time
        "quarter_start": quarter_start,
        "day_name": day_name,
        "month_name": month_name,
        "date_parts": date_parts,
        "is_holiday_usa": is_holiday_usa,
        "run_id": run_id,
        "unix_to_ts": unix_to_ts,
        "parse_timestamp": parse_timestamp,
        "parse_date": parse_date,
        "hour_of": hour_of,
        "minute_of": minute_of,
        "date_of": date_of,
        # quality
        "check_request": check_request,
        "check_one_bucket": check_one_bucket,
        "check_chart_keys": check_chart_keys,
        "check_status": check_status,
    }
