"""Adapters from the driver's testdata tables to the engine's input shapes.

These are fixtures, not operators: they only build landed-looking inputs
(text bars, API response pages, coin and chart documents) from the given
tables, so that every registered query reads those tables and grows with
them.  Each adapter has a twin in ``tickforge.oracles`` written in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.functions.symbols import symbol_bucket
from tickforge.functions.temporal import date_parts
from tickforge.session import ensure_utc

# Fixed values used by the fixtures (mirrored in tickforge.oracles).
QUOTES = ("USD", "BTC", "ETH")
FIXTURE_AS_OF = "2024-01-20 15:00:00"
FIXTURE_REQUEST_TS = "2024-02-01 06:30:00.250000"
ZERO_VOLUME_PAGE = 9
FAILED_PAGE = 6
FAILED_PAGE_FSYM = "CLICK"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pair_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (fsym, tsym, ts, value, event_id); 15 pairs."""
    ev = table(spark, sf_dir, "events")
    quote = F.col("user_id") % 3
    return ev.select(
        F.upper("event_type").alias("fsym"),
        F.when(quote == 0, QUOTES[0]).when(quote == 1, QUOTES[1]).otherwise(QUOTES[2]).alias("tsym"),
        F.col("ts").cast("timestamp").alias("ts"),
        "value",
        "event_id",
    )


def bars(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    """Numeric OHLCV bars of ``grain`` (day / hour / minute) per pair.

    Highs and closes are floored so that zero prices occur (they drive the
    NULLIF and divide-by-zero paths).
    """
    pe = pair_events(spark, sf_dir)
    order = F.col("ts")  # no two events of a pair share a ts in the testdata
    return (
        pe.groupBy("fsym", "tsym", F.date_trunc(grain, "ts").alias("bar_ts"))
        .agg(
            F.min_by("value", order).alias("open"),
            F.floor(F.max("value")).cast("double").alias("high"),
            F.min("value").alias("low"),
            F.floor(F.max_by("value", order)).cast("double").alias("close"),
            F.count("*").cast("double").alias("volumefrom"),
            F.round(F.sum("value"), 4).alias("volumeto"),
        )
        .withColumn("time", F.unix_seconds("bar_ts"))
    )


def landed_bars(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    """Bars as stage 1 lands them: every value text, partition columns added.

    Missing values are landed as text the way the landing step used to: a
    low under 1 as ``'nan'``, the quote volume of one-trade bars as
    ``'None'``.
    """
    b = bars(spark, sf_dir, grain)
    text = {c: F.col(c).cast("string") for c in ("time", "open", "high", "low", "close", "volumefrom", "volumeto")}
    text["low"] = F.when(F.col("low") < 1, F.lit("nan")).otherwise(text["low"])
    text["volumeto"] = F.when(F.col("volumefrom") == 1, F.lit("None")).otherwise(text["volumeto"])
    parts = date_parts("bar_ts")
    return b.select(
        *[v.alias(k) for k, v in text.items()],
        "fsym",
        "tsym",
        symbol_bucket("fsym").alias("fsym_char1"),
        F.date_format("bar_ts", "yyyy-MM-dd HH:mm:ss").alias("date"),
        *[v.alias(k) for k, v in parts.items()],
        F.lit(FIXTURE_REQUEST_TS).alias("request_timestamp"),
    )


def requested_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a landed day bar of its own: all events of a pair and day are
    copies of one bar time, each landed by a request at its own instant."""
    pe = pair_events(spark, sf_dir)
    price = F.floor("value").cast("string")
    return pe.select(
        F.unix_seconds(F.date_trunc("day", "ts")).cast("string").alias("time"),
        *[price.alias(c) for c in ("open", "high", "low", "close")],
        F.lit("1").alias("volumefrom"), F.lit("1").alias("volumeto"), "fsym", "tsym",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("request_timestamp"),
    )


def bar_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed API responses for minute bars: one page per pair and UTC day.

    ``page_no`` counts back from the newest day of the data (0 = newest), as
    a paged back-fill would fetch them.  A page holds at most 1,440 bars.
    Page 9 has zero volume everywhere; page 6 of CLICK failed with HTTP 500.
    Columns: fsym, tsym, page_no, status, body (JSON text).
    """
    b = bars(spark, sf_dir, "minute").withColumn("day", F.to_date("bar_ts"))
    newest = b.agg(F.max("day")).scalar()  # scalar subquery: one value, no join
    paged = b.withColumn("page_no", F.datediff(newest, F.col("day")))
    volume = F.when(F.col("page_no") == ZERO_VOLUME_PAGE, F.lit(0.0)).otherwise(F.col("volumefrom"))
    bar = F.struct(
        "time", "open", "high", "low", "close", volume.alias("volumefrom"), "volumeto"
    )
    pages = paged.groupBy("fsym", "tsym", "page_no").agg(
        F.sort_array(F.collect_list(bar)).alias("Data"), F.min("time").alias("TimeFrom")
    )
    failed = (F.col("fsym") == FAILED_PAGE_FSYM) & (F.col("page_no") == FAILED_PAGE)
    return pages.select(
        "fsym",
        "tsym",
        "page_no",
        F.when(failed, F.lit(500)).otherwise(F.lit(200)).alias("status"),
        F.when(failed, F.lit('{"Response":"Error"}'))
        .otherwise(F.to_json(F.struct("Data", "TimeFrom")))
        .alias("body"),
    )


def chained_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bar_pages`` as an interrupted back-fill left them: ``TimeFrom`` of every fourth page
    lies 25 hours early (the next page overlaps it), of VIEW page 4 is not landed,
    of SIGNUP nothing from page 3 on, and every page of PURCHASE was landed twice."""
    pages = bar_pages(spark, sf_dir)
    early = F.expr("""regexp_replace(body, '"TimeFrom":[0-9]+', concat('"TimeFrom":',
        cast(cast(regexp_extract(body, '"TimeFrom":([0-9]+)', 1) as bigint) - 90000 as string)))""")
    pages = pages.withColumn("body", F.when((F.col("page_no") % 4 == 1) & (F.col("status") == 200), early).otherwise(F.col("body")))
    pages = pages.filter(~((F.col("fsym") == "VIEW") & (F.col("page_no") == 4)) & ~((F.col("fsym") == "SIGNUP") & (F.col("page_no") >= 3)))
    return pages.unionByName(pages.filter(F.col("fsym") == "PURCHASE"))


def extended_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bar_pages`` whose even pages carry two fields more in every bar, one of them nested."""
    more = F.concat(F.lit('"conversionType":"direct","extra":{"page":'), F.col("page_no"), F.lit('},"volumeto":'))
    body = F.regexp_replace(F.col("body"), F.lit('"volumeto":'), more)
    return bar_pages(spark, sf_dir).withColumn("body", F.when(F.col("page_no") % 2 == 0, body).otherwise(F.col("body")))


def extended_charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``chart_documents`` whose odd blocks carry a unit in every point."""
    body = F.regexp_replace("body", '"y":', '"unit":"USD","y":')
    return chart_documents(spark, sf_dir).withColumn("body", F.when(F.col("block") % 2 == 1, body).otherwise(F.col("body")))


def coin_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coin-list responses built from ``customer``: one keyed object per
    nation and block of 256 customer keys (bounded documents).

    Every coin has ``Id``, ``Symbol``, ``CoinName`` and ``SortOrder``; only
    customers with a positive balance carry ``Balance`` (schema drift).
    Columns: doc_id, status, body.
    """
    c = table(spark, sf_dir, "customer")
    fields = F.map_concat(
        F.create_map(
            F.lit("Id"), F.col("c_custkey").cast("string"),
            F.lit("Symbol"), F.col("c_name"),
            F.lit("CoinName"), F.col("c_mktsegment"),
            F.lit("SortOrder"), F.col("c_nationkey").cast("string"),
        ),
        F.when(
            F.col("c_acctbal") > 0,
            F.create_map(F.lit("Balance"), F.col("c_acctbal").cast("string")),
        ).otherwise(F.create_map().cast("map<string,string>")),
    )
    block = F.floor(F.col("c_custkey") / 256)
    docs = c.groupBy(F.col("c_nationkey"), block.alias("block")).agg(
        F.map_from_entries(F.collect_list(F.struct("c_name", fields))).alias("Data")
    )
    return docs.select(
        F.format_string("%d-%d", "c_nationkey", "block").alias("doc_id"),
        F.lit(200).alias("status"),
        F.to_json(F.struct("Data")).alias("body"),
    )


def chart_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chart responses built from ``events``: one document per event type
    and block of 1,024 event ids (bounded), points ``x`` = unix seconds,
    ``y`` = value.

    Columns: chart, block, url, body.
    """
    ev = table(spark, sf_dir, "events")
    chart = F.concat(F.lit("n-"), F.lower("event_type"))
    point = F.struct(
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("x"),
        F.col("value").alias("y"),
    )
    block = F.floor(F.col("event_id") / 1024)
    docs = ev.groupBy(chart.alias("chart"), block.alias("block")).agg(
        F.sort_array(F.collect_list(point)).alias("values")
    )
    return docs.select(
        "chart",
        "block",
        F.concat(F.lit("https://api.example.org/charts/"), F.col("chart")).alias("url"),
        F.to_json(F.struct(F.col("values"))).alias("body"),
    )


def part_symbols(spark: SparkSession, sf_dir: str, seed_bad: bool = False) -> DataFrame:
    """Symbols from ``part``: ``upper(p_name)``, with ``p_size`` put in front
    where ``p_partkey % 7 = 0`` (digit-first symbols -> bucket ``_``).

    ``seed_bad`` blanks the symbol of size-50 parts and nulls that of
    size-49 parts, for the symbol check.  Columns: p_partkey, p_brand, fsym.
    """
    p = table(spark, sf_dir, "part")
    sym = F.when(
        F.col("p_partkey") % 7 == 0, F.concat(F.col("p_size").cast("string"), F.upper("p_name"))
    ).otherwise(F.upper("p_name"))
    if seed_bad:
        sym = F.when(F.col("p_size") == 50, F.lit("  ")).when(F.col("p_size") == 49, F.lit(None)).otherwise(sym)
    return p.select("p_partkey", "p_brand", sym.alias("fsym"))


def order_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instants from ``orders``: order date + ``o_orderkey`` seconds, plus a
    quarter-second fraction (none when ``o_orderkey % 4 = 0``).

    Columns: o_orderkey, order_date (date), instant (timestamp), text_ts,
    text_unix (texts in several layouts; every 10th key is ``garbage``).
    """
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    day_us = F.unix_micros(F.col("o_orderdate").cast("timestamp"))
    instant = F.timestamp_micros(day_us + key * 1_000_000 + (key % 4) * 250_000)
    whole = F.timestamp_seconds(F.unix_seconds(instant))
    garbage = key % 10 == 0
    text_ts = (
        F.when(garbage, F.lit("garbage"))
        .when(key % 3 == 0, F.date_format(whole, "yyyy-MM-dd HH:mm:ss"))
        .when(key % 3 == 1, F.date_format(whole, "MM/dd/yyyy HH:mm:ss"))
        .otherwise(F.date_format(whole, "yyyyMMdd"))
    )
    secs = F.unix_seconds(instant).cast("string")
    text_unix = (
        F.when(garbage, F.lit("garbage"))
        .when(key % 2 == 0, F.concat(secs, F.lit(".0")))
        .otherwise(secs)
    )
    return o.select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("order_date"),
        instant.alias("instant"),
        text_ts.alias("text_ts"),
        text_unix.alias("text_unix"),
    )
