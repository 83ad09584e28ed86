"""The page chain of a back-fill (X5, W3): what has come, what to ask for next.

A paged back-fill asks for the newest page first; every later request ends where the
page before began (``TimeFrom``).  Pages are landed as rows (``fsym``, ``tsym``,
``page_no``, ``status``, ``body``), so where a chain stands, whether its pages meet, and
the next request of every pair follow from the landed pages alone: a job that was
interrupted resumes from them.

Page bodies are parsed once into headers of a few numbers; only headers are moved,
and always by (pair, page): a pair with a very long history is no large group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.functions.temporal import last_utc_close
from tickforge.operators.landing import PAIR, page_all_zero
from tickforge.operators.pairs import request_manifest
from tickforge.plans.scans import written
from tickforge.sources.responses import OK_STATUS, bar_data, json_parse

# what a header needs of a page body
_HEADER_SCHEMA = "STRUCT<Data: ARRAY<STRUCT<time: BIGINT, volumefrom: DOUBLE>>, TimeFrom: BIGINT>"


def page_headers(pages: DataFrame, body: str = "body") -> DataFrame:
    """One row per page: ``fsym, tsym, page_no, status, n_bars, time_from, first_time,
    last_time, all_zero, stop``; written once.

    ``time_from`` is the page's ``TimeFrom``, or where that is missing the time of its
    first bar.  Pages landed more than once (a repeated request) count once: a good
    one goes before a failed one, then the one with more bars.  A malformed page with
    status 200 fails the job.
    """
    parsed = json_parse(body, _HEADER_SCHEMA, strict=False)
    data = bar_data(body, _HEADER_SCHEMA)
    ok = F.col("status").eqNullSafe(F.lit(OK_STATUS))
    times = F.col("_data.time")
    head = pages.select(*PAIR, "page_no", "status", ok.alias("_ok"), data.alias("_data"), parsed.getField("TimeFrom").alias("_from"))
    head = head.select(
        *PAIR, "page_no", "status", "_ok", F.when(F.col("_ok"), F.size("_data")).alias("n_bars"),
        F.when(F.col("_ok"), F.coalesce("_from", F.array_min(times))).alias("time_from"),
        F.when(F.col("_ok"), F.array_min(times)).alias("first_time"), F.when(F.col("_ok"), F.array_max(times)).alias("last_time"),
        F.when(F.col("_ok"), page_all_zero("_data")).alias("all_zero"))
    best = F.max(F.struct("_ok", "n_bars", "time_from", "first_time", "last_time", "all_zero", "status")).alias("h")
    one = head.groupBy(*PAIR, "page_no").agg(best)
    stop = ~F.col("h._ok") | F.coalesce("h.all_zero", F.lit(True))
    columns = [f"h.{c}" for c in ("status", "n_bars", "time_from", "first_time", "last_time", "all_zero")]
    return written(one.select(*PAIR, "page_no", *columns, stop.alias("stop")), "page-headers")


def _same(left: str, right: str) -> Column:
    """Same pair on both sides, NULL symbols too."""
    return F.col(f"{left}.fsym").eqNullSafe(F.col(f"{right}.fsym")) & F.col(f"{left}.tsym").eqNullSafe(F.col(f"{right}.tsym"))


def page_links(headers: DataFrame, bar_seconds: int) -> DataFrame:
    """One row per page: ``fsym, tsym, page_no, link, expected_to, last_time, shared_bars,
    missing_bars`` - how the page meets the one asked for before it.

    ``expected_to`` is that page's ``time_from``.  The page ``joined`` it if its last bar is
    that bar or the one before; ``overlap``: it reaches further (``shared_bars`` counts
    from ``time_from`` on, also for the one bar of a plain join); ``gap``: it ends earlier
    (``missing_bars`` lie between).  ``first`` has page number 0, ``missing_page``: the page
    before was never landed, ``failed``: the page itself or the one before is no good
    response, ``empty``: one of the two has no bars.
    """
    h, b = headers.alias("h"), headers.alias("b")
    step = (F.col("h.page_no") == F.col("b.page_no") + 1) & _same("h", "b")
    ahead = F.col("h.last_time") - F.col("b.time_from")
    link = (F.when(F.col("h.n_bars").isNull(), "failed").when(F.col("h.page_no") == 0, "first").when(F.col("b.page_no").isNull(), "missing_page")
            .when(F.col("b.n_bars").isNull(), "failed").when(ahead.isNull(), "empty")
            .when(ahead > 0, "overlap").when(ahead < -bar_seconds, "gap").otherwise("joined"))
    rows = h.join(b, step, "left").select(
        *[F.col(f"h.{c}").alias(c) for c in (*PAIR, "page_no")], link.alias("link"),
        F.col("b.time_from").alias("expected_to"), F.col("h.last_time").alias("last_time"), ahead.alias("_ahead"))
    met = F.col("link").isin("joined", "overlap", "gap")
    bars = F.expr(f"_ahead div {int(bar_seconds)}")
    return rows.select(*PAIR, "page_no", "link", "expected_to", "last_time",
                       F.when(met, F.greatest(bars + F.when(F.col("_ahead") >= 0, 1).otherwise(0), F.lit(0))).cast("bigint").alias("shared_bars"),
                       F.when(met, F.greatest(-bars - 1, F.lit(0))).cast("bigint").alias("missing_bars"))


def frontier(headers: DataFrame) -> DataFrame:
    """One row per pair: ``fsym, tsym, state, next_page, to_ts`` - where its chain stands.

    The chain of a pair is its pages 0, 1, ... in front of the first stop page and of
    the first page that is missing; ``next_page`` follows it and is asked for up to
    ``to_ts``, the ``time_from`` of the chain's last page (null if the chain is empty: from
    the last close).  ``done``: the chain ended at a page without volume; ``failed``: at a
    failed request, which is to be repeated; ``open``: at a page not landed yet.
    """
    h, n = headers.alias("h"), headers.alias("n")
    step = (F.col("n.page_no") == F.col("h.page_no") + 1) & _same("h", "n")
    pages = h.join(n, step, "left").select(
        *[F.col(f"h.{c}").alias(c) for c in (*PAIR, "page_no", "stop", "all_zero")], F.col("n.page_no").isNull().alias("_ends"))
    pairs = pages.groupBy(*PAIR).agg(
        F.min("page_no").alias("_least"), F.min(F.when(F.col("_ends"), F.col("page_no"))).alias("_end"),
        F.min(F.when(F.col("stop"), F.struct("page_no", "all_zero"))).alias("_stop"))
    missing = F.when(F.col("_least") > 0, F.lit(0)).otherwise(F.col("_end") + 1)
    pairs = pairs.withColumn("next_page", F.least(missing, F.coalesce("_stop.page_no", missing)).cast("int"))
    state = F.when(~F.col("_stop.page_no").eqNullSafe(F.col("next_page")), "open").when(F.col("_stop.all_zero"), "done").otherwise("failed")
    pairs = pairs.select(*PAIR, state.alias("state"), "next_page").alias("p")
    last = (F.col("p.next_page") == F.col("l.page_no") + 1) & _same("p", "l")
    return pairs.join(headers.alias("l"), last, "left").select("p.*", F.col("l.time_from").alias("to_ts"))


def next_requests(
    headers: DataFrame,
    grain: str,
    *,
    base_url: str,
    app_name: str,
    exchange: str,
    as_of: Column | str,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """X5, resumed: the next request of every pair that is not done: ``fsym, tsym, state,
    next_page, to_ts, url``.

    ``to_ts`` is where the pair's chain stands, or the last UTC close before ``as_of`` for
    a chain without a page.  ``pairs`` (``fsym, tsym``) adds those of which nothing has
    been landed yet (``new``, page 0); with no landed page at all it is the plain first manifest.
    """
    at = frontier(headers).filter("state <> 'done'")
    if pairs is not None:
        p, k = pairs.select(*PAIR).distinct().alias("p"), headers.select(*PAIR).distinct().alias("k")
        at = at.unionByName(p.join(k, _same("p", "k"), "left_anti").select(
            *PAIR, F.lit("new").alias("state"), F.lit(0).alias("next_page"), F.lit(None).cast("bigint").alias("to_ts")))
    start = last_utc_close(F.lit(as_of) if isinstance(as_of, str) else as_of)
    at = at.withColumn("to_ts", F.coalesce("to_ts", start))
    return request_manifest(at, grain, base_url=base_url, app_name=app_name, exchange=exchange, to_ts="to_ts",
                            keep=("state", "next_page", "to_ts"))
