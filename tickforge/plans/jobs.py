"""Whole jobs: land bar history, derive bars, land charts and coin lists.

The actions of a job are its writes, the checkpointed summaries and size checks of its
operators, and the one-row manifest that commits a landing run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.functions.symbols import chart_name
from tickforge.functions.temporal import last_utc_close
from tickforge.operators.derive import Grain, derive_bars, grain_of
from tickforge.operators.landing import (
    all_to_string,
    backfill_cut,
    cutoff_filter,
    stamp_columns,
)
from tickforge.operators.pairs import PAGE_LIMIT, pair_product, request_manifest
from tickforge.operators.quality import Watch, bad_symbol, bar_rules, check_request, guard
from tickforge.sinks.writers import LAYOUTS, sink_charts, sink_derived, sink_flat, sink_landing
from tickforge.sources.landed import (
    LANDED_TEXT_COLUMNS,
    LANDING_PARTITIONS,
    commit_run,
    new_attempt,
    scan_bars,
    scan_bars_prefix,
)
from tickforge.sources.responses import OK_STATUS, flatten_bars, flatten_charts, flatten_coins


def landing_rows(pages: DataFrame, as_of: str, request_ts: str, paged: bool = True) -> DataFrame:
    """Entry 2 up to the write: pages -> W3 -> S5 -> P6/D1/D10 -> P5 -> O1 -> P7.

    Only a paged back-fill stops at its first all-zero or failed page; single
    responses (``paged=False``: day bars, or a request with a limit) all land,
    bars without volume included.

    Data columns become text; the partition columns stay typed (they become
    folder names).  Rows are clustered by partition folder and sorted by
    numeric ``time`` inside each file before they become text.
    """
    kept = backfill_cut(pages) if paged else pages
    bars = flatten_bars(kept, keep=("fsym", "tsym"))
    stamped = stamp_columns(bars, request_ts)
    cut = cutoff_filter(stamped, last_utc_close(F.lit(as_of)))
    # rows of one partition folder together (hot folders split by AQE), then
    # O1: numeric time order inside each file
    clustered = cut.hint("rebalance", *LANDING_PARTITIONS)
    ordered = clustered.sortWithinPartitions(*LANDING_PARTITIONS, "time")
    return all_to_string(
        ordered.select(*LANDED_TEXT_COLUMNS, *LANDING_PARTITIONS), keep=LANDING_PARTITIONS
    )


def landing_job(
    pages: DataFrame,
    root: str,
    run_id: str,
    as_of: str,
    request_ts: str,
    grain: Grain | str = "minute",
    all_data: bool = True,
) -> str:
    """Land one run under ``<root>/run=<run_id>``; returns the folder to read.

    Hour and minute history (``all_data``) comes in pages and is cut; day bars
    and limited requests are single responses and land whole.

    Every call writes an attempt folder of its own and commits it to the run's
    manifest last, so landing a run again replaces it and doubles no row
    (``sources.landed.committed_run`` finds the newest attempt).  Symbols are checked
    while the rows are written (Q1, Q2); a run with a bad one is not committed.
    """
    paged = all_data and not grain_of(grain).date_is_timestamp
    watch = Watch(landing_rows(pages, as_of, request_ts, paged), bar_rules())
    attempt = new_attempt(root, run_id)
    sink_landing(watch.df, attempt, mode="errorifexists", cluster=False)
    commit_run(pages.sparkSession, root, run_id, attempt, watch.require())
    return attempt


def request_job(
    spark: SparkSession,
    path: str,
    fsyms: list[str],
    tsyms: list[str],
    grain: str,
    *,
    base_url: str,
    app_name: str,
    exchange: str,
    as_of: str,
    limit: int = PAGE_LIMIT,
    all_data: bool = True,
) -> None:
    """The first request of every pair as one flat Parquet dataset at ``path``.

    The arguments are checked before anything runs (Q1), the symbols while the
    manifest is written.
    """
    check_request(grain, fsyms, tsyms, limit, all_data, exchange, app_name)
    symbols = spark.createDataFrame([(s,) for s in fsyms], "fsym string")
    pairs = guard(pair_product(symbols, tsyms), {"blank symbol": bad_symbol("fsym") | bad_symbol("tsym")})
    manifest = request_manifest(pairs, grain, base_url=base_url, app_name=app_name, exchange=exchange,
                                all_data=all_data, limit=limit, as_of=as_of)
    manifest.write.mode("errorifexists").parquet(path)


def derive_job(
    spark: SparkSession,
    run: str,
    out_path: str,
    grain: Grain | str,
    layout: str = "range",
    prefix: str | None = None,
    split_copies_over: int | None = 1_000_000,
) -> None:
    """Entry 1: landed run -> derived bars of ``grain`` -> partitioned Parquet.

    ``layout``: ``range`` (default: one big shuffle into contiguous key ranges, skew-proof
    windows, one or two output folders per task; the ranges come from the counts of the
    chunk summary, for small inputs from a sample), ``counts`` (always from the counts), ``chunk`` (one big hash
    shuffle, skew-proof, but a file per folder and task), ``pair`` (window shuffle +
    folder-clustered rebalance), ``bucket`` (one shuffle by
    (``fsym_char1``, ``tsym``) that the windows reuse; a hot bucket is one
    task).

    ``split_copies_over``: a window chunk with more rows than this (only
    copies of one (pair, time) make one that large) is spread over several
    tasks (``operators.derive.pair_windows``); ``None`` turns the check off.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    g = grain_of(grain)
    landed = scan_bars_prefix(spark, run, prefix) if prefix else scan_bars(spark, run)
    landed = guard(landed, bar_rules())  # Q1, Q2
    if layout == "bucket":
        landed = landed.repartition("fsym_char1", "tsym")
    bars = derive_bars(
        landed,
        g,
        chunked=(layout != "bucket"),
        partitioning={"range": "auto", "counts": "counts"}.get(layout, "hash"),
        split_copies_over=split_copies_over if layout != "bucket" else None,
    )
    sink_derived(bars, out_path, layout=layout)


def chart_job(docs: DataFrame, path: str) -> None:
    """Entry 3: chart documents -> rows -> one folder per chart.

    Where the documents carry their URL, its chart name must be the document's (Q3);
    a mismatch fails the job before anything is committed.
    """
    if "url" in docs.columns:
        docs = guard(docs, {"chart and URL differ": ~F.col("chart").eqNullSafe(chart_name("url"))})
    sink_charts(flatten_charts(docs), path)


def coin_list_job(docs: DataFrame, folder: str, name: str, request_ts: str) -> str:
    """Coin list: documents -> rows (all text) + request stamp -> flat dataset.

    A failed coin-list response fails the job (Q4) before anything is committed; bar
    pages, in contrast, are skipped.
    """
    ok = F.col("status").eqNullSafe(F.lit(OK_STATUS))
    watch = Watch(docs, {"coin-list response is not HTTP 200": ~ok})
    coins = flatten_coins(watch.df.filter(ok))  # writes the parsed coins, which the watch sees
    watch.require()
    return sink_flat(coins.withColumn("request_timestamp", F.lit(request_ts)), folder, name)
