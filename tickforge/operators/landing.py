"""Landing steps: from landed bar pages to typed-then-text landing rows
(W3, A2, P5-P7, U1, U2, O1, O3).

The back-fill of a pair comes as pages, newest first.  The job keeps every
page before the first failed (non-200) or volume-less page and ignores all
pages behind it, even good ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions.symbols import symbol_bucket
from tickforge.functions.temporal import date_parts, parse_timestamp, unix_to_ts
from tickforge.plans.joins import join_small
from tickforge.sources.responses import OK_STATUS, bar_data, explode_rows

PAIR = ("fsym", "tsym")
# volume-only view of a page: enough to decide A2 without materialising bars
_VOLUME_SCHEMA = "STRUCT<Data: ARRAY<STRUCT<volumefrom: DOUBLE>>>"


def page_all_zero(data: Column | str) -> Column:
    """A2: every bar of the page has ``volumefrom = 0`` (true for an empty page).

    A NULL volume does not count as zero.  NULL when the page has no data
    array at all (e.g. an error body).
    """
    data = F.col(data) if isinstance(data, str) else data
    return F.forall(data, lambda b: F.coalesce(b.getField("volumefrom") == 0, F.lit(False)))


def page_flags(pages: DataFrame, body: str = "body") -> DataFrame:
    """Page metadata plus ``all_zero`` and ``stop`` (non-200 or all zero).

    A malformed page with status 200 is no stop: it fails the job (``bar_data``).
    """
    data = bar_data(body, _VOLUME_SCHEMA)
    all_zero = page_all_zero(data)
    stop = ~F.col("status").eqNullSafe(F.lit(OK_STATUS)) | F.coalesce(all_zero, F.lit(True))
    return pages.select(*PAIR, "page_no", "status", all_zero.alias("all_zero"), stop.alias("stop"))


def backfill_cut(pages: DataFrame, body: str = "body", max_pairs: int = 2_000_000) -> DataFrame:
    """Keep the pages of each pair in front of its first stop page.

    The first stop page per pair is a small aggregate (one row per pair,
    partial aggregation before its shuffle).  It is joined back by
    ``join_small``: broadcast when its checked row count is within
    ``max_pairs``, a shuffle join otherwise.  Page bodies are never shuffled
    by pair, so a pair with a very long history does not become one task.
    """
    first_stop = (
        page_flags(pages, body)
        .filter("stop")
        .groupBy(*PAIR)
        .agg(F.min("page_no").alias("_stop_page"))
    )
    joined = join_small(pages, first_stop, on=list(PAIR), how="left", max_rows=max_pairs)
    kept = F.col("_stop_page").isNull() | (F.col("page_no") < F.col("_stop_page"))
    return joined.filter(kept).drop("_stop_page")


def concat_pages(pages: DataFrame, keep: tuple[str, ...] = PAIR) -> DataFrame:
    """The bars of all given pages as one list of rows."""
    data = F.col("Data") if "Data" in pages.columns else bar_data()
    return explode_rows(pages, data, keep).select(*keep, "_item.*")


def stamp_columns(df: DataFrame, request_ts: str | None = None) -> DataFrame:
    """P6 (+ D1, D10): bucket, bar instant, date parts, request stamp."""
    instant = unix_to_ts("time")
    cols = {"fsym_char1": symbol_bucket("fsym"), "date": instant}
    cols.update(date_parts(instant))
    if request_ts is not None:
        cols["request_timestamp"] = F.lit(request_ts)
    return df.withColumns(cols)


def cutoff_filter(df: DataFrame, cutoff: Column | int, time_col: str = "time") -> DataFrame:
    """P5: keep bars at or before the cut-off (unix seconds)."""
    cutoff = cutoff if isinstance(cutoff, Column) else F.lit(cutoff)
    return df.filter(F.col(time_col) <= cutoff)


def sort_landing(df: DataFrame, time_col: str = "time") -> DataFrame:
    """O1: order each landing task's rows by bar time (numeric, before text)."""
    return df.sortWithinPartitions(time_col)


def all_to_string(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every column (but ``keep``) to text; NULL stays NULL, never 'None'."""
    return df.select(
        *[F.col(c) if c in keep else F.col(c).cast("string").alias(c) for c in df.columns]
    )


def concat_pairs(frames: list[DataFrame]) -> DataFrame:
    """Stack frames by column name; a missing column is NULL.  Empty list -> error."""
    frames = [f for f in frames if f is not None]
    if not frames:
        raise ValueError("concat_pairs needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def recent_bars(df: DataFrame, n: int, time_col: str = "time") -> DataFrame:
    """O3: the ``n`` newest bars of each pair, with their rank (1 = newest).

    ``row_number() <= n`` lets Spark put a per-pair top-n limit on both
    sides of the shuffle, so at most ``n`` rows per pair and task move.  Bars of
    one time rank by request, newest first, then by a hash of their columns.
    """
    w = Window.partitionBy(*PAIR).orderBy(F.col(time_col).desc(), *_newest_first(df))
    return df.withColumn("recent_rank", F.row_number().over(w)).filter(F.col("recent_rank") <= n)


def _newest_first(df: DataFrame, newest_by: str = "request_timestamp") -> list[Column]:
    """Tie order of bars of one time: newest request first, then a hash of all columns."""
    newest = [parse_timestamp(newest_by).desc_nulls_last()] if newest_by in df.columns else []
    return [*newest, F.xxhash64(*df.columns)]


def dedupe_bars(
    df: DataFrame,
    keys: tuple[str, ...] = PAIR,
    time_col: str = "time",
    newest_by: str = "request_timestamp",
) -> DataFrame:
    """Keep one bar per (pair, time): the one from the newest request.

    Back-fill pages overlap at their borders, so a bar can land twice.  Off
    by default everywhere (nothing is dropped silently).  Times are compared
    as instants (``unix_to_ts``: ``'60'`` and ``'60.0'`` are one time); bars
    whose time is unreadable are all kept.  ``row_number() = 1`` lets Spark
    keep only the newest row per key inside each task before the shuffle; the
    key includes the bar time, so no group is large.
    """
    timed = df.withColumn("_instant", unix_to_ts(time_col))
    w = Window.partitionBy(*keys, "_instant").orderBy(*_newest_first(df, newest_by))
    once = timed.filter(F.col("_instant").isNotNull()).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
    return once.drop("_rn").unionByName(timed.filter(F.col("_instant").isNull())).drop("_instant")
