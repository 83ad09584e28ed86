"""Derive typed bars with change and all-time-high columns.

One function, ``derive_bars(landed, grain)``, covers day, hour and minute
bars; a ``Grain`` says which calendar columns to add and whether the
all-time-high columns belong to the output.

Windows and skew
----------------
``lag(close)`` and the running ``max(nullif(high, 0))`` are defined per pair
(``fsym``, ``tsym``) in time order.  A plain window partitioned by pair puts
a whole pair into one task, and one pair may hold a large share of all rows.
So, by default, each pair's history is cut into time chunks and the window
runs per (pair, chunk):

1. a per-(pair, chunk) summary - last close and highest non-zero high - is
   aggregated from the input with map-side partial aggregation, so only
   about one row per chunk and task is shuffled for it,
2. a small window over that summary gives, per chunk, the close of the
   previous chunk and the highest high of all earlier chunks,
3. that "carry" row is unioned with the bars; the bars are shuffled once,
   by (pair, chunk), together with the carry rows, and one sort puts the
   carry row first in its chunk and feeds both window functions,
4. carry rows are dropped again.

The result equals the plain per-pair window: the first bar of a chunk sees
the carried close as its ``lag``, and the carried maximum enters every
running maximum of the chunk.  Bars with equal time always share a chunk,
so RANGE-frame peers are kept.  ``chunked=False`` gives the plain form.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions.numeric import (
    change,
    clean_double,
    null_if_zero,
    pct_change,
    pct_from_ath,
)
from tickforge.functions.symbols import symbol_bucket
from tickforge.functions.temporal import (
    date_of,
    hour_of,
    minute_of,
    parse_timestamp,
    unix_to_ts,
)
from tickforge.operators.landing import dedupe_bars
from tickforge.plans.joins import BROADCAST_BYTES, join_small
from tickforge.plans.scans import LOWEST, cut_ranges
from tickforge.session import checkpoint_root

# The numeric columns of a landed bar and the volume renames.
NUMERIC_COLUMNS = ("open", "high", "low", "close", "volumefrom", "volumeto")
VOLUME_RENAMES = {"volumefrom": "volume_fsym", "volumeto": "volume_tsym"}
PAIR_KEYS = ("fsym_char1", "tsym", "fsym")
TIE = ("_request", "_hash")  # order among bars of one time, see _with_tie


@dataclass(frozen=True)
class Grain:
    """What differs between day, hour and minute bars."""

    name: str
    bar_seconds: int
    chunk_seconds: int  # time span of one window chunk (bounds a window group)
    calendar: tuple[str, ...]  # calendar columns after ``date``
    ath: bool  # all_time_high / pct_from_ath in the output
    date_is_timestamp: bool  # daily ``date`` is the bar instant itself

    @property
    def order_column(self) -> str:
        return "date" if self.date_is_timestamp else "date_hour"


# Chunks hold at most ~1,500 bars of one pair (minute: one day, hour: 64 days);
# daily history of a pair is small, so a chunk spans 1,024 days.
DAY = Grain("day", 86_400, 86_400 * 1024, (), True, True)
HOUR = Grain("hour", 3_600, 86_400 * 64, ("hour",), False, False)
MINUTE = Grain("minute", 60, 86_400, ("hour", "minute"), False, False)
GRAINS = {g.name: g for g in (DAY, HOUR, MINUTE)}


def grain_of(grain: Grain | str) -> Grain:
    if isinstance(grain, Grain):
        return grain
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {sorted(GRAINS)}, got {grain!r}")
    return GRAINS[grain]


def output_columns(grain: Grain | str) -> list[str]:
    """The fixed output columns of a grain."""
    g = grain_of(grain)
    cols = ["date", *g.calendar, "fsym", "tsym", "open", "high", "low", "close",
            "change", "pct_change", "volume_fsym", "volume_tsym"]
    if g.ath:
        cols += ["all_time_high", "pct_from_ath"]
    return cols + ["fsym_char1"]


def typed_bars(landed: DataFrame) -> DataFrame:
    """The six numeric text columns -> double; other columns pass."""
    return landed.withColumns(
        {c: clean_double(c) for c in NUMERIC_COLUMNS if c in landed.columns}
    )


def replace_column(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add or replace columns by name."""
    return df.withColumns(columns)


def rename_volumes(df: DataFrame) -> DataFrame:
    """Volumefrom -> volume_fsym, volumeto -> volume_tsym."""
    return df.withColumnsRenamed({k: v for k, v in VOLUME_RENAMES.items() if k in df.columns})


def add_bar_time(df: DataFrame, grain: Grain | str) -> DataFrame:
    """P2 for bars: ``date`` (and ``date_hour``, ``hour``, ``minute``) from ``time``."""
    g = grain_of(grain)
    instant = unix_to_ts("time")
    if g.date_is_timestamp:
        cols = {"date": instant}
    else:
        cols = {"date_hour": instant}
    df = replace_column(df, cols)
    if not g.date_is_timestamp:
        extra = {"date": date_of("date_hour")}
        if "hour" in g.calendar:
            extra["hour"] = hour_of("date_hour")
        if "minute" in g.calendar:
            extra["minute"] = minute_of("date_hour")
        df = replace_column(df, extra)
    if "request_timestamp" in df.columns:
        df = replace_column(df, {"request_timestamp": parse_timestamp("request_timestamp")})
    return df


def project_bars(df: DataFrame, grain: Grain | str) -> DataFrame:
    """Keep the grain's output columns, in order."""
    return df.select(*output_columns(grain))


def _with_bucket(df: DataFrame) -> DataFrame:
    if "fsym_char1" in df.columns:
        return df
    return df.withColumn("fsym_char1", symbol_bucket("fsym"))


def _with_tie(df: DataFrame) -> DataFrame:
    """The order among bars of one time: their request, then a hash of their
    values.  Bars equal in these are alike in any order; no other column is read."""
    values = [c for c in (*NUMERIC_COLUMNS, *VOLUME_RENAMES.values()) if c in df.columns]
    request = F.col("request_timestamp") if "request_timestamp" in df.columns else F.lit(None).cast("timestamp")
    return df.withColumns({"_request": request, "_hash": F.xxhash64(*values)})


def _chunk_key(keys: list[str]) -> Column:
    """One number for (pair, chunk), NULLs included; marking a chunk as hot by
    a clash changes no result."""
    return F.xxhash64(*keys, "_chunk").alias("_k")


def pair_windows(
    df: DataFrame,
    order_col: str,
    *,
    with_ath: bool,
    chunk_seconds: int | None,
    partitioning: str = "hash",
    split_copies_over: int | None = None,
) -> DataFrame:
    """W1 + W2: ``close_lag1`` and (optionally) ``all_time_high`` per pair.

    ``close_lag1`` = LAG(close) OVER (PARTITION BY fsym, tsym ORDER BY t);
    ``all_time_high`` = MAX(NULLIF(high, 0)) OVER (same, default RANGE frame).
    ``fsym_char1`` is a function of ``fsym`` and is kept as the first
    partition key, so the window sort also orders rows for a writer that
    partitions by (``fsym_char1``, ``tsym``).

    ``partitioning`` (chunked form only) picks the one big shuffle:

    * ``hash`` on (pair, chunk),
    * ``counts``: contiguous key ranges of (``fsym_char1``, ``tsym``, ``fsym``,
      chunk) of about equal row count - each task holds one or two output folders
      (few files) while a long pair is still cut by chunk.  Where they begin follows
      from the rows the chunk summary has counted (see ``_places``); no row is read
      for it,
    * ``range``: such ranges by Spark's sampling, which reads the input once more.
      ``counts`` falls back to it where its table of places is too large to broadcast,
    * ``auto``: ``counts`` from ``COUNTED_ROWS`` rows on; fewer are sampled sooner than counted.

    Bars of one (pair, time) follow each other by request time, then by a hash
    of their content, in every form.

    ``split_copies_over`` (chunked form only) also splits chunks that hold
    more than that many rows, which only rows of the same (pair, time) can
    cause: see ``_split_hot_chunks``.  The rows of the result do not depend on it.
    It and ``counts`` run one job first (the chunk summary, checkpointed); with no
    such chunk the plan is the plain chunked one.
    """
    if partitioning not in ("hash", "range", "counts", "auto"):
        raise ValueError("partitioning must be 'hash', 'range', 'counts' or 'auto'")
    df = _with_tie(_with_bucket(df))
    keys = list(PAIR_KEYS)
    if chunk_seconds is None:
        w = Window.partitionBy(*keys).orderBy(order_col, *TIE)
        out = df.withColumn("close_lag1", F.lag("close").over(w))
        if with_ath:
            w = Window.partitionBy(*keys).orderBy(order_col)  # RANGE: bars of one time are peers
            out = out.withColumn("all_time_high", F.max(null_if_zero("high")).over(w))
        return out.drop(*TIE)

    chunk = F.floor(F.unix_seconds(F.col(order_col)) / F.lit(chunk_seconds))
    base = df.withColumn("_chunk", chunk)

    # 1. one summary row per (pair, chunk), partially aggregated before its
    #    own small shuffle; the last close follows the window's whole order
    #    (time, request, content), and a NULL time still ranks (lowest)
    counted = split_copies_over is not None or partitioning in ("counts", "auto")
    aggs = [F.max_by("close", F.struct(_order_key(order_col), *TIE)).alias("_last_close")]
    if with_ath:
        aggs.append(F.max(null_if_zero("high")).alias("_chunk_ath"))
    if counted:
        aggs.append(F.count(F.lit(1)).alias("_n"))
    summary = base.groupBy(*keys, "_chunk").agg(*aggs)
    hot, hot_rows, places = None, 0, None
    if counted:
        checkpoint_root(df.sparkSession)  # the shared folder (fails on a cluster without one)
        summary = summary.checkpoint(eager=True)
        is_hot = F.col("_n") > split_copies_over if split_copies_over is not None else F.lit(False)
        total, hot_rows, pairs, chunks = summary.agg(
            F.sum("_n"), F.sum(F.when(is_hot, F.col("_n"))), F.approx_count_distinct(F.struct(*keys)), F.count(F.lit(1))).first()
        if hot_rows:
            hot = summary.filter(is_hot).select(_chunk_key(keys)).distinct()
        if partitioning == "auto":
            partitioning = "counts" if (total or 0) >= COUNTED_ROWS else "range"
        if partitioning == "counts":
            places = _places(summary.withColumn("_n", F.when(is_hot, 0).otherwise(F.col("_n"))), keys,
                             (total or 0) - (hot_rows or 0), pairs, chunks)
        summary = summary.drop("_n")

    # 2. what each chunk inherits from the chunks before it (small window)
    w_prev = Window.partitionBy(*keys).orderBy("_chunk")
    carried = [F.lag("_last_close").over(w_prev).alias("close")]
    if with_ath:
        carried.append(
            F.max("_chunk_ath")
            .over(w_prev.rowsBetween(Window.unboundedPreceding, -1))
            .alias("high")
        )
    carry = summary.select(*keys, "_chunk", *carried)

    # 3. carry row first in every chunk, then the chunk's bars in time order;
    #    the one full shuffle is the window's own exchange above the union
    #    (hash on pair and chunk) or an explicit partitioning by key ranges
    if hot is None:
        stream = base.withColumns({"_lead": F.lit(1), "_tail": F.lit(0)}).unionByName(
            carry.withColumns({"_lead": F.lit(0), "_tail": F.lit(0)}), allowMissingColumns=True)
        group, ranges = [*keys, "_chunk"], 0
    else:
        ranges = _range_count(int(hot_rows), split_copies_over, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        stream = _split_hot_chunks(base, carry, hot, keys, order_col, with_ath, ranges)
        group = [*keys, "_chunk", "_range"]
    if partitioning == "range" or (partitioning == "counts" and places is None):
        stream = stream.repartitionByRange(*group)
    elif partitioning == "counts":
        stream = places.assign(stream, keys, ranges)
        group = [*group, "_place"]
    # a range that ends inside a time has a tail row with the highest high of that time
    parts = Window.partitionBy(*group)
    out = stream.withColumn("close_lag1", F.lag("close").over(parts.orderBy("_lead", order_col, "_tail", *TIE)))
    if with_ath:
        out = out.withColumn("all_time_high", F.max(null_if_zero("high")).over(parts.orderBy("_lead", order_col)))

    # 4. drop the carry and tail rows, put the copies back one by one: the second and
    #    later ones follow a bar that is like them, so their lag is their own close
    out = out.filter((F.col("_lead") == 1) & (F.col("_tail") == 0))
    if hot is not None:
        out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
        out = out.withColumn("close_lag1", F.when(F.col("_copy") == 1, F.col("close_lag1")).otherwise(F.col("close")))
    return out.drop("_lead", "_tail", "_copy", "_copies", "_range", "_place", "_chunk", *TIE)


# Rows of a range beyond which there are more ranges than keep every task busy.
RANGE_ROWS = 1_000_000


def _range_count(rows: int, limit: int, partitions: int) -> int:
    """Ranges of the ``rows`` in chunks of more than ``limit``: of at most ``limit`` rows,
    larger where there would be more than two ranges a shuffle partition, as each costs
    the driver a task's result and a sample, but of ``RANGE_ROWS`` at most."""
    return max(min(-(-rows // limit), 2 * partitions), -(-rows // max(limit, RANGE_ROWS)))


def _order_key(order_col: str) -> Column:
    return F.coalesce(F.unix_micros(F.col(order_col)), F.lit(LOWEST))


def _split_hot_chunks(
    base: DataFrame,
    carry: DataFrame,
    hot: DataFrame,
    keys: list[str],
    order_col: str,
    with_ath: bool,
    ranges: int,
) -> DataFrame:
    """Rows for chunked windows where some chunks hold very many rows of one time:
    a two-level scan over ranges of equal row count.

    1. the hot chunks (checked size, broadcast) mark their rows by a hash of
       (pair, chunk), which NULL keys have too; exact copies become one row with
       a count, partially aggregated.  The rows are cut into ``ranges`` contiguous
       ranges of the whole order (pair, chunk, time, request, content) and written
       once: neither one time nor one request needs to fit a task,
    2. one summary row per (pair, chunk, range): last close, highest high, and the
       highest high of its first time,
    3. a prefix over the ranges of a chunk, started by the chunk's carry row, gives
       each range the close and the highest high of all before it (its carry row);
       bars of one time are peers in the maximum, so a range that ends within a
       time also gets the highest high that later ranges hold of it (its tail row),
    4. the window runs per (pair, chunk, range); other chunks have range -1 and
       their single carry row.
    """
    columns = base.columns
    marked = base.withColumn("_k", _chunk_key(keys))
    flag = hot.withColumn("_hot", F.lit(True))
    rows = join_small(marked, flag, on=["_k"], how="left")
    hot_rows = cut_ranges(
        rows.filter(F.col("_hot").isNotNull()).groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")),
        [*keys, "_chunk", order_col, *TIE], ranges, "hot-bars")
    cold_rows = rows.filter(F.col("_hot").isNull()).select(
        *columns, F.lit(1).cast("bigint").alias("_copies"), F.lit(-1).alias("_range"))

    # 2. one row per range of a chunk
    high = null_if_zero("high") if with_ath else F.lit(None).cast("double")
    t = _order_key(order_col)
    edges = hot_rows.groupBy(*keys, "_chunk", "_range").agg(
        F.max_by("close", F.struct(t, *TIE)).alias("close"), F.max(high).alias("high"),
        F.max(F.struct((-t).alias("t"), high.alias("high"))).alias("first"),
        F.max(t).alias("_last"), F.max(order_col).alias(order_col))
    edges = edges.checkpoint(eager=True)

    # 3. the prefix, and the peers of the last time among later ranges
    hot_carry = join_small(carry.withColumn("_k", _chunk_key(keys)), flag, on=["_k"]).drop("_hot", "_k")
    g = edges.select(*keys, "_chunk", "_range", "close", *(["high"] if with_ath else [])).unionByName(
        hot_carry.withColumn("_range", F.lit(-1)))
    w_prev = Window.partitionBy(*keys, "_chunk").orderBy("_range")
    inherited = [F.lag("close").over(w_prev).alias("close")]
    if with_ath:
        inherited.append(F.max("high").over(w_prev.rowsBetween(Window.unboundedPreceding, -1)).alias("high"))
    range_carry = g.select(*keys, "_chunk", "_range", *inherited).filter(F.col("_range") >= 0)
    stream = hot_rows.unionByName(cold_rows).withColumns({"_lead": F.lit(1), "_tail": F.lit(0)})
    for c in (range_carry, carry.withColumn("_range", F.lit(-1))):
        stream = stream.unionByName(c.withColumns({"_lead": F.lit(0), "_tail": F.lit(0)}), allowMissingColumns=True)
    if with_ath:
        begins = edges.select(*keys, "_chunk", (-F.col("first.t")).alias("_t"), F.col("first.high").alias("high"))
        ends = edges.select(*keys, "_chunk", F.col("_last").alias("_t"), "_range", order_col)
        peers = Window.partitionBy(*keys, "_chunk", "_t")
        tails = (begins.unionByName(ends, allowMissingColumns=True).withColumn("high", F.max("high").over(peers))
                 .filter(F.col("_range").isNotNull() & F.col("high").isNotNull()).drop("_t"))
        stream = stream.unionByName(tails.withColumns({"_lead": F.lit(1), "_tail": F.lit(1)}), allowMissingColumns=True)
    return stream


COUNTED_ROWS = 2_000_000
# Rows of a place at least, so that small inputs make few tasks and files.
LEAST_ROWS = 10_000
# Bytes of a pair's entry and of a place in the broadcast table of places.
PAIR_BYTES, PLACE_BYTES = 128, 16
# Chunks whose running count one small window takes.
FEW_CHUNKS = 20_000


@dataclass(frozen=True)
class _Places:
    """Where the key ranges of equal row count begin: ``table`` has, per hash of a pair,
    the chunks at which its places begin and their numbers."""

    table: DataFrame
    count: int

    def assign(self, stream: DataFrame, keys: list[str], ranges: int) -> DataFrame:
        """``stream`` partitioned by place; a hot range is a place of its own."""
        # binary search among the first chunks of the pair's places
        found = F.expr(f"""_numbers[CASE WHEN size(_starts) = 1 THEN 0 ELSE aggregate(
            sequence(cast(floor(log2(size(_starts))) as int), 0, -1), 0, (at, i) -> CASE
            WHEN at + shiftleft(1, i) < size(_starts) AND _starts[at + shiftleft(1, i)] <= coalesce(_chunk, {LOWEST}L)
            THEN at + shiftleft(1, i) ELSE at END) END]""")
        placed = stream.withColumn("_pair", F.xxhash64(*keys)).join(F.broadcast(self.table), "_pair", "left")
        place = F.coalesce(found, F.lit(0))
        if ranges:
            place = F.when(F.col("_range") >= 0, F.col("_range") + self.count).otherwise(place)
        placed = placed.withColumn("_place", place.cast("int")).drop("_pair", "_starts", "_numbers")
        return placed.repartitionById(self.count + ranges, F.col("_place"))


def _places(summary: DataFrame, keys: list[str], total: int, pairs: int, chunks: int) -> _Places | None:
    """Ranges of (bucket, quote, symbol, chunk) of about equal row count from the counts
    of the chunk summary; None if the table of their beginnings is too large.

    Up to ``FEW_CHUNKS`` chunks are counted in one window; beyond, the running count is
    taken in three levels - output folders, pairs of a folder, chunks of a pair - so no
    window holds more than one of these groups.  The table has an entry per pair and per
    place, whatever the number of rows.
    """
    spark = summary.sparkSession
    # what the table holds is known before it is built: a hash and two arrays a pair, an
    # entry a place (the number of pairs is an estimate within 5 %)
    target = max(LEAST_ROWS, -(-total // int(spark.conf.get("spark.sql.shuffle.partitions"))))
    count = max(1, -(-total // target) + 1)
    if 1.2 * pairs * PAIR_BYTES + count * PLACE_BYTES > BROADCAST_BYTES:
        return None

    def before(by: list[str], order: list[str], n: str) -> Column:
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(n).over(w), F.lit(0))

    if chunks <= FEW_CHUNKS:
        every = [*keys, "_chunk"]
        running = summary.withColumn("_before", before([], every, "_n"))
        placed = running.withColumns({
            "_place": F.floor(F.col("_before") / F.lit(target)).cast("int"),
            "_was": F.floor(F.lag("_before").over(Window.partitionBy(*keys).orderBy("_chunk")) / F.lit(target)).cast("int")})
    else:
        placed = _placed_in_levels(summary, keys, target, before)
    begins = placed.filter(~F.col("_place").eqNullSafe(F.col("_was"))).select(
        F.xxhash64(*keys).alias("_pair"), F.struct(F.coalesce("_chunk", F.lit(LOWEST)).alias("_start"), "_place").alias("_s"))
    table = begins.groupBy("_pair").agg(F.sort_array(F.collect_list("_s")).alias("_s")).select(
        "_pair", F.col("_s._start").alias("_starts"), F.col("_s._place").alias("_numbers"))
    return _Places(table, count)


def _placed_in_levels(summary: DataFrame, keys: list[str], target: int, before) -> DataFrame:
    """Chunks with their place and that of the chunk before (``_was``), by running counts
    over folders, over the pairs of a folder, and over the chunks of a pair."""
    folder = keys[:2]

    def same(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        cond = F.lit(True)
        for c in on:
            cond = cond & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        return left.join(right.withColumnsRenamed({c: f"_r_{c}" for c in on}), cond).drop(*[f"_r_{c}" for c in on])

    w_pair = Window.partitionBy(*keys).orderBy("_chunk")
    chunks = summary.select(*keys, "_chunk", "_n").withColumns({"_in_pair": before(keys, ["_chunk"], "_n"), "_left": F.lead("_n").over(w_pair).isNull()})
    chunks = chunks.withColumn("_last", F.lag("_in_pair").over(w_pair))
    # the last chunk of a pair knows its total, the last pair of a folder the folder's
    of_pair = chunks.filter("_left").select(*keys, (F.col("_in_pair") + F.col("_n")).alias("_pair_n"))
    of_pair = of_pair.withColumns({"_in_folder": before(folder, ["fsym"], "_pair_n"),
                                   "_left": F.lead("_pair_n").over(Window.partitionBy(*folder).orderBy("fsym")).isNull()})
    of_folder = of_pair.filter("_left").select(*folder, (F.col("_in_folder") + F.col("_pair_n")).alias("_folder_n"))
    of_folder = of_folder.select(*folder, before([], folder, "_folder_n").alias("_in_all"))  # one row per output folder
    start = same(of_pair.drop("_left", "_pair_n"), of_folder, folder).select(*keys, (F.col("_in_all") + F.col("_in_folder")).alias("_from"))
    return same(chunks, start, keys).withColumns({
        "_place": F.floor((F.col("_from") + F.col("_in_pair")) / F.lit(target)).cast("int"),
        "_was": F.floor((F.col("_from") + F.col("_last")) / F.lit(target)).cast("int")})


def derive_bars(
    landed: DataFrame,
    grain: Grain | str,
    *,
    chunked: bool = True,
    partitioning: str = "hash",
    dedupe: bool = False,
    split_copies_over: int | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Landed (text) bars -> derived bars of ``grain``; lazy, no action.

    ``dedupe`` keeps one bar per (pair, time), the newest request's (see
    ``operators.landing.dedupe_bars``).  ``keep`` names extra intermediate
    columns (e.g. ``close_lag1``) to keep after the fixed output columns.
    """
    g = grain_of(grain)
    df = typed_bars(landed)
    if dedupe:
        df = dedupe_bars(df)
    df = add_bar_time(df, g)
    df = rename_volumes(df)
    df = pair_windows(
        df,
        g.order_column,
        with_ath=g.ath,
        chunk_seconds=g.chunk_seconds if chunked else None,
        partitioning=partitioning,
        split_copies_over=split_copies_over,
    )
    df = df.withColumns(
        {
            "change": change("close", "close_lag1"),
            "pct_change": pct_change("close", "close_lag1"),
        }
    )
    if g.ath:
        df = df.withColumn("pct_from_ath", pct_from_ath("close", "all_time_high"))
    return df.select(*output_columns(g), *keep)
