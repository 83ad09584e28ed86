"""Symbol pairs, buckets and request manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.functions.symbols import symbol_bucket
from tickforge.functions.temporal import last_utc_close
from tickforge.plans.scans import numbered

# Quote symbols of the back-fill jobs, page size of a paged
# back-fill, endpoint paths per grain and the two URL suffix layouts.
DEFAULT_QUOTES = ("USD", "BTC", "ETH")
PAGE_LIMIT = 2000
ENDPOINT_PATHS = {"day": "histoday", "hour": "histohour", "minute": "histominute"}
CHART_SUFFIX = "?timespan={timespan}&format={fmt}"


def pair_product(fsyms: DataFrame, tsyms: list[str] | tuple[str, ...], fsym: str = "fsym") -> DataFrame:
    """Every symbol with every quote symbol, duplicates kept.

    The quote list is a job argument of a few entries, so each symbol row is
    expanded in place (``explode`` of a literal array): no join, no shuffle,
    output linear in the input.
    """
    if not tsyms:
        raise ValueError("tsyms must not be empty")
    quotes = F.array(*[F.lit(t) for t in tsyms])
    return fsyms.select(F.col(fsym).alias("fsym"), F.explode(quotes).alias("tsym"))


def with_bucket(pairs: DataFrame) -> DataFrame:
    """X1 as a column of the pair table."""
    return pairs.withColumn("fsym_char1", symbol_bucket("fsym"))


def distinct_buckets(df: DataFrame) -> DataFrame:
    """A1: the sorted distinct buckets."""
    return df.select("fsym_char1").distinct().orderBy("fsym_char1")


def bucket_pairs(pairs: DataFrame) -> DataFrame:
    """A3 as a summary: pairs and symbols per bucket (one work unit each)."""
    return pairs.groupBy("fsym_char1").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.count_distinct("fsym").alias("n_symbols"),
    )


def work_units(pairs: DataFrame, unit_pairs: int, rows_per_range: int = 1_000_000) -> DataFrame:
    """A3 as work units: ``fsym_char1, unit, fsym, tsym``.

    The pairs of a bucket, in the order (``fsym``, ``tsym``), in units 1, 2, ... of
    ``unit_pairs`` pairs; the last unit of a bucket may be smaller.  Repeated pairs count
    each, NULL symbols form a bucket of their own.  A bucket with most of the pairs is
    numbered by many tasks (``plans.scans.numbered``).
    """
    if unit_pairs < 1:
        raise ValueError("unit_pairs must be at least 1")
    rows = numbered(pairs.select("fsym_char1", "fsym", "tsym"), ["fsym_char1"], ["fsym", "tsym"], rows_per_range)
    return rows.select("fsym_char1", F.expr(f"(_row - 1) div {int(unit_pairs)} + 1").alias("unit"), "fsym", "tsym")


def cluster_by_bucket(pairs: DataFrame) -> DataFrame:
    """A3 as a job layout: the pairs of one bucket together, one work unit
    each; a ``rebalance`` so AQE splits a bucket with very many pairs."""
    return pairs.hint("rebalance", "fsym_char1")


def request_manifest(
    pairs: DataFrame,
    grain: str,
    *,
    base_url: str,
    app_name: str,
    exchange: str,
    all_data: bool = True,
    limit: int = PAGE_LIMIT,
    as_of: Column | str | None = None,
    to_ts: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One request URL per row of ``pairs``; ``keep`` names columns to keep before it.

    * day + all data:         ``...&allData=true``
    * hour/minute + all data: ``...&limit=2000&toTs=<last UTC close>``
      (the first page), or ``&toTs=`` the column ``to_ts`` (a later page, see
      ``operators.frontier.next_requests``)
    * otherwise:              ``...&limit=<limit>``

    then always ``&e=<exchange>&extraParams=<app_name>``.
    """
    if grain not in ENDPOINT_PATHS:
        raise ValueError(f"grain must be one of {sorted(ENDPOINT_PATHS)}")
    start = f"{base_url.rstrip('/')}/{ENDPOINT_PATHS[grain]}?fsym="
    head = F.concat(F.lit(start), "fsym", F.lit("&tsym="), "tsym")
    if all_data and grain == "day":
        middle = F.lit("&allData=true")
    elif all_data:
        if as_of is None and to_ts is None:
            raise ValueError("as_of or to_ts is required for a paged back-fill")
        until = F.col(to_ts) if to_ts else last_utc_close(F.lit(as_of) if isinstance(as_of, str) else as_of)
        middle = F.format_string(f"&limit={PAGE_LIMIT}&toTs=%d", until)
    else:
        middle = F.lit(f"&limit={int(limit)}")
    tail = F.lit(f"&e={exchange}&extraParams={app_name}")
    return pairs.select("fsym", "tsym", *keep, F.concat(head, middle, tail).alias("url"))


def chart_requests(charts: DataFrame, timespan: str = "all", fmt: str = "json") -> DataFrame:
    """X5 for charts: the chart URL with its query suffix."""
    suffix = CHART_SUFFIX.format(timespan=timespan, fmt=fmt)
    return charts.withColumn("request_url", F.concat(F.col("url"), F.lit(suffix)))
