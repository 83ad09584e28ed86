"""Date and time expressions.

All of them are built-in Spark expressions, so they run inside whole-stage
codegen; none needs a Python worker.  They assume the session time zone is
UTC (see ``tickforge.session.ensure_utc``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text layouts accepted by parse_timestamp / parse_date, tried in
# this order after Spark's default (ISO-8601) form.  The underscore forms are
# what run_id produces.
TIMESTAMP_LAYOUTS = (
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy",
    "yyyyMMdd",
    "yyyy-MM-dd_HH_mm_ss_SSSSSS",
    "yyyy-MM-dd_HH_mm_ss",
)


# Unix seconds of 0001-01-01 00:00:00 and 9999-12-31 23:59:59 UTC.
SECONDS_MIN = -62_135_596_800
SECONDS_MAX = 253_402_300_799


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unix_to_ts(c: Column | str) -> Column:
    """Unix seconds (number or text, ``'1545523200.0'`` too) -> UTC timestamp.

    Dirty text ('None', 'nan', '') and seconds outside years 1-9999 give
    NULL instead of failing the job.
    """
    c = _c(c)
    seconds = F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))
    in_range = seconds.between(SECONDS_MIN, SECONDS_MAX)
    return F.when(in_range, F.timestamp_seconds(seconds))


def parse_timestamp(c: Column | str) -> Column:
    """Text -> timestamp; NULL when no known layout fits."""
    c = _c(c).cast("string")
    tries = [F.try_to_timestamp(c)]
    tries += [F.try_to_timestamp(c, F.lit(fmt)) for fmt in TIMESTAMP_LAYOUTS]
    return F.coalesce(*tries)


def parse_date(c: Column | str) -> Column:
    """D3: text -> date; NULL when no known layout fits."""
    return parse_timestamp(c).cast("date")


def quarter_start(c: Column | str) -> Column:
    """First day of the date's quarter."""
    return F.trunc(_c(c).cast("date"), "quarter")


def day_name(c: Column | str) -> Column:
    """Full weekday name, e.g. ``Tuesday``."""
    return F.date_format(_c(c), "EEEE")


def month_name(c: Column | str) -> Column:
    """Full month name, e.g. ``January``."""
    return F.date_format(_c(c), "MMMM")


def hour_of(c: Column | str) -> Column:
    """Hour of the (UTC) instant."""
    return F.hour(_c(c))


def minute_of(c: Column | str) -> Column:
    """Minute of the (UTC) instant."""
    return F.minute(_c(c))


def date_of(c: Column | str) -> Column:
    """Calendar date of the (UTC) instant."""
    return _c(c).cast("date")


def date_parts(c: Column | str) -> dict[str, Column]:
    """Year, month and day, the landing partition values."""
    c = _c(c)
    return {"year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c)}


def last_utc_close(as_of: Column | str) -> Column:
    """Unix seconds of midnight UTC of the day *before* ``as_of``.

    With a literal ``as_of`` Catalyst folds this to a constant, so a filter
    on it can reach the Parquet scan.
    """
    day_start = F.date_trunc("day", _c(as_of).cast("timestamp"))
    return F.unix_seconds(day_start - F.expr("INTERVAL 1 DAY"))


def run_id(as_of: Column | str) -> Column:
    """The instant as text with ``:`` ``.`` and blanks turned to ``_``.

    Six fraction digits, or none when the fraction is zero (Python's
    ``str(datetime)`` layout).
    """
    ts = _c(as_of).cast("timestamp")
    whole = F.date_trunc("second", ts) == ts
    text = F.when(whole, F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).otherwise(
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )
    return F.regexp_replace(text, r"[:. ]", "_")
