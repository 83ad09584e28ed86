"""Typing and arithmetic on bar values (P1 cell rule, P8, N1-N3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_double(c: Column | str) -> Column:
    """Landed text -> double.

    ``try_cast`` turns 'None' / '' into NULL instead of failing under ANSI
    mode; ``nanvl`` then turns NaN (from 'nan') into NULL, because ``max``
    ranks NaN above every number and one NaN would stick in a running
    maximum for good.  Infinity ('inf') would stick likewise and is NULL too.
    """
    number, none = F.nanvl(_c(c).try_cast("double"), F.lit(None).cast("double")), F.lit(None).cast("double")
    return F.when(F.abs(number) == F.lit(float("inf")), none).otherwise(number)


def null_if_zero(c: Column | str) -> Column:
    """Zero -> NULL (a zero high is no price)."""
    return F.nullif(_c(c), F.lit(0))


def change(close: Column | str, prev_close: Column | str) -> Column:
    """Close minus the previous stored bar's close."""
    return _c(close) - _c(prev_close)


def pct_change(close: Column | str, prev_close: Column | str) -> Column:
    """Change as a fraction of the previous close; NULL when that is 0."""
    return F.try_divide(change(close, prev_close), _c(prev_close))


def pct_from_ath(close: Column | str, ath: Column | str) -> Column:
    """``close / all_time_high - 1``; NULL while there is no ATH."""
    return F.try_divide(_c(close), _c(ath)) - F.lit(1)
