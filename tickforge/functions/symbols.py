"""Symbol and key text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def symbol_bucket(fsym: Column | str) -> Column:
    """``'_'`` when the symbol starts with a digit, else its first character.

    Case is kept (``btc`` -> ``b``).  An empty symbol gives ``''``; the
    quality check ``bad_symbols`` reports such rows.
    """
    fsym = _c(fsym)
    return F.when(fsym.rlike("^[0-9]"), F.lit("_")).otherwise(F.substring(fsym, 1, 1))


def chart_name(url: Column | str) -> Column:
    """The part of a chart URL after ``charts/``."""
    return F.regexp_replace(_c(url), r".*charts/", "")


def kebab_key(key: Column | str) -> Column:
    """``SNAKE_CASE`` key -> ``kebab-case``."""
    return F.translate(F.lower(_c(key)), "_", "-")
