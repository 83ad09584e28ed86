"""Data-quality checks (Q1-Q4).

Argument checks run on the driver at job start (they look at job
arguments, not data).  Dataset checks are lazy DataFrames of the offending
rows: empty means the check passed.  ``require_empty`` turns one into a
hard failure.

Inside a job a check reads nothing extra: ``guard`` fails the writing task at the
first bad row, so nothing is committed; ``Watch`` counts the bad rows of every rule while
the job writes, and the job commits only after ``require``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tickforge.functions.symbols import chart_name, kebab_key, symbol_bucket
from tickforge.sources.responses import OK_STATUS

# Accepted grains.
GRAINS = ("day", "hour", "minute")


def check_request(
    grain: str,
    fsyms: list[str],
    tsyms: list[str],
    limit: int,
    all_data: bool,
    exchange: str,
    app_name: str,
) -> None:
    """Q1 (arguments): types of the job arguments and the grain."""
    problems = []
    if not isinstance(app_name, str):
        problems.append(f"app_name must be text, got {app_name!r}")
    for name, value in (("fsyms", fsyms), ("tsyms", tsyms)):
        if not isinstance(value, (list, tuple)) or not all(isinstance(x, str) for x in value):
            problems.append(f"{name} must be a list of text, got {value!r}")
    if not isinstance(limit, int) or isinstance(limit, bool):
        problems.append(f"limit must be an int, got {limit!r}")
    if not isinstance(all_data, bool):
        problems.append(f"all_data must be a bool, got {all_data!r}")
    if not isinstance(exchange, str):
        problems.append(f"exchange must be text, got {exchange!r}")
    if grain not in GRAINS:
        problems.append(f"grain must be one of {GRAINS}, got {grain!r}")
    if problems:
        raise ValueError("; ".join(problems))


def bad_symbol(col: str) -> Column:
    """Q1 (data): NULL, empty or blank; such a symbol names no pair."""
    return F.col(col).isNull() | (F.trim(col) == "")


def bad_bucket(fsym: str = "fsym", bucket: str = "fsym_char1") -> Column:
    """Q2 by row: the slice a row is written to is not its symbol's, so the slice would
    hold more than one bucket."""
    return ~F.col(bucket).eqNullSafe(symbol_bucket(fsym))


def bar_rules() -> dict[str, Column]:
    """Q1 and Q2 for bars on their way into a landing or derived folder."""
    return {"blank symbol": bad_symbol("fsym") | bad_symbol("tsym"), "symbol outside its bucket": bad_bucket()}


def guard(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``df``, failing at the first row for which a rule is true (NULL is not)."""
    for what, bad in rules.items():
        seen = F.substring(F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns[:4]])), 1, 200)
        stop = F.raise_error(F.concat(F.lit(f"{what}: "), seen)).cast("boolean")
        df = df.filter(F.when(bad, stop).otherwise(True))
    return df


class Watch:
    """Counts the rows that break each rule while ``df`` is written (``observe``)."""

    def __init__(self, df: DataFrame, rules: dict[str, Column]):
        self._rules, self._seen = list(rules), Observation()
        counts = [F.count_if(bad).alias(f"rule_{i}") for i, bad in enumerate(rules.values())]
        self.df = df.observe(self._seen, F.count(F.lit(1)).alias("rows"), *counts)

    def require(self) -> int:
        """The rows written; fails if a rule was broken.  Call it after the write."""
        seen = self._seen.get
        bad = [f"{what}: {seen[f'rule_{i}']} rows" for i, what in enumerate(self._rules) if seen[f"rule_{i}"]]
        if bad:
            raise ValueError("; ".join(bad))
        return seen["rows"]


def bad_symbols(df: DataFrame, col: str = "fsym") -> DataFrame:
    """Q1 (data): symbols that cannot name a pair: NULL, empty or blank."""
    return df.filter(bad_symbol(col))


def check_one_bucket(df: DataFrame, slice_cols: list[str], fsym: str = "fsym") -> DataFrame:
    """Q2: slices whose symbols fall into more than one bucket."""
    return (
        df.groupBy(*slice_cols)
        .agg(F.count_distinct(symbol_bucket(fsym)).alias("n_buckets"))
        .filter(F.col("n_buckets") > 1)
    )


def check_chart_keys(df: DataFrame, key: str = "key", url: str = "url") -> DataFrame:
    """Q3: rows whose key, in kebab case, differs from the chart name in the URL."""
    return (
        df.withColumns({"key_name": kebab_key(key), "url_name": chart_name(url)})
        .filter(~F.col("key_name").eqNullSafe(F.col("url_name")))
    )


def check_status(responses: DataFrame, status: str = "status") -> DataFrame:
    """Q4: responses that are not HTTP 200."""
    return responses.filter(~F.col(status).eqNullSafe(F.lit(OK_STATUS)))


def require_empty(bad_rows: DataFrame, what: str) -> None:
    """Fail when a check found rows (one tiny ``limit(1)`` job)."""
    sample = bad_rows.limit(1).collect()
    if sample:
        raise ValueError(f"{what}: e.g. {sample[0].asDict()}")
