"""US federal holiday calendar and membership test.

The calendar is generated from the public federal rules, one row per
holiday and year, plus "observed" rows: a fixed-date holiday on a Saturday
is observed the Friday before, on a Sunday the Monday after (so New Year
2022 is observed on 2021-12-31).  The rules hold from 1971 on.

The membership test needs no calendar: it is an expression over the date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The federal holidays.
# (name, month, rule, first year, last year, observed)
#   rule: ("date", day) | ("nth", weekday, n) | ("last", weekday)
HOLIDAY_RULES = (
    ("New Year's Day", 1, ("date", 1), None, None, True),
    ("Martin Luther King Jr. Day", 1, ("nth", "MON", 3), 1986, None, False),
    ("Washington's Birthday", 2, ("nth", "MON", 3), None, None, False),
    ("Memorial Day", 5, ("last", "MON"), None, None, False),
    ("Juneteenth National Independence Day", 6, ("date", 19), 2021, None, True),
    ("Independence Day", 7, ("date", 4), None, None, True),
    ("Labor Day", 9, ("nth", "MON", 1), None, None, False),
    ("Columbus Day", 10, ("nth", "MON", 2), None, None, False),
    ("Veterans Day", 10, ("nth", "MON", 4), 1971, 1977, False),
    ("Veterans Day", 11, ("date", 11), 1978, None, True),
    ("Thanksgiving", 11, ("nth", "THU", 4), None, None, False),
    ("Christmas Day", 12, ("date", 25), None, None, True),
)
OBSERVED_SUFFIX = " (observed)"
FIRST_YEAR = 1971


def _rule_date(year: Column, month: int, rule: tuple) -> Column:
    first = F.make_date(year, F.lit(month), F.lit(1))
    kind = rule[0]
    if kind == "date":
        return F.make_date(year, F.lit(month), F.lit(rule[1]))
    if kind == "nth":
        # first <weekday> on or after the 1st, then whole weeks
        return F.date_add(F.next_day(F.date_sub(first, 1), rule[1]), 7 * (rule[2] - 1))
    if kind == "last":
        return F.next_day(F.date_sub(F.last_day(first), 7), rule[1])
    raise ValueError(f"unknown rule {rule!r}")


def holiday_calendar(years: DataFrame, year_col: str = "year") -> DataFrame:
    """One row per (holiday or observed day): ``holiday_date``, ``holiday``, ``observed``.

    ``years`` holds the years to generate (one row each).
    """
    y = F.col(year_col)
    entries = []
    for name, month, rule, lo, hi, observed in HOLIDAY_RULES:
        day = _rule_date(y, month, rule)
        valid = F.lit(True)
        if lo is not None:
            valid = valid & (y >= lo)
        if hi is not None:
            valid = valid & (y <= hi)
        day = F.when(valid, day)
        entries.append(F.struct(day.alias("holiday_date"), F.lit(name).alias("holiday"), F.lit(False).alias("observed")))
        if observed:
            dow = F.dayofweek(day)  # 1 = Sunday, 7 = Saturday
            shifted = F.when(dow == 7, F.date_sub(day, 1)).when(dow == 1, F.date_add(day, 1))
            entries.append(
                F.struct(shifted.alias("holiday_date"), F.lit(name + OBSERVED_SUFFIX).alias("holiday"), F.lit(True).alias("observed"))
            )
    return (
        years.select(F.inline(F.array(*entries)))
        .filter(F.col("holiday_date").isNotNull())
    )


def is_holiday(date: Column, include_observed: bool = True) -> Column:
    """Whether a date is a federal holiday (or its observed day), from the date
    alone: its own year's holidays, and the next New Year observed on 31 December.

    NULL before 1971, whose rules are not known here.
    """
    def hits(year: Column, name: str, month: int, rule: tuple, lo: int | None, hi: int | None, observed: bool, own: bool):
        day = _rule_date(year, month, rule)
        found = date == day if own else F.lit(False)
        if observed and include_observed:
            dow = F.dayofweek(day)  # 1 = Sunday, 7 = Saturday
            found = found | ((dow == 7) & (date == F.date_sub(day, 1))) | ((dow == 1) & (date == F.date_add(day, 1)))
        if lo is not None:
            found = found & (year >= lo)
        if hi is not None:
            found = found & (year <= hi)
        return found

    year = F.year(date)
    found = F.lit(False)
    for entry in HOLIDAY_RULES:
        found = found | hits(year, *entry, own=True)
    new_year = hits(year + 1, *HOLIDAY_RULES[0], own=False) & (F.month(date) == 12)
    return F.when(year >= FIRST_YEAR, found | new_year)


def is_holiday_usa(
    df: DataFrame,
    date_col: str,
    out_col: str = "is_holiday_usa",
    include_observed: bool = True,
) -> DataFrame:
    """Add a boolean: is the date a US federal holiday (or observed day)?

    A column expression: no calendar, join or further read of the input.  NULL
    date -> false, like a failed membership test; NULL for dates before 1971.
    """
    date = F.col(date_col).cast("date")
    return df.withColumn(out_col, F.when(date.isNull(), F.lit(False)).otherwise(is_holiday(date, include_observed)))
