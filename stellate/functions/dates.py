"""Date-key and calendar expressions.

Every function returns a Column built from Spark builtins so it stays in
whole-stage codegen.  Integer results are cast to BIGINT so they compare
equal to DuckDB's integer results.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values shared with the reference's semantics:
#   day numbers count from 1900-01-01 (day 0) and a time of day at or after
#   12:00 rounds up to the next day; the calendar key is yyyymmdd; the
#   legacy run stamp multiplies the year by 1000 (not 10000).
DAY_ZERO = "1900-01-01"
NOON_HOUR = 12


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c) -> Column:
    """yyyymmdd as an integer: year*10000 + month*100 + day."""
    d = _c(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def date_key_str(c) -> Column:
    """Zero-padded 'yyyyMMdd' text."""
    return F.date_format(_c(c), "yyyyMMdd")


def run_stamp_compat(c) -> Column:
    """The legacy stamp year*1000 + month*100 + day (neither unique nor monotone)."""
    d = _c(c)
    return (F.year(d) * 1000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def day_number_1900(c) -> Column:
    """Datetime converted to an integer day number (days since 1900-01-01),
    rounded at noon: 12:00:00 and later count as the next day."""
    ts = _c(c)
    days = F.datediff(F.to_date(ts), F.lit(DAY_ZERO).cast("date"))
    return (days + F.when(F.hour(ts) >= NOON_HOUR, 1).otherwise(0)).cast("bigint")


def day_diff_1900(c) -> Column:
    """Plain calendar-day difference from 1900-01-01 (no rounding)."""
    return F.datediff(F.to_date(_c(c)), F.lit(DAY_ZERO).cast("date")).cast("bigint")


def week_of_year_sunday(c) -> Column:
    """Week number where week 1 holds January 1st and weeks start on Sunday
    (not ISO; 53 or 54 at year end)."""
    d = F.to_date(_c(c))
    jan1_dow = F.dayofweek(F.trunc(d, "year"))  # Sunday = 1
    return ((F.dayofyear(d) - 1 + jan1_dow - 1) / 7).cast("bigint") + 1


def week_of_month(c) -> Column:
    """(day_of_month - 1) div 7 + 1."""
    return ((F.dayofmonth(_c(c)) - 1) / 7).cast("bigint") + 1


def month_name(c) -> Column:
    """Full English month name ('January')."""
    return F.date_format(_c(c), "MMMM")
