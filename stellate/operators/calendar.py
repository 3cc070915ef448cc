"""Calendar (date) dimension, generated set-based with sequence + explode."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.functions.dates import date_key, month_name, week_of_month, week_of_year_sunday

# The range the reference loads its calendar with.
REFERENCE_START = "1950-01-01"
REFERENCE_END = "2022-05-20"

CALENDAR_COLUMNS = ["date_key", "date", "day", "month", "quarter", "year", "month_name",
                    "week_of_year", "week_of_month", "day_of_month", "day_of_year"]


def calendar_columns(d: Column) -> list[Column]:
    """The calendar attributes of date column ``d`` (all integers BIGINT)."""
    return [
        date_key(d).alias("date_key"),
        d.alias("date"),
        F.dayofmonth(d).cast("bigint").alias("day"),
        F.month(d).cast("bigint").alias("month"),
        F.quarter(d).cast("bigint").alias("quarter"),
        F.year(d).cast("bigint").alias("year"),
        month_name(d).alias("month_name"),
        week_of_year_sunday(d).alias("week_of_year"),
        week_of_month(d).alias("week_of_month"),
        F.dayofmonth(d).cast("bigint").alias("day_of_month"),
        F.dayofyear(d).cast("bigint").alias("day_of_year"),
    ]


def calendar_from_bounds(bounds: DataFrame, start_col: str = "start_date",
                         end_col: str = "end_date") -> DataFrame:
    """One row per day of every [start, end] range in ``bounds`` (inclusive).

    ``bounds`` is normally a one-row aggregate (min/max of the fact dates),
    so the output size is bounded by the date span, not by the data.
    """
    days = bounds.select(F.explode(F.sequence(F.to_date(start_col), F.to_date(end_col),
                                              F.expr("INTERVAL 1 DAY"))).alias("_d"))
    return days.select(*calendar_columns(F.col("_d")))


def calendar(spark: SparkSession, start=REFERENCE_START, end=REFERENCE_END) -> DataFrame:
    """Calendar dimension for the inclusive range [start, end]."""
    if isinstance(start, str):
        start = _dt.date.fromisoformat(start)
    if isinstance(end, str):
        end = _dt.date.fromisoformat(end)
    bounds = spark.range(1).select(F.lit(start).alias("start_date"), F.lit(end).alias("end_date"))
    return calendar_from_bounds(bounds)


def calendar_for(df: DataFrame, *date_cols: str) -> DataFrame:
    """Calendar covering every date that occurs in ``date_cols`` of ``df``
    (a partial+final aggregate: one row crosses the shuffle per task)."""
    lo = F.least(*[F.min(F.to_date(c)) for c in date_cols])
    hi = F.greatest(*[F.max(F.to_date(c)) for c in date_cols])
    return calendar_from_bounds(df.agg(lo.alias("start_date"), hi.alias("end_date")))
