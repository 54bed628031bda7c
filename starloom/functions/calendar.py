"""Date keys and the generated fiscal calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# First and last day of the published calendar.
FIRST_DAY = dt.date(2000, 1, 1)
LAST_DAY = dt.date(2050, 12, 31)

# Fixed value: first month of the fiscal year.
FISCAL_START_MONTH = 4


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def date_key(value: Column | str) -> Column:
    """``YYYYMMDD`` text of a date or point in time; NULL stays NULL."""
    return F.date_format(_col(value).cast("date"), "yyyyMMdd")


def month_name(value: Column | str) -> Column:
    return F.date_format(_col(value).cast("date"), "MMMM")


def day_name(value: Column | str) -> Column:
    return F.date_format(_col(value).cast("date"), "EEEE")


def week_of_year(value: Column | str) -> Column:
    """Week 0..53 with weeks starting on Sunday.

    Days before the year's first Sunday are in week 0, so this is not the ISO
    week of ``F.weekofyear``.
    """
    day = _col(value).cast("date")
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("int")


def year_week(value: Column | str) -> Column:
    return F.year(_col(value)) * 100 + week_of_year(value)


def year_day(value: Column | str) -> Column:
    return F.year(_col(value)) * 1000 + F.dayofyear(_col(value))


def fiscal_year(value: Column | str) -> Column:
    """Named after the calendar year it ends in."""
    day = _col(value)
    return F.year(day) + F.when(F.month(day) >= FISCAL_START_MONTH, 1).otherwise(0)


def calendar_quarter(value: Column | str) -> Column:
    """``Q1`` .. ``Q4`` of the calendar year."""
    return F.concat(F.lit("Q"), F.quarter(_col(value)).cast("string"))


def weekday_flag(value: Column | str) -> Column:
    """0 on Saturday and Sunday, else 1."""
    return F.when(F.dayofweek(_col(value)).isin(1, 7), 0).otherwise(1)


def date_spine(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day from ``first`` to ``last``, both included."""
    days = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("full_date"))


def date_spine_of(df: DataFrame, column: str) -> DataFrame:
    """One row per day over the range that ``column`` spans."""
    day = F.col(column).cast("date")
    span = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    days = F.sequence("first", "last", F.expr("interval 1 day"))
    return span.select(F.explode(days).alias("full_date"))


def dim_date(
    spark: SparkSession, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY
) -> DataFrame:
    """The calendar dimension, one row per day.

    ``fiscal_qtr`` holds the calendar quarter although ``fiscal_year`` starts in
    April, as in the calendar being matched.
    """
    day = "full_date"
    return date_spine(spark, first, last).select(
        date_key(day).alias("date_key"),
        F.col(day),
        F.year(day).alias("year"),
        year_week(day).alias("year_week"),
        year_day(day).alias("year_day"),
        fiscal_year(day).alias("fiscal_year"),
        calendar_quarter(day).alias("fiscal_qtr"),
        F.month(day).alias("month"),
        month_name(day).alias("month_name"),
        F.dayofweek(day).alias("week_day"),
        day_name(day).alias("day_name"),
        weekday_flag(day).alias("day_is_weekday"),
    )
