from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.functions import calendar
from tests.conftest import rows


@pytest.fixture(scope="module")
def days(spark):
    collected = calendar.dim_date(spark).collect()
    return {row["full_date"]: row for row in collected}


def test_every_day_once_and_both_ends_included(days):
    assert len(days) == 18_628
    assert min(days) == dt.date(2000, 1, 1) and max(days) == dt.date(2050, 12, 31)
    assert (max(days) - min(days)).days + 1 == len(days)


def test_columns_in_order(spark):
    assert calendar.dim_date(spark).columns == [
        "date_key", "full_date", "year", "year_week", "year_day", "fiscal_year", "fiscal_qtr",
        "month", "month_name", "week_day", "day_name", "day_is_weekday",
    ]


def test_weeks_start_on_sunday(days):
    for day, row in days.items():
        assert row["year_week"] == day.year * 100 + int(day.strftime("%U"))
        assert row["week_day"] == day.isoweekday() % 7 + 1
    assert days[dt.date(2000, 1, 1)]["year_week"] == 200000
    assert days[dt.date(2000, 12, 31)]["year_week"] == 200053


def test_fiscal_year_starts_in_april_but_quarters_are_the_calendar_ones(days):
    march, april = days[dt.date(2024, 3, 31)], days[dt.date(2024, 4, 1)]
    assert (march["fiscal_year"], march["fiscal_qtr"]) == (2024, "Q1")
    assert (april["fiscal_year"], april["fiscal_qtr"]) == (2025, "Q2")


def test_leap_day(days):
    row = days[dt.date(2024, 2, 29)]
    assert (row["date_key"], row["year_day"], row["day_name"]) == ("20240229", 2024060, "Thursday")


def test_weekend_flag_is_a_number(days):
    assert days[dt.date(2024, 6, 1)]["day_is_weekday"] == 0
    assert days[dt.date(2024, 6, 2)]["day_is_weekday"] == 0
    assert days[dt.date(2024, 6, 3)]["day_is_weekday"] == 1


def test_date_key_of_a_point_in_time_and_of_nothing(spark):
    df = spark.sql(
        "select timestamp_ntz'2024-02-29 23:59:59.999999' as at"
        " union all select cast(null as timestamp_ntz)"
    )
    assert rows(df.select(calendar.date_key("at"))) == [("20240229",), (None,)]


def test_spine_over_data(spark):
    df = spark.sql("select explode(array(date'2024-02-27', date'2024-03-01', null)) as d")
    spine = calendar.date_spine_of(df, "d")
    assert [r[0].day for r in spine.orderBy("full_date").collect()] == [27, 28, 29, 1]
    assert spine.agg(F.count("*")).first()[0] == 4
