"""Calendar rules on the clock values where they turn."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from marketlake.functions import dates


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def day(text):
    return F.lit(text).cast("date")


@pytest.mark.parametrize(
    "now, closing_counts, expected",
    [
        ("2024-01-05 16:30:00", False, date(2024, 1, 4)),
        ("2024-01-05 16:30:00", True, date(2024, 1, 5)),
        ("2024-01-05 16:30:01", False, date(2024, 1, 5)),
        ("2024-01-05 00:00:00", False, date(2024, 1, 4)),
    ],
)
def test_day_cutoff(spark, now, closing_counts, expected):
    assert value(spark, dates.day_cutoff(at(now), closing_counts=closing_counts)) == expected


@pytest.mark.parametrize(
    "now, friday",
    [
        ("2024-01-12 23:00:00", date(2024, 1, 5)),  # Friday evening: still the week before
        ("2024-01-13 16:29:59", date(2024, 1, 5)),  # Saturday before the close: eight days back
        ("2024-01-13 16:30:00", date(2024, 1, 12)),  # Saturday after it
        ("2024-01-14 01:00:00", date(2024, 1, 12)),  # Sunday
        ("2024-01-15 18:00:00", date(2024, 1, 12)),  # Monday
    ],
)
def test_last_friday(spark, now, friday):
    assert value(spark, dates.last_friday(at(now))) == friday


def test_prev_week_friday_and_month_end(spark):
    assert value(spark, dates.prev_week_friday(day("2024-01-14"))) == date(2024, 1, 5)
    assert value(spark, dates.prev_month_end(day("2024-03-31"))) == date(2024, 2, 29)


@pytest.mark.parametrize(
    "last, now, gate, compat",
    [
        ("2024-01-08", "2024-01-10 12:00:00", False, True),  # the unpadded text is always larger
        ("2024-01-08", "2024-01-10 15:00:01", True, True),
        ("2024-01-08", "2024-01-10 05:59:59", True, True),
        ("2024-01-09", "2024-01-10 12:00:00", False, False),
        ("2024-01-09", "2024-01-10 15:30:00", True, True),
        ("2024-01-10", "2024-01-10 15:30:00", False, False),
    ],
)
def test_snapshot_gate(spark, last, now, gate, compat):
    assert value(spark, dates.snapshot_gate(day(last), at(now))) is gate
    assert value(spark, dates.snapshot_gate(day(last), at(now), compat=True)) is compat


@pytest.mark.parametrize(
    "now, intent, compat",
    [
        ("2024-01-10 17:00:00", "2024-01-10 15:00:00", "2024-01-10 15:00:00"),
        ("2024-01-10 09:00:00", "2024-01-09 15:00:00", "2024-01-09 15:00:00"),
        ("2024-01-10 10:30:00", "2024-01-10 10:30:00", "2024-01-09 15:00:00"),
        ("2024-01-10 14:59:00", "2024-01-10 14:30:00", "2024-01-09 15:00:00"),
    ],
)
def test_intraday_cutoff(spark, now, intent, compat):
    args = (at(now), day("2024-01-10"), day("2024-01-09"))
    assert value(spark, dates.intraday_cutoff(*args)) == intent
    assert value(spark, dates.intraday_cutoff(*args, compat=True)) == compat


def test_quarter_ends(spark):
    back = value(spark, dates.quarter_ends(day("2015-06-30"), day("2016-01-15"), -1))
    assert back == [date(2015, 3, 31), date(2015, 6, 30), date(2015, 9, 30), date(2015, 12, 31)]
    same = value(spark, dates.quarter_ends(day("2015-06-30"), day("2015-12-31"), 0))
    assert same == [date(2015, 6, 30), date(2015, 9, 30)]
    assert value(spark, dates.quarter_ends(day("2015-12-31"), day("2015-01-01"), 0)) == []


def test_split_range(spark):
    parts = value(spark, dates.split_range(day("2024-01-01"), day("2024-01-12"), 5))
    assert [tuple(p) for p in parts] == [
        (date(2024, 1, 1), date(2024, 1, 5)),
        (date(2024, 1, 6), date(2024, 1, 10)),
        (date(2024, 1, 11), date(2024, 1, 12)),
    ]
    exact = value(spark, dates.split_range(day("2024-01-01"), day("2024-01-06"), 5))
    assert tuple(exact[-1]) == (date(2024, 1, 6), date(2024, 1, 6))
    assert value(spark, dates.split_range(day("2024-01-02"), day("2024-01-01"), 5)) is None


def test_business_days_and_years(spark):
    days = value(spark, dates.business_days(day("2024-01-05"), day("2024-01-09")))
    assert days == [date(2024, 1, 5), date(2024, 1, 8), date(2024, 1, 9)]
    years = lambda mark, now: value(spark, dates.holding_years(day(mark), day(now)))
    assert years("2020-09-30", "2022-03-01") == [2020, 2021, 2022]
    assert years("2020-12-31", "2022-01-30") == [2021]
    assert years("2020-12-31", "2022-01-31") == [2021, 2022]
    assert years("2021-12-31", "2022-01-15") is None


def test_parsing(spark):
    assert value(spark, dates.parse_text_date(F.lit("2025年7月18日"))) == date(2025, 7, 18)
    assert value(spark, dates.parse_text_date(F.lit("no date"))) is None
    assert value(spark, dates.quarter_label_end(F.lit("2024年2季度股票投资明细"))) == date(2024, 6, 30)
    assert value(spark, dates.quarter_label_end(F.lit("2024年5季度"))) is None
    assert value(spark, dates.parse_date(F.lit("31132024"), "ddMMyyyy")) is None
    assert value(spark, dates.date_to_int(day("2024-02-09"))) == 20240209
    assert value(spark, dates.shift_text_date(F.lit("20240301"), -1)) == "20240229"
    assert value(spark, dates.parse_timestamp(F.lit("2024-01-02 10:30:00"))) == datetime(2024, 1, 2, 10, 30)


def test_floor_minutes_at_the_half_hour(spark):
    assert value(spark, dates.floor_minutes(at("2024-01-10 10:29:59"))) == "2024-01-10 10:00:00"
    assert value(spark, dates.floor_minutes(at("2024-01-10 10:30:00"))) == "2024-01-10 10:30:00"
