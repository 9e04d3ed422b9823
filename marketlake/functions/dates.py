"""Date expressions. The clock is always an argument, so every rule also runs over a column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Closing times of the markets and of the snapshot gate, as HH:mm:ss text.
MARKET_CLOSE = "16:30:00"
BOARD_CLOSE = "15:30:00"
SNAPSHOT_CLOSE = "15:00:00"
MARKET_OPEN = "09:30:00"
SNAPSHOT_MORNING = "06:00:00"
# The same two times without a leading zero, for the compatible text comparison.
MARKET_OPEN_UNPADDED = "9:30:00"
SNAPSHOT_MORNING_UNPADDED = "6:00:00"
# Fixed value: how a report period names its year and quarter.
QUARTER_LABEL = r"(\d{4}).*?([1-4])季度"


def clock(now: Column) -> Column:
    """Time of day as HH:mm:ss text. Cut from the timestamp's own text, so that a timestamp
    without time zone is never moved through the session's zone."""
    return F.substring(now.cast("string"), 12, 8)


def day_cutoff(now: Column, close: str = MARKET_CLOSE, closing_counts: bool = False) -> Column:
    """Today once the market has closed, else yesterday.

    ``closing_counts`` decides whether the closing second itself belongs to today.
    """
    closed = clock(now) >= close if closing_counts else clock(now) > close
    return F.when(closed, F.to_date(now)).otherwise(F.date_sub(F.to_date(now), 1))


def last_friday(now: Column, close: str = MARKET_CLOSE) -> Column:
    """Last finished trading week: the week counts as finished on Saturday after the close."""
    day = F.to_date(now)
    weekday = F.weekday(day)
    open_week = (weekday < 5) | ((weekday == 5) & (clock(now) < close))
    return F.when(open_week, F.date_sub(day, weekday + 3)).otherwise(F.date_sub(day, weekday - 4))


def prev_week_friday(day: Column) -> Column:
    """Friday of the week before, whatever the weekday."""
    day = F.to_date(day)
    return F.date_sub(day, F.weekday(day) + 3)


def prev_month_end(day: Column) -> Column:
    return F.last_day(F.add_months(F.to_date(day), -1))


def snapshot_gate(last_loaded: Column, now: Column, compat: bool = False) -> Column:
    """Whether the closing snapshot may be taken: market closed and the last one old enough.

    ``compat`` compares with the unpadded morning time as text, which holds at every hour.
    """
    yesterday = F.date_sub(F.to_date(now), 1)
    after_close = clock(now) > SNAPSHOT_CLOSE
    before_open = clock(now) < (SNAPSHOT_MORNING_UNPADDED if compat else SNAPSHOT_MORNING)
    stale = last_loaded < yesterday
    return (stale & (after_close | before_open)) | ((last_loaded == yesterday) & after_close)


def floor_minutes(now: Column, minutes: int = 30) -> Column:
    """Clock value floored to a whole number of minutes, as yyyy-MM-dd HH:mm:ss text."""
    slot = F.floor(F.minute(now) / minutes) * minutes
    hour = F.substring(now.cast("string"), 1, 14)
    return F.concat(hour, F.lpad(slot.cast("string"), 2, "0"), F.lit(":00"))


def intraday_cutoff(now: Column, last_day: Column, prev_day: Column, compat: bool = False) -> Column:
    """Latest bar end that can exist at ``now``, as yyyy-MM-dd HH:mm:ss text.

    ``last_day`` is the trading day at or before today, ``prev_day`` the one at or before
    yesterday. ``compat`` compares the opening time without its leading zero.
    """
    opening = MARKET_OPEN_UNPADDED if compat else MARKET_OPEN
    at_close = lambda day: F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 15:00:00"))
    return (
        F.when(clock(now) > MARKET_CLOSE, at_close(last_day))
        .when(clock(now) < opening, at_close(prev_day))
        .otherwise(floor_minutes(now, 30))
    )


def micros(time: Column, zoned: bool) -> Column:
    """Microseconds since 1970; of a time without zone as its own clock counts them."""
    if zoned:
        return F.unix_micros(time)
    day = F.unix_date(F.to_date(time)).cast("long") * 86_400_000_000
    second = (F.extract(F.lit("SECOND"), time) * 1_000_000).cast("long")
    return day + F.hour(time).cast("long") * 3_600_000_000 + F.minute(time).cast("long") * 60_000_000 + second


def next_start(watermark: Column, days: int = 0, weeks: int = 0, months: int = 0) -> Column:
    start = F.date_add(watermark, days + 7 * weeks)
    return F.add_months(start, months) if months else start


def start_floor(start: Column, *floors: Column) -> Column:
    return F.greatest(start, *floors)


def due(start: Column, end: Column, inclusive: bool) -> Column:
    return start <= end if inclusive else start < end


def quarter_ends(watermark: Column, end: Column, forward: int = -1) -> Column:
    """Quarter ends from the watermark's quarter (shifted by ``forward`` quarters) up to,
    but without, the month of ``end``."""
    first = F.add_months(F.trunc(watermark, "quarter"), 2 + 3 * forward)
    return F.transform(_months(first, F.trunc(end, "month"), 3), F.last_day)


def month_starts(start: Column, end: Column) -> Column:
    """First days of the months from ``start`` to ``end``, both included."""
    return _months(F.trunc(start, "month"), F.add_months(F.trunc(end, "month"), 1), 1)


def _months(first: Column, stop: Column, step: int) -> Column:
    """first, first + step months, ... below ``stop``; an empty array when there is none."""
    interval = F.make_ym_interval(F.lit(0), F.lit(step))
    empty = F.array().cast("array<date>")
    return F.when(first < stop, F.sequence(first, F.date_sub(stop, 1), interval)).otherwise(empty)


def split_range(start: Column, end: Column, days: int) -> Column:
    """Consecutive windows of ``days`` days covering [start, end]; the last one is cut at ``end``."""
    starts = F.sequence(start, end, F.make_dt_interval(F.lit(days)))
    windows = F.transform(
        starts,
        lambda s: F.struct(
            s.alias("window_start"), F.least(F.date_add(s, days - 1), end).alias("window_end")
        ),
    )
    return F.when(start <= end, windows)


def day_range(start: Column, end: Column) -> Column:
    """All days of [start, end]; null when the range is empty."""
    return F.when(start <= end, F.sequence(start, end))


def business_days(start: Column, end: Column) -> Column:
    return F.filter(day_range(start, end), lambda d: F.weekday(d) < 5)


def business_number(day: Column) -> Column:
    """Business days from Monday 1970-01-05 to before ``day``. Friday and Monday have neighbouring
    numbers; a weekend day has the number of the Monday after it."""
    weeks = F.floor(F.datediff(day, F.lit("1970-01-05").cast("date")) / 7)
    return 5 * weeks + F.least(F.weekday(day), F.lit(5))


def business_day(number: Column) -> Column:
    """The business day with this number."""
    days = 7 * F.floor(number / 5) + F.pmod(number, F.lit(5))
    return F.date_add(F.lit("1970-01-05").cast("date"), days.cast("int"))


def holding_years(watermark: Column, now: Column) -> Column:
    """Years still to load: the watermark's year, or the next one after a full year, up to this
    year; during January 1-30 only up to last year."""
    year_done = F.date_format(watermark, "MMdd") == "1231"
    first = F.year(watermark) + F.when(year_done, 1).otherwise(0)
    last = F.year(now) - F.when(F.date_format(now, "MMdd") < "0131", 1).otherwise(0)
    return F.when(first <= last, F.sequence(first, last))


def parse_date(text: Column, *formats: str) -> Column:
    """First format that fits, else null."""
    if not formats:
        return text.try_cast("date")
    return F.coalesce(*[F.try_to_date(text, f) for f in formats])


def date_to_int(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")


def int_to_date(number: Column) -> Column:
    return F.try_to_date(number.cast("string"), "yyyyMMdd")


def parse_text_date(text: Column) -> Column:
    """Year, month and day are the first three runs of digits, padded or not."""
    parts = F.regexp_extract_all(text, F.lit(r"([0-9]+)"), F.lit(1))
    pad = lambda i: F.lpad(F.get(parts, F.lit(i)), 2, "0")
    return F.try_to_date(F.concat(F.get(parts, F.lit(0)), pad(1), pad(2)), "yyyyMMdd")


def quarter_label_end(label: Column) -> Column:
    """Quarter end named by a report label, null when it names none."""
    year = F.regexp_extract(label, QUARTER_LABEL, 1)
    quarter = F.regexp_extract(label, QUARTER_LABEL, 2)
    month = quarter.cast("int") * 3
    return F.when(year != "", F.last_day(F.make_date(year.cast("int"), month, F.lit(1))))


def shift_text_date(text: Column, days: int) -> Column:
    return F.date_format(F.date_add(F.to_date(text, "yyyyMMdd"), days), "yyyyMMdd")


def parse_timestamp(text: Column) -> Column:
    return text.try_cast("timestamp_ntz")
