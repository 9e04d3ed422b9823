"""What is missing: per-key load windows from watermarks, cut-offs and the calendar.

All keys are planned in one DataFrame. Windows come from ``sequence`` and ``explode`` per
key, so a plan is as large as its result and nothing is paired up to be thrown away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions import dates
from marketlake.operators import joins


def symbol_dates(marks: DataFrame, calendar: DataFrame, end: Column, floor: Column | None = None) -> DataFrame:
    """Missing trading dates of every key: after its watermark, up to ``end``."""
    start = dates.next_start(F.col("watermark"), days=1)
    if floor is not None:
        start = dates.start_floor(start, floor)
    return joins.calendar_days(marks, calendar, start, end)


def explode_dates(marks: DataFrame, days: Column, name: str) -> DataFrame:
    """One row per planned date; keys with nothing to do disappear."""
    return marks.withColumn(name, F.explode(days))


def explode_windows(marks: DataFrame, windows: Column) -> DataFrame:
    return marks.select("*", F.inline(windows))


def until_gap(months: DataFrame, key: str, month: str, present: str) -> DataFrame:
    """Months before each key's first missing one. A key has at most one row per month, so
    the window is bounded by the calendar."""
    sofar = Window.partitionBy(key).orderBy(month).rowsBetween(Window.unboundedPreceding, 0)
    return (
        months.withColumn("_whole", F.min(F.col(present).cast("int")).over(sofar))
        .filter("_whole = 1")
        .drop("_whole")
    )


def relative_watermark(
    universe: DataFrame, stored: DataFrame, key: str, column: str, now: Column, days: int = 50
) -> DataFrame:
    """Highest timestamp per key, or ``now`` minus some days, as yyyy-MM-dd HH:mm:ss text."""
    marks = stored.groupBy(key).agg(F.max(column).alias("_mark"))
    default = now - F.make_dt_interval(F.lit(days))
    return (
        universe.select(key)
        .join(marks, key, "left")
        .select(
            key,
            F.date_format(F.coalesce("_mark", default), "yyyy-MM-dd HH:mm:ss").alias("watermark"),
        )
    )
