"""Loaded units, a key and a business day each, kept as intervals; and the units that are due besides them.

A maximum per key cannot say that a day before it is missing. Intervals can, and stay few: days that
follow each other, weekends aside, are one interval. Sets of days are compared as numbers of business
days, so that Friday and Monday are neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions import dates

INTERVAL = ["first_day", "last_day"]


def _before(key: str):
    return Window.partitionBy(key).orderBy("_from", "_to").rowsBetween(Window.unboundedPreceding, -1)


def _united(numbered: DataFrame, key: str) -> DataFrame:
    """(key, _from, _to) with overlapping and adjoining intervals in one. A key has one row a day at most."""
    run = Window.partitionBy(key).orderBy("_from", "_to").rowsBetween(Window.unboundedPreceding, 0)
    starts = F.coalesce(F.col("_from") > F.max("_to").over(_before(key)) + 1, F.lit(True)).cast("int")
    runs = numbered.withColumn("_new", starts).withColumn("_run", F.sum("_new").over(run))
    return runs.groupBy(key, "_run").agg(F.min("_from").alias("_from"), F.max("_to").alias("_to")).drop("_run")


def _dated(numbered: DataFrame, key: str) -> DataFrame:
    days = zip(INTERVAL, ("_from", "_to"))
    return numbered.select(key, *[dates.business_day(F.col(n)).alias(name) for name, n in days])


def islands(units: DataFrame, key: str, day: str) -> DataFrame:
    """(key, first_day, last_day): the runs of business days that a key has units on.

    Units of a null key, without a day or on a weekend do not count; repeated units count once.
    """
    number = dates.business_number(F.col(day))
    known = units.filter(F.col(key).isNotNull() & (F.weekday(day) < 5))
    days = known.select(key, number.alias("_from")).distinct().withColumn("_to", F.col("_from"))
    return _dated(_united(days, key), key)


def united(intervals: DataFrame, key: str) -> DataFrame:
    """The intervals of several loads as few ones: overlapping and adjoining ones become one."""
    numbers = [dates.business_number(F.col(c)) for c in INTERVAL]
    return _dated(_united(intervals.select(key, numbers[0].alias("_from"), numbers[1].alias("_to")), key), key)


def gaps(due: DataFrame, loaded: DataFrame, key: str, start: str = "start", end: str = "end") -> DataFrame:
    """(key, start, end) of the business days of each due range that no interval holds.

    ``due`` has one range a key. Both sides meet in one shuffle by key: the due range comes as a last
    interval behind its end, and every interval closes the gap after the ones before it.
    """
    low, high = dates.business_number(F.col(start)), dates.business_number(F.date_add(end, 1)) - 1
    ranges = due.select(key, (high + 1).alias("_from"), (high + 1).alias("_to"), low.alias("_low"), high.alias("_high"))
    held = loaded.select(key, *[dates.business_number(F.col(c)).alias(n) for c, n in zip(INTERVAL, ("_from", "_to"))])
    every = Window.partitionBy(key)
    both = held.unionByName(ranges, allowMissingColumns=True).select(
        key, "_from", "_to", F.max("_low").over(every).alias("_low"), F.max("_high").over(every).alias("_high")
    )
    both = both.filter("_low IS NOT NULL")  # keys that are due
    since = F.greatest("_low", F.max("_to").over(_before(key)) + 1)
    open_ = both.select(key, since.alias("_since"), F.least(F.col("_from") - 1, F.col("_high")).alias("_until"))
    open_ = open_.filter(F.col("_since") <= F.col("_until"))
    return open_.select(key, dates.business_day(F.col("_since")).alias(start), dates.business_day(F.col("_until")).alias(end))
