"""Anti joins, lookups and calendar joins.

No join is hinted: sizes are read from the statistics, and adaptive execution broadcasts a
side only when it has been measured to be under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def without(df: DataFrame, excluded: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``excluded``."""
    return df.join(excluded.select(*key), list(key), "left_anti")


def left_chain(df: DataFrame, *steps: tuple[DataFrame, Sequence[str]]) -> DataFrame:
    """Left joins in a row, each on its own key."""
    for right, key in steps:
        df = df.join(right, list(key), "left")
    return df


def per_exchange(calendar: DataFrame, exchanges: Sequence[str]) -> DataFrame:
    """Every calendar row once per exchange."""
    return calendar.withColumn("exchange", F.explode(F.array(*[F.lit(e) for e in exchanges])))


def by_rule(pairs: DataFrame, rules: DataFrame, equal: str, like: str) -> DataFrame:
    """Rows of ``pairs`` with every rule that fits: equal in one column, contained in the other.

    The rule's columns are added as ``rule_`` and the name. ``pairs`` should be reduced to distinct values
    of both columns first, as the equal column alone may hold few values.
    """
    few = rules.select(F.col(equal).alias(f"rule_{equal}"), F.col(like).alias(f"rule_{like}")).distinct()
    fits = (F.col(equal) == F.col(f"rule_{equal}")) & F.col(like).contains(F.col(f"rule_{like}"))
    return pairs.join(few, fits)


def asof_dates(days: DataFrame, calendar: DataFrame) -> DataFrame:
    """(day, last trading date at or before it, last trading date strictly before it).

    Both sides are reduced to distinct dates first, so the one window below runs over at
    most one row per calendar day, however many rows the callers hold.
    """
    spine = (
        days.select("day", F.lit(None).cast("date").alias("trade_date"))
        .unionByName(calendar.select(F.col("trade_date").alias("day"), "trade_date"))
        .groupBy("day")
        .agg(F.max("trade_date").alias("trade_date"))
    )
    ordered = Window.orderBy("day")
    last = F.last("trade_date", ignorenulls=True)
    return spine.select(
        "day",
        last.over(ordered.rowsBetween(Window.unboundedPreceding, 0)).alias("asof_date"),
        last.over(ordered.rowsBetween(Window.unboundedPreceding, -1)).alias("before_date"),
    )


def asof_join(df: DataFrame, day: str, calendar: DataFrame) -> DataFrame:
    """Attach ``asof_date`` and ``before_date`` of each row's day through an equi-join on the day."""
    lookup = asof_dates(df.select(F.col(day).alias("day")).distinct(), calendar)
    return df.join(lookup.withColumnRenamed("day", day), day, "left")


def calendar_days(windows: DataFrame, calendar: DataFrame, start: Column, end: Column) -> DataFrame:
    """Trading dates inside each row's [start, end].

    The range is written out as days and matched by equality, which keeps this a hash join
    where a date range condition would compare every row with every date.
    """
    days = windows.withColumn("trade_date", F.explode(F.when(start <= end, F.sequence(start, end))))
    return days.join(calendar.select("trade_date"), "trade_date", "left_semi")
