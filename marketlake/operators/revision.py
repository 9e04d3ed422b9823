"""Detect and apply recalculated history.

Adjusted prices are recalculated at the source after a dividend. Each load overlaps the
stored history by one bar; if that bar's close moved, the key's whole history is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators import aggregates

APPEND, RELOAD = "append", "reload"


def last_stored(stored: DataFrame, key: str, date: str, close: str) -> DataFrame:
    return aggregates.last_value(stored, key, date, close).withColumnRenamed("last_value", "last_close")


def classify(
    stored: DataFrame | None,
    incoming: DataFrame,
    key: str = "symbol",
    date: str = "trade_date",
    close: str = "close",
    lenient: bool = False,
    last: DataFrame | None = None,
) -> DataFrame:
    """One row per incoming key: last stored date and close, the overlap bar's close, action.

    ``last`` (key, last_date, last_close) saves looking them up in the stored rows.

    A key without stored rows is appended. A missing overlap bar means reload, or append when
    ``lenient``. The overlap is picked out while grouping, so incoming rows shuffle once.
    """
    last = last_stored(stored, key, date, close) if last is None else last.select(key, "last_date", "last_close")
    overlap = (
        incoming.join(last, key, "left")
        .groupBy(key)
        .agg(
            F.max("last_date").alias("last_date"),
            F.max("last_close").alias("last_close"),
            F.max(F.when(F.col(date) == F.col("last_date"), F.col(close))).alias("overlap_close"),
        )
    )
    action = (
        F.when(F.col("last_date").isNull(), APPEND)
        .when(F.col("overlap_close").isNull(), APPEND if lenient else RELOAD)
        .when(F.col("overlap_close") == F.col("last_close"), APPEND)
        .otherwise(RELOAD)
    )
    return overlap.withColumn("action", action)


def news(incoming: DataFrame, actions: DataFrame, key: str = "symbol", date: str = "trade_date") -> DataFrame:
    """Incoming bars of unrevised keys, without the overlap bar."""
    grown = actions.filter(F.col("action") == APPEND).select(key, "last_date")
    fresh = incoming.join(grown, key).filter(
        F.col("last_date").isNull() | (F.col(date) != F.col("last_date"))
    )
    return fresh.select(*incoming.columns)


def revised(actions: DataFrame, key: str = "symbol") -> DataFrame:
    return actions.filter(F.col("action") == RELOAD).select(key)


def apply(
    stored: DataFrame,
    incoming: DataFrame,
    history: DataFrame,
    actions: DataFrame,
    key: str = "symbol",
    date: str = "trade_date",
) -> DataFrame:
    """The table after the load: revised keys come from ``history``, the others grow by the
    incoming bars other than the overlap bar."""
    replaced = revised(actions, key)
    return (
        stored.join(replaced, key, "left_anti")
        .unionByName(news(incoming, actions, key, date).select(*stored.columns))
        .unionByName(history.join(replaced, key, "left_semi").select(*stored.columns))
    )
