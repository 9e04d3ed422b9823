"""The sync log: one row per (interface, table) with the last loaded date and a status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Status texts and the date of a table that never loaded.
SUCCESS = "成功"
FAILED = "失败"
NEVER = "1970-01-01"
#: Marks the rows of a table up to here as forgotten.
PURGED = "purged"

KEY = ["interface", "table_name"]


def _merge(log: DataFrame, runs: DataFrame, date: Column, status: Column) -> DataFrame:
    """Old rows and new runs grouped once by key; ``_old``/``_new`` hold each side's date."""
    old = log.select(*KEY, F.col("trade_date").alias("_old"), F.col("status").alias("_status"))
    new = runs.select(*KEY, F.col("trade_date").alias("_new"), F.lit(True).alias("_ran"))
    merged = (
        old.unionByName(new, allowMissingColumns=True)
        .groupBy(*KEY)
        .agg(*[F.max(c).alias(c) for c in ("_old", "_status", "_new", "_ran")])
    )
    return merged.select(
        *KEY,
        F.when(F.col("_ran"), date).otherwise(F.col("_old")).alias("trade_date"),
        F.when(F.col("_ran"), status).otherwise(F.col("_status")).alias("status"),
    )


def succeed(log: DataFrame, runs: DataFrame) -> DataFrame:
    """Log after the runs: their date and a success status, inserted where the key is new."""
    return _merge(log, runs, F.col("_new"), F.lit(SUCCESS))


def fail(log: DataFrame, runs: DataFrame) -> DataFrame:
    """Log after failed runs: status only, the date is kept, or 1970-01-01 for a new key."""
    runs = runs.select(*KEY, F.lit(None).cast("date").alias("trade_date"))
    return _merge(log, runs, F.coalesce("_old", F.lit(NEVER).cast("date")), F.lit(FAILED))


def purge(log: DataFrame, tables: DataFrame) -> DataFrame:
    """Forget the rows of rebuilt tables."""
    return log.join(tables.select("table_name"), "table_name", "left_anti").select(*log.columns)


def latest(runs: DataFrame, at: str) -> DataFrame:
    """The log from appended runs: status of the last run per key, date of its last success.

    Runs of a table up to its last purge do not count. Both sides combine on the map side.
    """
    purged = runs.filter(F.col("status") == PURGED).groupBy("table_name").agg(F.max(at).alias("_purged"))
    alive = runs.filter(F.col("status") != PURGED).join(purged, "table_name", "left")
    alive = alive.filter(F.col("_purged").isNull() | (F.col(at) > F.col("_purged")))
    loaded = F.when(F.col("status") == SUCCESS, F.struct(at, "trade_date"))
    last = alive.groupBy(*KEY).agg(
        F.max(loaded)["trade_date"].alias("_loaded"), F.max(F.struct(at, "status"))["status"].alias("status")
    )
    return last.select(*KEY, F.coalesce("_loaded", F.lit(NEVER).cast("date")).alias("trade_date"), "status")


def freshness(log: DataFrame, now: Column) -> DataFrame:
    return log.select(
        *KEY, "trade_date", "status", F.datediff(F.to_date(now), "trade_date").alias("lag_days")
    )
