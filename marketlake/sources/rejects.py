"""Parsed rows that no table can take: told apart in one pass, kept with their file, place and reason."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: What a judged row carries: why it is rejected, null for a good row, and then the text it was read from.
REASON, RAW = "_reason", "_raw"
SCHEMA = StructType(
    [StructField(n, StringType()) for n in ("table_name", "file", "place", "reason", "raw")] + [StructField("n_rows", LongType())]
)
KEY = ("table_name", "file", "reason", "raw")


def judged(rows: DataFrame, raw: Column, broken: Mapping[str, Column]) -> DataFrame:
    """``rows`` with the first reason whose condition holds, and the raw text of those that have one."""
    reason = F.coalesce(*[F.when(condition, F.lit(name)) for name, condition in broken.items()])
    return rows.withColumn(REASON, reason).withColumn(RAW, F.when(F.col(REASON).isNotNull(), raw))


def good(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(REASON).isNull()).drop(REASON, RAW)


def rejected(rows: DataFrame, table: str) -> DataFrame:
    """Rows for the table of rejects: one per file, reason and raw text, with the first place and the
    number of times. Combines on the map side."""
    bad = rows.filter(F.col(REASON).isNotNull()).select(
        F.lit(table).alias("table_name"), F.col("_batch").alias("file"), F.col("_pos").cast("string").alias("place"),
        F.col(REASON).alias("reason"), F.col(RAW).alias("raw"),
    )
    counted = bad.groupBy(*KEY).agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("n_rows"))
    return counted.select(*SCHEMA.fieldNames())
