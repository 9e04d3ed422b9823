"""Unions and the metric transpose."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def union_batches(spark: SparkSession, schema: StructType, batches: Sequence[DataFrame]) -> DataFrame:
    """All rows of equally shaped batches; a typed empty frame when there are none."""
    if not batches:
        return typed_empty(spark, schema)
    return reduce(DataFrame.unionByName, batches)


def typed_empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, the given columns; planned as an empty relation, without Python workers."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def union_tagged(segments: Mapping[str, DataFrame], column: str) -> DataFrame:
    """Union in which every row carries the name of its segment."""
    parts = [df.withColumn(column, F.lit(name)) for name, df in segments.items()]
    return reduce(DataFrame.unionByName, parts)


def gate_segments(df: DataFrame, segment: Column, late: Sequence[str], date: Column, since: str) -> DataFrame:
    """Drop the late segments' rows from before the day they came into being."""
    return df.filter(~segment.isin(*late) | (date >= F.lit(since).cast("date")))


def transpose(df: DataFrame, metric: str, columns: Sequence[str], metrics: Sequence[str], name: str) -> DataFrame:
    """Metric rows x named columns become one row per column with one column per metric.

    The metric list is given, so no pass over the data is needed to find it.
    """
    long = df.unpivot(metric, list(columns), name, "_value")
    return long.groupBy(name).pivot(metric, list(metrics)).agg(F.first("_value", ignorenulls=True))


def transpose_reports(
    df: DataFrame, report: Sequence[str], metric: str, columns: Sequence[str], metrics: Mapping[str, str], name: str
) -> DataFrame:
    """Many reports of metric rows x named columns: one row per report and column, one column per
    metric. ``metrics`` maps the labels to their names; other labels, and columns that hold nothing in a
    report, are left out. A report's cells are combined on the map side."""
    wanted = df.filter(F.col(metric).isin(*metrics))
    # columns of one unpivot share their type
    cells = wanted.select(*report, metric, *[F.col(c).cast("string").alias(c) for c in columns])
    long = cells.unpivot([*report, metric], list(columns), name, "_value").filter("_value IS NOT NULL")
    wide = [F.max(F.when(F.col(metric) == label, F.col("_value"))).alias(column) for label, column in metrics.items()]
    return long.groupBy(*report, name).agg(*wide)
