"""Checks that stand in for database constraints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructType

from marketlake.functions import numbers


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def violations(
    rows: DataFrame, key: Sequence[str], rules: Mapping[str, Column], stored: DataFrame | None = None, within: str | None = None
) -> DataFrame:
    """Keys of new rows that break a constraint: (key, n_rows, n_stored, misfits).

    A key may come once, counting the stored rows; ``misfits`` names the columns whose rule a row of the
    key breaks. All of it is one grouping with map-side combine. With ``within``, a date in the key, only
    stored rows in the new rows' range are read.
    """
    named = [F.max(F.when(~ok, F.lit(column))).alias(f"_m{i}") for i, (column, ok) in enumerate(rules.items())]
    flagged = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"), *named)
    found = flagged.select(*key, "n_rows", F.lit(0).cast("long").alias("n_stored"), F.concat_ws(",", *[f"_m{i}" for i in range(len(rules))]).alias("misfits"))
    if stored is not None:
        if within is not None:
            low, high = (rows.agg(f(within)).scalar() for f in (F.min, F.max))
            stored = stored.filter((F.col(within) >= low) & (F.col(within) <= high))
        held = stored.groupBy(*key).agg(F.count(F.lit(1)).alias("n_stored"))
        held = held.select(*key, F.lit(0).cast("long").alias("n_rows"), "n_stored", F.lit("").alias("misfits"))
        both = found.unionByName(held).groupBy(*key)
        found = both.agg(F.sum("n_rows").alias("n_rows"), F.sum("n_stored").alias("n_stored"), F.max("misfits").alias("misfits"))
    twice = F.col("n_rows") + F.col("n_stored") > 1
    return found.filter((F.col("n_rows") > 0) & (twice | (F.col("misfits") != "")))


def count_where(df: DataFrame, conditions: Mapping[str, Column], name: str, count: str) -> DataFrame:
    """One row per named condition with the number of rows that meet it, from one pass."""
    counts = df.agg(*[F.count_if(c).alias(label) for label, c in conditions.items()])
    return counts.unpivot([], list(conditions), name, count)


def column_misfits(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per column with the number of values that break its rule, from one pass."""
    return count_where(df, {name: ~ok for name, ok in rules.items()}, "column_name", "n_misfits")


def fit_rules(schema: StructType) -> dict[str, Column]:
    """Byte limits and decimal ranges declared by a dataset schema, for raw values."""
    rules: dict[str, Column] = {}
    for field in schema.fields:
        if isinstance(field.dataType, DecimalType):
            kind = field.dataType
            rules[field.name] = numbers.fits_decimal(F.col(field.name), kind.precision, kind.scale)
        elif "max_digits" in field.metadata:
            rules[field.name] = numbers.fits_decimal(F.col(field.name), field.metadata["max_digits"], 0)
        elif isinstance(field.dataType, StringType) and "max_bytes" in field.metadata:
            rules[field.name] = numbers.fits_bytes(F.col(field.name), field.metadata["max_bytes"])
    return rules


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its number of nulls, from one pass."""
    return column_misfits(df, {c: F.col(c).isNotNull() for c in columns})
