"""Column selection, renaming, tagging and type-wide rewrites."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def rename_map(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def normalise_names(df: DataFrame, separator: str = "-", drop_prefix: str = "") -> DataFrame:
    """Separators become underscores and a common prefix is dropped."""
    return df.toDF(*[c.replace(separator, "_").removeprefix(drop_prefix) for c in df.columns])


def tag(df: DataFrame, **constants: object) -> DataFrame:
    """Constant columns; a value may also be a Column, such as a window date."""
    return df.withColumns(
        {name: v if isinstance(v, Column) else F.lit(v) for name, v in constants.items()}
    )


def round_floats(df: DataFrame, digits: int = 2) -> DataFrame:
    """Round every float column half-even; all other columns stay as they are."""
    rounded = {
        name: F.bround(F.col(name), digits)
        for name, kind in df.dtypes
        if kind in ("double", "float")
    }
    return df.withColumns(rounded)


def cast_tail(df: DataFrame, position: int, digits: int = 2) -> DataFrame:
    """Columns from ``position`` on become rounded numbers, null where they are not numeric."""
    head, tail = df.columns[:position], df.columns[position:]
    return df.select(*head, *[F.bround(F.col(c).try_cast("double"), digits).alias(c) for c in tail])


def null_column(df: DataFrame, name: str, kind: str) -> DataFrame:
    return df.withColumn(name, F.lit(None).cast(kind))


def concat_label(df: DataFrame, name: str, label: str, column: str) -> DataFrame:
    return df.withColumn(name, F.concat_ws("-", F.lit(label), F.col(column)))
