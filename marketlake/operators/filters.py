"""Row filters. Each is one predicate, so that it reaches the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Special-treatment name patterns and the excluded range of codes.
SPECIAL_NAMES = ("ST%", "*ST%")
EXCLUDED_LOW, EXCLUDED_HIGH = 900000, 920000


def universe(
    df: DataFrame,
    code: str = "symbol",
    name: str = "symbol_name",
    patterns: Sequence[str] = SPECIAL_NAMES,
    low: int = EXCLUDED_LOW,
    high: int = EXCLUDED_HIGH,
) -> DataFrame:
    """Tradable securities: no special-treatment name, numeric code outside [low, high]."""
    number = F.col(code).try_cast("long")
    keep = (number < low) | (number > high)
    for pattern in patterns:
        keep = keep & ~F.col(name).like(pattern)
    return df.filter(keep)


def code_range(df: DataFrame, code: str, low: str, high: str) -> DataFrame:
    """Codes outside [low, high], compared as text."""
    return df.filter((F.col(code) < low) | (F.col(code) > high))


def is_in(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    return df.filter(F.col(column).isin(*values))


def not_in(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    return df.filter(~F.col(column).isin(*values))


def positive(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) > 0)


def after_watermark(df: DataFrame, column: str, watermark: DataFrame, mark: str = "watermark") -> DataFrame:
    """Rows newer than a one-row watermark, compared as a scalar subquery."""
    return df.filter(F.col(column) > watermark.select(mark).scalar())


def between(df: DataFrame, column: str, low: object, high: object) -> DataFrame:
    return df.filter(F.col(column).between(low, high))


def complete_rows(df: DataFrame) -> DataFrame:
    return df.dropna("any")


def complete_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.dropna("any", subset=list(key))


def drop_overlap(df: DataFrame, starts: DataFrame, key: str, date: str, start: str) -> DataFrame:
    """Drop the row that repeats each key's window start; keys without a start are kept whole."""
    joined = df.join(starts.select(key, start), key, "left")
    return joined.filter(F.col(start).isNull() | (F.col(date) != F.col(start))).drop(start)


def contains(df: DataFrame, column: str, part: str) -> DataFrame:
    return df.filter(F.col(column).contains(part))


def owned_by(df: DataFrame, column: str, owner: str) -> DataFrame:
    return df.filter(F.col(column) == F.upper(F.lit(owner)))


def code_order(*columns: str) -> list[Column]:
    return [F.col(c).asc() for c in columns]
