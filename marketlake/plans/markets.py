"""Margin, short sales, custody and exchange totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions import numbers


def margin_totals(detail: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Market totals per day from per-security detail."""
    return detail.groupBy("trade_date").agg(*[F.sum(m).alias(m) for m in measures])


def with_total_balance(detail: DataFrame) -> DataFrame:
    return detail.withColumns(
        {
            "short_balance": F.col("short_volume") * F.col("price"),
            "total_balance": F.col("margin_balance") + F.col("short_volume") * F.col("price"),
        }
    )


def short_share(trades: DataFrame, keys: Sequence[str], is_short: Column) -> DataFrame:
    """Short shares, their average price and their share of all turnover."""
    totals = trades.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(is_short, F.col("volume"))), F.lit(0)).alias("short_shares"),
        F.sum(F.when(is_short, F.col("amount"))).alias("short_amount"),
        F.sum("amount").alias("amount"),
    )
    return totals.withColumns(
        {
            "short_avg_price": numbers.ratio(F.col("short_amount"), F.col("short_shares")),
            "short_pct": numbers.percent(F.coalesce("short_amount", F.lit(0)), F.col("amount")),
        }
    )


def custody_summary(detail: DataFrame, unit: Sequence[str]) -> DataFrame:
    """Holdings, participants and percentage by holder type within each unit.

    Participants are made distinct by an aggregation of their own, so a unit with most of
    the rows is spread over its participants before it is counted. The window runs over the
    few holder types of a unit.
    """
    per_participant = detail.groupBy(*unit, "holder_type", "participant_id").agg(
        F.sum("holding").alias("holding")
    )
    by_type = per_participant.groupBy(*unit, "holder_type").agg(
        F.sum("holding").alias("holding"), F.count("participant_id").alias("participants")
    )
    whole = F.sum("holding").over(Window.partitionBy(*unit))
    return by_type.withColumn("pct", numbers.percent(F.col("holding"), whole))


def ranked_share(df: DataFrame, period: str, group: str, value: str) -> DataFrame:
    """Totals per period and group with their share of the period and their rank in it."""
    totals = df.groupBy(period, group).agg(F.sum(value).alias(value))
    within = Window.partitionBy(period)
    return totals.withColumns(
        {
            "pct": numbers.percent(F.col(value), F.sum(value).over(within)),
            "rank": F.rank().over(within.orderBy(F.col(value).desc())),
        }
    )


def category_totals(df: DataFrame, keys: Sequence[str], count: str, sums: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count), *[F.sum(s).alias(s) for s in sums]
    )


def board_day(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Listed count, volume, amount and average PE (total price over total earnings)."""
    per_security = df.groupBy(*keys, "symbol").agg(
        *[F.sum(c).alias(c) for c in ("volume", "amount", "earnings")]
    )
    totals = per_security.groupBy(*keys).agg(
        F.count("symbol").alias("listed_count"),
        *[F.sum(c).alias(c) for c in ("volume", "amount", "earnings")],
    )
    return totals.withColumn("avg_pe", numbers.ratio(F.col("amount"), F.col("earnings")))
