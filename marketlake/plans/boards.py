"""Boards: valuation, breadth, leaders and board history from member bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_caps(bars: DataFrame, shares: DataFrame, key: str = "symbol") -> DataFrame:
    """Market cap and float cap = close x shares. Other columns of ``shares``, such as the
    board of each security, come along in the same join."""
    return bars.join(shares, key).withColumns(
        {
            "market_cap": F.col("close") * F.col("total_shares"),
            "float_cap": F.col("close") * F.col("float_shares"),
        }
    )


def members(bars: DataFrame, constituents: DataFrame, key: str = "symbol") -> DataFrame:
    """Bars of board members; a security in several boards counts in each."""
    return bars.join(constituents, key)


def breadth(member_bars: DataFrame) -> DataFrame:
    """Per board and day: risers, fallers, cap, summed change, rank by cap.

    A day has one row per board, which bounds the window.
    """
    daily = member_bars.groupBy("trade_date", "board").agg(
        F.count_if(F.col("change") > 0).alias("risers"),
        F.count_if(F.col("change") < 0).alias("fallers"),
        F.sum("market_cap").alias("market_cap"),
        F.sum("change").alias("change"),
    )
    of_day = Window.partitionBy("trade_date").orderBy(F.col("market_cap").desc())
    return daily.withColumn("rank", F.rank().over(of_day))


def leaders(member_bars: DataFrame) -> DataFrame:
    """Per board and day: the member with the highest change %, lowest symbol first on a tie."""
    best = F.struct(F.col("change_pct"), (-F.col("symbol")).alias("tie"))
    return (
        member_bars.filter(F.col("change_pct").isNotNull())
        .groupBy("trade_date", "board")
        .agg(F.max(best).alias("best"))
        .select(
            "trade_date",
            "board",
            (-F.col("best.tie")).alias("leader"),
            F.col("best.change_pct").alias("leader_change_pct"),
        )
    )


def history(member_bars: DataFrame) -> DataFrame:
    """Board bar per day: summed member prices, volume and amount."""
    return member_bars.groupBy("board", "trade_date").agg(
        *[F.sum(c).alias(c) for c in ("open", "close", "high", "low", "volume", "amount")]
    )
