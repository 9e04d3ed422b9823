"""Fund holdings, fund snapshots and order-size flows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions import numbers
from marketlake.operators import aggregates


def weights(
    holdings: DataFrame,
    unit: Sequence[str],
    value: str = "holding_value",
    totals: DataFrame | None = None,
) -> DataFrame:
    """Percentage of each holding in its unit (fund and quarter).

    Totals come from an aggregation and a join, not from a window: a fund with a third of all
    holdings would put them into one window partition, while a join can be split or broadcast.
    ``totals`` (unit, total_value) can be handed in where a cheaper source than the holdings has
    them.
    """
    if totals is None:
        totals = holdings.groupBy(*unit).agg(F.sum(value).alias("total_value"))
    joined = holdings.join(totals, list(unit))
    return joined.withColumn("nav_pct", numbers.percent(F.col(value), F.col("total_value")))


def top_holdings(holdings: DataFrame, unit: Sequence[str], k: int, value: str = "holding_value", tie: str = "symbol") -> DataFrame:
    """The k largest holdings of each unit."""
    order = [F.col(value).desc(), F.col(tie).asc()]
    return aggregates.top_k(holdings, unit, order, k, rank="rank")


def with_discount(quotes: DataFrame, price: str, indicative: str) -> DataFrame:
    """Premium (positive) or discount (negative) to the indicative value in percent."""
    gap = F.col(price) - F.col(indicative)
    return quotes.withColumn("discount_pct", numbers.percent(gap, F.col(indicative)))


def bucket_flows(trades: DataFrame, keys: Sequence[str], buckets: Mapping[str, Column], signed: Column) -> DataFrame:
    """Net inflow per order-size bucket and in total."""
    sums = [
        F.coalesce(F.sum(F.when(inside, signed)), F.lit(0)).alias(f"{name}_inflow")
        for name, inside in buckets.items()
    ]
    return trades.groupBy(*keys).agg(*sums, F.sum(signed).alias("net_inflow"))
