"""Price bars and what is derived from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from marketlake.functions import dates, numbers


#: Digits of a tick's microseconds, its id and its price in cents, together one order key.
TICK_DIGITS = (17, 12, 9)
BAR_COLUMNS = ("high", "low", "volume", "amount")


def _order_key(trades: DataFrame, order: Sequence[str], digits: Sequence[int], price: str) -> Column:
    """Order columns and, at last, the price in cents as one fixed-width key."""

    def whole(column: str) -> Column:
        kind = trades.schema[column].dataType
        if isinstance(kind, (TimestampType, TimestampNTZType)):
            return dates.micros(F.col(column), isinstance(kind, TimestampType))
        return F.col(column)

    cents = (F.col(price) * 100).cast("long")
    return numbers.packed(list(zip([*map(whole, order), cents], digits, strict=True)))


def from_trades(
    trades: DataFrame,
    keys: Sequence[Column | str],
    order: Sequence[str],
    price: str = "price",
    volume: str = "volume",
    amount: str = "amount",
    digits: Sequence[int] | None = None,
) -> DataFrame:
    """Bars per key: first and last price in ``order`` (ties go by price), extremes, sums.

    One aggregation with map-side combine; a symbol with a third of all trades still reaches
    the reducers as one partial row per bar and task. ``digits``, of each order column and of the price in
    cents, makes the order one fixed-width key, so that the combine hashes where it would sort.
    """
    if digits is None:
        key, first, last = F.struct(*order, F.col(price).alias("_price")), F.min("_tick"), F.max("_tick")
    else:
        key, first, last = _order_key(trades, order, digits, price), F.min_by(price, "_tick"), F.max_by(price, "_tick")
    grouped = trades.withColumn("_tick", key).groupBy(*keys).agg(
        first.alias("_first"),
        last.alias("_last"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.sum(volume).alias("volume"),
        F.sum(amount).alias("amount"),
    )
    names = [c for c in grouped.columns if c not in ("_first", "_last", *BAR_COLUMNS)]
    part = "._price" if digits is None else ""
    return grouped.select(
        *names,
        F.col(f"_first{part}").alias("open"),
        F.col(f"_last{part}").alias("close"),
        *BAR_COLUMNS,
    )


def rollup(bars: DataFrame, keys: Sequence[Column | str], date: str = "trade_date") -> DataFrame:
    """Coarser bars from finer ones: first open, last close, extremes, sums, last date."""
    return bars.groupBy(*keys).agg(
        F.max(date).alias("trade_date"),
        F.min_by("open", date).alias("open"),
        F.max_by("close", date).alias("close"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.sum("volume").alias("volume"),
        F.sum("amount").alias("amount"),
    )


def weekly(bars: DataFrame, key: str = "symbol") -> DataFrame:
    return rollup(bars, [key, F.trunc("trade_date", "week").alias("week_start")])


def monthly(bars: DataFrame, key: str = "symbol") -> DataFrame:
    return rollup(bars, [key, F.trunc("trade_date", "month").alias("month")])


def with_change(bars: DataFrame, key: str = "symbol", date: str = "trade_date") -> DataFrame:
    """Change, change % and amplitude % against the previous close.

    Adjusted prices can be negative: change % divides by the absolute previous close, the
    amplitude by the signed one. A symbol has one bar per date, which bounds the window.
    """
    prev = F.lag("close").over(Window.partitionBy(key).orderBy(date))
    df = bars.withColumn("prev_close", prev)
    change = F.col("close") - F.col("prev_close")
    return df.withColumns(
        {
            "change": change,
            "change_pct": numbers.percent(change, F.abs("prev_close")),
            "amplitude_pct": numbers.percent(F.col("high") - F.col("low"), F.col("prev_close")),
        }
    )


def with_turnover(bars: DataFrame, shares: DataFrame, key: str = "symbol") -> DataFrame:
    """Turnover % = volume / floating shares."""
    joined = bars.join(shares.select(key, "float_shares"), key, "left")
    return joined.withColumn("turnover_pct", numbers.percent(F.col("volume"), F.col("float_shares")))


def slots(time: Column, minutes: int = 30) -> Column:
    """Start of the tumbling window that holds the timestamp."""
    return F.window(time, f"{minutes} minutes")["start"]
