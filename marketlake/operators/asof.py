"""Keyed as-of join of two large tables: the last row of a key at or before a time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_month(time: Column) -> Column:
    return F.trunc(F.to_date(time), "month")


def keyed_asof(
    left: DataFrame,
    right: DataFrame,
    key: str,
    time: str,
    right_time: str,
    values: Sequence[str],
    order: Sequence[str] = (),
    strict: bool = False,
    slice_of: Callable[[Column], Column] = by_month,
) -> DataFrame:
    """``left`` with the values of the last right row of its key at (or, ``strict``, only before) its time.

    Both sides are cut into slices of time, and meet as one sorted union per key and slice, so that a
    hot key is spread over its slices. What a slice starts with is the last right row of the key's
    earlier slices: those are reduced to one row per key and slice before they are carried forward.
    ``order`` decides among right rows of one time. Rows without a key, a time or an earlier right
    row keep nulls; repeated left rows keep a row each. Value columns must not be named as left ones.
    """
    known = F.col(key).isNotNull() & F.col(time).isNotNull()
    value = F.struct(*values)
    source = right.filter(F.col(key).isNotNull() & F.col(right_time).isNotNull()).select(
        F.col(key).alias("_key"), F.col(right_time).alias("_at"), F.struct(*order).alias("_order") if order else F.lit(0).alias("_order"),
        value.alias("_value"),
    )
    last = source.groupBy("_key", slice_of(F.col("_at")).alias("_slice")).agg(F.max_by("_value", F.struct("_at", "_order")).alias("_last"))
    wanted = left.filter(known).select(F.col(key).alias("_key"), slice_of(F.col(time)).alias("_slice")).distinct()
    earlier = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = wanted.join(last, ["_key", "_slice"], "full").withColumn("_start", F.last("_last", ignorenulls=True).over(earlier))
    # at one time right rows come first, or last if only earlier ones count
    rows = left.filter(known).select(
        F.col(key).alias("_key"), F.col(time).alias("_at"), F.lit(0 if strict else 1).alias("_side"), F.struct(*left.columns).alias("_row")
    )
    both = rows.unionByName(source.withColumn("_side", F.lit(1 if strict else 0)), allowMissingColumns=True)
    both = both.withColumn("_slice", slice_of(F.col("_at")))
    # peers end at the current row: right rows of the same time and side are ordered among themselves
    upto = Window.partitionBy("_key", "_slice").orderBy("_at", "_side", "_order").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("_seen", F.last("_value", ignorenulls=True).over(upto)).filter("_row IS NOT NULL")
    found = seen.join(carried.select("_key", "_slice", "_start"), ["_key", "_slice"], "left")
    found = found.withColumn("_found", F.coalesce("_seen", "_start")).select("_row.*", *[F.col("_found")[v].alias(v) for v in values])
    nothing = [F.lit(None).cast(right.schema[v].dataType).alias(v) for v in values]
    return found.unionByName(left.filter(~known).select("*", *nothing))
