"""Places of rows in the order of their group, without a task that holds a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import fresh, staged


def ranked(rows: DataFrame, group: str, order: Sequence[Column], place: str, size: str) -> DataFrame:
    """``rows`` with their place (from 0) in the order of their group, and the group's number of rows.

    Rows are dealt to sorted ranges of (group, order), so that a hot group is spread over many tasks.
    Places are counted within a range, and the counts of a group's earlier ranges are added: one row
    per group and range. ``group`` must not be null. Rows equal in ``order`` are dealt freely and may
    take each other's place; without rows there are none.
    """
    part, tie, own, before = fresh(rows, "_range", "_tie", "_own", "_before")
    # equal rows are spread over ranges as well
    dealt = rows.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(F.col(group), *order, F.col(tie))
    dealt = staged(dealt.drop(tie).withColumn(part, F.spark_partition_id()), "ranges")
    counts = dealt.groupBy(group, part).agg(F.count(F.lit(1)).alias(own))
    ranges = Window.partitionBy(group)
    earlier = ranges.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        group, part, F.coalesce(F.sum(own).over(earlier), F.lit(0)).alias(before), F.sum(own).over(ranges).alias(size)
    )
    inside = F.row_number().over(Window.partitionBy(group, part).orderBy(*order)) - 1
    placed = dealt.withColumn(own, inside).join(offsets, [group, part])
    return placed.select(*rows.columns, (F.col(before) + F.col(own)).alias(place), size)
