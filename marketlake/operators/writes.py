"""Write modes as plans: each returns the table as it is after the write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators import aggregates, filters, joins


def append(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    return existing.unionByName(incoming)


def _range_of(df: DataFrame, column: str, bound) -> Column:
    return df.agg(bound(column)).scalar()


def absent_rows(
    existing: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    within: str | None = None,
) -> DataFrame:
    """Incoming rows with a complete key that the table does not hold, last arrival per key.

    Duplicates go first: a key that came very often is cut to one row per task before anything
    is shuffled, and the anti join then reuses that partitioning. Only key columns of the table
    are read, and with ``within`` (a key column by which the files are clustered, such as the
    date) only row groups in the incoming range.
    """
    candidates = aggregates.keep_last(aggregates.with_key_hash(filters.complete_keys(incoming, key), key), key, order)
    if within is not None:
        low, high = (_range_of(incoming, within, f) for f in (F.min, F.max))
        existing = existing.filter((F.col(within) >= low) & (F.col(within) <= high))
    if any(existing.schema[k].dataType != incoming.schema[k].dataType for k in key):
        return joins.without(candidates.drop(aggregates.KEY_HASH), existing, key)  # equal keys may hash differently
    stored = aggregates.with_key_hash(existing.select(*key), key)
    return joins.without(candidates, stored, [aggregates.KEY_HASH, *key]).drop(aggregates.KEY_HASH)


def insert_if_absent(
    existing: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    within: str | None = None,
) -> DataFrame:
    """Existing rows never change; keys that are not there yet are added."""
    return existing.unionByName(absent_rows(existing, incoming, key, order, within))


def replace_slices(existing: DataFrame, incoming: DataFrame, slice_columns: Sequence[str]) -> DataFrame:
    """Slices named by the incoming rows are replaced whole; all other slices stay."""
    slices = incoming.select(*slice_columns).distinct()
    return existing.join(slices, list(slice_columns), "left_anti").unionByName(incoming)


def replace_where(existing: DataFrame, incoming: DataFrame, slice_filter: Column) -> DataFrame:
    """Rows that satisfy the slice filter give way to the incoming rows.

    A row for which the filter is null is outside the slice, as in a SQL DELETE.
    """
    kept = existing.filter(~F.coalesce(slice_filter, F.lit(False)))
    return kept.unionByName(incoming)


def replace_like(existing: DataFrame, incoming: DataFrame, equal: str, like: str, rules: DataFrame | None = None) -> DataFrame:
    """Slices are equal in one column and contained in the other: a rule replaces all stored boards
    of its exchange whose name contains its text.

    Rules without an incoming row replace nothing. Without ``rules`` every incoming pair is one. Both sides
    are reduced to their few pairs before they meet, and rows join on both columns.
    """
    arrived = incoming.select(equal, like).distinct()
    if rules is not None:
        fit = joins.by_rule(arrived, rules, equal, like)
        arrived = fit.select(F.col(f"rule_{equal}").alias(equal), F.col(f"rule_{like}").alias(like))
    replaced = joins.by_rule(existing.select(equal, like).distinct(), arrived, equal, like).select(equal, like).distinct()
    return existing.join(replaced, [equal, like], "left_anti").unionByName(incoming)


def replace_range(
    existing: DataFrame,
    incoming: DataFrame,
    key: str,
    date: str,
    low: str,
    high: str,
    inclusive: bool = True,
) -> DataFrame:
    """Per incoming key, the date range is replaced; other keys and dates stay.

    ``inclusive=False`` leaves the rows on both bounds alone, so a year's last quarter end
    would survive next to its re-loaded copy.
    """
    inside = F.col(date).between(low, high)
    if not inclusive:
        inside = (F.col(date) > low) & (F.col(date) < high)
    touched = incoming.select(F.col(key).alias("_key")).distinct()
    kept = existing.join(touched, (F.col(key) == F.col("_key")) & inside, "left_anti")
    return kept.unionByName(incoming)


def replace_snapshot(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """The incoming snapshot, or the existing rows if it is empty.

    The guard is a one-row scalar subquery, evaluated before the existing rows are read on.
    """
    arrived = incoming.limit(1).agg((F.count(F.lit(1)) > 0).alias("arrived"))
    return existing.filter(~arrived.scalar()).unionByName(incoming)


def update_parent_date(
    parent: DataFrame, child: DataFrame, key: str, child_date: str, column: str, fallback: Column
) -> DataFrame:
    """Parent rows with ``column`` set to their latest child date, or to ``fallback`` when no
    child row came."""
    latest = child.groupBy(key).agg(F.max(child_date).alias("_latest"))
    return (
        parent.join(latest, key, "left")
        .withColumn(column, F.coalesce("_latest", fallback))
        .drop("_latest")
    )


def reset_parent_date(parent: DataFrame, column: str) -> DataFrame:
    """All parents start over, as after a rebuild of the child table."""
    return parent.withColumn(column, F.lit(None).cast("date"))
