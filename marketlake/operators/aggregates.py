"""Watermarks, last values, keep-last and distinct.

All of them combine on the map side, so a key that holds a large share of the rows
reaches its reducer already reduced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from marketlake.operators import joins


def watermark(df: DataFrame, column: str, default: str, kind: str = "date") -> DataFrame:
    """One row: the highest value, or the default for an empty table."""
    return df.agg(F.coalesce(F.max(column), F.lit(default).cast(kind)).alias("watermark"))


def keyed_watermark(
    universe: DataFrame, stored: DataFrame, key: str, column: str, default: Column
) -> DataFrame:
    """Highest value per key of the universe; keys with no stored row get the default."""
    marks = stored.groupBy(key).agg(F.max(column).alias("_mark"))
    return (
        universe.select(key)
        .join(marks, key, "left")
        .select(key, F.coalesce("_mark", default).alias("watermark"))
    )


def rule_watermark(
    rules: DataFrame, stored: DataFrame, equal: str, like: str, column: str, default: Column
) -> DataFrame:
    """Highest value per rule, over the stored rows that are equal in one column and contain the
    rule's text in the other; rules without such rows get the default. Rows are reduced to the few
    pairs of both columns before they meet the rules."""
    pairs = stored.groupBy(equal, like).agg(F.max(column).alias("_mark"))
    marks = joins.by_rule(pairs, rules, equal, like).groupBy(f"rule_{equal}", f"rule_{like}").agg(F.max("_mark").alias("_mark"))
    marks = marks.select(F.col(f"rule_{equal}").alias(equal), F.col(f"rule_{like}").alias(like), "_mark")
    known = rules.select(equal, like).distinct().join(marks, [equal, like], "left")
    return known.select(equal, like, F.coalesce("_mark", default).alias("watermark"))


def last_value(df: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """Latest date per key and the value at that date."""
    return df.groupBy(key).agg(
        F.max(date).alias("last_date"), F.max_by(value, date).alias("last_value")
    )


def batch_bounds(df: DataFrame, batch: Sequence[str], date: str) -> DataFrame:
    return df.groupBy(*batch).agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"))


#: Column that holds the hash of a row's key, beside the key itself.
KEY_HASH = "_key_hash"


def with_key_hash(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.withColumn(KEY_HASH, F.xxhash64(*key))


def keep_last(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key in arrival order. ``order`` must be total.

    ``row_number() = 1`` is planned with a group limit before the shuffle, so each map
    task sends at most one row per key. Rows are sorted by the key's hash first: one number tells nearly all
    keys apart, where a symbol is followed by all of its days. A frame that has the hash keeps it.
    """
    if KEY_HASH not in df.columns:
        return keep_last(with_key_hash(df, key), key, order).drop(KEY_HASH)
    arrival = Window.partitionBy(KEY_HASH, *key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rank", F.row_number().over(arrival)).filter("_rank = 1").drop("_rank")


def top_k(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First k rows per group, with the same group limit before the shuffle (Spark plans it for
    k up to ``spark.sql.optimizer.windowGroupLimitThreshold``; beyond that the result is the
    same, without the early cut)."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def count_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The frame, plus a counter that is filled by whatever action runs on it."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
